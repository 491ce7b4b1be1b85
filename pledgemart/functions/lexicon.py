"""Which of thousands of words a text contains, told in one pass over the text.

The words become one pattern, a trie, that finds at every place of a text the longest word which begins there. Any
shorter word at that place is a beginning of it, so beginnings that are words themselves complete the answer, also
where words overlap. Where a place of the trie has many branches, these are halved by ranges of characters. So the
time per text hardly depends on the number of words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

#: Branches that are tried one after another.
_BRANCHES = 4
_END = ""


def trie_pattern(words: Iterable[str]) -> str:
    """A pattern of the longest word at a place, without a group of its own; empty words are left out."""
    root: dict = {}
    for word in words:
        node = root
        for sign in word:
            node = node.setdefault(sign, {})
        if word:
            node[_END] = {}
    return _pattern(root)


def _sign(sign: str) -> str:
    return rf"\x{{{ord(sign):x}}}"


def _pattern(node: dict) -> str:
    branches = sorted(sign for sign in node if sign != _END)
    if not branches:
        return "" if _END in node else "(?!)"
    return f"(?:{_branches(node, branches)})" + ("?" if _END in node else "")


def _branches(node: dict, signs: list[str]) -> str:
    if len(signs) <= _BRANCHES:
        return "|".join(_sign(s) + _pattern(node[s]) for s in signs)
    low, high = signs[: len(signs) // 2], signs[len(signs) // 2 :]
    return f"(?=[{_sign(low[0])}-{_sign(low[-1])}])(?:{_branches(node, low)})|(?:{_branches(node, high)})"


def _beginnings(text: Column, words: Iterable[str]) -> Column:
    """All words found in the text, among other beginnings of them, once each; NULL for NULL."""
    longest = F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?=({trie_pattern(words)}))"), F.lit(1)))
    cut = lambda word: F.transform(F.sequence(F.lit(1), F.length(word)), lambda n: word.substr(F.lit(1), n))
    return F.array_distinct(F.flatten(F.transform(longest, cut)))


def weighed_hits(text: Column, weights: Iterable[tuple[str, int]]) -> Column:
    """Sum of the weights of the (word, weight) pairs whose word is in the text; an empty word is in every text."""
    total: Counter = Counter()
    for word, weight in weights:
        total[word] += weight
    of_weight: dict[int, list[str]] = {}
    for word, weight in total.items():
        if word and weight:
            of_weight.setdefault(weight, []).append(word)

    def add(so_far: Column, word: Column) -> Column:
        for weight, some in of_weight.items():
            so_far = so_far + F.when(word.isin(some), weight).otherwise(0)
        return so_far

    return F.aggregate(_beginnings(text, total), F.lit(total[""]), add)


def groups_found(text: Column, groups: Mapping[str, Iterable[str]]) -> Column:
    """Comma-joined names of the groups with a word in the text, in their order; '' for NULL."""
    groups = {name: list(words) for name, words in groups.items()}

    def names(found: Column) -> Column:
        has = lambda words: found.isNotNull() if "" in words else F.exists(found, lambda word: word.isin(words))
        return F.concat_ws(",", *(F.when(has(words), F.lit(name)) for name, words in groups.items()))

    # Bound by the lambda, so that the text is searched once for all groups.
    return F.get(F.transform(F.array(_beginnings(text, {w for words in groups.values() for w in words})), names), F.lit(0))
