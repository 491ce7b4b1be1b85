"""Comment text: cleaning, sentiment, keyword groups, questions."""

from __future__ import annotations

import html
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from pledgemart import fixed_values as fv
from pledgemart.functions.lexicon import groups_found, weighed_hits

#: Lexicons of more words are looked for in one pass over the text.
MANY_WORDS = 64


@dataclass(frozen=True)
class Lexicon:
    """Words the rule-based scoring looks for; ``lower`` matches on lower-cased text."""

    positive: list[str] = field(default_factory=lambda: list(fv.POSITIVE_KEYWORDS))
    negative: list[str] = field(default_factory=lambda: list(fv.NEGATIVE_KEYWORDS))
    groups: dict[str, list[str]] = field(default_factory=lambda: dict(fv.KEYWORD_GROUPS))
    lower: bool = False

    def haystack(self, text: Column) -> Column:
        return F.lower(text) if self.lower else text


DEFAULT_LEXICON = Lexicon()


def _unescape_udf():
    # Defined locally, so that it travels by value and workers need no copy of this package.
    def unescape(text: pd.Series) -> pd.Series:
        return text.map(html.unescape, na_action="ignore")

    return F.pandas_udf(unescape, StringType())


def unescape_entities(text: Column) -> Column:
    """Text without '&' never reaches Python: it is sent as NULL and taken from the JVM side."""
    return F.coalesce(_unescape_udf()(F.when(F.contains(text, F.lit("&")), text)), text)


def strip_markup(text: Column) -> Column:
    """Tags, control characters and runs of whitespace become one space; ends trimmed; NULL becomes ''."""
    text = F.regexp_replace(text, fv.TAG_PATTERN, " ")
    text = F.regexp_replace(text, fv.CONTROL_PATTERN, " ")
    text = F.regexp_replace(text, r"(?U)\s+", " ")
    return F.coalesce(F.trim(text), F.lit(""))


def clean_text(text: Column) -> Column:
    return strip_markup(unescape_entities(text))


def _hits(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.contains(text, F.lit(w)).cast("int") for w in words], F.lit(0))


def sentiment_balance(text: Column, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """Number of positive words found minus number of negative words found."""
    hay = lexicon.haystack(text)
    if len(lexicon.positive) + len(lexicon.negative) > MANY_WORDS:
        return weighed_hits(hay, [*((w, 1) for w in lexicon.positive), *((w, -1) for w in lexicon.negative)])
    return _hits(hay, lexicon.positive) - _hits(hay, lexicon.negative)


def sentiment_label(balance: Column) -> Column:
    return F.when(balance > 0, "positive").when(balance < 0, "negative").otherwise("neutral")


def sentiment_score(balance: Column) -> Column:
    return F.signum(balance).cast("bigint")


def keyword_groups(text: Column, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """Comma-joined names of the groups with a word in the text, in rule order."""
    hay = lexicon.haystack(text)
    if sum(map(len, lexicon.groups.values())) > MANY_WORDS:
        return groups_found(hay, lexicon.groups)
    return F.concat_ws(
        ",",
        *[
            F.when(reduce(or_, [F.contains(hay, F.lit(w)) for w in words]), F.lit(group))
            for group, words in lexicon.groups.items()
        ],
    )


def is_question(text: Column) -> Column:
    return F.coalesce(text.rlike(fv.QUESTION_PATTERN), F.lit(False))


def content_length(text: Column) -> Column:
    return F.length(text).cast("bigint")
