import math

import public_tokenizers
import pytest
import tiktoken

from pledgemart.llm import bpe, token_totals

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TRUE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@pytest.mark.parametrize("name", ["given", "awkward"])
def test_sums_match_brute_force(spark, documents, awkward, name):
    docs = documents if name == "given" else awkward
    place = docs.columns.index("text")
    sizes = [len(TRUE.encode_ordinary(r[place] or "")) for r in docs.collect()]
    sums = token_totals.with_sums(token_totals.histogram(docs, PATH, public_tokenizers.PATTERN)).cache()
    rows = sums.collect()
    assert sorted(r.length for r in rows) == sorted(set(sizes))
    for r in rows:
        n = r.length
        assert r.docs == sizes.count(n) and r.tokens == n * r.docs
        assert r.docs_shorter == sum(s < n for s in sizes) and r.tokens_shorter == sum(s for s in sizes if s < n)
        assert r.docs_longer == sum(s > n for s in sizes) and r.tokens_longer == sum(s for s in sizes if s > n)
        assert r.tokens_cut == sum(min(s, n) for s in sizes)
    limits = [0, 1, 7, 100, 1024, 5000, 10**9]
    assert token_totals.cut_totals(sums, limits) == {c: sum(min(s, c) for s in sizes) for c in limits}
    shares = [0.01, 0.25, 0.5, 0.9, 1.0]
    assert token_totals.quantiles(sums, shares) == {q: sorted(sizes)[math.ceil(q * len(sizes)) - 1] for q in shares}


def test_empty_table(spark, documents):
    sums = token_totals.with_sums(token_totals.histogram(documents.limit(0), PATH, public_tokenizers.PATTERN))
    assert sums.count() == 0
    assert token_totals.cut_totals(sums, [5]) == {5: 0} and token_totals.quantiles(sums, [0.5]) == {0.5: None}
