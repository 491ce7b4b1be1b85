"""Token counts from an exact histogram of encoded lengths.

Documents are counted by encoded length. With the sums over all longer and over all shorter ones
beside each length, the histogram answers totals, quantiles, and the tokens that are left if every
document is cut at a limit, for every limit, without looking at a document again:

    left at limit c = tokens of documents up to c + c * documents longer than c

The sums run within blocks of lengths and over the totals of a fixed number of blocks. The histogram is
written before it is read twice, so that texts are encoded once, and its quantiles make blocks of like size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pledgemart.llm.bpe import token_counts
from pledgemart.llm.common import stage

BLOCKS = 64


def histogram(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """length, docs: how many rows of ``docs`` (doc_id, text) have so many tokens.

    Null and empty texts have length 0; repeated rows count each; an empty table has no lengths.
    """
    counts = token_counts(docs, path, pattern)
    return counts.groupBy(F.col("n_tokens").alias("length")).agg(F.count("*").alias("docs"))


def with_sums(hist: DataFrame) -> DataFrame:
    """``hist`` (length, docs) with running sums per length.

    tokens (of this length), docs_shorter, tokens_shorter, docs_longer, tokens_longer, and
    tokens_cut: the tokens left in all if documents are cut at this length.
    """
    hist = stage(hist.select("length", "docs"))
    borders = hist.agg(F.percentile_approx("length", [n / BLOCKS for n in range(1, BLOCKS)])).first()[0] or []
    block = F.size(F.filter(F.array(*map(F.lit, borders)), lambda b: b < F.col("length")))
    rows = hist.select("length", "docs", (F.col("length") * F.col("docs")).alias("tokens"), block.alias("block"))
    blocks = rows.groupBy("block").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    up, down = Window.orderBy("block"), Window.orderBy(F.desc("block"))
    total = lambda c, order: (F.sum(c).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col(c))
    blocks = blocks.select("block", *(total(c, o).alias(f"{c}_{n}") for c in ("docs", "tokens") for n, o in (("before", up), ("behind", down))))
    inner_up = Window.partitionBy("block").orderBy("length")
    inner_down = Window.partitionBy("block").orderBy(F.desc("length"))
    out = rows.join(blocks, "block")
    sums = {
        f"{c}_{n}": F.col(f"{c}_{b}") + total(c, o)
        for c in ("docs", "tokens") for n, b, o in (("shorter", "before", inner_up), ("longer", "behind", inner_down))
    }
    out = out.withColumns(sums).select("length", "docs", "tokens", *sums)
    return out.withColumn("tokens_cut", F.col("tokens_shorter") + F.col("tokens") + F.col("length") * F.col("docs_longer"))


def cut_totals(sums: DataFrame, limits: list[int]) -> dict[int, int]:
    """The tokens left for each limit, also one between the lengths that occur (0 without documents)."""
    if not limits:
        return {}
    at = lambda c: F.max(F.when(F.col("length") <= c, F.struct("length", F.col("tokens_shorter") + F.col("tokens"), "docs_longer")))
    found = sums.agg(F.sum("docs"), *(at(c) for c in limits)).first()
    return {c: (0 if not found[0] else c * found[0] if row is None else row[1] + c * row[2]) for c, row in zip(limits, found[1:], strict=True)}


def quantiles(sums: DataFrame, shares: list[float]) -> dict[float, int | None]:
    """For each share the smallest length that at least that share of documents does not exceed."""
    if not shares:
        return {}
    upto = F.col("docs_shorter") + F.col("docs")
    n = F.col("docs_shorter") + F.col("docs") + F.col("docs_longer")
    found = sums.agg(*(F.min(F.when(upto >= F.ceil(F.lit(s) * n), F.col("length"))) for s in shares)).first()
    return dict(zip(shares, found, strict=True))
