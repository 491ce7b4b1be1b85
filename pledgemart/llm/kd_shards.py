"""Shards by k-d tree partitioning over document metadata.

The tree splits a set of documents, again and again, at a weighted median along its widest metadata
dimension. A node stands for a number of shards; it gives half of them (rounded) to its lower side,
and the split lies where that side has the same share of the bytes. So the leaves come out with
nearly equal bytes for any number of shards; with a target size instead of a number, the number is
what the target asks for.

Dimensions are numbers from 0 to 1: source, language, length and id. The number of a source or language
is its place among the bytes of all, in the order of the whole texts. Ties within a dimension are
broken by a hash, so a split can go through a value that a third of all rows share. A weighted
median is found by counting bytes in 1,024 bins of every node's range, then again within the bin
that holds it, until the bin is as good as one document. Each round is one aggregation over the
narrow metadata rows; what comes to the driver is a row per node. What is known of the nodes goes back as
arrays that a row's node is the index of, so expressions do not grow with the shards.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, functions as F

from pledgemart.llm.common import pick, stage

OVERHEAD_BYTES = 16
DIMENSIONS = ("source", "lang", "length", "id")
#: A dimension is a whole number of DIM_BITS, followed by TIE_BITS of hash: one key to split at.
DIM_BITS, TIE_BITS, BIN_BITS = 24, 32, 10
KEY_BITS = DIM_BITS + TIE_BITS
#: A split may be off by this share of a shard's bytes.
TOLERANCE = 1 / 2000


def metadata(docs: DataFrame, overhead: int = OVERHEAD_BYTES) -> DataFrame:
    """doc_id, size, text_crc32, uid, tie and the value of each dimension: text for source and lang, else a number."""
    there = [c for c in ("source", "lang") if c in docs.columns]
    rows = pick(docs, "doc_id", "text", *there)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    made = {c: (F.col(c) if c in there else F.lit(None)).cast("string") for c in ("source", "lang")}
    rows = rows.select(
        "doc_id", (size + overhead).alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("uid"), *(v.alias(k) for k, v in made.items()),
    )
    # Repeated rows differ in the last bits of the tie only, so that they can be dealt out as well.
    tie = F.xxhash64("doc_id", "text_crc32").bitwiseAND(F.lit(0xFFFF)) * (1 << 16) + F.xxhash64("uid").bitwiseAND(F.lit(0xFFFF))
    place = F.col("doc_id").try_cast("double")
    return rows.select(
        "doc_id", "size", "text_crc32", "uid", tie.alias("tie"), "source", "lang",
        F.log2(F.col("size").cast("double")).alias("length"), F.coalesce(place, F.lit(0.0)).alias("id"),
    )


def _text_places(rows: DataFrame, name: str) -> DataFrame:
    """A row per distinct text of the column, null first in order: ``{name}_text`` and its place.

    The place is the middle of its bytes in the order of whole texts, as a share of all bytes. Texts are
    summed up within ranges of the order, each offset by the ranges before, so many texts do no harm.
    """
    texts = rows.groupBy(F.col(name).alias("t")).agg(F.sum("size").alias("w"))
    texts = stage(texts.orderBy(F.asc_nulls_first("t")).withColumn("range", F.spark_partition_id()))
    before, total = {}, 0
    for r in sorted(texts.groupBy("range").agg(F.sum("w").alias("w")).collect()):  # one row per partition of the sort
        before[r.range] = total
        total += r.w
    start = F.lit(0).cast("bigint")
    if before:
        start = F.get(F.from_json(F.lit(json.dumps([before.get(i, 0) for i in range(max(before) + 1)])), "array<bigint>"), F.col("range"))
    within = F.expr("sum(w) OVER (PARTITION BY range ORDER BY t NULLS FIRST ROWS UNBOUNDED PRECEDING)")
    # Staged, so that its size is known when Spark chooses how to join it.
    return stage(texts.select(F.col("t").alias(f"{name}_text"), ((start + within - F.col("w") / 2) / F.lit(float(max(1, total)))).alias("place")))


def _placed(rows: DataFrame) -> DataFrame:
    """The rows with numbers for source and lang."""
    for name in ("source", "lang"):
        places = _text_places(rows, name)
        rows = rows.withColumnRenamed(name, f"{name}_row").join(places, F.col(f"{name}_row").eqNullSafe(F.col(f"{name}_text")))
        rows = rows.withColumnRenamed("place", name).drop(f"{name}_row", f"{name}_text")
    return rows


def _keys(rows: DataFrame) -> DataFrame:
    """The rows with one key per dimension: its value scaled to DIM_BITS, then the tie."""
    ends = rows.agg(*(f(d).alias(f"{n}_{d}") for d in DIMENSIONS for n, f in (("lo", F.min), ("hi", F.max)))).first()
    top = (1 << DIM_BITS) - 1

    def key(d: str) -> Column:
        lo, hi = ends[f"lo_{d}"] or 0.0, ends[f"hi_{d}"] or 0.0
        scaled = F.floor((F.col(d) - lo) / (hi - lo) * top) if hi > lo else F.lit(0)
        return (scaled.cast("bigint") * (1 << TIE_BITS) + F.col("tie")).alias(f"k_{d}")

    return rows.select("doc_id", "size", "text_crc32", "uid", F.lit(0).alias("node"), *(key(d) for d in DIMENSIONS))


class _Node:
    def __init__(self, first: int, shards: int):
        self.first, self.shards = first, shards

    def split(self) -> tuple["_Node", "_Node"]:
        low = self.shards // 2
        return _Node(self.first, low), _Node(self.first + low, self.shards - low)


def _spreads(rows: DataFrame) -> dict[int, tuple[str, float]]:
    """The widest dimension of every node (by byte-weighted standard deviation), and the node's bytes."""
    w = F.col("size").cast("double")
    x = {d: F.shiftright(f"k_{d}", TIE_BITS).cast("double") / (1 << DIM_BITS) for d in DIMENSIONS}
    sums = [F.sum(w).alias("w"), *(F.sum(w * v).alias(f"s_{d}") for d, v in x.items()), *(F.sum(w * v * v).alias(f"q_{d}") for d, v in x.items())]
    out = {}
    for r in rows.groupBy("node").agg(*sums).collect():
        spread = {d: r[f"q_{d}"] / r.w - (r[f"s_{d}"] / r.w) ** 2 for d in DIMENSIONS}
        out[r.node] = max(DIMENSIONS, key=lambda d: spread[d]), r.w
    return out


def _of_node(values: dict[int, float], kind: str = "bigint") -> Column:
    """What ``values`` has for a row's node, NULL if nothing."""
    first, last = (min(values), max(values)) if values else (0, -1)
    known = F.from_json(F.lit(json.dumps([values.get(n) for n in range(first, last + 1)])), f"array<{kind}>")
    return F.get(known, (F.col("node") - first).cast("int"))


def _chosen(by_node: dict[int, str]) -> Column:
    """Each row's key in the dimension of its node."""
    place = _of_node({node: DIMENSIONS.index(d) for node, d in by_node.items()}, "int")
    return F.get(F.array(*(f"k_{d}" for d in DIMENSIONS)), place)


def _cuts(rows: DataFrame, wide: dict[int, tuple[str, float]], shares: dict[int, float], tolerance: float) -> dict[int, int]:
    """For every node the key below which its share of bytes lies."""
    keyed = rows.select("node", "size", _chosen({n: wide[n][0] for n in shares}).alias("key"))
    want = {n: wide[n][1] * shares[n] for n in shares}
    # The range (low, bits) that holds the cut, and the bytes below it.
    low, below, bits, open_ = dict.fromkeys(shares, 0), dict.fromkeys(shares, 0.0), KEY_BITS, set(shares)
    cuts: dict[int, int] = {}
    while open_ and bits > 0:
        step = min(BIN_BITS, bits)
        bits -= step
        start = _of_node({n: low[n] for n in open_})
        held = keyed.withColumn("at", F.col("key") - start).filter(F.col("at").between(0, (1 << bits + step) - 1))
        bins = held.groupBy("node", F.shiftright("at", bits).alias("bin")).agg(F.sum("size").alias("w"))
        # As many bins per node as BIN_BITS allow.
        bins = bins.withColumn("upto", F.expr("sum(w) OVER (PARTITION BY node ORDER BY bin)"))
        rest = _of_node({n: want[n] - below[n] for n in open_}, "double")
        crossed = F.when(F.col("upto") > rest, F.struct("bin", "w", "upto"))
        found = {r.node: r.crossed for r in bins.groupBy("node").agg(F.min(crossed).alias("crossed")).collect()}
        for n in list(open_):
            held_by = found.get(n)
            if held_by is None:  # all bins lie below: cut behind them
                cuts[n] = low[n] + (1 << bits + step)
                open_.discard(n)
                continue
            below[n] += held_by.upto - held_by.w
            low[n] += held_by.bin << bits
            before, behind = want[n] - below[n], below[n] + held_by.w - want[n]
            if min(before, behind) <= tolerance or bits == 0:
                cuts[n] = low[n] + ((1 << bits) if before > behind else 0)
                open_.discard(n)
    return cuts


def assign(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, overhead: int = OVERHEAD_BYTES) -> DataFrame:
    """doc_id, size, text_crc32, shard (from 0), slot (from 0, without gaps, per shard) of every row.

    Give the number of shards, or the bytes a shard should have. Null texts have no bytes beyond
    ``overhead`` and the checksum of the empty text; null metadata sorts first, and so do ids that are no
    numbers; a very long text is one row of its size; repeated rows are dealt out like others; an empty table gives no
    rows.
    """
    rows = stage(metadata(docs, overhead))
    total = rows.agg(F.sum("size")).first()[0] or 0
    if shards is None:
        shards = max(1, math.ceil(total / target_bytes))
    rows = stage(_keys(_placed(rows)))
    nodes = {0: _Node(0, shards)}
    next_id = 1
    while total and any(node.shards > 1 for node in nodes.values()):
        wide = _spreads(rows)
        split = {n: node for n, node in nodes.items() if node.shards > 1 and n in wide}
        if not split:
            break
        shares = {n: (node.shards // 2) / node.shards for n, node in split.items()}
        cuts = _cuts(rows, wide, shares, TOLERANCE * total / shards)
        lower = {}
        for n, node in split.items():
            nodes.pop(n)
            lower[n] = next_id
            nodes[next_id], nodes[next_id + 1] = node.split()
            next_id += 2
        upper = (_chosen({n: wide[n][0] for n in split}) >= _of_node(cuts)).cast("int")
        moved = F.coalesce((_of_node(lower) + upper).cast("int"), F.col("node"))
        # Each level is written: the expressions of all levels would grow into one another.
        rows = stage(rows.withColumn("node", moved))
    shard = _of_node({n: node.first for n, node in nodes.items()}, "int")
    return _slots(rows.select("doc_id", "size", "text_crc32", "uid", shard.cast("int").alias("shard")))


def _slots(rows: DataFrame) -> DataFrame:
    """Numbers the rows of each shard in groups, each offset by the rows of those before.

    With the square root of all rows as the number of groups, neither a group nor the list of a
    shard's groups grows faster than that root.
    """
    groups = max(1, math.isqrt(rows.count()))
    part = F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int")
    rows = rows.withColumn("part", part)
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = counts.select("shard", "part", (F.expr("sum(n) OVER (PARTITION BY shard ORDER BY part)") - F.col("n")).alias("before"))
    within = F.expr("row_number() OVER (PARTITION BY shard, part ORDER BY doc_id, text_crc32, uid)") - 1
    return rows.withColumn("within", within).join(before, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("within")).cast("bigint").alias("slot")
    )
