"""Near-duplicates by SimHash, compared at the anchors of a covering code.

Two fingerprints of 64 bits that differ in at most two bits differ in at most one bit of the low
or of the high 31-bit block (bits 0-30 and 32-62; bits 31 and 63 are left to the final comparison).
The anchors of a block are the code words of the perfect Hamming code of length 31: every block
value lies within covering radius 1 of exactly one of them, its home. A fingerprint is replicated
to every anchor within covering radius plus threshold, 1 + 1 = 2 bits, of each block: 15 or 16
anchors. If x and y differ in at most one bit of the block, the home of x is within two bits of y,
so the pair meets at the home of the smaller fingerprint and is compared there. There are 2^26
anchors per block, so the rows that meet at an anchor stay few as the corpus grows.

Copies share a fingerprint and are reduced to it before the comparison; no group is expanded into
pairs. Links become components by passing the smallest label along (``components``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T
from xxhash import xxh64_intdigest

from pledgemart.llm.common import limit_batches, pick, stage
from pledgemart.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
#: The threshold of a whole fingerprint, and of one of its two blocks.
MOST_BITS = 2
BLOCK_BITS = 31
_digest = partial(xxh64_intdigest, seed=SEED)


def fingerprint_of(text: str | bytes | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash of one text as an unsigned number; a text without words (or none) has 0."""
    raw = text.encode() if isinstance(text, str) else text or b""
    tokens = raw.lower().split()  # of bytes: lowers A-Z only and splits at space and \x09-\x0d
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    ones = np.zeros(64, np.int64)
    count = 0
    hashes = np.fromiter(map(_digest, shingles), np.uint64)
    for start in range(0, len(hashes), 1 << 16):  # a very long text is unpacked in parts
        part = hashes[start : start + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        count += len(part)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, ``row_key`` (unique) and ``fp`` (64 bits as a signed long) of each row.

    ``row_key`` holds the partition's number and the row's place in it: stage the result before
    reading it twice. A null text counts as empty.
    """
    docs = pick(docs, *keep, *([] if text in keep else [text]))
    place = docs.columns.index(text)
    limit_batches(docs.sparkSession)
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("row_key", T.LongType()), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column(place)
            fps = np.fromiter((fingerprint_of(t.as_py(), words) for t in texts), np.uint64, len(texts))
            keys = np.arange(key, key + len(texts), dtype=np.int64)
            key += len(texts)
            columns = [*(batch.column(i) for i in range(len(keep))), pa.array(keys), pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return docs.mapInArrow(run, schema)


def _block(fp: Column, block: int) -> Column:
    return F.shiftrightunsigned(fp, 32 * block).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def _syndrome(value: Column) -> Column:
    """0 for a code word, else the number (from 1) of the bit whose flip leads to the home."""
    out = F.lit(0)
    for k in range(5):
        covered = sum(1 << i for i in range(BLOCK_BITS) if (i + 1) >> k & 1)
        out = out + (F.bit_count(value.bitwiseAND(F.lit(covered))) % 2) * (1 << k)
    return out


def _anchors(fp: Column, block: int) -> Column:
    """All code words within two bits, the home first.

    Flipping bits i and j reaches a code word if i XOR j is the syndrome; a code word has no other
    within two bits.
    """
    def flipped(value: Column, bit: Column) -> Column:
        return value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit - 1).cast("int")))

    def both(value: Column, s: Column) -> Column:
        home = F.when(s == 0, value).otherwise(flipped(value, F.greatest(s, F.lit(1))))
        firsts = F.filter(F.sequence(F.lit(1), F.lit(BLOCK_BITS)), lambda i: (s != 0) & (i != s) & (i < i.bitwiseXOR(s)))
        return F.concat(F.array(home), F.transform(firsts, lambda i: flipped(flipped(value, i), i.bitwiseXOR(s))))

    value = _block(fp, block)
    return F.transform(F.array(F.struct(value.alias("v"), _syndrome(value).alias("s"))), lambda x: both(x.v, x.s))[0]


def links(fps: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints that differ in at most ``most_bits`` (2 or fewer) bits.

    ``fps`` has distinct, non-null values in ``fp``. Every pair comes once. Spark sizes the exploded anchors like the
    fingerprints, a thirtieth of what they are, so the join sorts both sides at every size and broadcasts neither.
    """
    if not 0 <= most_bits <= MOST_BITS:
        raise ValueError("the anchors cover two differing bits at most")
    placed = [fps.select("fp", F.lit(b).alias("block"), F.posexplode(_anchors(F.col("fp"), b)).alias("place", "anchor")) for b in (0, 1)]
    placed = placed[0].union(placed[1])
    near = placed.select("block", "anchor", F.col("fp").alias("b"))
    home = placed.filter("place = 0").select("block", "anchor", F.col("fp").alias("a"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    # A pair belongs to the low block if it differs there in one bit at most, else to the high one.
    block = F.when(F.bit_count(_block(differ, 0)) <= 1, 0).otherwise(1)
    return (
        home.hint("merge").join(near.hint("merge"), ["block", "anchor"])
        .filter((F.col("a") < F.col("b")) & (F.bit_count(differ) <= most_bits) & (F.col("block") == block))
        .select("a", "b")
    )


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS, text: str = "text") -> DataFrame:
    """One row per document row: ``doc_id``, ``row_key``, ``fp``, ``component_id``.

    ``component_id`` is the smallest ``doc_id`` of all rows reachable over links; rows with a null id
    link like others but give no smallest id (null if no id is reachable). Repeated rows are linked.
    An empty table gives no row. Other columns of ``docs`` may have any name; they are not read.
    """
    rows = stage(fingerprints(docs, words, text))
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(stage(links(distinct.select("fp"), most_bits)))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    # Hardly any root has many fingerprints, and a fingerprint comes once: neither side has a hot row.
    by_fp = named.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "row_key", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS, text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of its smallest ``doc_id``, of equal ids any one.

    Rows without an id come last. The rows are kept whole, from a staged copy that fixes their keys.
    """
    columns = docs.columns
    plain = docs.toDF(*(f"_{i}" for i in range(len(columns))))
    doc_id, body = f"_{columns.index('doc_id')}", f"_{columns.index(text)}"
    keyed = stage(fingerprints(plain, words, body, keep=tuple(plain.columns)))
    order = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("doc_id"), "row_key")
    distinct = stage(keyed.groupBy("fp").agg(F.min(order).alias("first")))
    roots = components(stage(links(distinct.select("fp"), most_bits)))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("fp", "first", F.coalesce("root", "fp").alias("group"))
    kept = named.groupBy("group").agg(F.min("first").alias("kept"))
    by_fp = named.select("fp", "group").join(kept, "group").select("fp", F.col("kept.row_key").alias("kept_key"))
    # Only keys are moved to find the rows that go. They are staged so that their size is known
    # when Spark chooses how to take them out of the texts.
    gone = stage(keyed.select("row_key", "fp").join(by_fp, "fp").filter("row_key != kept_key").select("row_key"))
    return keyed.join(gone, "row_key", "left_anti").select(*plain.columns).toDF(*columns)
