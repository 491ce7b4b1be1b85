"""Benchmark decontamination by winnowing.

Of every ``span - k + 1`` consecutive k-grams of words a text keeps those with the smallest hash
(all of equal smallest). Two texts that share ``span`` words share such a window whole, so both keep
the same k-grams of it: every shared span of that length has a fingerprint in common. The
fingerprints of documents and benchmark items are joined, and each hit is extended word by word to
both sides; runs of at least ``span`` words count. An item shorter than ``span`` words is one window
of its own length; for each length that occurs, k is that length and every k-gram is kept.

Documents drop the fingerprints that no item has before anything is shuffled: they are looked up in
a Bloom filter of fixed size, which a larger benchmark only makes less sharp. A fingerprint carries
the few words around it that an extension can need, so no text is moved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pledgemart.llm.common import byte_slices, limit_batches, mix, pick, span_hashes, stage, text_bytes

SPAN = 10
GRAM = 5
FILTER_BITS = 23
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of words: digits, letters, and every byte of a code point beyond ASCII.
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Words:
    """The words of a run of texts: their bytes in lower case, bounds, and each text's first word."""

    def __init__(self, column: pa.Array):
        data, offsets = text_bytes(column)
        inside = _IS_WORD[data]
        before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
        after = np.concatenate([inside[1:], [False]]) if len(data) else inside
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        before[inner] = False  # a text that begins here continues no word
        after[inner - 1] = False
        self.data = _LOWER[data]
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def text(self, start: int, end: int) -> list[str]:
        return [self.data[self.starts[i] : self.ends[i]].tobytes().decode("utf-8", "replace") for i in range(start, end)]


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k words from each place on, as far as there are k."""
    out = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[j : j + len(out)]
    return mix(out + np.uint64(k))


def winnow(words: Words, hashes: np.ndarray, k: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (of a gram's first word) and hashes of the grams kept: the smallest of each window.

    A window is the grams of ``span`` words of one text. All of equal smallest hash are kept.
    """
    grams = gram_hashes(hashes, k)
    width = span - k + 1
    whole = np.zeros(len(grams), bool)  # windows that begin here lie within one text
    if len(grams) >= width:
        ends = np.repeat(words.first[1:], words.counts)[: len(grams)]
        whole = np.arange(len(grams)) + span <= ends
    if not whole.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    size = len(grams) - width + 1
    least = grams[:size].copy()
    for j in range(1, width):
        np.minimum(least, grams[j : j + size], out=least)
    kept = np.zeros(len(grams), bool)
    whole = whole[:size]
    for j in range(width):
        kept[j : j + size] |= whole & (grams[j : j + size] == least)
    places = np.flatnonzero(kept)
    return places, grams[places]


def _bit_places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


_GRAM = T.StructType([
    T.StructField("h", T.LongType()),
    T.StructField("n", T.IntegerType()),  # length of the gram, in words
    T.StructField("at", T.LongType()),  # place of its first word in the text
    T.StructField("left", T.IntegerType()),  # words given before it
    T.StructField("words", T.ArrayType(T.StringType())),
])


def _fingerprint(df: DataFrame, key: str, span: int, k: int, short: list[int] | None, bloom, bits: int) -> DataFrame:
    """(row_key, key, n_words, grams) of each row of ``df`` (key, text).

    ``short``: the lengths of short windows to look for in documents; None for items, where the
    length decides. ``bloom``: the filter that a document's fingerprints must pass.
    """
    schema = T.StructType([
        T.StructField("row_key", T.LongType()), df.schema[key], T.StructField("n_words", T.LongType()),
        T.StructField("grams", T.ArrayType(_GRAM)),
    ])
    arrow = pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int32()), ("at", pa.int64()), ("left", pa.int32()), ("words", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        known = None if bloom is None else np.frombuffer(bloom.value, np.uint8)
        for batch in (part for whole in batches for part in byte_slices(whole, "text")):
            words = Words(batch.column(1))
            hashes = span_hashes(words.data, words.starts, words.ends)
            lengths = words.counts
            parts = [(k, *winnow(words, hashes, k, span))]
            for n in range(1, span) if short is None else short:
                places, grams = winnow(words, hashes, n, n)
                if short is None:  # of items only those of exactly this length
                    whole = lengths[np.searchsorted(words.first, places, "right") - 1] == n
                    places, grams = places[whole], grams[whole]
                parts.append((n, places, grams))
            out: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for n, places, grams in parts:
                if known is not None and len(grams):
                    one, two = _bit_places(grams, bits)
                    passed = (known[one >> 3] >> (one & 7)) & (known[two >> 3] >> (two & 7)) & 1
                    places, grams = places[passed == 1], grams[passed == 1]
                texts = np.searchsorted(words.first, places, "right") - 1
                reach = span - n if n == k and k < span else 0
                for place, gram, text in zip(places.tolist(), grams.view(np.int64).tolist(), texts.tolist(), strict=True):
                    first, end = int(words.first[text]), int(words.first[text + 1])
                    start = max(first, place - reach)
                    out[text].append({
                        "h": gram, "n": n, "at": place - first, "left": place - start,
                        "words": words.text(start, min(end, place + n + reach)),
                    })
            keys = np.arange(row, row + batch.num_rows, dtype=np.int64)
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), batch.column(0), pa.array(lengths.astype(np.int64)), pa.array(out, arrow)], names=schema.fieldNames()
            )

    return df.mapInArrow(run, schema)


def _bloom(items: DataFrame, bits: int) -> bytes:
    """Bit array of the items' fingerprints; what comes to the driver is 2^bits bits at most."""
    mask = F.lit((1 << bits) - 1)
    places = F.array(F.col("h").bitwiseAND(mask), F.shiftrightunsigned("h", 32).bitwiseAND(mask))
    bytes_ = (
        items.select(F.explode(places).alias("p"))
        .groupBy(F.shiftright("p", 3).alias("byte"))
        .agg(F.bit_or(F.expr("shiftleft(1, cast(p & 7 as int))")).alias("v"))
        .toPandas()
    )
    out = np.zeros(1 << max(0, bits - 3), np.uint8)
    out[bytes_["byte"].to_numpy(np.int64)] = bytes_["v"].to_numpy(np.uint8)
    return out.tobytes()


def _run(steps: Column, same) -> Column:
    """How many steps, counted from the first, are the same one after another."""
    return F.aggregate(steps, F.lit(0), lambda done, i: F.when((done == i - 1) & same(i), i).otherwise(done))


def _steps(most: Column) -> Column:
    return F.when(most > 0, F.sequence(F.lit(1), F.greatest(most, F.lit(1)))).otherwise(F.array().cast("array<int>"))


class Contamination:
    """What ``find`` returns: ``rows`` (row_key, doc_id, n_words) and ``hits`` (row_key, item_id, start, end)."""

    def __init__(self, rows: DataFrame, hits: DataFrame):
        self.rows, self.hits = rows, hits

    def per_document(self) -> DataFrame:
        """One row per document row: n_words, n_hit, items (ascending as text), contaminated."""
        span = F.struct("start", "end")
        spans = self.hits.groupBy("row_key").agg(
            F.array_sort(F.collect_set(span)).alias("spans"),
            F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
        )
        begin = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("reached"))
        covered = F.aggregate("spans", begin, lambda acc, s: F.struct(
            (acc.n + F.greatest(F.lit(0), s.end - F.greatest(s.start, acc.reached))).alias("n"),
            F.greatest(acc.reached, s.end).alias("reached"),
        ))
        found = spans.select("row_key", covered.n.alias("n_hit"), "items")
        n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
        return self.rows.join(found, "row_key", "left").select(
            "row_key", "doc_id", "n_words", n_hit.alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"),
        )


def find(docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = GRAM, filter_bits: int = FILTER_BITS) -> Contamination:
    """All words of ``docs`` (doc_id, text) within a run of ``span`` words that an item (item_id, text) has.

    Words are lower-cased (A-Z) runs of digits, ASCII letters and code points beyond ASCII. An item
    of fewer than ``span`` words, but not none, is one window. Null and empty texts have no words.
    Repeated documents are rows of their own; repeated items are one by id. Hits of an item without
    an id count as hit words, the item itself is not listed. Empty tables give no hits.
    """
    if not 1 <= k < span:
        raise ValueError("k must be shorter than the span")
    spark = docs.sparkSession
    limit_batches(spark)
    found = _fingerprint(pick(items, "item_id", "text"), "item_id", span, k, None, None, filter_bits)
    listed = stage(found.select("item_id", "row_key", F.inline("grams")))
    short = sorted(r.n for r in listed.filter(F.col("n") != k).select("n").distinct().collect())
    if listed.filter((F.col("n") == k) & (F.size("words") == k)).limit(1).count():  # items of exactly k words
        short = sorted({*short, k})
    bloom = spark.sparkContext.broadcast(_bloom(listed, filter_bits))
    rows = stage(_fingerprint(pick(docs, "doc_id", "text"), "doc_id", span, k, short, bloom, filter_bits))
    grams = rows.select("row_key", F.inline("grams"))
    doc = grams.select("row_key", "h", "n", "at", "left", "words")
    item = listed.select("h", "n", "item_id", F.col("left").alias("ileft"), F.col("words").alias("iwords")).distinct()
    met = doc.join(item, ["h", "n"])
    left, right = F.least("left", "ileft"), F.least(F.size("words") - F.col("left"), F.size("iwords") - F.col("ileft"))
    back = _run(_steps(left), lambda i: F.get("words", F.col("left") - i) == F.get("iwords", F.col("ileft") - i))
    on = _run(_steps(right), lambda i: F.get("words", F.col("left") + i - 1) == F.get("iwords", F.col("ileft") + i - 1))
    met = met.select("row_key", "item_id", "n", "at", F.size("iwords").alias("given"), back.alias("back"), on.alias("on"))
    # A window of a short item is the whole item; else the run around the gram must reach the span.
    long = F.when(F.col("given") < span, F.col("on") >= F.col("given")).otherwise((F.col("on") >= k) & (F.col("back") + F.col("on") >= span))
    hits = met.filter(long).select(
        "row_key", "item_id", (F.col("at") - F.col("back")).alias("start"), (F.col("at") + F.col("on")).alias("end")
    ).distinct()
    return Contamination(rows.select("row_key", "doc_id", "n_words"), hits)


def clean(docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = GRAM) -> DataFrame:
    """``docs`` without the rows that share a window with an item; columns and texts stay as they are.

    Whether a row goes depends on its text alone, so rows are told by a 64-bit hash of it. The
    hashes are staged so that their size is known when Spark chooses how to take them out.
    """
    names = docs.columns
    plain = docs.toDF(*(f"_{i}" for i in range(len(names))))
    text = F.col(f"_{names.index('text')}")
    body = plain.select(F.xxhash64(text).alias("doc_id"), text.alias("text"))
    dirty = find(body, items, span, k).per_document().filter("contaminated").select(F.col("doc_id").alias("key")).distinct()
    return plain.withColumn("key", F.xxhash64(text)).join(stage(dirty), "key", "left_anti").drop("key").toDF(*names)
