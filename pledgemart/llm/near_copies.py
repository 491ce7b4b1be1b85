"""Near copies by SimHash, checked by the exact Jaccard similarity of word shingles; the others at the rare ends of their sets.

Two texts are alike if the sets of their five-word shingles have a Jaccard similarity of 0.8 or more.
First texts whose fingerprints differ in two bits at most (``simhash``) are paired, compared on the whole
sets, and linked if they are alike. SimHash misses near copies; those are found by their shingles.

All shingles have one order, the same for every text; then two such sets share a shingle among the
first fifth (and one more) of each. Only those are compared, so no pair is missed, and every pair that
meets is checked on the whole sets. Any order gives the same result: frequent shingles are put last to
keep the groups that meet small. Which are frequent is counted in a table of fixed size.

Two alike texts meet at the first shingle they share, and share nothing before it: the later its place in
a text, the less can be shared, and the smaller the other text must be (``reach``). Pairs beyond it meet at
an earlier shingle or are not alike. Of two texts within reach the smaller one reaches its own size at least; only
rows that do (they lead) need to meet the others of their group.

Texts that meet at one shingle are not expanded into pairs: in each round a few of them are compared with
all others and leave the group, and texts that are linked already, also over others, are not compared
again. The same texts are taken in all groups they are in, so that texts that share much meet once. Rounds go
on until no group has two texts that are not linked. As fewer and larger groups are left, more of their texts
are taken in a round, as far as the rows that meet keep in step with the rows, so that rounds, and the driver's
jobs, are fewer; where they would not, only leading rows are taken, or those outside the group's largest component
if these are fewer. New links join the components found before; a round without any leaves them alone.

Most pairs that meet share a passage and little else. How many shingles of a text fall into each of some
buckets is kept beside it, in about half a byte per shingle; what two texts share can't be more than the
sum of the lesser counts. Only pairs that this does not rule out get their texts, to be compared exactly.
Counts and texts of a round are looked up in a Bloom filter of the round's pairs before they are moved, so that
what is shuffled follows from the pairs; the joins drop what the filter lets through besides.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from xxhash import xxh64_intdigest

from pledgemart.llm.common import discard, limit_batches, mix, pick, stage
from pledgemart.llm import simhash
from pledgemart.llm.components import components

SHINGLE_WORDS = 5
#: The least Jaccard similarity of a link, as a fraction.
SHARED, OF = 4, 5
#: Places of the table that frequent shingles are counted in.
TABLE = 1 << 20
#: How many texts of each group meet all others in the first, second, ... rounds; then four times as many as in the
#: round before, as long as the rows that meet are PAIRS times the rows of all groups at most.
CENTRES = (1, 4, 16, 64)
PAIRS = 8
#: The least and the most buckets of a text's counts.
BUCKETS = (16, 4096)
#: Bits of a Bloom filter per number in it, and the least and the most bits of it all, as powers of two.
FILTER_PER, FILTER_BITS = 16, (16, 26)
_digest = partial(xxh64_intdigest, seed=42)


def shingles_of(text: str | bytes | None, words: int = SHINGLE_WORDS) -> tuple[int, np.ndarray]:
    """A hash of the text's words, and the hashes of its distinct shingles, ascending; without words there are none."""
    raw = text.encode() if isinstance(text, str) else text or b""
    tokens = raw.lower().split()  # of bytes: lowers A-Z only and splits at space and \x09-\x0d
    if len(tokens) <= words:
        parts = [b" ".join(tokens)] if tokens else []
    else:
        parts = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    return _digest(b" ".join(tokens)), np.unique(np.fromiter(map(_digest, parts), np.uint64))


def are_alike(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and both * OF >= SHARED * (len(a) + len(b) - both)


def counts_of(shingles: np.ndarray) -> bytes:
    """How many of the distinct shingles fall into each bucket, in a byte each; 255 stands for any number from there."""
    n = min(max(BUCKETS[0], 1 << (len(shingles) // 2).bit_length()), BUCKETS[1])
    places = (shingles >> np.uint64(20)) % np.uint64(n)
    return np.minimum(np.bincount(places.astype(np.int64), minlength=n), 255).astype(np.uint8).tobytes()


def may_be_alike(a: bytes, b: bytes, size_a: int, size_b: int) -> bool:
    """Whether counts leave it open that two texts are alike; buckets are powers of two, so the finer fold into the coarser."""
    x, y = (np.frombuffer(c, np.uint8).astype(np.int64) for c in (a, b))
    x[x == 255], y[y == 255] = 1 << 40, 1 << 40
    n = min(len(x), len(y))
    both = int(np.minimum(x.reshape(-1, n).sum(axis=0), y.reshape(-1, n).sum(axis=0)).sum())
    both = min(both, size_a, size_b)
    return both * OF >= SHARED * (size_a + size_b - both)


def reach_of(size: int, place: np.ndarray) -> np.ndarray:
    """The most shingles of a text that is alike to one of ``size`` shingles, if the first they share has this place (from 0) in it."""
    return np.minimum((SHARED + OF) * (size - place) // SHARED - size, size * OF // SHARED)


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``row_key`` (unique), ``key``, the same for texts of the same words, and their fingerprint ``fp``; stage it before reading it twice."""
    place = docs.columns.index(text)
    limit_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema, T.StructField("row_key", T.LongType()), T.StructField("key", T.LongType()), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            keys = np.fromiter((_digest(b" ".join((t.as_py() or "").encode().lower().split())) for t in batch.column(place)), np.uint64, batch.num_rows)
            fps = np.fromiter((simhash.fingerprint_of(t.as_py()) for t in batch.column(place)), np.uint64, batch.num_rows)
            rows = np.arange(at, at + batch.num_rows, dtype=np.int64)
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows), pa.array(keys.view(np.int64)), pa.array(fps.view(np.int64))], names=schema.fieldNames())

    return docs.mapInArrow(run, schema)


def _tallied(texts: DataFrame) -> DataFrame:
    """How often the shingles of each place of the table occur in a task, where clearly more often than others; and key, size, counts of each text with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = np.zeros(TABLE, np.int64), set()
        for batch in batches:
            rows = []
            for t in batch.column(0):
                key, found = shingles_of(t.as_py())
                np.add.at(n, (found % np.uint64(TABLE)).astype(np.int64), 1)
                if key not in seen and len(found):
                    seen.add(key)
                    rows.append((key, len(found), counts_of(found)))
            if rows:
                none = pa.nulls(len(rows), pa.int64())
                keys, sizes, counts = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([none, none, pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(counts, pa.binary())], names=names)
        mean = n.mean()
        places = np.flatnonzero(n >= mean + 8 * mean**0.5 + 4)
        none = (pa.nulls(len(places), kind) for kind in (pa.int64(), pa.int32(), pa.binary()))
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(n[places]), *none], names=names)

    names = ["place", "n", "key", "size", "counts"]
    return texts.mapInArrow(run, "place long, n long, key long, size int, counts binary")


def _frequent(tallies: DataFrame) -> np.ndarray:
    """How often the shingles of each place of the table occur, 0 where not clearly more often than others."""
    found = tallies.where("place IS NOT NULL").groupBy("place").agg(F.sum("n").alias("n"))
    table = np.zeros(TABLE, np.uint32)
    found = found.toArrow()  # TABLE rows at most, which as Python's rows would be some hundred MB
    table[found["place"].to_numpy()] = np.minimum(found["n"].to_numpy(), (1 << 32) - 1)
    return table


def _first_shingles(texts: DataFrame, sent: Broadcast) -> DataFrame:
    """token, key, size (of the whole set), reach for the first fifth of each text's shingles, and one more; ``sent`` has the table of frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, seen = sent.value, set()
        for batch in batches:
            tokens, keys, sizes, reaches = [], [], [], []
            for t in batch.column(0):
                key, found = shingles_of(t.as_py())
                if key in seen or not len(found):  # copies of a task need no second look
                    continue
                seen.add(key)
                most = len(found) - -(-SHARED * len(found) // OF) + 1
                order = np.lexsort((found, often[(found % np.uint64(TABLE)).astype(np.int64)]))[:most]
                tokens.append(found[order])
                keys.append(np.full(most, key, np.uint64))
                sizes.append(np.full(most, len(found), np.int32))
                reaches.append(reach_of(len(found), np.arange(most)).astype(np.int32))
            if tokens:
                whole = [np.concatenate(x) for x in (tokens, keys, sizes, reaches)]
                yield pa.RecordBatch.from_arrays([pa.array(whole[0].view(np.int64)), pa.array(whole[1].view(np.int64)), pa.array(whole[2]), pa.array(whole[3])], names=names)

    names = ["token", "key", "size", "reach"]
    return texts.mapInArrow(run, "token long, key long, size int, reach int")


def _can_be_alike(size_a: Column, reach_a: Column, size_b: Column, reach_b: Column) -> Column:
    """Whether texts that meet at a shingle can be alike if they share none before it."""
    return (size_a <= reach_b) & (size_b <= reach_a)


def _bits_of(numbers: pa.Array, bits: int) -> np.ndarray:
    """The two bits of each number in a Bloom filter of 2**bits."""
    spread = mix(numbers.to_numpy().view(np.uint64))
    mask = np.uint64((1 << bits) - 1)
    return np.stack([spread & mask, (spread >> np.uint64(32)) & mask]).astype(np.int64)


def among(rows: DataFrame, column: str, numbers: DataFrame, n: int) -> DataFrame:
    """The ``rows``, staged, whose ``column`` (never null) is one of the ``numbers`` (columns of longs, about ``n`` in all), and a few others.

    The numbers are set in a Bloom filter whose words are put together by Spark; it has a most size,
    from which on it lets more others through.
    """
    spark, place = rows.sparkSession, rows.columns.index(column)
    bits = min(max(FILTER_BITS[0], (FILTER_PER * n).bit_length()), FILTER_BITS[1])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(1 << (bits - 6), np.uint64)
        for batch in batches:
            for x in batch.columns:
                at = _bits_of(x, bits).ravel()
                np.bitwise_or.at(words, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        places = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(words[places].view(np.int64))], names=["word", "bits"])

    found = numbers.mapInArrow(build, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    sent = spark.sparkContext.broadcast(words)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _bits_of(batch.column(place), bits)
            held = (sent.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            yield batch.filter(pa.array(held.all(axis=0)))

    out = stage(rows.mapInArrow(passing, rows.schema))
    sent.destroy()
    return out


def _alike(pairs: DataFrame, keyed: DataFrame, first: DataFrame, text: str) -> DataFrame:
    """The pairs (a, b) of keys whose texts are alike; ``first`` has the row_key of one text per key, its size and counts."""
    pairs = stage(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    n = pairs.count()
    if not n:
        return pairs
    # Staged, so that their size is known when Spark chooses how to join them.
    counts = among(first.select("key", "row_key", "size", "counts"), "key", pairs, 2 * n)
    sized = pairs.join(counts.toDF("a", "ra", "na", "ca"), "a").join(counts.toDF("b", "rb", "nb", "cb"), "b")
    sized = sized.select("a", "b", "ra", "rb", "na", "nb", "ca", "cb")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yes = [may_be_alike(ca, cb, na, nb) for na, nb, ca, cb in zip(*(c.to_pylist() for c in batch.columns[4:]), strict=True)]
            yield batch.select([0, 1, 2, 3]).filter(pa.array(yes, pa.bool_()))

    open_ = stage(sized.mapInArrow(sift, "a long, b long, ra long, rb long"))
    n = open_.count()
    if not n:
        discard(pairs)
        discard(counts)
        return open_
    texts = among(pick(keyed, "row_key", text).toDF("row_key", "t"), "row_key", open_.select("ra", "rb"), 2 * n)
    met = open_.join(texts.toDF("ra", "ta"), "ra").join(texts.toDF("rb", "tb"), "rb").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yes = [are_alike(shingles_of(x.as_py())[1], shingles_of(y.as_py())[1]) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(yes, pa.bool_()))

    found = stage(met.mapInArrow(run, "a long, b long"))
    for used in (pairs, counts, open_, texts):
        discard(used)
    return found


def fingerprint_pairs(first: DataFrame) -> DataFrame:
    """(a, b) of keys by SimHash: each with the least key of its fingerprint, and those of fingerprints that are near; ``first`` has key and fp."""
    heads = stage(first.groupBy("fp").agg(F.min("key").alias("head")))
    equal = first.join(heads, "fp").filter("key != head").select(F.col("head").alias("a"), F.col("key").alias("b"))
    near = simhash.links(heads.select("fp")).toDF("fa", "fb")
    near = near.join(heads.toDF("fa", "a"), "fa").join(heads.toDF("fb", "b"), "fb").select("a", "b")
    return equal.union(near)


def _unlinked(rest: DataFrame, roots: DataFrame) -> DataFrame:
    """``rest`` (token, key, size, reach) with the root of each key and its place (from 1) in its token, of tokens whose texts are not all linked.

    Texts have the same order in all tokens.
    """
    rest = rest.join(roots.withColumnRenamed("node", "key"), "key", "left")
    rest = rest.select("token", "key", "size", "reach", F.coalesce("root", "key").alias("root"))
    ordered = Window.partitionBy("token").orderBy("key")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = rest.select("*", F.min("root").over(whole).alias("lo"), F.max("root").over(whole).alias("hi"), F.row_number().over(ordered).alias("place"))
    return stage(rest.filter("lo != hi").drop("lo", "hi"))


def groups(keyed: DataFrame, text: str) -> DataFrame:
    """(node, root) of every key that is linked to another; ``keyed`` is staged, with row_key, key, fp and the text."""
    texts = keyed.select(text)
    tallies = stage(_tallied(texts))
    sent = texts.sparkSession.sparkContext.broadcast(_frequent(tallies))
    # Texts of the same words have the same fingerprint, and copies in several tasks the same counts; those without words have none.
    first = keyed.groupBy("key").agg(F.min("row_key").alias("row_key"), F.min("fp").alias("fp"))
    counts = tallies.where("key IS NOT NULL").groupBy("key").agg(F.first("size").alias("size"), F.first("counts").alias("counts"))
    first = stage(first.join(counts, "key"))
    discard(tallies)
    links = _alike(fingerprint_pairs(first.select("key", "fp")), keyed, first, text)
    roots, turn, most = stage(components(links)), 0, CENTRES[0]
    discard(links)
    # Of one token's texts only rows are sorted, never gathered; most tokens have one text and go at once. They are read once
    # and never staged, as they take as much disk as the texts.
    met = _first_shingles(texts, sent)
    met = met.select("*", *(F.expr(f"{n}(key) OVER (PARTITION BY token)").alias(n) for n in ("min", "max")))
    left = _unlinked(met.filter("min != max").select("token", "key", "size", "reach").distinct(), roots)
    sent.destroy()
    rows, sifted = left.count(), False
    while not left.isEmpty():
        # Those taken leave, so that other ones are taken each time.
        able = left.withColumn("able", F.lit(True))
        if turn < len(CENTRES):
            most = CENTRES[turn]
        else:
            fits = not sifted and _met(able, 4 * most) <= PAIRS * rows
            if not fits:
                sifted, able = True, _sifted(left)
                fits = _met(able, 4 * most) <= PAIRS * rows
            most = 4 * most if fits else most
        centre = stage(_centres(able, most)) if sifted else _named(left.where(F.col("place") <= most))
        pairs = left.join(centre, "token").filter(F.col("root") != F.col("root_b"))
        pairs = pairs.filter(_can_be_alike(F.col("size"), F.col("reach"), F.col("size_b"), F.col("reach_b")))
        found = _alike(pairs.select(F.col("key").alias("a"), "b"), keyed, first, text)
        if not found.isEmpty():
            joined = _joined(roots, found)
            discard(roots)
            roots = joined
        # Centres have met all others; a token whose other texts are all linked has nothing to tell, nor has one without centres.
        if sifted:
            rest = left.join(centre.select("token", F.col("b").alias("key")), ["token", "key"], "left_anti")
            rest = rest.join(centre.select("token").distinct(), "token", "left_semi")
        else:
            rest = left.where(F.col("place") > most)
        still = _unlinked(rest.select("token", "key", "size", "reach"), roots)
        for used in (left, found, *([centre] if sifted else [])):
            discard(used)
        left, turn = still, turn + 1
    for used in (first, left):
        discard(used)
    return roots


def _sifted(left: DataFrame) -> DataFrame:
    """``left`` with ``able``: whether a row must meet the others of its token. Every pair within reach has a leading row, and one outside the largest component."""
    leads = F.col("reach") >= F.col("size")
    about = left.groupBy("token", "root").agg(F.count("*").alias("n"), F.count(F.when(leads, 1)).alias("leading"))
    about = about.groupBy("token").agg(F.sum("n").alias("n"), F.sum("leading").alias("leading"), F.max(F.struct("n", "root")).alias("top"))
    about = about.select("token", (F.col("leading") <= F.col("n") - F.col("top.n")).alias("few_lead"), F.col("top.root").alias("top"))
    able = F.when(F.col("few_lead"), leads).otherwise(F.col("root") != F.col("top"))
    return left.join(about, "token").select("token", "key", "size", "reach", "root", able.alias("able"))


def _met(able: DataFrame, most: int) -> float:
    """How many rows meet in a round that takes ``most`` texts of each group."""
    lots = able.groupBy("token").agg(F.count("*").alias("n"), F.count(F.when(F.col("able"), 1)).alias("able"))
    return lots.agg(F.sum(F.least(F.col("able"), F.lit(most)) * F.col("n").cast("double"))).first()[0]


def _centres(able: DataFrame, most: int) -> DataFrame:
    """The first ``most`` able rows of each token."""
    place = F.row_number().over(Window.partitionBy("token").orderBy("key"))
    return _named(able.where("able").withColumn("place", place).where(F.col("place") <= most))


def _named(centres: DataFrame) -> DataFrame:
    """token, b, size_b, reach_b, root_b of rows that meet the others of their token."""
    return centres.select("token", *(F.col(c).alias(f) for c, f in (("key", "b"), ("size", "size_b"), ("reach", "reach_b"), ("root", "root_b"))))


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) of ``roots`` and of the nodes of ``links`` (a, b), after these: only the links between components are followed."""
    for c in ("a", "b"):
        links = links.join(roots.toDF(c, f"root_{c}"), c, "left").withColumn(f"root_{c}", F.coalesce(f"root_{c}", c))
    moved = stage(components(links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))))
    kept = roots.join(moved.toDF("root", "moved"), "root", "left").select("node", F.coalesce("moved", "root").alias("root"))
    # A node that had no link before was its own root.
    out = stage(kept.union(moved.join(roots.select("node"), "node", "left_anti").select("node", "root")))
    discard(moved)
    return out


def keep_one(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies: that of its smallest ``doc_id``, of equal ids any one.

    Links count over others. Rows without an id come last; texts without words are one group. The rows are kept whole.
    """
    columns = docs.columns
    plain = docs.toDF(*(f"_{i}" for i in range(len(columns))))
    doc_id, body = f"_{columns.index('doc_id')}", f"_{columns.index(text)}"
    keyed = stage(_keyed(plain, body))
    order = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("doc_id"), "row_key")
    named = keyed.groupBy("key").agg(F.min(order).alias("first")).join(groups(keyed, body).withColumnRenamed("node", "key"), "key", "left")
    named = stage(named.select("key", "first", F.coalesce("root", "key").alias("group")))
    kept = named.groupBy("group").agg(F.min("first").alias("kept"))
    by_key = named.join(kept, "group").select("key", F.col("kept.row_key").alias("kept_key"))
    # Only keys are moved to find the rows that go. They are staged so that their size is known
    # when Spark chooses how to take them out of the texts.
    gone = stage(keyed.select("row_key", "key").join(by_key, "key").filter("row_key != kept_key").select("row_key"))
    return keyed.join(gone, "row_key", "left_anti").select(*plain.columns).toDF(*columns)
