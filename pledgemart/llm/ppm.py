"""Language-model scoring by prediction by partial matching (PPM), order 4, over bytes.

The model is a trie of byte contexts with the counts of what follows them in the training texts. A
symbol (a byte, or the end of the text) is predicted in its longest context that was seen; where it
was not seen there, an escape is coded (method C: as many escapes as different symbols) and the next
shorter context is asked, from which the symbols of the longer one are excluded. In the last place
all symbols left are equally likely. Contexts at the beginning of a text are filled with a start
mark. The model is trained first and then fixed, so the code length of a symbol depends on it and
the four before it only: it is worked out once for every five symbols that occur.

Nothing of a size that grows with the corpus is sent to every task. Texts are cut into chunks of
about CHUNK_BYTES; each chunk tells which words and which five symbols it has and how often its
training texts have them, sums and code lengths come from joins on those keys, and each chunk gets
back the values of its own keys together with its texts.

The base is a smoothed unigram model over words with the same training texts.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pledgemart.llm.common import byte_slices, discard, limit_batches, pick, stage

ORDER = 4
CHUNK_BYTES = 32 << 20
#: A symbol takes nine bits: 0 before the text, 1 to 256 a byte, 257 the end.
BITS, START, END, ALPHABET = 9, 0, 257, 257
HELD_OUT, FOLDS = 2, 7

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def five_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte and end of each text the symbol with the four before it, as one number, and
    where each text's numbers begin (one more at the end)."""
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    symbols = np.zeros(len(data) + (ORDER + 1) * n, np.int64)
    shift = np.repeat(np.arange(n) * (ORDER + 1) + ORDER, lengths)
    symbols[np.arange(len(data)) + shift] = data.astype(np.int64) + 1
    ends = offsets[1:] + np.arange(n) * (ORDER + 1) + ORDER
    symbols[ends] = END
    keys = symbols[ORDER:].copy() if n else symbols
    for k in range(1, ORDER + 1):
        keys |= symbols[ORDER - k : len(symbols) - k] << (BITS * k)
    real = np.ones(len(keys), bool)
    starts = (ends + 1)[:-1]  # where the next text's start marks lie
    for k in range(ORDER):
        real[starts - ORDER + k] = False
    return keys[real], offsets + np.arange(n + 1)


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, packed, held_out and the chunk of every row, staged.

    ``packed`` is the text with A-Z lower-cased, null as empty, compressed: it is stored and moved once.
    """
    limit_batches(docs.sparkSession)
    rows = pick(docs, "doc_id", "text")
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    text = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = rows.select("doc_id", text.alias("text"), (fold == HELD_OUT).alias("held_out"))
    schema = T.StructType([
        rows.schema["doc_id"], T.StructField("packed", T.BinaryType()), rows.schema["held_out"], T.StructField("chunk", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, seen = TaskContext.get().partitionId() << 32, 0
        for batch in (part for whole in batches for part in byte_slices(whole, "text")):
            chunks = pa.array(np.full(batch.num_rows, first + seen // chunk_bytes))
            raw = [text.as_py().encode() for text in batch.column(1)]
            seen += sum(map(len, raw))
            packed = pa.array([zlib.compress(text, 1) for text in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed, batch.column(2), chunks], names=schema.fieldNames())

    return stage(rows.mapInArrow(run, schema))


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes], np.ndarray, np.ndarray]]:
    """Runs of rows with their texts, the texts' fives, and where those of each text begin."""
    for part in byte_slices(batch, "packed", 1 << 20):
        raw = [zlib.decompress(packed.as_py()) for packed in part["packed"]]
        offsets = np.cumsum([0, *map(len, raw)])
        yield part, raw, *five_symbols(np.frombuffer(b"".join(raw), np.uint8), offsets)


_KEYS = T.StructType([
    T.StructField("chunk", T.LongType()), T.StructField("word", T.StringType()), T.StructField("five", T.LongType()), T.StructField("n", T.LongType()),
])


class _Counts:
    """The words and fives of one chunk, each with its count in the training texts (also 0)."""

    def __init__(self):
        self.words: Counter = Counter()
        self.fives: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, batch: pa.RecordBatch) -> None:
        for part, raw, keys, starts in _unpacked(batch):
            held = part["held_out"].to_numpy(zero_copy_only=False)
            for text, out in zip(raw, held, strict=True):
                words = text.split()
                if out:
                    for word in set(words):
                        self.words[word] += 0
                else:
                    self.words.update(words)
            self._add_fives(keys, np.repeat(~held, np.diff(starts)))

    def _add_fives(self, keys: np.ndarray, train: np.ndarray) -> None:
        self.fives.append(np.unique(keys[train], return_counts=True))
        other = np.unique(keys[~train])
        self.fives.append((other, np.zeros(len(other), np.int64)))
        if len(self.fives) > 16:
            self.fives = [self._merged()]

    def _merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(x) for x in zip(*self.fives, strict=True))
        distinct, place = np.unique(keys, return_inverse=True)
        return distinct, np.bincount(place, counts, len(distinct)).astype(np.int64)

    def batches(self, chunk: int) -> Iterator[pa.RecordBatch]:
        keys, counts = self._merged()
        words = pa.array([w.decode() for w in self.words], pa.string())
        n = pa.array(self.words.values(), pa.int64())
        for word, five, count in ((words, pa.nulls(len(words), pa.int64()), n), (pa.nulls(len(keys), pa.string()), pa.array(keys), pa.array(counts))):
            for start in range(0, len(word), 1 << 16):
                part = [x.slice(start, 1 << 16) for x in (word, five, count)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part[0]), chunk)), *part], names=_KEYS.fieldNames())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk that is read in several parts gives several rows for a key; they are summed later."""
    at, counts = None, _Counts()
    for batch in batches:
        chunks = batch.column(3).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(chunks)) + 1), len(chunks)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            if at is not None and chunks[start] != at:
                yield from counts.batches(at)
                counts = _Counts()
            at = int(chunks[start])
            counts.add(batch.slice(start, end - start))
    if at is not None:
        yield from counts.batches(at)


def _context(five: Column, order: int) -> Column:
    """The last ``order`` symbols before the one predicted."""
    return F.shiftright(five, BITS).bitwiseAND(F.lit((1 << BITS * order) - 1))


def log_probabilities(fives: DataFrame) -> DataFrame:
    """(five, logp): log10 of the probability of the last of each five symbols, given the four.

    ``fives`` has five (distinct) and n, its count in training; rows with n = 0 are to be predicted too.
    """
    symbol = F.col("five").bitwiseAND(F.lit((1 << BITS) - 1))
    seen = fives.filter("n > 0").select("five", symbol.alias("s"), "n")
    # By order: what follows each context, and the context's total and number of symbols.
    follow = {k: stage(seen.groupBy(_context(F.col("five"), k).alias("c"), "s").agg(F.sum("n").alias("n"))) for k in range(ORDER + 1)}
    nodes = {k: follow[k].groupBy("c").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")) for k in follow}
    for k in range(1, ORDER + 1):
        # The count that the symbols of a context have in the next shorter one, where they are excluded.
        shorter = follow[k - 1].select(F.col("c").alias("short"), "s", F.col("n").alias("m"))
        longer = follow[k].withColumn("short", F.col("c").bitwiseAND(F.lit((1 << BITS * (k - 1)) - 1)))
        gone = longer.join(shorter, ["short", "s"]).groupBy("c").agg(F.sum("m").alias("gone"))
        nodes[k] = nodes[k].join(gone, "c")
    known = fives.filter("n > 0").withColumn("c", _context(F.col("five"), ORDER)).join(nodes[ORDER], "c")
    known = known.select("five", F.log10(F.col("n") / (F.col("total") + F.col("kinds"))).alias("logp"))
    # Those not seen in full walk down, order by order.
    walk = fives.filter("n = 0").select("five", symbol.alias("s"))
    zero = F.lit(0).cast("bigint")
    for k in range(ORDER, -1, -1):
        walk = walk.withColumn("c", _context(F.col("five"), k))
        node = nodes[k].select("c", F.col("total").alias(f"t{k}"), F.col("kinds").alias(f"d{k}"), *([F.col("gone").alias(f"g{k}")] if k else []))
        walk = walk.join(node, "c", "left")
        if k < ORDER:
            walk = walk.join(follow[k].select("c", "s", F.col("n").alias(f"n{k}")), ["c", "s"], "left")
        walk = walk.drop("c")
    none = lambda c: F.coalesce(c, zero)
    steps = []  # the code of order k, if the symbol was not found in a longer context
    found = F.lit(False)
    for k in range(ORDER, -1, -1):
        left = none(f"t{k}") - (none(f"g{k + 1}") if k < ORDER else zero)
        kinds = none(f"d{k}") - (none(f"d{k + 1}") if k < ORDER else zero)
        here = F.col(f"n{k}").isNotNull() if k < ORDER else F.lit(False)
        code = F.when(here, F.log10(F.col(f"n{k}") / (left + kinds))) if k < ORDER else F.lit(None).cast("double")
        escape = F.when(kinds > 0, F.log10(kinds / (left + kinds))).otherwise(F.lit(0.0))
        steps.append(F.when(found, F.lit(0.0)).otherwise(F.coalesce(code, escape)))
        found = found | here
    steps.append(F.when(found, F.lit(0.0)).otherwise(-F.log10(F.greatest(F.lit(ALPHABET) - none("d0"), F.lit(1)).cast("double"))))
    return known.union(walk.select("five", reduce(lambda a, b: a + b, steps).alias("logp")))


_SCORES = [("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType())]


def score(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row (doc_id, text).

    Rows whose crc32 of the id, as text, leaves 2 in a division by 7 are held out, all others train;
    a null id counts as the empty text. Texts are taken with A-Z lower-cased, null as empty. Tokens
    are words and one end. ``base_score`` is the unigram model's log10 probability, ``score`` that of
    PPM for the whole text with its end. Repeated rows train and are scored each by itself; without
    training rows all symbols are equally likely.
    """
    rows = chunked(docs, chunk_bytes)
    keys = stage(rows.mapInArrow(_count, _KEYS))
    words = stage(keys.filter("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")))
    total = words.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("kinds")).first()
    ends = rows.filter("NOT held_out").count()
    tokens, kinds = (total.n or 0) + ends, total.kinds + (ends > 0)
    fives = stage(keys.filter("five IS NOT NULL").groupBy("five").agg(F.sum("n").alias("n")))
    codes = stage(log_probabilities(fives))
    log = lambda n: math.log10((n + 1) / (tokens + kinds + 1))
    of_words = keys.filter("word IS NOT NULL").select("chunk", "word").join(words, "word")
    of_fives = keys.filter("five IS NOT NULL").select("chunk", "five").join(codes, "five")
    values = of_words.select("chunk", "word", F.lit(None).cast("bigint").alias("five"), F.col("n").cast("double").alias("value")).union(
        of_fives.select("chunk", F.lit(None).cast("string"), "five", "logp")
    )
    end, scale = log(ends), math.log10(tokens + kinds + 1)
    schema = T.StructType([rows.schema["doc_id"], rows.schema["held_out"], *(T.StructField(n, t) for n, t in _SCORES)])

    def run(key, texts: pa.Table, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        is_word = np.asarray(table["word"].is_valid())
        value = table["value"].to_numpy()
        counts = dict(zip((w.encode() for w in table["word"].to_pylist() if w is not None), value[is_word].tolist()))
        fives = table["five"].filter(pa.array(~is_word)).to_numpy()
        order = np.argsort(fives, kind="stable")
        fives, codes = fives[order], value[~is_word][order]
        out = []
        for batch, raw, keys, starts in (x for b in texts.to_batches() for x in _unpacked(b)):
            n_tokens, n_known, base = [], [], []
            for text in raw:
                found = text.split()
                n = np.fromiter(map(counts.__getitem__, found), np.float64, len(found))
                n_tokens.append(len(found) + 1)
                n_known.append(int((n > 0).sum()) + (ends > 0))
                base.append(float(np.log10(n + 1).sum()) - len(found) * scale + end)
            logp = np.add.reduceat(codes[np.searchsorted(fives, keys)], starts[:-1])
            out.append(pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(logp)],
                names=schema.fieldNames(),
            ))
        return pa.Table.from_batches(out) if out else pa.Table.from_batches([], schema=pa.schema(zip(schema.fieldNames(), [texts.schema.field("doc_id").type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()])))

    values = stage(values)
    discard(keys)
    scored = rows.groupBy("chunk").cogroup(values.groupBy("chunk")).applyInArrow(run, schema)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
