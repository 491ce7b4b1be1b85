"""Byte-level BPE by prefix dynamic programming.

The encoding of a text's prefix is a prefix of nothing less than itself: if t1..tn encodes some
bytes, t1..tn-1 encodes theirs. So every byte prefix has one last token, and it is enough to store
that. The last token of a prefix is the token t that ends there and may follow the last token u of
the prefix before t: two tokens may stand side by side if their bytes encode to just the two. The
encoding is read off from the end.

Appending bytes adds entries and changes none (``Prefixes.append``). After an edit only the entries
behind it are made anew, until as many in a row as the longest token is long agree with the old
ones; all further entries only depend on those (``Prefixes.replace``). ``Text`` does the same for a
whole text whose pieces are encoded separately: pieces before an edit stay, and so do all behind
the first old border that is met again.
"""

from __future__ import annotations

import base64
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pledgemart.llm.common import byte_slices, limit_batches, pick, text_bytes
from pledgemart.llm.prefix_table import PrefixTable

#: Pieces, and pairs of tokens, that a worker remembers at a time: 100 to 200 MB.
MEMORY = 400_000
#: Lengths of the beginnings whose last tokens are kept for other pieces, in bytes.
SHARED = (9, 7, 5)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 of the bytes, a space, the rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Vocabulary:
    """Ranks, and which two tokens may follow one another."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self._pairs: dict[int, bool] = {}
        self._edges: dict[int, tuple] = {}

    def merges(self, raw: bytes) -> tuple[list[bytes], list[tuple[bytes, bytes]]]:
        """The few bytes of a token, merged by rank: what is left, and the two sides of each merge."""
        parts, made = [raw[i : i + 1] for i in range(len(raw))], []
        while len(parts) > 1:
            known = [rank for a, b in zip(parts, parts[1:], strict=False) if (rank := self.ranks.get(a + b)) is not None]
            if not known:
                break
            joined = self.tokens[min(known)]
            at = next(i for i in range(len(parts) - 1) if parts[i] + parts[i + 1] == joined)
            made.append((parts[at], parts[at + 1]))
            parts[at : at + 2] = [joined]
        return parts, made

    def edges(self, token: int) -> tuple:
        """Whether the token's bytes encode to it, and its parts at the left and at the right edge.

        A part is (bytes, rank at which it comes to be, rank at which it is merged away).
        """
        if (known := self._edges.get(token)) is not None:
            return known
        raw = self.tokens[token]
        parts, made = self.merges(raw)
        sides = {a + b: (a, b) for a, b in made}
        found = []
        for side in (0, 1):
            part, gone, run = raw, float("inf"), []
            while True:
                born = self.ranks[part] if len(part) > 1 else -1
                run.append((part, born, gone))
                if part not in sides:
                    break
                part, gone = sides[part][side], born
            found.append(run)
        known = self._edges[token] = (parts == [raw], *found)
        return known

    def alone(self, token: int) -> bool:
        return self.edges(token)[0]

    def pair(self, first: int, second: int) -> bool:
        """Whether the bytes of both encode to just the two.

        They do unless a part at the right edge of the first and one at the left edge of the second
        are there at a time and their merge comes before either is merged away at home. Of equal
        ranks the merge further left comes first.
        """
        key = first << 20 | second
        if (known := self._pairs.get(key)) is not None:
            return known
        whole_a, _, rights = self.edges(first)
        whole_b, lefts, _ = self.edges(second)
        known = whole_a and whole_b
        if known:
            get = self.ranks.get
            for a, a_born, a_gone in rights:
                for b, b_born, b_gone in lefts:
                    if a_born <= b_gone and b_born < a_gone and (rank := get(a + b)) is not None and rank < a_gone and rank <= b_gone:
                        known = False
        if len(self._pairs) >= MEMORY:
            self._pairs.clear()
        self._pairs[key] = known
        return known


class Prefixes:
    """The last token of every prefix of some bytes."""

    def __init__(self, vocabulary: Vocabulary, raw: bytes = b""):
        self.vocabulary, self.raw, self.last = vocabulary, b"", []
        self.append(raw)

    def _extend(self, end: int) -> None:
        """The entry of the next prefix."""
        ranks, vocabulary = self.vocabulary.ranks, self.vocabulary
        for size in range(min(vocabulary.longest, end), 0, -1):
            token = ranks.get(self.raw[end - size : end])
            if token is None:
                continue
            if size == end:
                if vocabulary.alone(token):
                    break
            elif vocabulary.pair(self.last[end - size - 1], token):
                break
        else:
            raise ValueError(f"no token ends with byte {self.raw[end - 1]}")
        self.last.append(token)

    def append(self, more: bytes) -> None:
        self.raw += more
        for end in range(len(self.last) + 1, len(self.raw) + 1):
            self._extend(end)

    def replace(self, start: int, end: int, by: bytes) -> int:
        """Put ``by`` in place of bytes start to end; returns how many entries were made anew."""
        old, shift = self.last, len(by) - (end - start)
        self.raw = self.raw[:start] + by + self.raw[end:]
        self.last = old[:start]
        agree = 0
        while len(self.last) < len(self.raw):
            now = len(self.last) + 1
            self._extend(now)
            before = now - shift  # the same prefix end in the old bytes
            same = now > start + len(by) and before >= 1 and old[before - 1] == self.last[-1]
            agree = agree + 1 if same else 0
            if agree >= self.vocabulary.longest:
                self.last += old[before:]
                return now - start
        return len(self.raw) - start

    def ids(self) -> list[int]:
        out, end = [], len(self.raw)
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(self.vocabulary.tokens[token])
        return out[::-1]


class Encoder:
    """Texts to ids and back. A piece that is itself a token is that token; pieces are remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.pattern = regex.compile(pattern)
        self.remembered = _Remembered(self)
        # How long a token can be that ends with two given bytes (or is one byte).
        self._reach: dict[bytes, int] = {}
        for token in ranks:
            self._reach[token[-2:]] = max(len(token), self._reach.get(token[-2:], 0))
        # The last tokens of all prefixes of the beginnings that many pieces share.
        self._shared: dict[bytes, list[int]] = {}

    def piece(self, raw: bytes) -> tuple[int, ...]:
        """``Prefixes(raw).ids()``, from the longest beginning that an earlier piece has had."""
        ranks, shared = self.vocabulary.ranks, self._shared
        token = ranks.get(raw)
        if token is not None:
            return (token,)
        last: list[int] = []
        for size in SHARED:
            if size < len(raw) and (before := shared.get(raw[:size])) is not None:
                last = before.copy()
                break
        get, pairs, pair, reach = ranks.get, self.vocabulary._pairs.get, self.vocabulary.pair, self._reach.get
        for end in range(len(last) + 1, len(raw) + 1):
            most = reach(raw[end - 2 : end], 1) if end > 1 else 1
            if most > end:
                most = end
            for start in range(end - most, end):
                token = get(raw[start:end])
                if token is None:
                    continue
                if not start:
                    if self.vocabulary.alone(token):
                        break
                    continue
                fits = pairs(last[start - 1] << 20 | token)
                if fits or fits is None and pair(last[start - 1], token):
                    break
            else:
                raise ValueError(f"no token ends with byte {raw[end - 1]}")
            last.append(token)
        for size in SHARED:
            if size < len(raw) and raw[:size] not in shared:
                if len(shared) >= MEMORY // 2:
                    shared.clear()
                shared[raw[:size]] = last[:size]
        sizes, out, end = self.vocabulary.sizes, [], len(raw)
        while end:
            token = last[end - 1]
            out.append(token)
            end -= sizes[token]
        out.reverse()
        return tuple(out)

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        self.remembered.trim()
        return list(chain.from_iterable(map(self.remembered.__getitem__, self.pieces(text))))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


class Column:
    """Columns of texts to ids: all pieces of a batch are encoded at once, equal ones together."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        tokens = {raw.decode("latin-1"): rank for raw, rank in ranks.items()}
        self.table = PrefixTable(tokens, {s: r for s, r in tokens.items() if len(s) > 1}, whole=True)
        self.pattern = regex.compile(pattern)

    def encode(self, texts: pa.Array) -> pa.ListArray:
        data, offsets = text_bytes(texts)
        sizes, per_text = array("q"), array("q")
        for text in texts.to_pylist():
            pieces = self.pattern.findall(text) if text else ()
            sizes.extend(map(len, pieces))
            per_text.append(len(pieces))
        ends = np.cumsum(np.frombuffer(sizes, np.int64)) if sizes else np.zeros(0, np.int64)
        starts = np.flatnonzero((data & 0xC0) != 0x80)[np.append(0, ends[:-1])] if len(ends) else ends
        ids, counts = self.table.encode(data.astype(np.uint32), starts)
        if (ids < 0).any():
            raise ValueError("a byte is not a token")
        upto = np.append(0, np.cumsum(counts))[np.append(0, np.cumsum(np.frombuffer(per_text, np.int64)))]
        return pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(ids))


class Bytes:
    """The bytes of ids, of whole columns at once."""

    def __init__(self, ranks: dict[bytes, int]):
        known = {rank: token for token, rank in ranks.items()}
        parts = [known.get(i, b"") for i in range(max(known) + 1)]
        self.data, self.sizes = np.frombuffer(b"".join(parts), np.uint8), np.array(list(map(len, parts)), np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def of(self, lists: pa.ListArray) -> pa.BinaryArray:
        ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        if len(ids) and not (0 <= ids.min() <= ids.max() < len(self.sizes) and self.sizes[ids].all()):
            raise ValueError("ids that are no tokens")
        sizes = self.sizes[ids]
        upto = np.append(0, np.cumsum(sizes))
        data = self.data[np.arange(upto[-1]) + np.repeat(self.starts[ids] - upto[:-1], sizes)]
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        bounds = upto[np.append(0, np.cumsum(counts))].astype(np.int32)
        valid = np.packbits(lists.is_valid().to_numpy(zero_copy_only=False), bitorder="little")
        return pa.BinaryArray.from_buffers(pa.binary(), len(lists), [pa.py_buffer(x.tobytes()) for x in (valid, bounds, data)])


class _Remembered(dict):
    """Ids of pieces; of those put aside when it grew full, the ones still in use come back."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder, self.aside = encoder, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.aside.get(piece)
        if ids is None:
            ids = self.encoder.piece(piece.encode())
        if len(piece) <= 64:
            self[piece] = ids
        return ids

    def trim(self) -> None:
        if len(self) > MEMORY:
            self.aside = dict(self)
            self.clear()


class Text:
    """An encoded text that can be edited: its pieces, their bounds and ids."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.text = encoder, text
        self.ends, self.parts = self._pieces(0)

    def _pieces(self, start: int, stop_at=None) -> tuple[list[int], list[tuple[int, ...]]]:
        ends, parts = [], []
        for match in self.encoder.pattern.finditer(self.text, start):
            ends.append(match.end())
            parts.append(self.encoder.remembered[match.group()])
            if stop_at and stop_at(match.end()):
                break
        return ends, parts

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, by: str) -> int:
        """Put ``by`` in place of characters start to end; returns how many pieces were made anew."""
        # A piece is decided by its own characters and at most two behind it: white space leaves
        # its last character to the next piece if another character follows that one.
        keep = bisect_left(self.ends, start - 1)
        old_ends, old_parts = self.ends, self.parts
        self.text = self.text[:start] + by + self.text[end:]
        shift = len(by) - (end - start)
        border = {e + shift: i for i, e in enumerate(old_ends) if e >= end}
        begin = old_ends[keep - 1] if keep else 0
        ends, parts = self._pieces(begin, lambda e: e > start + len(by) and e in border)
        self.ends, self.parts = old_ends[:keep] + ends, old_parts[:keep] + parts
        made = len(ends)
        if ends and ends[-1] in border and ends[-1] > start + len(by):
            rest = border[ends[-1]] + 1
            self.ends += [e + shift for e in old_ends[rest:]]
            self.parts += old_parts[rest:]
        return made

    def ids(self) -> list[int]:
        return list(chain.from_iterable(self.parts))


def _made_of(spark: SparkSession, path: str, make):
    """A function for the workers that gives them ``make`` of the ranks, which travel once per executor, as the file's bytes."""
    with open(path, "rb") as file:
        # A worker keeps what it was sent, and with it what was made of it, from task to task.
        sent = spark.sparkContext.broadcast({"file": file.read()})  # the vocabulary, of fixed size

    def get():
        held = sent.value
        if "made" not in held:
            held["made"] = make({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, held["file"].splitlines())})
        return held["made"]

    return get


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids) of every row: the ids of its whole text; a null or empty text has none.

    Rows keep their number and order within a partition; repeated rows are encoded like others.
    """
    spark = docs.sparkSession
    limit_batches(spark)
    get = _made_of(spark, path, lambda ranks: Column(ranks, pattern))
    docs = pick(docs, key, text)
    schema = T.StructType([docs.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column = get()
        for batch in (part for whole in batches for part in byte_slices(whole, text)):
            yield pa.RecordBatch.from_arrays([batch.column(0), column.encode(batch.column(1))], names=schema.fieldNames())

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with a binary column ``decoded``: the bytes of the ids, of null ids null."""
    spark = encoded.sparkSession
    limit_batches(spark)
    get = _made_of(spark, path, Bytes)
    schema = T.StructType([*encoded.schema, T.StructField("decoded", T.BinaryType())])
    place = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = get()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                yield pa.RecordBatch.from_arrays([*part.columns, tokens.of(part.column(place))], names=schema.fieldNames())

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids, decoded of every row."""
    return decode(encode(docs, path, pattern), path)


def token_counts(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens) of every row."""
    return encode(docs, path, pattern, text, key).select(key, F.size("ids").cast("bigint").alias("n_tokens"))
