"""SentencePiece BPE by a table of last tokens per prefix.

Blanks become the mark of a space and one more is put before the text, as the model says; then characters
merge by the scores of the pieces they make. ``PrefixTable`` gives the ids of all texts of a batch at once:
the last token of every prefix, from the automaton's matches and the test of neighbouring pairs, read off
from the end. A character that the model doesn't have becomes the byte tokens of its UTF-8 bytes.

Decoding looks up the bytes of each token, takes the blank before the text off again, and replaces every
byte of a run of byte tokens that is no UTF-8, as the public library does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from pledgemart.llm.common import byte_slices, limit_batches, pick, text_bytes
from pledgemart.llm.prefix_table import PrefixTable

BLANK = "▁"  # a space within pieces
#: Characters of one text that are encoded at a time.
CHUNK = 1 << 21


class Pieces:
    """A model's pieces, their order of merging and their bytes; models that need more than that are refused."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto.FromString(model)
        kinds = proto.ModelProto.SentencePiece
        rules, trained = spec.normalizer_spec, spec.trainer_spec
        if (
            trained.model_type != proto.TrainerSpec.BPE or not trained.byte_fallback or rules.precompiled_charsmap
            or rules.remove_extra_whitespaces or not rules.escape_whitespaces or trained.treat_whitespace_as_suffix
        ):
            raise ValueError("only BPE models with byte fallback that take texts as they are can be used")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in spec.pieces):
            raise ValueError("models with user-defined or unused pieces can't be used")
        of_kind = lambda kind: {i: p.piece for i, p in enumerate(spec.pieces) if p.type == kind}
        self.count = len(spec.pieces)
        self.prefix = BLANK if rules.add_dummy_prefix else ""
        self.end = next(i for i, p in of_kind(kinds.CONTROL).items() if p == (trained.eos_piece or "</s>"))
        self.unknown, self.unknown_surface = set(of_kind(kinds.UNKNOWN)), trained.unk_surface
        self.bytes = {i: int(p[3:5], 16) for i, p in of_kind(kinds.BYTE).items()}
        self.normal = of_kind(kinds.NORMAL)
        order = {score: n for n, score in enumerate(sorted({p.score for p in spec.pieces}, reverse=True))}
        ranks = {p.piece: order[p.score] for p in spec.pieces if p.type == kinds.NORMAL and len(p.piece) > 1}
        ids = {p: i for i, p in self.normal.items()}
        # Characters that only occur within longer pieces get ids of their own, which end as byte tokens.
        inner = sorted({c for p in ids for c in p} - ids.keys())
        self.inner = np.array([-1 - ord(c) for c in inner], np.int32)
        self.table = PrefixTable(ids | {c: self.count + n for n, c in enumerate(inner)}, ranks)


class Encoder:
    """Columns of texts to ids and back."""

    def __init__(self, model: bytes):
        self.pieces = pieces = Pieces(model)
        raw = {i: p.replace(BLANK, " ").encode() for i, p in pieces.normal.items()} | {i: bytes([b]) for i, b in pieces.bytes.items()}
        parts = [raw.get(i, b"") for i in range(pieces.count)]
        self._parts, self._data = parts, np.frombuffer(b"".join(parts), np.uint8)
        self._sizes = np.array(list(map(len, parts)), np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes
        #: A blank of these, at the beginning of a text, is the one that was put before it.
        self._leads = np.array([bool(pieces.prefix) and i in pieces.normal and p[:1] == b" " for i, p in enumerate(parts)])
        self._marks = np.array([i not in raw for i in range(pieces.count)])
        self._byte_ids = np.zeros(256, np.int32)
        for i, b in pieces.bytes.items():
            self._byte_ids[b] = i

    def _expand(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unknown characters (-1 - character) to their byte tokens."""
        inner = ids >= self.pieces.count
        if inner.any():
            ids[inner] = self.pieces.inner[ids[inner] - self.pieces.count]
        odd = ids < 0
        if not odd.any():
            return ids, counts
        kinds, which = np.unique(ids[odd], return_inverse=True)
        raw = [chr(-1 - k).encode() for k in kinds.tolist()]
        widths = np.array(list(map(len, raw)))[which]
        size = np.ones(len(ids), np.int64)
        size[odd] = widths
        out, ends = np.repeat(ids, size), np.cumsum(size)
        first = (ends - size)[odd]
        for k in range(4):
            held = widths > k
            byte = np.array([r[k] if len(r) > k else 0 for r in raw], np.uint8)
            out[first[held] + k] = self._byte_ids[byte[which[held]]]
        return out, np.diff(np.append(0, ends)[np.append(0, np.cumsum(counts))])

    def _ids(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        symbols = np.where(symbols == 0x20, np.uint32(ord(BLANK)), symbols)
        return self._expand(*self.pieces.table.encode(symbols, starts))

    def _long(self, text: str) -> np.ndarray:
        """Ids of a text that is taken in parts, cut where no token can span."""
        whole, found, at = self.pieces.prefix + text.replace(" ", BLANK), [], 0
        while at < len(whole):
            end = min(len(whole), at + CHUNK)
            back = end
            while at < back < len(whole) and self.pieces.table.spans(whole, back):
                back -= 1
            while back == at and end < len(whole) and self.pieces.table.spans(whole, end):
                end += 1
            end = back if back > at else end
            found.append(self._ids(np.frombuffer(whole[at:end].encode("utf-32-le"), "<u4"), np.zeros(1, np.int64))[0])
            at = end
        return np.concatenate(found)

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """The ids of each text with the end id; of a null or empty text only that."""
        data, offsets = text_bytes(texts)
        if len(texts) == 1 and len(data) > CHUNK:
            ids, counts = self._long(data.tobytes().decode()), None
            counts = np.array([len(ids)])
        else:
            begins = np.append(0, np.cumsum((data & 0xC0) != 0x80))[offsets]  # in characters
            some = np.flatnonzero(np.diff(begins))
            symbols = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
            starts = begins[some]
            if self.pieces.prefix:
                symbols = np.insert(symbols, starts, ord(BLANK))
                starts = starts + np.arange(len(starts))
            ids, per_text = self._ids(symbols, starts)
            counts = np.zeros(len(texts), np.int64)
            counts[some] = per_text
        ends = np.cumsum(counts)
        ids = np.insert(ids, ends, self.pieces.end)
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends + np.arange(1, len(ends) + 1)), pa.int32()), pa.array(ids.astype(np.int32, copy=False)))

    def decode(self, lists: pa.ListArray) -> pa.Array:
        """The text of each list of ids, of a null list null."""
        n = len(lists)
        lists = pa.ListArray.from_arrays(lists.offsets, lists.values, mask=lists.is_null()) if lists.null_count else lists
        ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        if len(ids) and not 0 <= ids.min() <= ids.max() < self.pieces.count:
            raise ValueError("ids that the model doesn't have")
        ends = np.cumsum(counts)
        sizes, begins = self._sizes[ids], self._starts[ids]
        firsts = (ends - counts)[counts > 0]
        lead = firsts[self._leads[ids[firsts]]]
        sizes[lead] -= 1
        begins[lead] += 1
        upto = np.append(0, np.cumsum(sizes))
        data = self._data[np.arange(upto[-1]) + np.repeat(begins - upto[:-1], sizes)]
        bounds = upto[np.append(0, ends)]
        marks = self._marks[ids]
        marks[(ends - 1)[counts > 0]] &= ids[(ends - 1)[counts > 0]] != self.pieces.end
        slow = marks.any() or (data[bounds[:-1][bounds[:-1] < len(data)]] & 0xC0 == 0x80).any()
        try:
            data.tobytes().decode()
        except UnicodeDecodeError:
            slow = True
        if slow:
            return pa.array([None if x is None else self.decode_one(x) for x in lists.to_pylist()], pa.string())
        valid = pa.py_buffer(np.packbits(lists.is_valid().to_numpy(zero_copy_only=False), bitorder="little").tobytes())
        return pa.StringArray.from_buffers(n, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes()), valid)

    def decode_one(self, ids: list[int]) -> str:
        """The text of any ids, step by step: marks give nothing but end a run of bytes."""
        out, held, fresh = [], b"", True
        for i in [*ids, None]:
            if i in self.pieces.bytes:
                held, fresh = held + self._parts[i], False
                continue
            while held:
                size = next((n for n in (1, 2, 3, 4) if _is_character(held[:n])), 0)
                out.append(held[:size].decode() if size else "�")
                held = held[size or 1 :]
            if i in self.pieces.unknown:
                out.append(self.pieces.unknown_surface)
                fresh = False
            elif i in self.pieces.normal:
                piece = self._parts[i].decode()
                out.append(piece[1:] if fresh and self._leads[i] else piece)
                fresh = False
        return "".join(out)


def _is_character(raw: bytes) -> bool:
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


def _encoder_of(spark: SparkSession, path: str):
    """A function for the workers; the model travels once per executor, as the file's bytes."""
    with open(path, "rb") as file:
        # A worker keeps what it was sent, and with it the encoder made of it, from task to task.
        sent = spark.sparkContext.broadcast({"file": file.read()})  # the model, of fixed size

    def make() -> Encoder:
        held = sent.value
        if "encoder" not in held:
            held["encoder"] = Encoder(held["file"])
        return held["encoder"]

    return make


def encode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids) of every row: the ids of its whole text by the model at ``path``, and the end id.

    A null or empty text has the end id only. A text of any length is encoded whole, in parts between which
    no token can lie. Rows keep their number and order within a partition, repeated rows are encoded like
    others, null keys stay null, an empty table gives no rows, and further columns, also of like names, are
    dropped.
    """
    spark = docs.sparkSession
    limit_batches(spark)
    make = _encoder_of(spark, path)
    docs = pick(docs, key, text)
    schema = T.StructType([docs.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make()
        for batch in (part for whole in batches for part in byte_slices(whole, text)):
            yield pa.RecordBatch.from_arrays([batch.column(0), encoder.encode(batch.column(1))], names=schema.fieldNames())

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the text of the ids, of null ids null."""
    spark = encoded.sparkSession
    limit_batches(spark)
    make = _encoder_of(spark, path)
    schema = T.StructType([*encoded.schema, T.StructField("decoded", T.StringType())])
    place = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                yield pa.RecordBatch.from_arrays([*part.columns, encoder.decode(part.column(place))], names=schema.fieldNames())

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, decoded of every row."""
    return decode(encode(docs, path), path)
