"""Centroid clustering over a vector-approximation file (VA-file).

Every dimension is cut into a few cells, and each vector is kept twice: its cell numbers, packed into a
few bits per dimension, and the whole vector. For a centroid a table per dimension holds the least and the
greatest squared distance to each cell; their sums over a vector's cells bound its distance. A round
reads the packed cells and the clusters of the round before. A vector whose lowest interval overlaps no
other one, and whose cluster stays, is settled by that. Only the others are fetched: those that may lie
in several clusters, for their exact distances, and those that move, for the sums of the clusters. Sums
are kept from round to round and changed by what moves.

All components are whole numbers, so distances and sums are exact, and neither the order of rows nor the
cells change a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pledgemart.llm.common import discard, limit_batches, pick, stage

DIMENSIONS, SCALE = 64, 64
CLUSTERS, ROUNDS = 16, 3
#: Bits per dimension of the packed cells.
BITS = 6
#: Vectors whose values place the borders of the cells: those of the smallest hashes.
SAMPLE = 4096
#: Components are held to this, so that every squared distance fits in 64 bits.
MOST = 1 << 27
#: Packed cells with the cluster before and behind a round; where the round is not decided, the candidates as bits.
_ROUND = (
    T.StructType().add("key", T.LongType()).add("cells", T.BinaryType()).add("was", T.IntegerType())
    .add("cluster", T.IntegerType()).add("candidates", T.LongType())
)
#: Rows without a key carry what a task adds to the sums of clusters.
_ADDED = T.StructType().add("n", T.LongType()).add("sums", T.ArrayType(T.LongType()))


def scaled(vector: Column) -> Column:
    """Whole numbers floor(64 * x), x as double; null for a vector that is not to be used."""
    fits = (F.size(vector) == DIMENSIONS) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = F.transform(vector, lambda x: F.floor(F.greatest(F.least(SCALE * x, F.lit(float(MOST))), F.lit(float(-MOST)))).cast("int"))
    return F.when(fits, held)


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS).astype(np.int64)


def _borders(values: np.ndarray, most: int) -> np.ndarray:
    """Borders of at most ``most`` cells from the least to the greatest value, and behind it.

    Each value begins with a cell of its own; then the neighbours whose union widens the intervals of the fewest
    values are joined.
    """
    low, mass = np.unique(values, return_counts=True)
    if len(low) > 4 * most:
        keep = np.unique(np.linspace(0, len(low) - 1, 4 * most).astype(int))
        low, mass = low[keep], np.add.reduceat(mass, keep)
    end = values.max() + 1
    while len(low) > most:
        width = np.diff(np.append(low, end)) - 1
        grown = mass[:-1] * (width[1:] + 1) + mass[1:] * (width[:-1] + 1)
        at = int(grown.argmin())
        mass[at] += mass[at + 1]
        low, mass = np.delete(low, at + 1), np.delete(mass, at + 1)
    return np.append(low, end)


class Cells:
    """Cells of each dimension, and intervals of the distances to them."""

    def __init__(self, sample: np.ndarray, bits: int = BITS):
        self.bits, self.dimensions = bits, sample.shape[1]
        # A value is in the cell that its number of borders at or below it names. The outer two cells
        # hold what lies beyond the sample; borders that are not needed are repeated.
        self.borders = np.empty(((1 << bits) - 1, self.dimensions), np.int64)
        for d in range(self.dimensions):
            found = _borders(sample[:, d], (1 << bits) - 2)
            self.borders[:, d] = np.append(found, np.full(len(self.borders) - len(found), found[-1]))
        self.low = np.vstack([np.full(self.dimensions, -MOST), self.borders])
        self.high = np.vstack([self.borders - 1, np.full(self.dimensions, MOST)])

    def pack(self, vectors: np.ndarray) -> np.ndarray:
        cells = np.empty(vectors.shape, np.uint8)
        for d in range(self.dimensions):
            cells[:, d] = np.searchsorted(self.borders[:, d], vectors[:, d], "right")
        bits = cells[:, :, None] >> np.arange(self.bits, dtype=np.uint8) & 1
        return np.packbits(bits.reshape(len(vectors), -1), axis=1)

    def unpack(self, packed: np.ndarray) -> np.ndarray:
        bits = np.unpackbits(packed, axis=1, count=self.dimensions * self.bits).reshape(len(packed), self.dimensions, self.bits)
        return bits @ (1 << np.arange(self.bits)).astype(np.uint8)

    def intervals(self, centroids: np.ndarray) -> np.ndarray:
        """(dimension, cell, 2 * centroids): least, then greatest squared distance to each centroid."""
        low, high = self.low.T[:, :, None] - centroids.T[:, None, :], self.high.T[:, :, None] - centroids.T[:, None, :]
        least = np.where((low <= 0) & (high >= 0), 0, np.minimum(low**2, high**2))
        return np.concatenate([least, np.maximum(low**2, high**2)], axis=2)

    def candidates(self, packed: np.ndarray, table: np.ndarray) -> np.ndarray:
        """(vectors, centroids): which centroids may be nearest."""
        cells = self.unpack(packed)
        bounds = np.zeros((len(packed), table.shape[2]), np.int64)
        for d in range(self.dimensions):
            bounds += table[d][cells[:, d]]
        k = table.shape[2] // 2
        return bounds[:, :k] <= bounds[:, k:].min(axis=1, keepdims=True)


def nearest(vectors: np.ndarray, centroids: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest candidate of each vector, of equal ones that of the smaller number, and its squared distance."""
    best, cluster = np.full(len(vectors), np.iinfo(np.int64).max), np.full(len(vectors), -1, np.int32)
    for k, centroid in enumerate(centroids):
        at = np.flatnonzero(candidates[:, k])
        if len(at):
            distance = ((vectors[at] - centroid) ** 2).sum(axis=1)
            closer = distance < best[at]
            best[at[closer]], cluster[at[closer]] = distance[closer], k
    return cluster, best


class _Sums:
    """What vectors add to the sums of clusters and take from them."""

    def __init__(self, k: int, dimensions: int = DIMENSIONS):
        self.n, self.sums = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)

    def move(self, vectors: np.ndarray, clusters: np.ndarray, sign: int = 1) -> None:
        for k in np.unique(clusters).tolist():
            held = vectors[clusters == k]
            self.n[k] += sign * len(held)
            self.sums[k] += sign * held.sum(axis=0)

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        some = np.flatnonzero(self.n.astype(bool) | self.sums.any(axis=1))
        held = {"cluster": pa.array(some, pa.int32()), "n": pa.array(self.n[some]), "sums": pa.array(list(self.sums[some]), pa.list_(pa.int64()))}
        return pa.RecordBatch.from_arrays([held[f.name] if f.name in held else pa.nulls(len(some), f.type) for f in schema], names=schema.names)


def _batch(names: list[str], columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)


def _without_sums(n: int) -> dict[str, pa.Array]:
    return {"n": pa.nulls(n, pa.int64()), "sums": pa.nulls(n, pa.list_(pa.int64()))}


class VAFile:
    """The file of one table of vectors, and its clustering.

    ``vectors`` has a key column and an array of numbers. Rows whose vector has another number of components,
    or a null or non-finite one, are left out; values beyond 2^27 in size after scaling count as 2^27. Keys may be
    null or repeat, each row counts. A table without a usable vector has no clusters, one with fewer than
    ``clusters`` has as many as it has vectors.
    """

    def __init__(self, vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", seed: int = 1, clusters: int = CLUSTERS, bits: int = BITS, sample: int = SAMPLE):
        self.spark = vectors.sparkSession
        limit_batches(self.spark)
        whole = pick(vectors, key, vector).toDF("id", "v")
        usable = whole.select("id", scaled(F.transform("v", lambda x: x.cast("double"))).alias("v")).where("v IS NOT NULL")
        order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
        first = usable.select(order.alias("h"), "v").orderBy("h", "v").limit(max(sample, clusters)).collect()  # a bounded sample
        first = np.array([r.v for r in first], np.int64).reshape(-1, DIMENSIONS)
        self.key, self.centroids, self.fetched = key, first[:clusters], []
        if not len(first):
            self.table = usable.select("id", "v", F.lit(0).cast("bigint").alias("key"), F.lit(b"").alias("cells"))
            return
        if len(self.centroids) > 62:
            raise ValueError("at most 62 clusters")
        self.cells = cells = Cells(first, bits)
        schema = T.StructType([*usable.schema, T.StructField("key", T.LongType()), T.StructField("cells", T.BinaryType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at = TaskContext.get().partitionId() << 40
            for batch in batches:
                rows = np.arange(at, at + batch.num_rows, dtype=np.int64)
                at += batch.num_rows
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows), _binary(cells.pack(_flat(batch.column(1))))], names=schema.fieldNames())

        #: id, v, key (unique), cells: vectors and approximations; a scan reads the columns that it names.
        self.table = stage(usable.mapInArrow(run, schema))

    def _whole_pass(self) -> DataFrame:
        """A row per vector with its nearest centroid and the distance, and the rows of the sums. All vectors are read."""
        cells, centroids = self.cells, self.centroids
        schema = T.StructType([self.table.schema["id"], *_ROUND.fields[:2], _ROUND["cluster"], T.StructField("distance", T.LongType()), *_ADDED])
        names, arrow = schema.fieldNames(), to_arrow_schema(schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table, total = cells.intervals(centroids), _Sums(len(centroids))
            for batch in batches:
                id_, v, key, packed = batch.columns
                vectors = _flat(v)
                cluster, distance = nearest(vectors, centroids, cells.candidates(_unpacked(packed), table))
                total.move(vectors, cluster)
                yield _batch(names, {"id": id_, "key": key, "cells": packed, "cluster": pa.array(cluster), "distance": pa.array(distance), **_without_sums(len(key))})
            yield total.batch(arrow)

        return stage(self.table.select("id", "v", "key", "cells").mapInArrow(run, schema))

    def _round(self, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The next clusters: (those that the intervals settle, the others after a look at their vectors)."""
        cells, centroids = self.cells, self.centroids
        bits = 1 << np.arange(len(centroids), dtype=np.int64)

        def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = cells.intervals(centroids)
            for batch in batches:
                key, packed, was = batch.columns
                may = cells.candidates(_unpacked(packed), table)
                cluster = may.argmax(axis=1).astype(np.int32)
                fetch = (may.sum(axis=1) > 1) | (cluster != was.to_numpy())
                yield _batch(_ROUND.fieldNames(), {"key": key, "cells": packed, "was": was, "cluster": pa.array(cluster, mask=fetch), "candidates": pa.array(may @ bits, mask=~fetch)})

        met = stage(state.select("key", "cells", F.col("cluster").alias("was")).mapInArrow(narrow, _ROUND))
        # Staged, so that their size is known when Spark chooses how to find the vectors.
        open_ = stage(met.where("candidates IS NOT NULL").drop("cluster"))
        self.fetched.append(open_.count())
        wanted = open_.join(self.table.select("key", "v"), "key").select("key", "cells", "was", "candidates", "v")
        schema = T.StructType([*_ROUND.fields[:4], *_ADDED])
        names, arrow = schema.fieldNames(), to_arrow_schema(schema)

        def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = _Sums(len(centroids))
            for batch in batches:
                key, packed, was, candidates, v = batch.columns
                vectors, before = _flat(v), was.to_numpy()
                cluster, _ = nearest(vectors, centroids, (candidates.to_numpy()[:, None] & bits) > 0)
                moved = cluster != before
                total.move(vectors[moved], before[moved], -1)
                total.move(vectors[moved], cluster[moved])
                yield _batch(names, {"key": key, "cells": packed, "was": was, "cluster": pa.array(cluster), **_without_sums(len(key))})
            yield total.batch(arrow)

        found = stage(wanted.mapInArrow(fetch, schema))
        discard(open_)
        return met, found

    def _add_up(self, rows: DataFrame, total: _Sums) -> None:
        """Take the sums along and renew the centroids: a row per task and cluster comes together, one per cluster to the driver."""
        parts = [F.sum(F.get("sums", F.lit(d)).cast("decimal(38,0)")).alias(f"s{d}") for d in range(DIMENSIONS)]
        for row in rows.where("key IS NULL AND sums IS NOT NULL").groupBy("cluster").agg(F.sum("n").alias("n"), *parts).collect():
            total.n[row.cluster] += row.n
            total.sums[row.cluster] += np.array([int(row[f"s{d}"]) for d in range(DIMENSIONS)])
        some = total.n > 0
        self.centroids = self.centroids.copy()
        self.centroids[some] = total.sums[some] // total.n[some][:, None]

    def cluster(self, rounds: int = ROUNDS) -> DataFrame:
        """Key, cluster and squared distance of every usable vector after ``rounds`` rounds; ``centroids`` are then the last ones."""
        if not len(self.centroids):
            return self.table.select(F.col("id").alias(self.key), F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        total, state, used = _Sums(len(self.centroids)), None, ()
        for n in range(rounds):
            if n == 0:  # every vector comes into a cluster, so all are read
                new = (self._whole_pass(),)
                self._add_up(new[0], total)
                state = new[0].where("key IS NOT NULL")
            else:
                new = self._round(state)
                self._add_up(new[1], total)
                state = new[0].where("candidates IS NULL").select("key", "cells", "cluster").union(new[1].where("key IS NOT NULL").select("key", "cells", "cluster"))
            for old in used:
                discard(old)
            used = new
        last = self._whole_pass()
        for old in used:
            discard(old)
        return last.where("key IS NOT NULL").select(F.col("id").alias(self.key), "cluster", "distance")


def _binary(packed: np.ndarray) -> pa.Array:
    offsets = np.arange(len(packed) + 1, dtype=np.int32) * packed.shape[1]
    return pa.BinaryArray.from_buffers(pa.binary(), len(packed), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(packed))])


def _unpacked(column: pa.Array) -> np.ndarray:
    """The bytes of equally long binary values, a row each."""
    data = np.frombuffer(column.cast(pa.large_binary()).buffers()[2], np.uint8) if len(column) else np.zeros((0, 1), np.uint8)
    width = len(column[0].as_py()) if len(column) else 1
    start = column.offset * width
    return data.reshape(-1)[start : start + len(column) * width].reshape(-1, width)
