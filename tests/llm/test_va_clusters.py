import hashlib
import math
import random

import numpy as np
import pytest

from pledgemart.llm import queries, va_clusters
from pledgemart.llm.va_clusters import MOST, Cells, VAFile, nearest


def brute(rows, clusters=16, rounds=3):
    """The contract in plain Python integers: rows are (vec_id, vector)."""
    held = lambda x: math.floor(max(-MOST, min(MOST, 64 * x)))
    kept = [(i, [held(x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:clusters]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    assign = lambda: [min(range(len(centroids)), key=lambda k: (far(v, centroids[k]), k)) for _, v in kept]
    for _ in range(rounds):
        found = assign()
        for k in range(len(centroids)):
            own = [v for (_, v), c in zip(kept, found, strict=True) if c == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = assign()
    distances = [far(v, centroids[k]) for (_, v), k in zip(kept, found, strict=True)]
    per = {k: sum(d for d, c in zip(distances, found, strict=True) if c == k) for k in set(found)}
    digest = lambda k: hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()
    return [(i, k, d, per[k], sum(distances), digest(k)) for (i, _), k, d in zip(kept, found, distances, strict=True)]


def test_query_matches_brute_force_on_the_given_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = queries.op12(spark, sf_dir)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows))


SCHEMA = "vec_id long, embedding array<float>, EMBEDDING int, key int, cluster int"


def awkward(n):
    rng = random.Random(n)
    some = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(6)]
    rows = [(i, [x + rng.choice([0, 0.1, -0.2]) for x in rng.choice(some)]) for i in range(n)]
    rows += [(n + i, some[0]) for i in range(n)]  # copies
    rows += [(5, some[1]), (5, some[2]), (None, some[3]), (None, None), (7000, [1.0] * 63), (7001, [1.0] * 65), (7002, [])]
    rows += [(7003, [None, *some[0][1:]]), (7004, [float("nan"), *some[0][1:]]), (7005, [float("-inf"), *some[0][1:]])]
    rows += [(7006, [3e38, *some[0][1:]]), (7007, [-3e38, *some[1][1:]]), (7008, [0.0] * 64)]
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


@pytest.mark.parametrize("n", [3, 120])
def test_awkward_vectors(spark, n):
    rows = awkward(n)
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA).repartition(4)
    want = brute(rows)
    got = sorted(map(tuple, queries.op12_frame(frame).collect()), key=repr)
    long = lambda x: x if x < 1 << 63 else None
    assert got == sorted(((i, k, d, long(p), long(t), h) for i, k, d, p, t, h in want), key=repr)


def test_tables_without_vectors(spark):
    frame = spark.createDataFrame([(1, None, 1, 2, 3), (2, [1.0], 1, 2, 3)], SCHEMA)
    assert queries.op12_frame(frame).count() == 0
    assert queries.op12_frame(frame.limit(0)).collect() == []


def test_intervals_hold_every_distance_and_candidates_the_nearest():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-40, 41, (500, 64))
    vectors[:3] = [[MOST] * 64, [-MOST] * 64, [0] * 64]
    centroids = vectors[rng.integers(0, 500, 9)]
    exact = ((vectors[:, None, :] - centroids) ** 2).sum(axis=2)
    for bits in (1, 3, 5):
        cells = Cells(vectors[3:200], bits)
        packed = cells.pack(vectors)
        assert packed.shape[1] == 8 * bits
        table = cells.intervals(centroids)
        held = cells.unpack(packed)
        bounds = sum(table[d][held[:, d]] for d in range(64))
        assert (bounds[:, :9] <= exact).all() and (exact <= bounds[:, 9:]).all()
        cluster, distance = nearest(vectors, centroids, cells.candidates(packed, table))
        assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()


def test_few_vectors_are_fetched(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    file = VAFile(vectors)
    found = file.cluster()
    rows = found.count()
    print("fetched of", rows, file.fetched)
    assert rows == vectors.count() and all(n < rows / 2 for n in file.fetched)
