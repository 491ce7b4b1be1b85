"""What Spark sizes too low is not sent to the driver, however small the input is."""

import random

import pytest

from pledgemart.llm import near_copies, simhash
from pledgemart.llm.common import stage


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def values():
    rng = random.Random(8)
    found = {rng.getrandbits(63) for _ in range(50)}
    return sorted({*found, *(x ^ 1 for x in found), *(x ^ 1 << 40 for x in found)})


def test_anchors_of_fingerprints_are_sorted_not_broadcast(spark, values):
    fps = stage(spark.createDataFrame([(v,) for v in values], "fp long"))
    links = simhash.links(fps)
    assert "SortMergeJoin [block" in plan(links) and "Broadcast" not in plan(links)
    want = {(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2}
    assert {tuple(r) for r in links.collect()} == want and len(want) >= 100


def test_pairs_of_fingerprints_broadcast_no_anchors(spark, values):
    first = stage(spark.createDataFrame(list(enumerate(values)), "key long, fp long"))
    pairs = near_copies.fingerprint_pairs(first)
    assert "SortMergeJoin [block" in plan(pairs) and "BroadcastHashJoin [block" not in plan(pairs)
    want = {(i, j) for i, a in enumerate(values) for j, b in enumerate(values) if i < j and (a ^ b).bit_count() <= 2}
    assert {tuple(sorted(r)) for r in pairs.collect()} == want


def test_frequent_places_come_as_columns(spark, monkeypatch):
    tallies = stage(spark.createDataFrame([(3, 5), (3, 6), (9, 1 << 33), (None, None)], "place long, n long"))
    frame = type(tallies)
    monkeypatch.setattr(frame, "collect", lambda self: pytest.fail("a row object for each place"))
    table = near_copies._frequent(tallies)
    assert table.dtype == "uint32" and len(table) == near_copies.TABLE
    assert {i: int(table[i]) for i in table.nonzero()[0]} == {3: 11, 9: (1 << 32) - 1}
    assert not near_copies._frequent(tallies.limit(0)).any()
