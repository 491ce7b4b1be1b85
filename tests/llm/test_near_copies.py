import random

import numpy as np
import pytest

from pledgemart.llm import near_copies


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_kept(docs):
    """The smallest id of each group, by comparing every set of shingles with every other (ids are unique)."""
    sets = {d: shingles(t) for d, t in docs}
    alike = lambda x, y: x == y or 5 * len(x & y) >= 4 * len(x | y)
    ids, root = sorted(sets), {}
    for i in ids:
        todo = [] if i in root else [i]
        while todo:
            a = todo.pop()
            if a not in root:
                root[a] = i
                todo += [b for b in ids if b not in root and alike(sets[a], sets[b])]
    return {d for d, r in root.items() if d == r}


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_given_tables_match_brute_force(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = {r.doc_id for r in near_copies.keep_one(docs).collect()}
    assert kept == brute_kept(rows) and len(kept) < len({t for _, t in rows})


@pytest.mark.parametrize("centres", [(2, 4, 8)])
def test_chains_clusters_and_common_lines(spark, monkeypatch, centres):
    monkeypatch.setattr(near_copies, "CENTRES", centres)
    rng, texts = random.Random(2), []
    common = " ".join(f"line{i}" for i in range(12))
    for _ in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice((6, 30, 120)))]
        for _ in range(8):
            texts.append(f"{' '.join(words)} {common}")
            for _ in range(rng.randint(0, 4)):  # edits that add up along the chain
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    base = [f"b{i}" for i in range(200)]
    texts += [" ".join(w if rng.random() > 0.012 else f"x{rng.randrange(10**6)}" for w in base) for _ in range(60)]
    texts += ["", " \n", None, "One two", "one  TWO", "one"]
    docs = list(enumerate(texts))
    kept = {r.doc_id for r in near_copies.keep_one(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    assert kept == brute_kept(docs)


def test_counts_never_rule_out_texts_that_are_alike():
    rng, ruled_out = random.Random(5), 0
    for _ in range(400):
        n = rng.choice([1, 5, 40, 300, 9000])
        a = [rng.getrandbits(64) for _ in range(n)]
        b = [x for x in a if rng.random() > rng.choice([0, 0.1, 0.3])] + [rng.getrandbits(64) for _ in range(rng.randrange(1 + n // 5))]
        x, y = (np.unique(np.array(v or [1], np.uint64)) for v in (a, b))
        held = near_copies.counts_of(x), near_copies.counts_of(y)
        assert near_copies.may_be_alike(*held, len(x), len(y)) or not near_copies.are_alike(x, y)
    for _ in range(100):
        n = rng.choice([100, 1000, 6000])
        x, y = (np.unique(np.array([rng.getrandbits(64) for _ in range(n)], np.uint64)) for _ in range(2))
        ruled_out += not near_copies.may_be_alike(near_copies.counts_of(x), near_copies.counts_of(y), len(x), len(y))
    assert ruled_out > 95
    same = np.full(3, 7 << 20, np.uint64) + np.arange(3, dtype=np.uint64)
    assert near_copies.counts_of(np.repeat(same, 200))[7] == 255  # held, and read as any number


def test_awkward_rows(spark, awkward):
    """Equal ids, nulls, a very long text and clashing names: one row of each group, kept whole."""
    kept = near_copies.keep_one(awkward)
    assert kept.columns == awkward.columns
    rows = [tuple(r) for r in kept.collect()]
    assert set(rows) <= {tuple(r) for r in awkward.collect()}
    assert sorted((r[0] is None, r[0] or 0) for r in rows) == [(False, i) for i in (1, 3, 6, 7, 8)] + [(True, 0)]
    assert near_copies.keep_one(awkward.limit(0)).count() == 0


def test_rounds_of_a_large_group_stay_few(spark, monkeypatch):
    """Texts that share a passage and are not alike: more of them meet in each round, and without new links no component is sought."""
    common = " ".join(f"c{i}" for i in range(12))
    docs = spark.createDataFrame([(i, f"{common} a{i} b{i}") for i in range(200)], "doc_id long, text string")
    calls, alike, components = [], near_copies._alike, near_copies.components

    def counted(*given):
        calls.append("round")
        assert calls.count("round") < 9
        return alike(*given)

    monkeypatch.setattr(near_copies, "_alike", counted)
    monkeypatch.setattr(near_copies, "components", lambda edges: calls.append("components") or components(edges))
    monkeypatch.setattr(near_copies, "CENTRES", (1,))
    monkeypatch.setattr(near_copies, "PAIRS", 200, raising=False)
    assert near_copies.keep_one(docs).count() == 200
    assert calls.count("round") > 3 and calls.count("components") == 1


def test_new_links_join_known_components(spark):
    roots = spark.createDataFrame([(1, 1), (4, 1), (2, 2), (6, 2), (3, 3), (9, 3)], "node long, root long")
    links = spark.createDataFrame([(4, 6), (7, 8), (8, 9), (5, 10)], "a long, b long")
    got = {r.node: r.root for r in near_copies._joined(roots, links).collect()}
    assert got == {1: 1, 4: 1, 2: 1, 6: 1, 3: 3, 9: 3, 7: 3, 8: 3, 5: 5, 10: 5}


def test_alike_texts_are_within_reach_at_the_first_shingle_they_share():
    rng, alike = random.Random(9), 0
    for _ in range(2000):
        a = [rng.getrandbits(64) for _ in range(rng.choice([1, 4, 9, 40, 300]))]
        b = [x for x in a if rng.random() > rng.choice([0, 0.1, 0.2])]
        b += [rng.getrandbits(64) for _ in range(rng.randrange(1 + len(a) // 5))]
        x, y = (np.unique(np.array(v or [1], np.uint64)) for v in (a, b))
        if near_copies.are_alike(x, y):
            first = np.intersect1d(x, y)[0]
            reach_x, reach_y = (int(near_copies.reach_of(len(v), np.searchsorted(v, first))) for v in (x, y))
            assert len(x) <= reach_y and len(y) <= reach_x
            alike += 1
    assert alike > 500


def test_pairs_of_large_groups_keep_in_step_with_rows(spark, monkeypatch):
    """Edited copies of one text, and texts with one passage as their greater part: few pairs are compared, few rounds needed."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(60)]
    texts = [" ".join(w if rng.random() > 0.02 else f"x{rng.randrange(10**6)}" for w in base) for _ in range(200)]
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [" ".join([passage, *(f"q{rng.randrange(10**6)}" for _ in range(rng.randint(13, 15)))]) for _ in range(200)]
    docs = list(enumerate(texts))
    pairs, alike = [], near_copies._alike

    def counted(met, *given):
        pairs.append(met.distinct().count())
        return alike(met, *given)

    monkeypatch.setattr(near_copies, "_alike", counted)
    monkeypatch.setattr(near_copies, "CENTRES", (1, 4))
    kept = {r.doc_id for r in near_copies.keep_one(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    assert kept == brute_kept(docs)
    assert sum(pairs) < 20 * len(texts) and len(pairs) < 12, pairs


def test_only_what_pairs_need_is_moved_or_kept(spark, monkeypatch):
    """Shingles of one text only are never staged, and texts and counts are picked for their pairs without a shuffle, also where nothing is broadcast."""
    rng, staged, real = random.Random(6), [], near_copies.stage

    def noted(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        out = real(df)
        staged.append((df.columns, out.count(), "Exchange" in plan))
        return out

    long = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    texts = [" ".join(f"v{rng.randrange(10**6)}" for _ in range(40)) for _ in range(300)]
    texts += [" ".join(long), " ".join([*long[:-1], "other"]), " ".join([*long[:200], "other", *long[201:]])]
    docs = list(enumerate(texts))
    monkeypatch.setattr(near_copies, "stage", noted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = {r.doc_id for r in near_copies.keep_one(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert kept == brute_kept(docs) == set(range(301))
    assert sum(n for names, n, _ in staged if "token" in names) < 300
    picked = [(n, moved) for names, n, moved in staged if "t" in names]
    assert picked and all(n < 30 and not moved for n, moved in picked), picked


def test_among_finds_all_and_few_others(spark):
    rows = spark.range(20000).selectExpr("id * 3 as row_key", "cast(id as string) as t").repartition(3)
    wanted = spark.range(500).selectExpr("id * 90 as a", "id * 90 + 3 as b")
    got = {r.row_key for r in near_copies.among(rows, "row_key", wanted, 1000).collect()}
    assert got >= {r for i in range(500) for r in (90 * i, 90 * i + 3)} and len(got) < 1400
    assert near_copies.among(rows.limit(0), "row_key", wanted, 1000).count() == 0
