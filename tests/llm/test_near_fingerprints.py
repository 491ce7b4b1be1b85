import random

from test_near_copies import brute_kept

from pledgemart.llm import near_copies, simhash


def test_near_copies_are_paired_by_simhash_first(spark, monkeypatch):
    rng, used, checked = random.Random(4), [], []
    real, alike = simhash.links, near_copies._alike
    monkeypatch.setattr(simhash, "links", lambda fps, *a: used.append(fps) or real(fps, *a))
    monkeypatch.setattr(near_copies, "_alike", lambda *a: checked.append((out := alike(*a)).count()) or out)
    long = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    texts = [" ".join(long), " ".join([*long[:-1], "other"]), "one two", "ONE  two", "x y z", "", None]
    # Of few words: alike by neither fingerprint nor shingles.
    texts += [" ".join(f"v{rng.randrange(10**6)}" for _ in range(30)) for _ in range(20)]
    docs = list(enumerate(texts))
    kept = {r.doc_id for r in near_copies.keep_one(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert kept == brute_kept(docs) and not kept & {1, 3, 6}
    assert len(used) == 1 and checked[0] >= 1
    # All that is alike here was linked by fingerprints, so no round by shingles was left.
    assert len(checked) == 1


def test_pairs_of_fingerprints(spark):
    rows = [(1, 0), (2, 0), (3, 0), (4, 3), (5, 7), (6, 255)]
    got = {tuple(sorted(r)) for r in near_copies.fingerprint_pairs(spark.createDataFrame(rows, "key long, fp long")).collect()}
    assert got == {(1, 2), (1, 3), (1, 4), (4, 5)}
