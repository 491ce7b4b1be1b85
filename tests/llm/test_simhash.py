import random
import re

import pytest
import xxhash

from pledgemart.llm import components, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def brute_components(fps):
    """Smallest id by repeated search; ids may repeat or be null."""
    out, groups = [], []
    for _, fp in fps:
        if any(fp in g for g in groups):
            continue
        group, todo = set(), [fp]
        while todo:
            a = todo.pop()
            if a not in group:
                group.add(a)
                todo += [b for _, b in fps if b not in group and (a ^ b).bit_count() <= 2]
        groups.append(group)
    for d, fp in fps:
        group = next(g for g in groups if fp in g)
        out.append((d, fp, min((x for x, y in fps if y in group and x is not None), default=None)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", ["given", "awkward"])
def test_rows_match_brute_force(spark, documents, awkward, name):
    docs = documents if name == "given" else awkward
    place = docs.columns.index("text")
    fps = [(r[0], brute_fingerprint(r[place])) for r in docs.collect()]
    got = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == brute_components(fps)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len({str(c) + str(f if c is None else "") for _, f, c in brute_components(fps)})


def test_links_of_chains_and_clusters_are_all_found(spark):
    rng, values = random.Random(1), []
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(8):
            values.append(x)
            for _ in range(rng.randint(0, 2)):
                x ^= 1 << rng.randrange(64)
    values += [0, 1, 3, 7, 15, (1 << 64) - 1, 1 << 63, 1 << 31, (1 << 63) | (1 << 31)]
    values = sorted({signed(v) for v in values})
    got = [tuple(r) for r in simhash.links(spark.createDataFrame([(v,) for v in values], "fp long")).collect()]
    want = [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if ((a ^ b) % (1 << 64)).bit_count() <= 2]
    assert sorted(got) == sorted(want)


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 90)] + [(200, i) for i in range(201, 260)] + [(300, 301), (301, 300), (5, 5)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(91)}, **{i: 200 for i in range(200, 260)}, 300: 300, 301: 300}
