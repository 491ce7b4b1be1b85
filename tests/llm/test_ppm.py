import math
import zlib
from collections import Counter, defaultdict

import pytest

from pledgemart.llm import ppm
from pledgemart.llm.common import pick

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Trie:
    """PPM with method C and exclusion, symbol by symbol."""

    def __init__(self):
        self.counts = defaultdict(Counter)

    def symbols(self, raw):
        return ["start"] * 4, [*raw, "end"]

    def train(self, raw):
        before, todo = self.symbols(raw)
        for s in todo:
            for k in range(5):
                self.counts[tuple(before[len(before) - k :])][s] += 1
            before = [*before[1:], s]

    def probability(self, before, s):
        p, excluded = 1.0, set()
        for k in range(4, -1, -1):
            counts = {x: n for x, n in self.counts.get(tuple(before[len(before) - k :]), {}).items() if x not in excluded}
            if counts:
                total, kinds = sum(counts.values()), len(counts)
                if s in counts:
                    return p * counts[s] / (total + kinds)
                p *= kinds / (total + kinds)
                excluded |= set(counts)
        return p / (257 - len(excluded))

    def log10(self, raw):
        before, todo = self.symbols(raw)
        out = 0.0
        for s in todo:
            out += math.log10(self.probability(before, s))
            before = [*before[1:], s]
        return out


def brute(docs):
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in docs]
    raws = [(t or "").translate(LOWER).encode() for _, t in docs]
    trie, words = Trie(), Counter()
    for raw, out in zip(raws, held):
        if not out:
            trie.train(raw)
            words.update([*raw.split(), None])
    n, v = sum(words.values()), len(words)
    rows = []
    for (d, _), raw, out in zip(docs, raws, held):
        tokens = [*raw.split(), None]
        base = sum(math.log10((words[t] + 1) / (n + v + 1)) for t in tokens)
        rows.append((d, out, len(tokens), sum(words[t] > 0 for t in tokens), n, round(base, 6), round(trie.log10(raw), 6)))
    return sorted(rows, key=repr)


def run(docs, **how):
    return sorted(((*tuple(r)[:5], round(r.base_score, 6), round(r.score, 6)) for r in ppm.score(docs, **how).collect()), key=repr)


@pytest.mark.parametrize("chunk_bytes", [1 << 24, 20_000])
def test_given_tables_match_a_trie(spark, documents, chunk_bytes):
    some = documents.filter("length(text) < 4000").repartition(3)
    docs = [(r.doc_id, r.text) for r in some.collect()]
    want = brute(docs)
    assert any(r[1] for r in want) and run(some, chunk_bytes=chunk_bytes) == want


def test_awkward_rows(spark, awkward):
    odd = pick(awkward, "doc_id", "text").filter("doc_id IS NULL OR doc_id != 6")
    odd = odd.union(spark.createDataFrame([(i, t) for i, t in enumerate(["aaaa", "\u0000\u0001", "É漢 ÉÉ", "AbAbAb", "zzz never", "abababababab"] * 6, 30)], "doc_id long, text string"))
    assert run(odd) == brute([tuple(r) for r in odd.collect()])
    assert ppm.score(awkward).count() == awkward.count()
    assert ppm.score(awkward.limit(0)).count() == 0
    lone = spark.createDataFrame([(i, "Some text") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id long, text string")
    assert run(lone) == brute([tuple(r) for r in lone.collect()])


def test_probabilities_of_all_symbols_sum_to_one(spark):
    """What may follow a context, seen or not, shares all of the probability."""
    trie = Trie()
    for raw in (b"banana", b"bandana", b"an", b""):
        trie.train(raw)
    for before in ([*b"bana"], [*b"anan"], [*b"zzan"], ["start"] * 4, [*b"qqqq"]):
        assert abs(sum(trie.probability(before, s) for s in [*range(256), "end"]) - 1) < 1e-9
