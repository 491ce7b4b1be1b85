import random
import re

from pledgemart.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, span=10):
    """(n_words, n_hit, item ids) per document, by looking up every window."""
    windows = {}
    for item_id, text in items:
        words = words_of(text)
        size = min(span, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item_id)
    out = []
    for _, text in docs:
        words, hit, found = words_of(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if (got := windows.get(tuple(words[i : i + size]))) is not None:
                    hit.update(range(i, i + size))
                    found |= got
        out.append((len(words), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def run(spark, docs, items, **how):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.find(d, i, **how).per_document().collect()
    by_id = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in rows}
    assert len(rows) == len(docs)
    return [by_id[doc_id] for doc_id, _ in docs]


def test_random_texts_match_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "漢", "Ab"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 3, 5, 5, 9, 10, 11, 14, 30]) + 0)) for i in range(14) if i != 1]
    items = [(i, t) for i, t in items if len(t.split()) != 1] + [(90, None), (91, items[-1][1])]
    docs = []
    for i in range(120):
        parts = [text(rng.randrange(40))]
        for _ in range(rng.randrange(3)):
            words = (rng.choice(items)[1] or "").split()
            start = rng.randrange(max(1, len(words) - 9))
            parts += [" ".join(words[start : start + rng.choice([9, 10, 11, 40])]), text(rng.randrange(6))]
        docs.append((i, ". ".join(parts)))
    assert run(spark, docs, items) == brute(docs, items)
    assert any(n for _, n, _ in brute(docs, items))


def test_given_tables_match_brute_force(spark, sf_dir, documents):
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = brute(docs, items)
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, k=7, filter_bits=6) == want  # a filter that lets nearly all pass


def test_awkward_rows(spark, awkward):
    items = spark.createDataFrame([(1, "two three four five six seven eight nine ten eleven"), (2, None), (3, "")], "item_id long, text string")
    rows = decontam.find(awkward, items).per_document().collect()
    assert len(rows) == awkward.count()
    assert sorted(r.n_hit for r in rows if r.n_hit) == [10, 10, 10]
    assert decontam.clean(awkward, items).columns == awkward.columns
    assert decontam.clean(awkward, items).count() == awkward.count() - 3
    assert decontam.find(awkward.limit(0), items).per_document().count() == 0
    assert decontam.find(awkward, items.limit(0)).per_document().filter("contaminated").count() == 0
