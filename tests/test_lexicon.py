import random

from pyspark.sql import functions as F

from pledgemart.functions import text as nlp
from pledgemart.functions.lexicon import groups_found, trie_pattern, weighed_hits


def _words(rng, n):
    return ["".join(rng.choice("ab.|)가나\U0001f600") for _ in range(rng.randint(1, 5))) for _ in range(n)]


def test_hits_equal_those_of_looking_for_each_word(spark):
    rng = random.Random(3)
    texts = [None, "", *("".join(rng.choice("abc.|)가나다\U0001f600\n") for _ in range(rng.randint(1, 60))) for _ in range(200))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    weights = [(w, rng.choice((1, 1, -1, 3))) for w in _words(rng, 300)] + [("", 2)]
    groups = {"first": _words(rng, 40), "any": ["", "zz"], "last": _words(rng, 40), "none": ["zz"]}
    got = df.select("t", weighed_hits(F.col("t"), weights).alias("n"), groups_found(F.col("t"), groups).alias("g")).collect()
    assert len(got) == len(texts)
    for r in got:
        if r.t is None:
            assert r.n is None and r.g == ""
        else:
            assert r.n == sum(weight for w, weight in weights if w in r.t)
            assert r.g == ",".join(g for g, words in groups.items() if any(w in r.t for w in words))


def test_large_lexicons_give_what_small_ones_give(spark, monkeypatch):
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    lexicon = nlp.Lexicon(positive=["der", "de", "ation", "der"], negative=["the", "he", "hen"], groups={"a": ["tion", "io"], "b": ["q"]}, lower=True)
    both = []
    for many in (64, 0):
        monkeypatch.setattr(nlp, "MANY_WORDS", many)
        both.append(texts.select("text", nlp.sentiment_balance(F.col("text"), lexicon), nlp.keyword_groups(F.col("text"), lexicon)).collect())
    assert both[0] == both[1]


def test_no_word_matches_nowhere(spark):
    assert spark.range(1).select(weighed_hits(F.lit("text"), [])).first()[0] == 0
    assert trie_pattern([""]) == "(?!)"
