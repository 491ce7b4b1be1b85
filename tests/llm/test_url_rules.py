import re
from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from pledgemart.llm import url_rules
from pledgemart.llm.queries import URL_LIST, op6


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def listed(url):
    host, path = parts(url)
    fit = [(len(h + p), h + p, v) for v, h, p in URL_LIST if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1", "http://example.com", "http://example.com?x=/en/", "x://a.example.com/en/#/y",
    "https://example.net/es/1", "https://q.net/fr/", "https://q.net/fr", "https://notexample.com/en/a", "http://É.net/é?ä#ö", "a://b://c.net/es/",
    "http://a.org/de/page.html?utm=1&ref=2#top", "http://a.org/de/", "http://a.org/de/\nx",
]


def test_hosts_paths_and_list_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    labels = spark.createDataFrame([], "page_id long, label string")
    got = {r.page_id: r for r in url_rules.judge(pages, labels, URL_LIST).collect()}
    for i, url in enumerate(URLS):
        assert (got[i].host, got[i].path) == parts(url)
        rule, verdict = listed(url)
        assert got[i].rule == rule and (rule is None or got[i].verdict == verdict)


def test_rules_and_matches_are_those_of_brute_force(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").unionByName(
        spark.createDataFrame([(900 + i, u, None) for i, u in enumerate(URLS)], "page_id long, url string, html string"))
    labels = spark.createDataFrame([(i, "block" if i % 3 else "allow") for i in range(0, 950, 2)] + [(4, "block"), (None, "allow")], "page_id long, label string")
    support, confidence = 0.15, 0.6
    sets = {r.page_id: (r.url, tuple(r.tokens)) for r in pages.select("page_id", "url", url_rules.tokens_of(F.col("url")).alias("tokens")).collect()}
    label = {i: "block" if i % 3 else "allow" for i in range(0, 950, 2) if i != 4}
    transactions = [(t, listed(u)[1] or label.get(i)) for i, (u, t) in sets.items()]
    transactions = [(t, v) for t, v in transactions if t and v]
    n = len(transactions)
    frequent = {k for k, c in Counter(x for t, _ in transactions for x in t).items() if c >= support * n}
    whole, with_label = Counter(), Counter()
    for t, v in transactions:
        items = [x for x in t if x in frequent]
        for size in range(1, len(items) + 1):
            for c in combinations(items, size):
                whole[c] += 1
                with_label[c, v] += 1
    rules = [(k / whole[c], k / n, len(c), list(c), v) for (c, v), k in with_label.items() if k >= support * n and k / whole[c] >= confidence]
    assert rules
    got = {r.page_id: r for r in url_rules.judge(pages, labels, URL_LIST, support, confidence).collect()}
    for i, (url, tokens) in sets.items():
        fits = [r for r in rules if set(r[3]) <= set(tokens)]
        want = listed(url)[1] or (max(fits)[4] if fits else "allow")
        assert got[i].verdict == want, (url, got[i])


def test_query_and_empty_tables(spark, sf_dir):
    out = op6(spark, sf_dir)
    assert out.columns[:5] == ["page_id", "host", "path", "rule", "verdict"] and out.count() == 50
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").withColumn("URL ", F.lit(1)).withColumn("Html", F.lit(1)).withColumn("tokens", F.lit(1))
    none = spark.createDataFrame([], "page_id long, label string")
    assert url_rules.judge(pages.limit(0), none, URL_LIST).count() == 0
    assert url_rules.judge(pages.union(pages), none, []).filter("verdict = 'allow'").count() == 100
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
