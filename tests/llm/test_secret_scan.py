import re

from pledgemart.llm import secret_scan as scan

RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
HEX = "04dbebab91ab85687d33eeaaf9ac699e1188f962"


def brute(docs):
    out = []
    for doc_id, text in docs:
        words = [w for w in re.split(r"[ \t-\r]+", text or "") if w]
        for at, word in enumerate(words):
            if len(word) >= 16:
                out += [(doc_id, at, k, m) for k, m in enumerate(RUN.findall(word))]
    return sorted(out, key=repr)


def test_candidates_match_brute_force(spark, documents, awkward):
    extra = spark.createDataFrame([(1, f'x="{HEX}",y="{HEX[:20]}" tail'), (2, f"https://a.b/{HEX}?q=1"), (3, HEX)], "doc_id long, text string")
    for docs in (documents, awkward, extra):
        got = scan.candidates(docs).select("doc_id", "word_at", "run_at", "candidate").collect()
        place = docs.columns.index("text")
        assert sorted(map(tuple, got), key=repr) == brute([(r[0], r[place]) for r in docs.collect()])


def test_named_values_of_any_length_and_sign(spark):
    docs = spark.createDataFrame([
        (1, "password=hunter2!x end"), (2, "my api_key : 'ab.cd@ef' and"), (3, "secret: $a!b@c.d#e tail"), (4, "the author: Smith wrote x = 12345"),
        (5, "pwd="), (6, f"token={HEX}"), (7, f"auth_token={HEX}.{HEX}!"), (8, "PASSWORD:  x1y2"),
        (9, "a_token=abcd;b_token=efgh"),
    ], "doc_id long, text string")
    got = {}
    for r in scan.candidates(docs).collect():
        got.setdefault(r.doc_id, []).append(r.candidate)
    assert got.pop(7)[-1] == f"{HEX}.{HEX}!"
    assert got == {6: [HEX], 9: ["abcd", "efgh"], 1: ["hunter2!x"], 2: ["ab.cd@ef"], 3: ["$a!b@c.d#e"], 8: ["x1y2"]}


def test_short_named_secrets_are_masked_and_words_stay(spark, documents):
    planted = [(5000 + i, f"see password = q{i * 7919 % 1000}Zx!{i}k for it and the password: please ask", "en", None, 9) for i in range(40)]
    done = scan.redact(documents.union(spark.createDataFrame(planted, documents.schema)))
    texts = [r.text for r in done.filter("doc_id >= 5000").collect()]
    assert len(texts) == 40 and sum("= <SECRET> for" in t for t in texts) >= 38 and all("please ask" in t for t in texts)


def test_labels_are_no_function_of_the_features():
    assert not set(scan.EVIDENCE) & set(scan.FEATURES)


def test_features_match_brute_force(spark, documents):
    table = scan.dictionary(documents)

    def coverage(value):
        low = value.lower()
        threes = [low[i : i + 3] for i in range(max(1, len(low) - 2))]
        place = lambda w: table[(ord(w[0]) - 96) << 10 | (ord(w[1]) - 96) << 5 | (ord(w[2]) - 96)]
        return sum(place(t) if re.fullmatch("[a-z]{3}", t) else 0.0 for t in threes) / len(threes)

    for r in scan.features(scan.candidates(documents), table).collect():
        c = r.candidate
        kinds = ["a" if x.islower() else "A" if x.isupper() else "0" if x.isdigit() else x for x in c]
        want = {
            "f_length": len(c), "f_transitions": sum(a != b for a, b in zip(kinds, kinds[1:])) / len(c),
            "f_digits": len(re.findall("[0-9]", c)) / len(c), "f_upper": len(re.findall("[A-Z]", c)) / len(c),
            "f_hex": len(re.findall("[0-9a-fA-F]", c)) / len(c), "f_letter_run": max(map(len, re.split("[^A-Za-z]+", c))),
            "f_coverage": coverage(c), "f_slashes": c.count("/"), "f_dots": c.count("."),
            "f_before_coverage": coverage(r.before.split(" ")[-1]), "f_after_coverage": coverage(r.after),
        }
        assert {k: r[k] for k in want} == want or all(abs(r[k] - v) < 1e-12 for k, v in want.items()), (c, want, r)


def test_held_out_labels_and_unnamed_secrets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = scan.stage(scan.weak_labels(scan.features(scan.candidates(docs), scan.dictionary(docs))))
    half = found.filter("pmod(xxhash64(candidate), 2) = 0")
    held = scan.scan(docs, labelled=half).join(found.select("doc_id", "word_at", "run_at", "label"), ["doc_id", "word_at", "run_at"])
    n = {(r.label, r.is_secret): r["count"] for r in held.filter("pmod(xxhash64(candidate), 2) = 1").groupBy("label", "is_secret").count().collect()}
    assert n[1.0, True] > 40 and n[0.0, False] > 400
    assert n.get((1.0, False), 0) + n.get((0.0, True), 0) <= 0.02 * sum(n.values())


def test_redaction_keeps_everything_else(spark, sf_dir, documents, awkward):
    planted = documents.limit(0).union(spark.createDataFrame(
        [(1000 + i, f'see token = "{HEX[i:]}{HEX[:i]}" and token = "{HEX}" twice', "en", None, 9) for i in range(8)], documents.schema
    )).union(documents)
    done = scan.redact(planted)
    assert done.columns == documents.columns and done.count() == planted.count()
    rows = {r.doc_id: r for r in done.collect()}
    assert rows[1003].text == 'see token = "<SECRET>" and token = "<SECRET>" twice' and rows[1003].n_chars == len(rows[1003].text)
    before = {r.doc_id: r for r in documents.collect()}
    same = [d for d, r in before.items() if rows[d] == r]
    assert len(same) > 0.9 * len(before)
    assert all(re.sub("<SECRET>", "", r.text)[:10] in before[d].text or "<SECRET>" in r.text for d, r in rows.items() if d in before)
    assert scan.redact(awkward).columns == awkward.columns and scan.redact(awkward).count() == awkward.count()


def test_without_both_labels_or_rows(spark, documents):
    plain = spark.createDataFrame([(1, "averyveryverylongwordindeed"), (2, None)], "doc_id long, text string")
    assert [(r.score, r.is_secret) for r in scan.scan(plain).collect()] == [(0.0, False)]
    assert scan.scan(documents.limit(0)).count() == 0


def test_plan_is_native(spark, documents):
    plan = scan.scan(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_dictionary_has_rarer_words_too(spark):
    """Over 5,000 common words, and rarer ones of other letters."""
    common = "concat(char(97 + id div 676 % 13), char(97 + id div 26 % 26), char(97 + id % 26))"
    docs = spark.range(6000).selectExpr(f"repeat(concat({common}, ' '), 4) text").union(spark.createDataFrame([("Zyxw zyxw Zyxw Zyxw qqq qqq",)], "text string"))
    table = scan.dictionary(docs)
    place = lambda w: table[(ord(w[0]) - 96) << 10 | (ord(w[1]) - 96) << 5 | (ord(w[2]) - 96)]
    assert place("zyx") == place("yxw") == place("iup") == 1.0 and place("qqq") == 0.0
