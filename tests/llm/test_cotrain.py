from pyspark.sql import functions as F

from pledgemart.llm import cotrain


def labels_of(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").alias("label"))


def test_held_out_accuracy_and_whole_result(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), labels_of(spark, sf)
    out = cotrain.classify(docs, labels.filter("doc_id % 2 = 0")).cache()
    assert out.count() == docs.count()
    held = out.join(labels.filter("doc_id % 2 = 1"), "doc_id")
    n = {(r.label, r.kept): r["count"] for r in held.groupBy("label", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.01 * n[1, True] and n.get((0, True), 0) <= 0.1 * n[0, False]


def test_rounds_add_rows_of_the_pool(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), labels_of(spark, sf)
    sizes = []
    fit = cotrain._fit
    monkeypatch.setattr(cotrain, "_fit", lambda rows, view: sizes.append(rows.count()) or fit(rows, view))
    model = cotrain.train(docs, labels.filter("doc_id % 3 = 0"), rounds=1)
    assert sizes[2] > sizes[0] and sizes[3] > sizes[1]
    assert all(slope > 0 for slope, _ in model.calibration.values())


def test_labelled_rows_are_bounded_and_every_other_text_is_there_once(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    monkeypatch.setattr(cotrain, "LABELLED_MOST", 50)
    known, rest = cotrain._samples(cotrain.counted(docs.union(docs)), labels_of(spark, sf))
    assert 25 < known.count() < 100 and known.select("doc_id").distinct().count() == known.count()
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).distinct().count()
    assert rest.count() == texts - known.select("text_key").distinct().count()
    # The row that stands for a text is the same in every run.
    assert rest.exceptAll(cotrain._samples(cotrain.counted(docs.repartition(7)), labels_of(spark, sf))[1]).count() == 0


def test_score_is_the_sum_of_the_calibrated_views(spark):
    """Scores worked out by hand from the models' coefficients."""
    import math

    sf = "/root/testdata/sf0.001"
    rows = cotrain.views(cotrain.counted(spark.read.parquet(f"{sf}/documents.parquet")))
    model = cotrain.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), labels_of(spark, "/root/testdata/sf0.01"), rounds=1)
    scores = {r.doc_id: r for r in model.score(rows).collect()}
    for r in rows.collect():
        odds = {}
        for name, fitted in (("text", model.text), ("meta", model.meta)):
            slope, start = model.calibration[name]
            odds[name] = slope * (float(r[f"{name}_view"].dot(fitted.coefficients.toArray())) + fitted.intercept) + start
        want = 1 / (1 + math.exp(-(odds["text"] + odds["meta"] - model.prior)))
        assert abs(scores[r.doc_id].score - want) < 1e-9


def test_awkward_rows_and_labels(spark, awkward):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (6, 1), (7, None)], "doc_id long, label int")
    out = cotrain.classify(awkward, labels).collect()
    assert len(out) == awkward.count() and {r.score for r in out} <= {0.5, 1.0}
    assert cotrain.classify(awkward.limit(0), labels).count() == 0


def test_counts_are_staged_and_views_only_where_they_are_learnt_from(spark, monkeypatch):
    sf, staged, stage = "/root/testdata/sf0.01", [], cotrain.stage

    def noted(df):
        out = stage(df)
        # Taken at once: the rounds remove their tables.
        unused = sum(out.filter(f"{n}_label IS NULL AND {n}_view IS NOT NULL").count() for n in ("text", "meta") if f"{n}_label" in out.columns)
        staged.append((out.columns, unused))
        return out

    monkeypatch.setattr(cotrain, "stage", noted)
    monkeypatch.setattr(cotrain, "ROUNDS", 1)
    assert cotrain.classify(spark.read.parquet(f"{sf}/documents.parquet"), labels_of(spark, sf)).count() > 0
    assert "tf" in staged[0][0] and "text_view" not in staged[0][0]
    assert any("text_label" in columns for columns, _ in staged) and not any(unused for _, unused in staged)


def test_copies_are_dropped_in_parts(spark, monkeypatch):
    """No shuffle of the counts of words holds more than a part of the texts; together the parts have every text once."""
    sf, staged, stage = "/root/testdata/sf0.01", [], cotrain.stage
    docs = spark.read.parquet(f"{sf}/documents.parquet")

    def noted(df):
        out = stage(df)
        if "tf" in out.columns:
            staged.append({r.text_key for r in out.select("text_key").collect()})
        return out

    rows = stage(cotrain.counted(docs.union(docs)))
    monkeypatch.setattr(cotrain, "stage", noted)
    known, rest = cotrain._samples(rows, labels_of(spark, sf).filter("doc_id % 3 = 0"))
    keys = [r.text_key for r in rest.select("text_key").collect()]
    assert len(keys) == len(set(keys)) == sum(map(len, staged)) and set(keys) == set().union(*staged)
    assert max(map(len, staged)) < 0.5 * len(keys)
