"""Quality classifier by co-training of two views.

One classifier sees the content of a text: its words, their length, digits, capitals. The
other sees the page: source, language, size and form (lines, signs, repetition), but no word. Both start from the
labelled rows. In every round each labels all other texts of the table, once each, and those it is sure
of are added to the training rows of the other. At the end each view is calibrated on labelled rows that
neither was trained on, and the two calibrated log odds are added (less the prior, which both contain).

Only the labelled rows are a bounded sample, by the parameter below. The unlabelled texts of every round are
all of them, and the score is computed for every document from its whole text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import FeatureHasher, HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from pledgemart.llm.common import discard, pick, stage
from pledgemart.llm.quality_rules import words_of

#: Labelled rows for fitting and calibration; of more, about so many, and the others count as unlabelled.
LABELLED_MOST = 4_000
ROUNDS, SURE = 3, 0.95
#: A pseudo-label weighs so much of a given one.
PSEUDO_WEIGHT = 0.5
#: One in so many labelled rows is kept for calibration.
CALIBRATION = 4
WORD_FEATURES, META_FEATURES = 1 << 12, 1 << 8
THRESHOLD = 0.5
#: Copies of texts are dropped in so many parts, one after the other.
PARTS = 4

_CONTENT = ["t_digits", "t_capitals", "t_word_length"]
_LAYOUT = ["m_size", "m_lines", "m_signs", "m_distinct"]
_KINDS = ["m_source", "m_lang", "m_size_class"]


def counted(docs: DataFrame) -> DataFrame:
    """What both views are made of, for every row (doc_id, text): its counts of hashed words and figures.

    ``source`` and ``lang`` are used if they are there; null counts as a value of its own. ``text_key`` is a
    hash of the text, the same for equal texts, ``page_key`` one of source and language.
    """
    there = [c for c in ("source", "lang") if c in docs.columns]
    rows = pick(docs, "doc_id", "text", *there)
    label = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("?")) if c in there else F.lit("?")
    rows = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), label("source").alias("m_source"), label("lang").alias("m_lang"))
    rows = rows.withColumn("words", words_of(F.lower("text")))
    size, n = F.length("text"), F.size("words")
    share = lambda count, whole: (count / F.greatest(whole, F.lit(1))).cast("double")
    of = lambda pattern: share(size - F.length(F.regexp_replace("text", pattern, "")), size)
    rows = rows.withColumns({
        "text_key": F.xxhash64("text"), "page_key": F.xxhash64("m_source", "m_lang"),
        "t_digits": of("[0-9]"), "t_capitals": of(r"\p{Lu}"),
        "m_distinct": share(F.size(F.array_distinct("words")), n),
        "t_word_length": share(F.length(F.regexp_replace("text", r"\s", "")), n) / 10,
        "m_size": F.log1p(size.cast("double")) / 10,
        "m_lines": 10 * share(size - F.length(F.translate("text", "\n", "")), size),
        "m_signs": of(r"[^\p{L}\p{N}\s.,;:'-]"),
        "m_size_class": F.concat(F.lit("s"), F.floor(F.log2(size + F.lit(1))).cast("string")),
    })
    rows = HashingTF(numFeatures=WORD_FEATURES, inputCol="words", outputCol="tf").transform(rows)
    return rows.select("doc_id", "text_key", "page_key", "tf", *_CONTENT, *_LAYOUT, *_KINDS)


def views(rows: DataFrame) -> DataFrame:
    """The rows of ``counted`` with the two feature vectors, text_view and meta_view, in place of their parts."""
    rows = Normalizer(inputCol="tf", outputCol="words").transform(rows)
    rows = VectorAssembler(inputCols=["words", *_CONTENT], outputCol="text_view").transform(rows)
    rows = FeatureHasher(numFeatures=META_FEATURES, inputCols=_KINDS, outputCol="kinds").transform(rows)
    rows = VectorAssembler(inputCols=["kinds", *_LAYOUT], outputCol="meta_view").transform(rows)
    return rows.drop("tf", "words", "kinds", *_CONTENT, *_LAYOUT, *_KINDS)


@dataclass
class Model:
    """Both views' classifiers, their calibration (slope, intercept), and the prior log odds.

    Without labels of both kinds there are no classifiers, and every score is ``only``.
    """

    text: LogisticRegressionModel | None
    meta: LogisticRegressionModel | None
    calibration: dict[str, tuple[float, float]]
    prior: float
    only: float = 0.5

    def score(self, rows: DataFrame) -> DataFrame:
        """doc_id, text_score, meta_score, score of rows with both views."""
        if self.text is None:
            same = F.lit(self.only)
            return rows.select("doc_id", same.alias("text_score"), same.alias("meta_score"), same.alias("score"))
        odds = {}
        for name in ("text", "meta"):
            rows = _apply(getattr(self, name), rows, name)
            slope, start = self.calibration[name]
            odds[name] = F.lit(slope) * F.col(f"{name}_odds") + F.lit(start)
        return rows.select(
            "doc_id", _share(odds["text"]).alias("text_score"), _share(odds["meta"]).alias("meta_score"),
            _share(odds["text"] + odds["meta"] - F.lit(self.prior)).alias("score"),
        )


def _share(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def _apply(model: LogisticRegressionModel, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with the model's log odds for good quality."""
    done = model.transform(rows).withColumn(f"{name}_odds", vector_to_array("rawPrediction")[1])
    return done.drop("rawPrediction", "probability", "prediction")


def _fit(rows: DataFrame, view: str) -> LogisticRegressionModel:
    return LogisticRegression(featuresCol=view, labelCol="label", weightCol="weight", maxIter=25, regParam=1e-4).fit(rows)


def _part(column: str, share: float) -> Column:
    return F.pmod(F.xxhash64(F.col(column), F.lit("part")), F.lit(1 << 30)) <= int(min(1.0, share) * (1 << 30))


def _first(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key; a task drops the others of its rows before the shuffle."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("place", place).where("place = 1").drop("place")


def _samples(rows: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the rows of ``counted`` the labelled ones, one per id, with ``label``; and all other texts, one row each; both with their views."""
    given = labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    given = given.filter("label = other").select("doc_id", F.col("label").cast("double").alias("label"))
    ids = stage(rows.select("doc_id").filter("doc_id IS NOT NULL").distinct().join(given, "doc_id"))
    few = ids.filter(_part("doc_id", LABELLED_MOST / max(1, ids.count())))
    # LABELLED_MOST ids, or nearly so; below, as many texts. Copies of a labelled text are left out of the rest.
    known = stage(views(_first(rows.join(F.broadcast(few), "doc_id"), "doc_id", "text_key", "page_key")))
    discard(ids)
    rest = rows.join(F.broadcast(known.select("text_key").distinct()), "text_key", "left_anti")
    # Counts of words take less disk than their shares in the views, which are written when the shuffles' files are gone.
    # A shuffle's rows take three times the disk of a staged table, so that only one part of the texts is shuffled at a time.
    parts = [stage(_first(rest.filter(F.pmod("text_key", F.lit(PARTS)) == i), "text_key", "doc_id", "page_key")) for i in range(PARTS)]
    pool = stage(views(reduce(DataFrame.union, parts)))
    for part in parts:
        discard(part)
    return known, pool


def train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, sure: float = SURE) -> Model:
    """Co-train on ``docs`` (doc_id, text) and ``labels`` (doc_id, label: 1 good, 0 not)."""
    return _train(stage(counted(docs)), labels, rounds, sure)


def _train(all_rows: DataFrame, labels: DataFrame, rounds: int = ROUNDS, sure: float = SURE) -> Model:
    known, rest = _samples(all_rows, labels)
    try:
        return _exchange(known, rest, rounds, sure)
    finally:
        discard(known)
        discard(rest)


def _exchange(known: DataFrame, pool: DataFrame, rounds: int, sure: float) -> Model:
    rows = known.withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION)))
    counts = {(r.label, r.held): r["count"] for r in rows.groupBy("label", (F.col("fold") == 0).alias("held")).count().collect()}
    if any(not counts.get((label, held)) for label in (0.0, 1.0) for held in (False, True)):
        total = sum(counts.values())
        good = sum(n for (label, _), n in counts.items() if label == 1)
        return Model(None, None, {}, 0.0, good / total if total else 0.5)
    given = rows.filter("fold != 0").withColumn("weight", F.lit(1.0))
    held = rows.filter("fold = 0")
    # Pseudo-labels of the last round, as a table: each is worked out once, not in every pass of a fit.
    told = None
    models: dict[str, LogisticRegressionModel] = {}
    for turn in range(rounds + 1):
        for name in ("text", "meta"):
            train_on = given.select(f"{name}_view", "label", "weight")
            if told is not None:
                label = F.col(f"{name}_label")
                train_on = train_on.union(told.filter(label.isNotNull()).select(f"{name}_view", label, F.lit(PSEUDO_WEIGHT)))
            models[name] = _fit(train_on, f"{name}_view")
        if told is not None:
            discard(told)
        if turn < rounds:
            told = stage(_told(models, pool, sure))
    calibration = {}
    for name, model in models.items():
        odds = VectorAssembler(inputCols=[f"{name}_odds"], outputCol="x").transform(_apply(model, held, name)).withColumn("weight", F.lit(1.0))
        line = LogisticRegression(featuresCol="x", labelCol="label", weightCol="weight", maxIter=50, regParam=1e-3).fit(odds.select("x", "label", "weight"))
        calibration[name] = float(line.coefficients[0]), float(line.intercept)
    good, bad = (sum(n for (label, _), n in counts.items() if label == x) for x in (1.0, 0.0))
    return Model(models["text"], models["meta"], calibration, math.log(good / bad))


def _told(models: dict[str, LogisticRegressionModel], pool: DataFrame, sure: float) -> DataFrame:
    """The rows of ``pool`` that a view is sure of: text_label is what the text's classifier is to learn, meta_label the page's."""
    judged = pool.select("text_view", "meta_view")
    for name, model in models.items():
        judged = _apply(model, judged, name)
    least = math.log(sure / (1 - sure))
    is_sure = lambda name: F.abs(F.col(f"{name}_odds")) >= least
    apart = F.signum("text_odds") != F.signum("meta_odds")
    labels = {
        # A row on which both are sure, of different things, helps neither.
        f"{name}_label": F.when(is_sure(other) & ~(is_sure(name) & apart), (F.col(f"{other}_odds") > 0).cast("double"))
        for name, other in (("text", "meta"), ("meta", "text"))
    }
    told = judged.withColumns(labels).drop("text_odds", "meta_odds").filter(" OR ".join(f"{c} IS NOT NULL" for c in labels))
    # A view is kept where it is to be learnt from.
    return told.select(*(F.when(F.col(f"{n}_label").isNotNull(), F.col(f"{n}_view")).alias(f"{n}_view") for n in models), *labels)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_score, meta_score, score, kept of every row of ``docs``.

    Null texts count as empty and are scored like others, as are very long ones; rows without an id are
    scored and may get pseudo-labels only; ids with both labels count as unlabelled; of several texts of a
    labelled id one is taken, by its hash; other columns are ignored; an empty table gives no rows.
    """
    rows = stage(counted(docs))
    return _train(rows, labels).score(views(rows)).withColumn("kept", F.col("score") >= threshold)
