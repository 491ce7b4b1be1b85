"""Secret scans: candidates by shape, false positives removed by a random forest.

A candidate is a run of at least 16 characters of keys and tokens (letters, digits, + / _ = -), or whatever
a text puts behind a secret's name and = or :, of any signs and from 4 characters on. Most are long words,
numbers or names. A forest judges each by its length, the transitions between character classes, how far its
letters are those of the corpus's own words, signs of a path, and the words beside it. It is trained on
labelled findings; where no table of them exists, ``weak_labels`` makes some from how a candidate is written
down (named, assigned, quoted, in a URL). The forest does not see these, so it learns what secrets look like.

All of it is column expressions and Spark's own forest.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from pledgemart.llm.common import pick, stage
from pledgemart.llm.quality_rules import _let, words_of

SHORTEST, SHORTEST_NAMED = 16, 4
#: Labelled findings that the forest is trained on; of more, about so many, chosen by a hash.
TRAIN_MOST = 20_000
#: Dictionary: words of 3 to 12 letters that the corpus has at least so often.
DICTIONARY_TIMES = 3
TREES, DEPTH, SEED = 20, 6, 7
MASK = "<SECRET>"

_RUN = r"[A-Za-z0-9+/_=-]{16,}"
#: Words before a value that name it a secret.
_NAMES = r"(?i)(token|secret|passw|pwd|api.?key|access.?key|private.?key|auth(?!or)|bearer|credential)"
_ASSIGNED = _NAMES + r"[A-Za-z0-9_.-]*[\"'`]?\s*[=:]+"
_VALUE = r"[\"'`(]*([^\"'`,;\s]{4,})"
_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
FEATURES = [
    "f_length", "f_transitions", "f_digits", "f_upper", "f_hex", "f_distinct", "f_letter_run", "f_coverage",
    "f_slashes", "f_dashes", "f_dots", "f_before_coverage", "f_after_coverage",
]
#: How the candidate is written down: evidence for labels, which the forest does not see.
EVIDENCE = ["f_in_url", "f_named", "f_assigned", "f_quoted"]


def candidates(docs: DataFrame) -> DataFrame:
    """A row per candidate: doc_id, source, text_key, word_at, run_at, word, before, after, candidate.

    ``word_at`` counts the words of the text from 0, ``run_at`` the candidates within the word: its
    runs, then named values that are none of them. ``before`` are up to three words in front. ``text_key`` is a hash of the text, the same for equal texts.
    """
    # Cheap signs of an assignment; the patterns are tried on what these let through.
    assigns = lambda w: F.contains(w, F.lit("=")) | F.contains(w, F.lit(":"))
    ends = lambda w: F.coalesce(F.endswith(w, F.lit("=")) | F.endswith(w, F.lit(":")), F.lit(False))

    def around(words: Column) -> Column:
        places = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.transform(
            F.filter(places, lambda i: (F.length(F.get(words, i)) >= SHORTEST) | assigns(F.get(words, i)) | ends(F.get(words, i - 1))),
            lambda i: F.struct(
                i.alias("word_at"), F.get(words, i).alias("word"),
                F.concat_ws(" ", *(F.get(words, i - k) for k in (3, 2, 1))).alias("before"),
                F.coalesce(F.get(words, i + 1), F.lit("")).alias("after"),
            ),
        )

    source = pick(docs, "source") if "source" in docs.columns else None
    docs = pick(docs, "doc_id", "text", *([] if source is None else ["source"]))
    label = F.lit(None).cast("string") if source is None else F.col("source").cast("string")
    found = docs.select("doc_id", label.alias("source"), F.xxhash64("text").alias("text_key"), F.explode(_let(words_of(F.col("text")), around)).alias("w"))
    runs = F.regexp_extract_all("word", F.lit(f"({_RUN})"))
    within = F.regexp_extract_all("word", F.lit(_ASSIGNED + _VALUE), F.lit(2))
    beside = F.when(F.col("before").rlike(_ASSIGNED + "$"), F.regexp_extract_all("word", F.lit("^" + _VALUE), F.lit(1))).otherwise(F.array().cast("array<string>"))
    # A run that holds a name and reaches into its value gives way to the whole value.
    taken = _let(F.struct(runs.alias("runs"), F.concat(within, beside).alias("named")), lambda c: F.when(F.size(c["named"]) == 0, c["runs"]).otherwise(
        F.concat(F.filter(c["runs"], lambda r: ~r.rlike(_ASSIGNED + ".")), F.array_except(c["named"], c["runs"]))
    ))
    return found.select("doc_id", "source", "text_key", "w.*").select("*", F.posexplode(taken).alias("run_at", "candidate"))


def dictionary(docs: DataFrame, times: int = DICTIONARY_TIMES) -> list[float]:
    """For every three letters (in a table of 32^3 places) 1 if a word of the dictionary has them, else 0.

    Words are counted over all texts; of the dictionary only its distinct threes come to the driver.
    """
    words = pick(docs, "text").select(F.explode(words_of(F.col("text"))).alias("word"))
    words = words.filter(F.length("word").between(3, 12)).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= times)
    lower = words.select(F.regexp_replace(F.lower("word"), "[^a-z]", "").alias("word")).filter(F.length("word") >= 3)
    threes = F.transform(F.sequence(F.lit(1), F.length("word") - 2), lambda i: F.substring(F.col("word"), i, 3))
    table = [0.0] * (1 << 15)
    for row in lower.select(F.explode(threes).alias("three")).distinct().collect():  # 26^3 at most
        a, b, c = (ord(x) - 96 for x in row.three)
        table[a << 10 | b << 5 | c] = 1.0
    return table


def _coverage(value: Column, table: Column) -> Column:
    """The share of the value's threes of characters that the dictionary has; 0 if it is shorter."""
    def share(low: Column) -> Column:
        code = lambda i: F.ascii(F.substring(low, i, 1)) - 96
        threes = F.transform(F.sequence(F.lit(1), F.greatest(F.length(low) - 2, F.lit(1))), lambda i: F.when(
            F.substring(low, i, 3).rlike("^[a-z]{3}$"), F.get(table, code(i) * 1024 + code(i + 1) * 32 + code(i + 2))
        ).otherwise(F.lit(0.0)))
        return F.aggregate(threes, F.lit(0.0), lambda a, b: a + b) / F.size(threes)

    return _let(F.lower(value), share)


def features(found: DataFrame, table: list[float]) -> DataFrame:
    c, size = F.col("candidate"), F.length("candidate")
    known = F.from_json(F.lit(json.dumps(table)), "array<double>")  # folded into one literal of fixed size
    classes = F.translate(c, _LOWER + _UPPER + _DIGIT, "a" * 26 + "A" * 26 + "0" * 10)
    count = lambda pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    flag = lambda condition: F.coalesce(condition, F.lit(False)).cast("double")
    made = {
        "f_length": size.cast("double"),
        "f_transitions": F.regexp_count(classes, F.lit(r"(.)(?!\1)(?=.)")) / size,
        "f_digits": count("[0-9]") / size,
        "f_upper": count("[A-Z]") / size,
        "f_hex": count("[0-9a-fA-F]") / size,
        "f_distinct": F.size(F.array_distinct(F.split(c, ""))) / size,
        "f_letter_run": F.array_max(F.transform(F.split(c, "[^A-Za-z]+"), lambda x: F.length(x))).cast("double"),
        "f_coverage": _coverage(c, known),
        "f_slashes": count("/"), "f_dashes": count("[-_]"), "f_dots": count("[.]"),
        "f_in_url": flag(F.col("word").contains("://")),
        "f_named": flag(F.concat_ws(" ", "before", "word").rlike(_NAMES)),
        "f_assigned": flag(F.col("before").rlike("[=:]$") | F.col("word").rlike("^[A-Za-z_.-]{2,30}[=:]")),
        "f_quoted": flag(F.col("word").rlike("[\"'`]")),
        "f_before_coverage": _coverage(F.substring_index("before", " ", -1), known),
        "f_after_coverage": _coverage(F.col("after"), known),
    }
    return found.withColumns(made)


def weak_labels(found: DataFrame) -> DataFrame:
    """``found`` (with features) with ``label``: 1 for likely secrets, 0 for likely false positives, else null.

    1: named and assigned, not in a URL, and quoted or not only letters; 0: in a URL, or in running text,
    neither named nor assigned nor quoted.
    """
    has = lambda name: F.col(name) == 1
    told = has("f_named") & has("f_assigned") & (has("f_quoted") | F.col("candidate").rlike("[^A-Za-z]"))
    plain = ~has("f_named") & ~has("f_assigned") & ~has("f_quoted")
    return found.withColumn("label", F.when(has("f_in_url") | plain, 0.0).when(told, 1.0))


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def train(labelled: DataFrame, most: int = TRAIN_MOST) -> RandomForestClassificationModel | None:
    """A forest from the rows with a ``label``; None unless both labels occur."""
    labelled = labelled.filter("label IS NOT NULL").select("label", *FEATURES)
    n = {r.label: r["count"] for r in labelled.groupBy("label").count().collect()}
    if len(n) < 2:
        return None
    share = min(1.0, most / sum(n.values()))
    # Of rows that are equal in all features, as copies are, a share is taken too.
    chosen = labelled.withColumn("id", F.monotonically_increasing_id())
    chosen = chosen.filter(F.pmod(F.xxhash64(*FEATURES, "id"), F.lit(1 << 30)) <= int(share * (1 << 30)))
    weight = F.when(F.col("label") == 1, n[0.0] / n[1.0]).otherwise(1.0)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight")
    return forest.fit(_assembled(chosen.withColumn("weight", weight)).select("features", "label", "weight"))


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """Every candidate of every text with ``score`` (the forest's probability) and ``is_secret``.

    ``labelled`` are findings with features and label; without it ``weak_labels`` are taken. If only
    one kind of label occurs, there is no forest: the score is then the label, or 0. Null and empty
    texts have no candidates, very long ones as many as they hold; repeated rows give their findings once
    each; a missing ``source`` counts as null; an empty table gives no rows.
    """
    found = stage(weak_labels(features(candidates(docs), dictionary(docs))))
    model = train(found if labelled is None else labelled)
    if model is None:
        scored = found.withColumn("score", F.coalesce("label", F.lit(0.0)))
    else:
        scored = model.transform(_assembled(found)).withColumn("score", vector_to_array("probability")[1])
    kept = ["doc_id", "text_key", "word_at", "run_at", "candidate", *FEATURES, *EVIDENCE, "score"]
    return scored.select(*kept, (F.col("score") >= threshold).alias("is_secret"))


def redact(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mask`` and ``n_chars``, if there, counted anew.

    All rows and columns stay: null and empty texts as they are, repeated rows alike, an empty table empty.
    Columns are told apart by place, so names may clash. Secrets are joined by a hash of the text, one row per text, from a
    staged table whose size is known when Spark chooses how to join it.
    """
    names = docs.columns
    secrets = scan(docs).filter("is_secret").groupBy("text_key").agg(F.collect_set("candidate").alias("secrets"))
    longest = F.sort_array(F.transform("secrets", lambda s: F.struct((-F.length(s)).alias("n"), s.alias("s"))))
    plain = docs.toDF(*(f"_{i}" for i in range(len(names))))
    text = f"_{names.index('text')}"
    joined = plain.withColumn("text_key", F.xxhash64(text)).join(stage(secrets), "text_key", "left")
    masked = F.aggregate(longest, F.col(text), lambda t, s: F.replace(t, s["s"], F.lit(mask)))
    out = joined.withColumn(text, F.when(F.col("secrets").isNull(), F.col(text)).otherwise(masked))
    if "n_chars" in names:
        n = f"_{names.index('n_chars')}"
        out = out.withColumn(n, F.when(F.col("secrets").isNull(), F.col(n)).otherwise(F.length(text).cast(plain.schema[n].dataType)))
    return out.select(*plain.columns).toDF(*names)
