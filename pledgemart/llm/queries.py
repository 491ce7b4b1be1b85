"""Registered queries of this package: each runs its operator over the whole intended table."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pledgemart.llm import bpe, conversations, cotrain, decontam, kd_shards, ppm, quality_rules, secret_scan, sentence_pieces, simhash, token_totals, url_rules, va_clusters
from pledgemart.llm.common import pick

RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hex64(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).per_document()
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


_OP1_SQL = r"""
WITH words AS (
    SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    UNION ALL
    SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), item_windows AS (
    SELECT DISTINCT id AS item_id, least(len(w), 10) AS n, list_slice(w, p, p + least(len(w), 10) - 1) AS win
    FROM (SELECT id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM words WHERE kind = 'b' AND len(w) > 0)
), places AS (
    SELECT id AS doc_id, n, p, list_slice(w, p, p + n - 1) AS win
    FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM words, (SELECT DISTINCT n FROM item_windows) WHERE kind = 'd')
), met AS (
    SELECT doc_id, item_id, p, n FROM places JOIN item_windows USING (n, win)
), hit AS (
    SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM met) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS list
    FROM met GROUP BY doc_id
)
SELECT id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit ON hit.doc_id = id LEFT JOIN items ON items.doc_id = id WHERE kind = 'd'"""


def encoded(docs: DataFrame) -> DataFrame:
    """Each row's ids, and digests of them and of what they decode to."""
    done = bpe.round_trip(docs, RANK_FILE, public_tokenizers.PATTERN)
    return done.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_frame(docs: DataFrame) -> DataFrame:
    return encoded(docs).drop("ids")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_frame(table(spark, sf_dir, "documents"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return cotrain.classify(table(spark, sf_dir, "documents"), labels)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    return quality_rules.judge(table(spark, sf_dir, "documents"), trusted)


URL_LIST = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = table(spark, sf_dir, "labels").filter("quality IS NOT NULL AND toxic IS NOT NULL")
    labels = judged.select(
        F.col("doc_id").alias("page_id"), F.when((F.col("quality") == 0) | (F.col("toxic") == 1), "block").otherwise("allow").alias("label")
    )
    return url_rules.judge(table(spark, sf_dir, "pages"), labels, URL_LIST)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = kd_shards.assign(table(spark, sf_dir, "documents"), shards=40)
    return dealt.select("*", F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = token_totals.histogram(table(spark, sf_dir, "documents"), RANK_FILE, public_tokenizers.PATTERN)
    return token_totals.with_sums(hist)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "word_at", "run_at", F.length("candidate").alias("length"),
        F.sha2("candidate", 256).alias("candidate_sha256"), "score", "is_secret",
    )


def damaged(conversations_table: DataFrame) -> DataFrame:
    """The rows with faults put in by the checksum of conversation and turn; those that are lost are left out."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = pick(conversations_table, "conv_id", "turn", "role", "text")
    fault = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    rows = rows.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), fault.alias("fault")).where("fault != 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("copy"))


def op11_frame(turns: DataFrame) -> DataFrame:
    """A report per conversation of the table, also of those of which no row is left."""
    found = conversations.report(damaged(turns)).withColumnRenamed("conv_id", "conv")
    whole = pick(turns, "conv_id").distinct()
    return whole.join(found, whole.conv_id.eqNullSafe(found.conv), "left").select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_frame(table(spark, sf_dir, "conversations"))


def op12_frame(vectors: DataFrame) -> DataFrame:
    file = va_clusters.VAFile(vectors)
    found = file.cluster()
    # One row per cluster: as many as there are centroids.
    per = {r.cluster: int(r.d) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    of = lambda values, kind: F.get(F.array(*(F.lit(v) for v in values)).cast(f"array<{kind}>"), F.col("cluster"))
    k = max(1, len(file.centroids))
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in file.centroids] or [None]
    return found.select(
        "vec_id", "cluster", "distance", of([per.get(i, 0) for i in range(k)], "bigint").alias("cluster_inertia"),
        F.lit(sum(per.values())).cast("bigint").alias("inertia"), of(digests, "string").alias("centroid_sha256"),
    )


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_frame(table(spark, sf_dir, "embeddings"))


def op13_frame(docs: DataFrame) -> DataFrame:
    done = sentence_pieces.round_trip(docs, PIECE_MODEL)
    return done.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_frame(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_winnowing_decontamination": op1,
    "op2_byte_bpe": op2,
    "op3_simhash_near_dedup": op3,
    "op4_cotraining_quality": op4,
    "op5_likelihood_ratio_rules": op5,
    "op6_association_url_rules": op6,
    "op7_ppm_scores": op7,
    "op8_kd_tree_shards": op8,
    "op9_length_histogram": op9,
    "op10_forest_secret_scan": op10,
    "op11_conversation_repair": op11,
    "op12_va_file_clusters": op12,
    "op13_sentence_pieces": op13,
    "pipeline": pipeline,
}
#: SQL where DuckDB can say the same; the others are held against brute force in tests/llm.
ORACLES: dict[str, str] = {
    "op1_winnowing_decontamination": _OP1_SQL,
}
