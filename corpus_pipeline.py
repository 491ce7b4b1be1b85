"""From raw documents to token ids: five stages, each an operator of pledgemart.llm.

Every stage takes what its predecessor kept, as the Parquet table that was written of it:

1. quality rules: documents that fail the base rule or look unlike trusted text go;
2. near-duplicates, by SimHash with an exact check (a Jaccard similarity of 0.8 over five words), and by shared
   shingles what SimHash misses: one document of each group stays, that of the smallest id;
3. benchmark decontamination: documents that share ten words in a row with a benchmark item go;
4. secret scan: secrets in the texts are masked, all documents stay;
5. byte-level BPE: the ids of every text, checked by decoding them again.

The first four return the columns of ``documents``; the last doc_id, n_tokens, ids, ids_sha256 and
decoded_sha256. Nulls, empty texts and repeated rows are handled as the operators say: a null or
very short text fails the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pledgemart.llm import decontam, near_copies, quality_rules, secret_scan
from pledgemart.llm.common import stage
from pledgemart.llm.queries import encoded, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels").filter("quality = 1"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded(docs)


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret scan", secrets),
    ("byte-level BPE", tokens),
]

#: Hashes, a trained forest and BPE are beyond SQL; tests/llm/test_pipeline.py has the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
