import re

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_decontam import brute as brute_hits
from test_near_copies import brute_kept
from test_quality_rules import brute as brute_quality

import corpus_pipeline
from pledgemart.llm import bpe
from pledgemart.llm.common import stage

TRUE = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={},
)


def test_stages_match_brute_force(spark, sf_dir, documents):
    near = [(i, i) for i in range(0, 60, 3)]
    planted = documents.union(documents.limit(0)).union(
        documents.filter("doc_id < 60 AND doc_id % 3 = 0").withColumn("doc_id", F.col("doc_id") + 5000)
    )
    docs, seen = planted, {}
    for name, step in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(step(spark, docs, sf_dir))
        seen[name] = before, {r.doc_id: r for r in docs.collect()}
        if name != "byte-level BPE":
            assert docs.columns == documents.columns
    text = lambda rows: [(r.doc_id, r.text) for r in rows.values()]
    trusted = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").collect()}
    before, after = seen["quality rules"]
    assert set(after) == {r[0] for r in brute_quality(text(before), trusted) if r[-1]} and len(after) < len(before)
    before, after = seen["near-duplicates"]
    assert set(after) == brute_kept(text(before)) and len(before) - len(after) >= len(near) // 2
    before, after = seen["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hits = dict(zip(before, brute_hits(text(before), items)))
    assert set(after) == {d for d, h in hits.items() if not h[1]} and len(after) < len(before)
    before, after = seen["secret scan"]
    assert set(after) == set(before)
    for d, r in after.items():
        pattern = "[A-Za-z0-9+/_=-]{16,}".join(map(re.escape, r.text.split("<SECRET>")))
        assert re.fullmatch(pattern, before[d].text, re.S)
        assert not re.search(r'token = "[0-9a-f]{40}"', r.text) and r.n_chars == len(r.text)
    before, after = seen["byte-level BPE"]
    assert {d: list(r.ids) for d, r in after.items()} == {d: TRUE.encode_ordinary(r.text) for d, r in before.items()}


@pytest.mark.parametrize("rows", ["some", "none"])
def test_awkward_tables(spark, sf_dir, awkward, rows):
    docs = awkward if rows == "some" else awkward.limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, sf_dir))
    assert docs.count() == (1 if rows == "some" else 0)


def test_run_is_the_stages_in_turn(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"] and out.count() > 100
