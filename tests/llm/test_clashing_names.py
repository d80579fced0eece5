"""Stages carry columns that are named like anything the operators use inside."""

import pytest
from pyspark.sql import functions as F

from plumbline.llm import exact_dedup, language_id, mixing, simhash

NAMES = ("digest_", "Other_", "id_", "any_kept", "any_kept_", "rows_", "row_", "size_", "taken_", "plan_key_", "doc_key_", "key_", "size", "taken", "target", "fp", "fp_", "doc_fp_",
         "stays", "stays_", "root", "component_id", "first", "count", "lang_pred_", "lang_score_", "LANG_rejected_", "held", "n", "kept", "keep_id", "group_size", "win")


@pytest.mark.parametrize("stage", ["exact", "near", "mix", "language"])
def test_every_stage_carries_any_column(spark, sf, stage):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.unionByName(docs.limit(30))  # some rows repeat, which takes the other branch
    wide = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in NAMES])
    run = {
        "exact": exact_dedup.deduplicate, "near": simhash.keep_one, "mix": mixing.sample_text,
        "language": lambda d: language_id.keep_learned(d, language_id.fit(d.select("doc_id", "text", "lang"), per_language=30, order=2)),
    }[stage]
    out = run(wide)
    assert out.columns == wide.columns
    got = out.collect()
    assert all(r[n] == f"{n}{r.doc_id}" for r in got for n in NAMES)
    if stage != "language":
        assert sorted((r.doc_id, r.text) for r in got) == sorted((r.doc_id, r.text) for r in run(docs).collect())
