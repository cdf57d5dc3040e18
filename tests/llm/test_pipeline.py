"""The pipeline's stages on a small table with odd rows and extra columns of clashing names."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402


def test_stages(spark, table, tmp_path):
    rng = random.Random(1)
    words = [f"word{i}" for i in range(500)]
    texts = [None, "", "12 34", *["\n".join(" ".join(rng.choice(words) for _ in range(12)) + "." for _ in range(10)) for _ in range(20)]]
    texts += [texts[5], texts[6] + " more"]
    docs = table(texts, [None] * 3 + ["en"] * 21 + [None])
    for name in ("_lines", "score", "lang_pred", "n_lines", "kept", "_text"):
        docs = docs.withColumn(name, F.lit(1))
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
            ids = {r["doc_id"] for r in docs.collect()}
            assert set(range(3, 23)) <= ids and not ids & {0, 1, 2}
            assert docs.filter("n_chars <> length(text)").count() == 0
    assert {r["doc_id"] for r in docs.collect()} >= set(range(3, 23))


def test_stages_of_nothing(spark, table, tmp_path):
    docs = table([])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.count() == 0
