"""The driver's contract; every query that has SQL agrees with it on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from gleaner.plans import catalog

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FAST = ["model_knowledge", "span_lookup", "sentence_idf", "normalize_text", "stable_ids", "sentences", "keywords_topk", "token_overlaps", "question_shape", "repeated_line_filter", "card_summary", "streamed_card_summary", "fact_types", "fact_combinations", "concept_fact_edges", "evidence_dedupe", "markdown_sections", "planning_batches", "answer_checks", "upsert"]


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 6))
    return repr(v)


@pytest.mark.parametrize("name", FAST)
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{DIR}/{t}.parquet')")
    df = catalog.queries()[name](spark, DIR)
    got = con.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in got.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in got.fetchall())
    assert sorted(tuple(plain(r[c]) for c in sorted(names)) for r in df.collect()) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    if any(q.startswith("op") and q[2].isdigit() for q in entry.queries()):
        assert {q.split("_")[0] for q in entry.queries() if q.startswith("op")} == {f"op{i}" for i in range(1, 11)}
