"""The pipeline's stages, and SQL for the queries that it can express."""

from __future__ import annotations

import os
import random

import duckdb
import pytest

import corpus_pipeline
from millwatch.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    expected = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in expected.description]
    assert sorted(names) == sorted(got.columns)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.select(*names).collect()), key=key) == sorted(expected.fetchall(), key=key)


def prose(rng, n=120):
    return " ".join("".join(rng.choices(["th", "ing", "er", "an", "wh", "ou", "sh", "le"], k=rng.randint(1, 3))) for _ in range(n))


def test_stages(spark, documents, tmp_path):
    rng = random.Random(11)
    clean = [(k, prose(rng), "en", "web") for k in range(40)]
    base = prose(rng, 400)
    words = base.split()
    words[200] = "different"
    rows = [
        *clean,
        (100, clean[0][1] + " \n", "en", "web"),  # an exact copy of 0, and longer
        (101, base, "en", "web"),
        (102, " ".join(words), "en", "web"),  # a near copy
        (103, "too short", "en", "web"),
        (104, " ".join(str(k) for k in range(100, 200)), "en", "web"),  # no letter
        (105, None, None, None),
    ]
    docs = documents(*rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    kept, current = {}, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, str(tmp_path))
        assert current.columns == docs.columns
        kept[name] = {r.doc_id for r in current.select("doc_id").collect()}
        current.write.parquet(str(tmp_path / name))
        current = spark.read.parquet(str(tmp_path / name))
    everything = {k for k in range(40)} | {100, 101, 102}
    assert kept["quality_rules"] - {104} == everything
    assert kept["language_id"] == everything
    assert kept["exact_dedup"] == everything - {0}
    assert kept["simhash_near_dedup"] == everything - {0, 102}
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == kept["simhash_near_dedup"]


def test_empty_corpus(spark, no_documents, tmp_path):
    no_documents.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
