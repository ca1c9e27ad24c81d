"""Every registered query against its SQL, and its plan against what must never be in one."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__
from tools.check_oracle import rows_of

from dialogeval.catalog import QUERIES
from dialogeval.oracle import ORACLES


@pytest.fixture(scope="module")
def database(sf_dir):
    db = duckdb.connect()
    for file in os.listdir(sf_dir):
        db.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    return db


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, database, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    result = database.execute(ORACLES[name])
    expected = rows_of([c[0] for c in result.description], result.fetchall())
    assert rows_of(df.columns, df.collect()) == expected


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["model", "num_rows", "mean_rouge_l"]


def test_distinct_texts_are_tagged_in_place(spark):
    from dialogeval.operators import entities
    from dialogeval.sources import scratch

    texts = scratch.through_table(spark.createDataFrame([("Ann",), ("Ann",)], "text string"), "texts")
    listed = spark.createDataFrame([("Ann", "PER")], "entity string, type string")
    found = entities.extract_entities(texts, listed)
    found.collect()
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_training_set_is_one_map_stage_behind_its_input(spark):
    from dialogeval.plans import training
    from dialogeval.sources import scratch

    raw = spark.createDataFrame([("1", "a **Summary b")], "dialog_id string, response string")
    rows = training.build_training_set(scratch.through_table(raw, "raw"))
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
