from __future__ import annotations

import datetime
import os

import pytest
from pyspark.sql import functions as F

from dialogeval.functions import text
from dialogeval.operators import entities
from dialogeval.sources import datasets, scratch
from dialogeval.streaming import jobs

CELLS = [
    ("plain", "a"),
    ("newline", "two\nlines"),
    ("quote", 'say "hi", she said'),
    ("edges", '"'),
    ("backslash", "a\\b\\"),
    ("blank", " padded "),
    ("na", "NA"),
    ("carriage", "a\r\nb\rc"),
    ("comma", ",,"),
    ("missing", None),
    ("empty", ""),
]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(CELLS, "id string, cell string")
    datasets.write_csv(df, str(tmp_path / "c"))
    read = lambda **o: datasets.scan_csv(spark, str(tmp_path / "c"), "id string, cell string", multi_line=True, **o)
    found = dict(map(tuple, read().collect()))
    # An empty cell is missing after a CSV round trip; Parquet between stages keeps the difference.
    assert found == {**dict(CELLS), "empty": None}
    missing = read(na_values=["NA"])
    assert missing.where("id = 'na'").first().cell is None
    with pytest.raises(Exception, match="(?i)exists"):
        datasets.write_csv(df, str(tmp_path / "c"))


def test_csv_columns_go_by_name_and_nothing_is_lost(spark, tmp_path):
    def read(content, schema="a string, b bigint"):
        path = tmp_path / f"{abs(hash(content + schema))}.csv"
        path.write_text(content)
        return datasets.scan_csv(spark, str(path), schema)

    assert [tuple(r) for r in read("b,a\n1,x\n").collect()] == [("x", 1)]
    for schema in ("a string", "a string, b bigint, c string", "a string, c bigint"):
        with pytest.raises(ValueError, match="columns"):
            read("b,a\n1,x\n", schema)
    for bad in ("b,a\none,x\n", "b,a\n1,x,surplus\n"):
        with pytest.raises(Exception, match="(?i)malformed"):
            read(bad).collect()


def test_dataset_splits_are_pruned(spark, tmp_path):
    df = spark.range(100).withColumn("split", F.when(F.col("id") < 5, "test").otherwise("train"))
    path = str(tmp_path / "d")
    datasets.write_dataset(df, path)
    test = datasets.scan_dataset(spark, path, split="test", columns=["id"])
    assert test.count() == 5
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_dated_results_and_label_map(spark, tmp_path):
    datasets.write_dated(spark.range(3).toDF("id"), str(tmp_path / "r"), "2024-02-01")
    datasets.write_dated(spark.range(2).toDF("id"), str(tmp_path / "r"), "2024-02-02")
    dates = {r.run_date: r["count"] for r in spark.read.parquet(str(tmp_path / "r")).groupBy("run_date").count().collect()}
    assert dates == {datetime.date(2024, 2, 1): 3, datetime.date(2024, 2, 2): 2}
    for ids in (7, 4):  # a rerun replaces its date and no other
        datasets.write_dated(spark.range(ids).toDF("id"), str(tmp_path / "r"), "2024-02-01")
    dates = {r.run_date: r["count"] for r in spark.read.parquet(str(tmp_path / "r")).groupBy("run_date").count().collect()}
    assert dates == {datetime.date(2024, 2, 1): 4, datetime.date(2024, 2, 2): 2}
    labels = spark.createDataFrame([(2, "y", "b"), (1, "x", "a")], datasets.LABEL_MAP_SCHEMA)
    datasets.write_label_map(labels, str(tmp_path / "l"))
    back = datasets.scan_label_map(spark, str(tmp_path / "l")).orderBy("position")
    assert [tuple(r) for r in back.collect()] == [(1, "x", "a"), (2, "y", "b")]


def test_overwriting_a_split_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "d")
    datasets.write_dataset(spark.createDataFrame([(1, "train"), (2, "test")], "id int, split string"), path)
    for _ in range(2):
        datasets.write_dataset(spark.createDataFrame([(3, "test"), (4, "test")], "id int, split string"), path, mode="overwrite")
    found = sorted((r.id, r.split) for r in spark.read.parquet(path).collect())
    assert found == [(1, "train"), (3, "test"), (4, "test")]


def test_table_from_list(spark):
    df = datasets.table_from_list(spark, ["p", "q"], "model_input", "string")
    assert [r.model_input for r in df.collect()] == ["p", "q"]


def test_scratch_uses_the_configured_folder(spark):
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert scratch.scratch_path(spark, "x").startswith(folder + "/x-")
    assert scratch.scratch_path(spark, "x") != scratch.scratch_path(spark, "x")
    stored = scratch.through_table(spark.range(5).toDF("id"), "ids")
    assert stored.count() == 5 and "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()


def test_scopes_remove_their_tables_only(spark):
    def stored(n, fail=False):
        made.append(scratch.through_table(spark.range(n).toDF("id"), "made"))
        if fail:
            raise KeyError(n)
        return made[-1].where("id > 0")

    made = [scratch.through_table(spark.range(3).toDF("id"), "before")]
    kept = scratch.finished(spark, "kept", lambda: stored(4))
    with scratch.scope(spark):
        inner = scratch.finished(spark, "inner", lambda: stored(5))
        assert inner.count() == 4
    with pytest.raises(KeyError), scratch.scope(spark):
        stored(6, fail=True)
    assert made[0].count() == 3 and kept.columns == ["id"] and kept.count() == 3
    paths = [os.path.dirname(f.removeprefix("file://")) for df in (*made[1:], inner) for f in df.inputFiles()]
    assert paths and not any(os.path.exists(p) for p in paths)


def test_entity_stream_leaves_no_tables_of_its_batches(spark, tmp_path):
    listed = spark.createDataFrame([("Ann", "PER"), ("Ann Lee", "PER")], "entity string, type string")
    ready = entities.prepare(listed, max_broadcast_bytes=0)
    source, found = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("Ann Lee sat",), ("Bob",), (None,)], "text string").write.parquet(source)
    folder = scratch.shared_folder(spark)
    before = set(os.listdir(folder))
    jobs.stream_entities(spark.readStream.schema("text string").parquet(source), ready, found, str(tmp_path / "s")).awaitTermination(120)
    rows = spark.read.parquet(found).where("text IS NOT NULL").collect()
    assert sorted((r.text, r.entities) for r in rows) == [("Ann Lee sat", ["Ann Lee"]), ("Bob", [])]
    assert set(os.listdir(folder)) == before


def test_training_stream_equals_batch(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "dialog_id string, response string"
    rows = [(str(i), f"x {i}\n**Summary: s {i}") for i in range(60)]
    spark.createDataFrame(rows[:30], schema).write.parquet(source)
    jobs.stream_training_set(spark, source, schema, sink, state, "dialog_id").awaitTermination(120)
    spark.createDataFrame(rows[30:], schema).write.mode("append").parquet(source)
    jobs.stream_training_set(spark, source, schema, sink, state, "dialog_id").awaitTermination(120)

    from dialogeval.plans import training

    batch = training.build_training_set(spark.createDataFrame(rows, schema), exact=False)
    columns = ["dialog_id", "summary", "dialog", "split"]
    streamed = spark.read.parquet(sink).select(*columns)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.select(*columns).collect()))


def test_overlap_and_entity_streams(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = "model_output string, summary string"
    spark.createDataFrame([("Ann sat", "Ann sat"), ("Bob", "Ann")], schema).write.parquet(source)
    out = str(tmp_path / "scores")
    jobs.stream_overlap(spark, source, schema, out, str(tmp_path / "s1")).awaitTermination(120)
    assert sorted(r.rouge_l for r in spark.read.parquet(out).collect()) == [0.0, 1.0]

    listed = spark.createDataFrame([("Ann", "PER")], "entity string, type string")
    texts = jobs.read_stream(spark, source, schema).select(text.py_strip(F.col("model_output")).alias("text"))
    found = str(tmp_path / "entities")
    jobs.stream_entities(texts, listed, found, str(tmp_path / "s2")).awaitTermination(120)
    rows = spark.read.parquet(found).select("text", "entities").collect()
    assert sorted((r.text, r.entities) for r in rows) == [("Ann sat", ["Ann"]), ("Bob", [])]


def test_batches_share_one_gazetteer(spark, tmp_path, monkeypatch):
    source, found = str(tmp_path / "in"), str(tmp_path / "out")
    listed, reads = spark.createDataFrame([("Ann", "PER")], "entity string, type string"), []
    prepare = entities.prepare
    monkeypatch.setattr(entities, "prepare", lambda *a: reads.append(a) or prepare(*a))
    for i in range(3):
        spark.createDataFrame([(f"Ann {i}",)], "text string").coalesce(1).write.mode("append").parquet(source)
    texts = spark.readStream.schema("text string").option("maxFilesPerTrigger", 1).parquet(source)
    jobs.stream_entities(texts, listed, found, str(tmp_path / "s")).awaitTermination(120)
    rows = spark.read.parquet(found).collect()
    assert sorted((r.text, r.entities, r.batch) for r in rows) == sorted((r.text, ["Ann"], r.batch) for r in rows)
    assert {r.batch for r in rows} == {0, 1, 2} and len(reads) == 1
    assert {r.gazetteer_version for r in rows} == {prepare(listed).version}
