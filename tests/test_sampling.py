from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from dialogeval.operators import joins, sampling
from dialogeval.plans import training

SEED = 7


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(3000).select(F.col("id").cast("string").alias("row_id"))


def order(ids, seed=SEED):
    return sorted(ids, key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())


def ids(df):
    return [r.row_id for r in df.select("row_id").collect()]


def test_shuffle_is_the_order_of_hash_keys(rows):
    assert ids(sampling.seeded_shuffle(rows, SEED, "row_id")) == order(map(str, range(3000)))


@pytest.mark.parametrize("lo, hi", [(0, 10), (100, 900), (2990, 4000), (3000, 3001), (0, 3000), (5, 5)])
def test_slice_by_ranks_equals_top_k(rows, lo, hi):
    expected = order(map(str, range(3000)))[lo:hi]
    assert sorted(ids(sampling.range_slice(rows, SEED, "row_id", lo, hi))) == sorted(expected)


def test_missing_ids_have_no_place(spark):
    df = spark.createDataFrame([("1",), (None,)], "row_id string")
    with pytest.raises(ValueError, match="NULL"):
        sampling.range_slice(df, SEED, "row_id", 0, 1)


def test_a_slice_is_a_filter(rows):
    plan = sampling.range_slice(rows, SEED, "row_id", 10, 2000)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_slices_do_not_depend_on_partitions(rows):
    one = ids(sampling.range_slice(rows.repartition(1), SEED, "row_id", 50, 80))
    many = ids(sampling.range_slice(rows.repartition(13), SEED, "row_id", 50, 80))
    assert sorted(one) == sorted(many)


@pytest.mark.parametrize("fraction", [0.0, 0.05, 0.333, 1.0])
def test_exact_split(rows, fraction):
    split = sampling.train_test_split_exact(rows, SEED, "row_id", fraction)
    test, train = ids(split.where("split = 'test'")), ids(split.where("split = 'train'"))
    expected = order(map(str, range(3000)))[: math.ceil(fraction * 3000)]
    assert sorted(test) == sorted(expected)
    assert len(test) + len(train) == 3000 and not set(test) & set(train)


def test_threshold_split_is_complete_and_close(rows):
    split = sampling.train_test_split(rows, SEED, "row_id", 0.2)
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert sum(counts.values()) == 3000 and 500 < counts["test"] < 700
    again = sampling.train_test_split(rows.repartition(9), SEED, "row_id", 0.2)
    assert sorted(ids(again.where("split = 'test'"))) == sorted(ids(split.where("split = 'test'")))


def test_sample_size(rows):
    assert len(ids(sampling.sample_n(rows, SEED, "row_id", 100))) == 100
    assert len(ids(sampling.sample_n(rows, SEED, "row_id", 9999))) == 3000
    with pytest.raises(ValueError):
        sampling.sample_n(rows, SEED, "row_id", 9999, strict=True)


def test_holdout_never_meets_the_eval_subset(spark):
    first = spark.range(400).select(F.concat(F.lit("d:"), F.col("id")).alias("row_id"))
    second = spark.range(900).select(F.concat(F.lit("c2:"), F.col("id")).alias("row_id"))
    used = sampling.eval_subset([first, second], SEED, "row_id", 100)
    held = sampling.holdout_slice(first, SEED, "row_id", 100, 200)
    assert len(ids(held)) == 200
    assert not set(ids(used)) & set(ids(held))
    rest = joins.holdout_antijoin(first, used, "row_id")
    assert sorted(ids(rest)) == sorted(set(ids(first)) - set(ids(used)))


def test_blind_labels_are_a_permutation(spark):
    models = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "model string")
    labels = sampling.blind_labels(models, 3).orderBy("position").collect()
    assert [r.label for r in labels] == ["1", "2", "3", "4"]
    assert sorted(r.model for r in labels) == ["a", "b", "c", "d"]
    letters = sampling.blind_labels(models, 3, style="letter").orderBy("position").collect()
    assert [r.label for r in letters] == ["a", "b", "c", "d"]
    many = sampling.blind_labels(models.sparkSession.range(28).selectExpr("string(id) AS model"), 3, style="letter")
    assert [r.label for r in many.orderBy("position").collect()][24:] == ["y", "z", "aa", "ab"]
    assert [r.model for r in letters] == [r.model for r in labels]


def test_training_split_is_exact(spark):
    for n in (1, 20, 41):
        raw = spark.createDataFrame([(str(i), f"x **Summary: {i}") for i in range(n)], "dialog_id string, response string")
        assert training.build_training_set(raw).where("split = 'test'").count() == math.ceil(0.05 * n)


def test_training_set_mix(spark):
    raw = spark.createDataFrame(
        [(str(i), f"A: hi {i}\nB: **yo**\n\n**Summary:** *They met {i}.*\n") for i in range(50)],
        "dialog_id string, response string",
    )
    rows = training.build_training_set(raw, test_fraction=0.5).cache()
    row = rows.where("dialog_id = '3'").first()
    assert row.summary == "They met 3."
    assert row.dialog.endswith("\n\n **Conversation:** \n\n A hi 3B yo")
    assert [m.role for m in row.messages] == ["system", "user", "assistant"]
    second = rows.select("dialog_id", "messages", "split").withColumn(
        "dialog_id", F.concat(F.lit("c2:"), "dialog_id")
    )
    mixed = training.mix_corpora(rows, second)
    assert mixed.count() == 100 and mixed.where("text is null").count() == 0
    test = mixed.where("split = 'test'").count()
    assert training.training_mix(mixed).count() == 100 - test
    assert training.evaluation_mix(mixed, row_id="dialog_id", rows=10).count() == 10
    assert training.evaluation_mix(mixed, row_id="dialog_id").count() == test
