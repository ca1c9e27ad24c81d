"""Seeded shuffles, splits, slices and samples on hash keys.

Every function takes the seed as an argument and a unique row id. Two tables whose ids carry the name of
their corpus keep the same keys when they are concatenated, so the first `k` rows of a union never reach
beyond the first `k` rows of either part.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogeval import constants as K
from dialogeval.functions.hashing import below_fraction, hash_key

# A hash prefix of 4 hex digits: the count table has at most 65,536 rows whatever the data.
BUCKET_DIGITS = 4

_KEY, _BUCKET = "_hash_key", "_bucket"


def seeded_shuffle(df: DataFrame, seed: int, row_id: str) -> DataFrame:
    """Rows in random but repeatable order: one range-partitioned sort."""
    return df.orderBy(hash_key(seed, F.col(row_id)), F.col(row_id))


def train_test_split(df: DataFrame, seed: int, row_id: str, test_fraction: float) -> DataFrame:
    """Add `split` by hash threshold. Row-local: no shuffle, same answer on a stream.

    The test share is `test_fraction` in expectation; `train_test_split_exact` hits the exact count.
    """
    is_test = below_fraction(hash_key(seed, F.col(row_id)), test_fraction)
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def train_test_split_exact(df: DataFrame, seed: int, row_id: str, test_fraction: float) -> DataFrame:
    """Add `split`; the `ceil(test_fraction * n)` rows with the lowest hash keys are the test split.

    The bound is found from the ids alone when this is called; the rows then decide for themselves, without a shuffle.
    """
    return split_before(df, seed, row_id, exact_bound(df, seed, row_id, test_fraction))


def exact_bound(df: DataFrame, seed: int, row_id: str, test_fraction: float) -> tuple[str, str] | None:
    """`(key, id)` of the first row behind the test split; None if all rows are test."""
    return _bounds_of_ranks(df, seed, row_id, lambda total: [math.ceil(test_fraction * total)])[0]


def split_before(df: DataFrame, seed: int, row_id: str, bound: tuple[str, str] | None) -> DataFrame:
    """Add `split`: rows before the bound are test."""
    return df.withColumn("split", F.when(_before(seed, row_id, bound), "test").otherwise("train"))


def range_slice(df: DataFrame, seed: int, row_id: str, lo: int, hi: int) -> DataFrame:
    """Rows `[lo, hi)` of the shuffled table; fewer if the table is shorter.

    The hash keys at both bounds are found from the ids alone when this is called; the slice is then a filter on the
    key of each row, whatever its size.
    """
    low, high = _bounds_of_ranks(df, seed, row_id, lambda total: [lo, hi])
    return df.where(_before(seed, row_id, high) & ~_before(seed, row_id, low))


def sample_n(df: DataFrame, seed: int, row_id: str, n: int, strict: bool = False) -> DataFrame:
    """Exactly `n` random rows without replacement; fewer if the table is shorter, unless `strict`."""
    if strict and df.count() < n:
        raise ValueError(f"the table has fewer than {n} rows")
    return range_slice(df, seed, row_id, 0, n)


def eval_subset(
    parts: Sequence[DataFrame], seed: int, row_id: str, rows: int = K.EVAL_SUBSET_ROWS
) -> DataFrame:
    """Concatenate the test parts, shuffle, take the first `rows`."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    return range_slice(union, seed, row_id, 0, rows)


def holdout_slice(
    df: DataFrame,
    seed: int,
    row_id: str,
    used_rows: int = K.EVAL_SUBSET_ROWS,
    rows: int = K.HOLDOUT_ROWS,
) -> DataFrame:
    """The `rows` shuffled rows behind the first `used_rows`, which training looked at already."""
    return range_slice(df, seed, row_id, used_rows, used_rows + rows)


def blind_labels(models: DataFrame, seed: int, style: str = "number") -> DataFrame:
    """`(position, model, label)` in random order; labels are `1..k`, or letters for `style='letter'`.

    `models` has one row per model, so the unpartitioned window sees a handful of rows.
    """
    order = Window.orderBy(hash_key(seed, F.col("model")), "model")
    ranked = models.select(F.row_number().over(order).alias("position"), "model")
    label = F.col("position").cast("string")
    if style == "letter":
        # a to z, then aa, ab, ... for up to 702 models.
        place = F.col("position") - 1
        first = F.when(place >= 26, F.chr(F.floor(place / 26) + 96)).otherwise("")
        label = F.concat(first, F.chr(place % 26 + 97))
    return ranked.withColumn("label", label)


def _before(seed: int, row_id: str, bound: tuple[str, str] | None) -> Column:
    """Is the place of a row before `bound`? Everything is before the end."""
    if bound is None:
        return F.lit(True)
    key, at = hash_key(seed, F.col(row_id)), F.col(row_id).cast("string")
    return (key < bound[0]) | ((key == bound[0]) & (at < bound[1]))


def _bounds_of_ranks(
    df: DataFrame, seed: int, row_id: str, ranks: Callable[[int], list[int]]
) -> list[tuple[str, str] | None]:
    """`(key, id)` at each rank, counted from 0; None behind the last row.

    Rows are counted per hash prefix (at most 16 ** BUCKET_DIGITS counts, whatever the table holds) and ids are ranked
    only in the buckets that hold a wanted rank, about n / 65,536 ids each. An id must be unique and not NULL: a rank
    would not name a row otherwise.
    """
    keyed = df.select(F.col(row_id).cast("string").alias("_id"), hash_key(seed, F.col(row_id)).alias(_KEY))
    keyed = keyed.withColumn(_BUCKET, F.substring(_KEY, 1, BUCKET_DIGITS))
    counts = keyed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n"), F.count("_id").alias("ids")).collect()
    if any(row["n"] != row["ids"] for row in counts):
        raise ValueError(f"{row_id} is NULL in some rows, so they have no place in the order")
    counts = sorted((row[_BUCKET], row["n"]) for row in counts)
    wanted = ranks(sum(n for _, n in counts))
    places, start = {}, 0
    for bucket, n in counts:
        for rank in wanted:
            if start <= rank < start + n:
                places[rank] = (bucket, rank - start)
        start += n
    inside = keyed.where(F.col(_BUCKET).isin(sorted({bucket for bucket, _ in places.values()})))
    order = Window.partitionBy(_BUCKET).orderBy(_KEY, "_id")
    ranked = inside.withColumn("_rank", F.row_number().over(order) - 1)
    hit = F.lit(False)
    for bucket, rank in places.values():
        hit = hit | ((F.col(_BUCKET) == bucket) & (F.col("_rank") == rank))
    found = {(row[_BUCKET], row["_rank"]): (row[_KEY], row["_id"]) for row in ranked.where(hit).collect()}
    return [found[places[rank]] if rank in places else None for rank in wanted]
