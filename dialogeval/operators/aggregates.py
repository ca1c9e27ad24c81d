"""Per-model means, totals, distributions and human votes."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogeval.functions import text
from dialogeval.operators.joins import MAX_BROADCAST_BYTES, fits, row_size, salted_join
from dialogeval.operators.projections import missing_to_null
from dialogeval.sources import scratch

# Rank error of the sketch that places the cut points in `exact_quantiles`, as 1 / accuracy.
SKETCH_ACCURACY = 20_000
# An interval with more distinct values is divided further before it is sorted, into about so many parts.
MOST_SORTED, PARTS = 8_192, 64


def score_means(scores: Sequence[str]) -> list[Column]:
    """Mean of each score; missing scores do not count."""
    return [F.avg(missing_to_null(F.col(s).cast("double"))).alias(f"mean_{s}") for s in scores]


def entity_sums() -> list[Column]:
    """Hallucinated and missed entities."""
    return [
        F.sum(f"num_{kind}_entities").cast("bigint").alias(f"{kind}_entities") for kind in ("hallucinated", "missed")
    ]


def mean_by_model(df: DataFrame, scores: Sequence[str], model: str = "model") -> DataFrame:
    """Mean of each score per model; rows without a model do not count."""
    return df.where(F.col(model).isNotNull()).groupBy(model).agg(*score_means(scores))


def entity_totals(df: DataFrame, model: str = "model") -> DataFrame:
    """Hallucinated and missed entities per model."""
    return df.where(F.col(model).isNotNull()).groupBy(model).agg(*entity_sums())


def mean_per_column(df: DataFrame, columns: Sequence[str], mean_name: str) -> DataFrame:
    """`(model, mean)` with one row per score column: a single global aggregate, then a reshape."""
    means = df.agg(*[F.avg(missing_to_null(F.col(f"`{c}`"))).alias(c) for c in columns])
    return means.unpivot([], [f"`{c}`" for c in columns], "model", mean_name)


def describe_scores(df: DataFrame, by: Sequence[str], scores: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles (interpolated) and maximum of each score."""
    values = F.explode(
        F.array(*[F.struct(F.lit(s).alias("score"), F.col(s).cast("double").alias("value")) for s in scores])
    )
    long = df.select(*by, values.alias("pair")).select(*by, "pair.score", "pair.value")
    long = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    keys = [*by, "score"]
    moments = [
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]
    return exact_quantiles(long, keys, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, moments)


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    quantiles: dict[str, float],
    also: Sequence[Column] = (),
    accuracy: int = SKETCH_ACCURACY,
    most_sorted: int = MOST_SORTED,
) -> DataFrame:
    """Exact interpolated quantiles of groups that are too large for one task.

    A mergeable sketch puts a few cut points closely around each wanted quantile. They divide the values into intervals,
    and interval counts are exact. An interval that holds a wanted position and more than `most_sorted` distinct values is
    divided again by a sketch of its own values, and so on; then the small ones are sorted. So no task sorts more than
    that, and the sketches decide how often values are read, never the result. Named aggregates in `also` are computed in
    the same pass as the first sketch. Small tables, a row per group or interval, are stored between steps, and the groups are measured.
    """
    by = list(by)
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    counted = scratch.through_table(counted, "quantile_values")
    near = 2.0 / accuracy
    cut_shares = sorted({min(max(q + d, 0.0), 1.0) for q in quantiles.values() for d in (-near, near)})
    groups = df.groupBy(*by).agg(
        F.percentile_approx(value, cut_shares, accuracy).alias("_cuts"),
        F.count(value).alias("_total"),
        *also,
    )
    others = [c for c in groups.columns if c not in (*by, "_cuts", "_total")]
    groups = scratch.through_table(groups, "quantile_groups")
    # A row of a step has at most the values of its group's row, and a group has at most two intervals for each quantile.
    few = fits(groups, row_size(groups) * (2 * len(quantiles)), MAX_BROADCAST_BYTES)
    shares, last = F.array(*[F.lit(q) for q in quantiles.values()]), F.col("_total") - 1
    wanted = F.concat(
        F.transform(shares, lambda q: F.floor(q * last)), F.transform(shares, lambda q: F.ceil(q * last))
    )
    # At first every group is one interval.
    whole = groups.select(
        *by, F.lit(0).alias("_interval"), F.lit(0).cast("bigint").alias("_start"), F.array_distinct(wanted).alias("_wanted"), "_cuts"
    )
    hit = _narrowed(counted.withColumn("_interval", F.lit(0)), whole, by, value, few)
    while (hit.rows.agg(F.max("_values")).first()[0] or 0) > most_sorted:
        values = scratch.through_table(hit.values, "quantile_values")
        cuts = values.groupBy(*by, "_interval").agg(
            F.percentile_approx(value, [k / PARTS for k in range(PARTS + 1)], accuracy).alias("_cuts")
        )
        cuts = hit.rows.select(*by, "_interval", "_start", "_wanted").join(cuts, [*by, "_interval"])
        hit = _narrowed(values, scratch.through_table(cuts, "quantile_cuts"), by, value, few)

    narrow = Window.partitionBy(*by, "_interval").orderBy(value)
    ranked = _with_group(hit.values, hit.rows.drop("_values"), [*by, "_interval"], value, few)
    ranked = ranked.withColumn(
        "_upto", F.col("_start") + F.sum("_n").over(narrow.rowsBetween(Window.unboundedPreceding, 0))
    )
    positions = F.filter(
        "_wanted", lambda p: (p >= F.col("_upto") - F.col("_n")) & (p < F.col("_upto"))
    )
    # At most two positions per quantile are left in a group from here on.
    picked = ranked.select(*by, value, F.explode(positions).alias("_position"))
    table = picked.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("_position", value))).alias("_at")
    )
    table = groups.where("_total > 0").select(*by, "_total").join(table, by)

    def interpolated(q: float) -> Column:
        place = F.lit(q) * last
        low = F.element_at("_at", F.floor(place))
        high = F.element_at("_at", F.ceil(place))
        return low + (high - low) * (place - F.floor(place))

    found = table.select(*by, *[interpolated(q).alias(name) for name, q in quantiles.items()])
    return groups.select(*by, *others).join(found, by, "left") if others else found


class _Intervals(NamedTuple):
    """`rows`: the intervals that hold a wanted position, with the number of values before them and of distinct values in
    them, stored; `values`: their distinct values and counts."""

    rows: DataFrame
    values: DataFrame


def _narrowed(values: DataFrame, intervals: DataFrame, by: list[str], value: str, few: bool) -> _Intervals:
    """Divide each interval at its cuts and keep the parts that hold a wanted position."""
    keys = [*by, "_interval"]
    placed = _with_group(values, intervals, keys, value, few)
    placed = placed.withColumn("_part", F.size(F.filter("_cuts", lambda cut: cut < F.col(value)))).drop("_cuts")
    sizes = placed.groupBy(*keys, "_part", "_start", "_wanted").agg(
        F.sum("_n").alias("_size"), F.count(F.lit(1)).alias("_values")
    )
    # One row for each part of an interval.
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_start") + F.coalesce(F.sum("_size").over(before), F.lit(0))
    sizes = sizes.withColumn("_start", start)
    inside = F.filter("_wanted", lambda p: (p >= F.col("_start")) & (p < F.col("_start") + F.col("_size")))
    hit = sizes.withColumn("_wanted", inside).where(F.size("_wanted") > 0)
    number = F.row_number().over(Window.partitionBy(*by).orderBy("_interval", "_part"))
    hit = scratch.through_table(hit.select(*keys, "_part", number.alias("_next"), "_start", "_wanted", "_values"), "quantile_intervals")
    kept = _with_group(placed.drop("_start", "_wanted"), hit.select(*keys, "_part", "_next"), [*keys, "_part"], value, few)
    kept = kept.select(*by, F.col("_next").alias("_interval"), value, "_n")
    rows = hit.select(*by, F.col("_next").alias("_interval"), "_start", "_wanted", "_values")
    return _Intervals(rows, kept)


def _with_group(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], row_id: str, few: bool
) -> DataFrame:
    """Put the row of its group next to each row; a group may own most rows."""
    if few:
        return rows.join(F.broadcast(groups), list(keys))
    key = F.struct(*keys)
    keyed = groups.withColumn("_group", key).drop(*keys)
    return salted_join(rows.withColumn("_group", key), keyed, "_group", [row_id]).drop("_group")


def win_counts(votes: DataFrame, label_map: DataFrame, split_ties: bool = False) -> DataFrame:
    """Votes for each label of the map, zeros kept. A tie such as `1,3` names no label by default."""
    winners = votes.where(F.col("winner").isNotNull()).select("winner")
    if split_ties:
        parts = F.transform(F.split("winner", ","), text.py_strip)
        winners = winners.select(F.explode(parts).alias("winner"))
    counts = winners.groupBy("winner").agg(F.count(F.lit(1)).alias("wins"))
    return label_map.join(counts, label_map["label"] == counts["winner"], "left").select(
        "position", "model", "label", F.coalesce("wins", F.lit(0)).alias("wins")
    )


def winner_string(ballots: DataFrame, order_by: str, rows: int) -> DataFrame:
    """Winners among the first `rows` ballots in order, joined by commas, as one short text."""
    read = ballots.orderBy(order_by).limit(rows).where(F.col("winner").isNotNull())
    votes = F.array_sort(F.collect_list(F.struct(order_by, "winner")))
    return read.agg(F.array_join(F.transform(votes, lambda v: v["winner"]), ",").alias("winners"))
