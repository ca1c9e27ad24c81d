"""Joins that replace alignment by row position, and lookups that survive hot keys.

Joins on unique row ids need no care: Spark shuffles them evenly, or broadcasts a side it measured as small.
A lookup joins many rows to a table with one row per key, and one key may own a third of the rows. The lookup
table is broadcast only after its size was measured; beyond the limit frequent keys are salted. (Adaptive
execution alone does not help here: it leaves a skewed join as it is when a side was aggregated first.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogeval.sources import scratch

# A lookup table up to this size is broadcast.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# Counters of the sketch that finds frequent keys: at least, and at most as the sketch allows.
TRACKED_KEYS, MOST_TRACKED_KEYS = 16_384, 1_000_000

_HASH, _SALT, _SALTS = "_key_hash", "_salt", "_salts"


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct `row`; what stands beside it clashes with none of them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def row_size(df: DataFrame) -> Column:
    """Bytes of all columns of a row, about."""
    size = F.lit(0)
    for field in df.schema.fields:
        kind, column = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif kind in ("array", "map", "struct"):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
        else:
            size = size + F.lit(8)
    return size


def fits(df: DataFrame, row_bytes: Column, max_bytes: int) -> bool:
    """Measure a table: is the sum of `row_bytes` within the limit? One aggregate over those columns."""
    if max_bytes <= 0:
        return False
    size = df.agg(F.sum(row_bytes.cast("bigint") + 16)).first()[0]
    return (size or 0) <= max_bytes


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    row_id: Sequence[str],
    row_bytes: Column | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Inner join of many `rows` to a `table` with one row per `key`; `row_id` names a unique row.

    All columns of `table` are measured unless `row_bytes` says what a row takes.
    """
    width = row_size(table) if row_bytes is None else row_bytes
    if fits(table, width, max_broadcast_bytes):
        return rows.join(F.broadcast(table), key)
    return salted_join(rows, table, key, row_id)


def salted_join(rows: DataFrame, table: DataFrame, key: str, row_id: Sequence[str]) -> DataFrame:
    """Inner shuffle join in which frequent keys are divided.

    A sketch over `rows` finds the frequent keys. Rows of such a key are spread over as many salts as the
    key has average partitions of rows, and its one row in `table` is copied once per salt. Only keys with more
    rows than an average partition count as frequent, so there are fewer of them than partitions and their
    list can be broadcast; it is stored first, because a sketch
    merged in another order may differ and both sides must use the same salts. The sketch only decides what
    is spread, never what matches.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = min(partitions, MOST_TRACKED_KEYS // 16)
    tracked = max(TRACKED_KEYS, 16 * most)
    hashed = rows.withColumn(_HASH, F.xxhash64(key))
    top = hashed.agg(
        F.expr(f"approx_top_k({_HASH}, {most}, {tracked})").alias("top"),
        F.count(F.lit(1)).alias("total"),
    ).select(F.explode("top").alias("top"), "total")
    frequent = top.select(
        F.col("top.item").alias(_HASH),
        F.ceil(F.col("top.count") * partitions / F.col("total")).cast("int").alias(_SALTS),
    ).where(F.col(_SALTS) > 1)
    frequent = scratch.through_table(frequent, "frequent_keys")

    salts = F.coalesce(F.col(_SALTS), F.lit(1))
    spread = hashed.join(F.broadcast(frequent), _HASH, "left").withColumn(
        _SALT, F.pmod(F.xxhash64(*row_id), salts).cast("int")
    )
    copied = (
        table.withColumn(_HASH, F.xxhash64(key))
        .join(F.broadcast(frequent), _HASH, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), salts - 1)))
    )
    joined = spread.drop(_HASH, _SALTS).join(copied.drop(_HASH, _SALTS), [key, _SALT])
    return joined.drop(_SALT)


def models_x_prompts(prompts: DataFrame, models: Sequence[str]) -> DataFrame:
    """Every prompt for every model. The models are a literal list, so this is a map-side explode."""
    return prompts.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))


def attach_outputs(
    prompts: DataFrame, outputs: DataFrame, keys: Sequence[str] = ("dialog_id", "model")
) -> DataFrame:
    """Put outputs next to their prompts; prompts without an output keep NULL."""
    return prompts.join(outputs, list(keys), "left")


def label_to_model(
    votes: DataFrame, label_map: DataFrame, label: str = "winner", row_id: str = "dialog_id"
) -> DataFrame:
    """Resolve the label of each vote to its model; votes that name no label drop out.

    There are few labels, so each of them is a hot key.
    """
    names = label_map.select(F.col("label").alias(label), "model")
    return lookup_join(votes, names, label, [row_id], F.octet_length(label) + F.octet_length("model"))


def holdout_antijoin(df: DataFrame, used: DataFrame, key: str) -> DataFrame:
    """Rows of `df` whose key was not used before."""
    return df.join(used.select(key), key, "left_anti")
