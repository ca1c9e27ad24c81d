"""Filters, row limits, exact deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which any of the listed columns is missing."""
    return df.na.drop(subset=list(columns))


def entity_type_in(entities: DataFrame, types: Sequence[str]) -> DataFrame:
    """Keep entity rows of the allowed types."""
    return entities.where(F.col("type").isin(*types))


def head_n(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First `n` rows in an explicit order; Spark keeps only the `n` best rows of each task."""
    return df.orderBy(*order_by).limit(n)


def dedup_exact(df: DataFrame, text: str, order_by: str) -> DataFrame:
    """Keep the row with the lowest `order_by` for each distinct text; missing texts are one group.

    `min` has a partial aggregate, so a text with a billion copies leaves each map task as one row and
    never meets in one reducer. `order_by` must be a unique row id. If the table has other columns, the
    kept ids select their rows with a semi-join on that unique id.
    """
    kept = df.groupBy(text).agg(F.min(order_by).alias(order_by))
    if set(df.columns) == {text, order_by}:
        return kept.select(*df.columns)
    return df.join(kept.select(order_by), order_by, "left_semi").select(*df.columns)
