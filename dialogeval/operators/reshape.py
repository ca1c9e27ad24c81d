"""Wide <-> long, concatenation, set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogeval import constants as K
from dialogeval.functions import text


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), [f"`{v}`" for v in values], name, value)


def wide_to_long(df: DataFrame, ids: Sequence[str] | None = None) -> DataFrame:
    """Output columns become `(model, model_output)` rows; rows without text drop out.

    Output columns are those with the usual prefix, or all but the `ids` if these are given. A `dialog` among the ids is turned back from a prompt into the bare dialogue.
    """
    if ids is None:
        ids = [c for c in df.columns if not c.startswith(K.OUTPUT_COLUMN_PREFIX)]
    ids = [c for c in ids if c in df.columns]
    long = melt(df, ids, [c for c in df.columns if c not in ids], "model", "model_output")
    long = long.withColumn("model", text.model_from_column(F.col("model")))
    long = long.na.drop(subset=["summary", "model_output"])
    if "dialog" in ids:
        long = long.withColumn("dialog", text.recover_dialog(F.col("dialog")))
    return long


def long_to_wide(
    df: DataFrame,
    ids: Sequence[str],
    models: Sequence[str],
    prefix: str = K.OUTPUT_COLUMN_PREFIX,
    model: str = "model",
    value: str = "model_output",
    key: Sequence[str] | None = None,
) -> DataFrame:
    """One column per model. The models are given, so no extra job looks for them.

    A group is one dialogue and holds one row per model; its outputs are gathered as pairs of model and text and never
    sorted. With `key`, the ids that tell groups apart, the other `ids` (texts that are the same in all rows of a group)
    are carried along and are not grouped by. Of several outputs of a model the smallest counts.
    """
    key = list(ids if key is None else key)
    carried = [c for c in ids if c not in key]
    known = F.col(value).isNotNull() & F.col(model).isin(list(models))
    pair = F.struct(F.col(model).alias("model"), F.col(value).alias("value"))
    found = [F.collect_set(F.when(known, pair)).alias("found")]
    if carried:
        found.append(F.collect_set(F.struct(*[F.col(c) for c in carried])).alias("carried"))
    groups = df.groupBy(*key).agg(*found)
    same = F.array_min("carried") if carried else None

    def output(name: str) -> Column:
        own = F.filter("found", lambda p: p["model"] == name)
        return F.array_min(F.transform(own, lambda p: p["value"])).alias(f"{prefix}{name}")

    return groups.select(
        *[same[c].alias(c) if c in carried else F.col(c) for c in ids], *[output(name) for name in models]
    )


def concat_tables(*tables: DataFrame) -> DataFrame:
    """Rows of all tables; columns meet by name, missing ones are NULL."""
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result


def set_or_empty(values: Column) -> Column:
    """A missing set counts as empty."""
    return F.coalesce(values, F.array().cast("array<string>"))


def set_difference(left: Column, right: Column) -> Column:
    return F.array_except(set_or_empty(left), set_or_empty(right))


def set_size(values: Column) -> Column:
    return F.size(set_or_empty(values))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.countDistinct(column).alias(f"num_{column}s"))


def identical_outputs(df: DataFrame, key: str = "dialog_id", output: str = "model_output") -> DataFrame:
    """Per key: do all models say the same after lower-casing and stripping?

    Two 64-bit hashes stand for a text, 128 bits in all; lowest = highest of each needs one partial aggregate of numbers.
    A missing output equals nothing.
    """
    form = text.normalise_text(F.col(output))
    hashed = df.select(key, F.xxhash64(form).alias("one"), F.xxhash64(F.lit(1), form).alias("two"), form.isNotNull().alias("known"))
    same = [F.min(h) == F.max(h) for h in ("one", "two")]
    return hashed.groupBy(key).agg((same[0] & same[1] & F.min("known")).alias("identical"))


def identical_in_row(columns: Sequence[str]) -> Column:
    """The same test on a wide row."""
    forms = F.array(*[text.normalise_text(F.col(f"`{c}`")) for c in columns])
    return (F.size(F.array_distinct(forms)) == 1) & F.forall(forms, lambda form: form.isNotNull())


def any_true(df: DataFrame, flag: str) -> DataFrame:
    return df.agg(F.coalesce(F.bool_or(flag), F.lit(False)).alias(f"any_{flag}"))
