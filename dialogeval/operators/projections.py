"""Row-local projections. They also run unchanged on streaming DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogeval import constants as K
from dialogeval.functions import chat, text


def split_response(df: DataFrame, response: str = "response") -> DataFrame:
    """Add `summary` and `dialog`, the raw parts around the summary marker."""
    return df.withColumns(
        {"summary": text.summary_part(F.col(response)), "dialog": text.dialog_part(F.col(response))}
    )


def strip_markup(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: text.strip_markup(F.col(c)) for c in columns})


def dialog_summary_columns(df: DataFrame, response: str = "response") -> DataFrame:
    """Clean `summary`, `dialog` wrapped in its prompt, constant `system_prompt`."""
    parts = strip_markup(split_response(df, response), ["summary", "dialog"])
    return parts.withColumns(
        {"dialog": text.build_prompt(F.col("dialog")), "system_prompt": F.lit(K.SYSTEM_PROMPT)}
    )


def project_keep(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Keep the listed columns in the order the table has them; unknown names are ignored."""
    return df.select(*[c for c in df.columns if c in set(keep)])


def columns_matching(df: DataFrame, part: str) -> list[str]:
    return [c for c in df.columns if part in c]


def rename_by_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def reorder_columns(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Select `order`; a missing column is an error and never a silent fallback."""
    missing = [c for c in order if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in the table: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in order])


def add_messages(df: DataFrame) -> DataFrame:
    """Add the training conversation of each row."""
    return df.withColumn(
        "messages", chat.chat_messages(F.col("system_prompt"), F.col("dialog"), F.col("summary"))
    )


def render_chatml(
    df: DataFrame, messages: str = "messages", template: chat.ChatTemplate = chat.CHATML
) -> DataFrame:
    """Add `text`, each conversation rendered with the chat template."""
    return df.withColumn("text", chat.render_chat(F.col(messages), template))


def expand_struct(df: DataFrame, column: str) -> DataFrame:
    """Replace a struct column by its fields."""
    return df.select(*[F.col(c) for c in df.columns if c != column], f"{column}.*")


def missing_to_null(column: Column) -> Column:
    """NaN -> NULL, so that means and sums skip it."""
    return F.when(~F.isnan(column), column)
