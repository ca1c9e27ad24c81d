"""Datasets with splits, CSV exchange files and the label map.

Parquet is the format between stages; CSV is for exchange. Every reader takes a schema, so nothing is
inferred from the data and Spark can prune columns and partitions from the first scan on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LABEL_MAP_SCHEMA = "position int, model string, label string"
# Quotes are doubled inside cells; blanks at the edges of a cell belong to it.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def scan_dataset(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    split: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Read a Parquet dataset; `split` prunes to one partition directory, `columns` the scan."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    if split is not None:
        df = df.where(F.col("split") == split)
    return df if columns is None else df.select(*columns)


def write_dataset(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("split",), mode: str = "errorifexists"
) -> None:
    """Write Parquet with one directory per split; the job commit makes it all or nothing.

    With the mode "overwrite" exactly the splits that `df` has rows of are replaced, and others stay. Rows are not
    shuffled first: each task writes at most one file per split. A writer that wants fewer files repartitions by a hash of
    the row id before calling this, never by the split itself.
    """
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def write_dated(df: DataFrame, path: str, run_date: str) -> None:
    """Write results under `run_date=<date>`.

    The date is an argument, and what was written for it before is replaced, so that a rerun gives the same table; other
    dates stay as they are. A run without rows leaves the date as it was.
    """
    write_dataset(df.withColumn("run_date", F.lit(run_date).cast("date")), path, ["run_date"], "overwrite")


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    na_values: Sequence[str] = (),
    multi_line: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Read header CSV whose quoted cells may hold commas and doubled quotes, and newlines with `multi_line`.

    Columns are found by their header names, in whatever order the files have them; the result has the order of
    `schema`. Unknown and missing columns raise, as do files whose headers differ, cells that are not of their type and
    rows with more or fewer cells (`mode` can relax the last two). Cells equal to one of `na_values` become missing, as
    does an empty cell. `multi_line` makes a file one task; large exports should come as many files (which `write_csv`
    produces) or as Parquet.
    """
    asked = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.options(**CSV_OPTIONS, multiLine=multi_line, mode=mode)
    header = reader.options(inferSchema=False).csv(path).columns
    if sorted(header) != sorted(asked.names):
        raise ValueError(f"the file has the columns {header}, not {asked.names}")
    in_file = StructType([asked[name] for name in header])
    # The headers of all files are checked; of the cells, those of the columns that are read.
    df = reader.schema(in_file).options(enforceSchema=False).csv(path).select(*asked.names)
    if not na_values:
        return df
    strings = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    return df.select(
        *[
            F.when(~F.col(c).isin(*na_values), F.col(c)).alias(c) if c in strings else F.col(c)
            for c in df.columns
        ]
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write header CSV without an index; one file per task."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_label_map(label_map: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write `(position, model, label)` as JSON lines; the position keeps the order of the models."""
    label_map.select("position", "model", "label").write.mode(mode).json(path)


def scan_label_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LABEL_MAP_SCHEMA).json(path)


def table_from_list(spark: SparkSession, values: Sequence, column: str, data_type: str) -> DataFrame:
    """One-column table from a short list the caller holds already."""
    return spark.createDataFrame([(v,) for v in values], f"{column} {data_type}")
