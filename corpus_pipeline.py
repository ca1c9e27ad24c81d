"""A training corpus from `documents`: five stages, each written as Parquet and read again as the input of the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogeval.llm import decontaminate, jaccard, mixing, secrets, toxicity
from dialogeval.sources import scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model calls toxic go."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document of the smallest id stays."""
    return jaccard.keep_smallest(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; the documents stay."""
    return secrets.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The order in which the documents are read, by block and position; a document may be read several times."""
    return mixing.mix_sources(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix),
]

# The classifier of the first stage and the hashes of the last one have no SQL; a test compares the rows of run() with
# a brute-force version of the stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of `documents`.

    What each stage kept stays stored, so that a stage can be looked at or repeated; the tables that it needed on the way
    are removed. NULL texts and empty tables pass through every stage; their results are told by the operators.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:

        def kept(stage=stage, docs=docs) -> DataFrame:
            return stage(spark, docs, sf_dir).select(*[F.col(c) for c in docs.columns])

        docs = scratch.finished(spark, f"stage_{name}", kept)
    return STAGES[-1][1](spark, docs, sf_dir)
