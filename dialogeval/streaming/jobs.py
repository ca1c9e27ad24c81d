"""Continuous versions of the map-only jobs.

Building training rows and scoring overlap look at one row at a time, so the batch plans run on a stream
unchanged. Entity tagging needs an aggregate per text and runs on each micro-batch against a static
gazetteer, which is read and indexed once for all batches. State is only the list of files already read; it lives with the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from dialogeval import constants as K
from dialogeval.operators import entities, rouge
from dialogeval.plans import training
from dialogeval.sources import scratch


def read_stream(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def append_files(
    df: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ()
) -> StreamingQuery:
    """Write what has arrived and stop; the file sink commits each micro-batch exactly once."""
    writer = df.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.partitionBy(*partition_by) if partition_by else writer).start()


def stream_training_set(
    spark: SparkSession, source: str, schema: StructType | str, path: str, checkpoint: str, row_id: str
) -> StreamingQuery:
    """Raw responses in, training rows out under `split=<train|test>`, split by threshold."""
    rows = training.build_training_set(read_stream(spark, source, schema), row_id=row_id, exact=False)
    return append_files(rows, path, checkpoint, ("split",))


def stream_overlap(
    spark: SparkSession, source: str, schema: StructType | str, path: str, checkpoint: str
) -> StreamingQuery:
    """Model outputs in, the same rows with `rouge_l` out."""
    return append_files(rouge.rouge_l(read_stream(spark, source, schema)), path, checkpoint)


def stream_entities(
    texts: DataFrame,
    gazetteer: DataFrame | entities.Gazetteer,
    path: str,
    checkpoint: str,
    column: str = "text",
    types: tuple[str, ...] = K.ENTITY_TYPES,
) -> StreamingQuery:
    """Entity sets of the distinct texts of each micro-batch.

    The gazetteer is prepared before the first batch; its version is a column of the result, so that results of an older
    one can be told apart. A batch writes its own directory, so a batch that is run again replaces what it wrote before.
    Intermediate tables of a batch are removed with it, so an endless stream does not fill the shared folder.
    """
    ready = gazetteer if isinstance(gazetteer, entities.Gazetteer) else entities.prepare(gazetteer, types)

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch.scope(batch.sparkSession):
            found = entities.extract_entities(batch, ready, column, types)
            found = found.withColumn("gazetteer_version", F.lit(ready.version))
            found.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = texts.writeStream.foreachBatch(write).trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).start()
