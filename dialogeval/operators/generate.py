"""Batch generation: every model over every prompt, long table out.

Three kinds of model: extractive ones are column expressions and run in the JVM; the central sentence needs to know how
common words are in the whole corpus, so that blocks of dialogues look their words up; any other is a predictor built on the executors, once per model and
partition, and fed in Arrow batches.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dialogeval.functions import text
from dialogeval.operators.joins import MAX_BROADCAST_BYTES, lookup_join, row_size, whole_row
from dialogeval.sources import scratch

Predictor = Callable[[list], Sequence[str]]
# Prompts that are shuffled go to so many tasks that each gets about so many bytes at most.
TASK_BYTES = 128 * 1024 * 1024


def first_of(sentences: Column) -> Column:
    return F.try_element_at(sentences, F.lit(1))


def last_of(sentences: Column) -> Column:
    return F.try_element_at(sentences, F.lit(-1))


def longest_of(sentences: Column) -> Column:
    """Longest sentence; the first of equally long ones."""
    measured = F.transform(
        sentences,
        lambda s, i: F.struct(F.length(s).alias("size"), (-i).alias("place"), s.alias("sentence")),
    )
    return F.array_max(measured)["sentence"]


def first_sentence(dialog: Column) -> Column:
    return first_of(text.sentences(dialog))


EXTRACTIVE: dict[str, Callable[[Column], Column]] = {
    "org/lead-1": first_of,
    "org/tail-1": last_of,
    "org/longest-1": longest_of,
}


def generate_extractive(
    prompts: DataFrame,
    dialog: str = "model_input",
    models: Mapping[str, Callable[[Column], Column]] = EXTRACTIVE,
) -> DataFrame:
    """Add `model`, `model_output`: one row per prompt and model, no shuffle, no Python.

    A model picks from the sentences of the dialogue, which are split once for all models.
    """
    outputs = F.array(
        *[
            F.struct(F.lit(name).alias("model"), pick(F.col("_sentences")).alias("model_output"))
            for name, pick in models.items()
        ]
    )
    split = prompts.withColumn("_sentences", text.sentences(F.col(dialog)))
    return split.withColumn("_output", F.explode(outputs)).select(*prompts.columns, "_output.*")


CENTRAL = "org/central-1"
# Weights of words are whole numbers of this size, so that sums do not depend on their order.
WEIGHT_UNIT = 1_000_000
# The dialogues of a block take about so many bytes; a block has at most so many rows (a power of two).
BLOCK_BYTES, MOST_BLOCK_ROWS = 16 * 1024 * 1024, 4096


def word_weights(texts: DataFrame, column: str) -> DataFrame:
    """`(token, weight)`: inverse document frequency, ln(texts / texts with the word), in millionths, of every word.

    A text counts a word once, in its map task; only partial counts of words are shuffled. Missing texts do not count.
    """
    known = texts.where(F.col(column).isNotNull())
    total = known.count()
    tokens = F.array_distinct(F.split(text.words(F.col(column)), " "))
    counted = known.select(F.explode(tokens).alias("token")).where("token <> ''").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    weight = F.round(F.log(F.lit(float(total)) / F.col("n")) * WEIGHT_UNIT).cast("bigint")
    return counted.select("token", weight.alias("weight"))


def central_place(sentences: Sequence[str], weight: Mapping[str, int]) -> int:
    """Place of the sentence, given as words between blanks, with the highest mean weight; the first of equal ones."""
    place, highest = 0, None
    for i, sentence in enumerate(sentences):
        tokens = sentence.split()
        if not tokens:
            continue
        mean = float(sum(weight[t] for t in tokens if t in weight)) / len(tokens)
        if highest is None or mean > highest:
            place, highest = i, mean
    return place


def _central_block(key: tuple, rows: pa.Table, store: pa.Table) -> pa.Table:
    weight: dict[str, int] = {}
    for token, value in zip(store["token"].to_pylist(), store["weight"].to_pylist()):
        weight[token] = weight.get(token, 0) + (value or 0)
    parts = []
    for batch in rows.to_batches():
        sentences = batch.column("sentences")
        sizes = sentences.value_lengths().to_numpy(zero_copy_only=False)
        places = [central_place(said, weight) for said in batch.column("words").to_pylist()]
        chosen = sentences.flatten().take(pa.array(np.cumsum(sizes, dtype="int64") - sizes + places, pa.int64()))
        parts.append(pa.table([batch.column("number"), chosen], names=["number", "sentence"]))
    return pa.concat_tables(parts) if parts else pa.table({"number": pa.array([], pa.int64()), "sentence": pa.array([], pa.string())})


def generate_central(
    prompts: DataFrame,
    dialog: str = "model_input",
    model: str = CENTRAL,
    weights: DataFrame | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Add `model`, `model_output`: the sentence of each dialogue whose words have the highest mean weight.

    `weights` is a table `(token, weight)` with whole numbers; the default are the inverse document frequencies over the
    dialogues of `prompts`. Every occurrence of a word counts; words without a weight weigh nothing. Ties go to the first
    sentence, so do dialogues without words; without a sentence the output is missing. Rows need no key. Dialogues are
    worked on in blocks: a block fetches the weight of each of its distinct words once, and its dialogues, which are
    shuffled once, meet that store. So neither words nor sentences become rows of a shuffle. Words that many blocks share
    are salted if the weights are too large to be sent to all tasks.
    """
    rows = prompts.select(F.monotonically_increasing_id().alias("number"), whole_row(prompts))
    rows = scratch.through_table(rows, "prompts")
    said = F.col(f"row.`{dialog}`")
    if weights is None:
        weights = scratch.through_table(word_weights(rows.select(said.alias("text")), "text"), "weights")
    mean, total = rows.agg(F.avg(F.octet_length(said)), F.sum(F.octet_length(said).cast("bigint"))).first()
    most = BLOCK_BYTES / max(1.0, mean or 1.0)
    block = F.shiftright("number", max(0, min(int(most), MOST_BLOCK_ROWS).bit_length() - 1)).alias("block")
    tokens = rows.select(block, F.explode(F.array_distinct(F.split(text.words(said), " "))).alias("token"))
    tokens = scratch.through_table(tokens.where("token <> ''").distinct(), "block_words")
    store = lookup_join(tokens, weights, "token", ["block"], max_broadcast_bytes=max_broadcast_bytes)
    # The texts travel as they are; what is made of them, only to the Python worker.
    held = rows.select(block, "number", said.alias("said")).where("said IS NOT NULL")
    tasks = math.ceil((total or 0) / TASK_BYTES)
    usual = int(prompts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = held.repartition(tasks, "block") if tasks > usual else held.repartition("block")
    split = held.select("block", "number", text.sentences(F.col("said")).alias("sentences")).where(F.size("sentences") > 0)
    split = split.withColumn("words", F.transform("sentences", text.words))
    picked = split.groupBy("block").cogroup(store.select("block", "token", "weight").groupBy("block"))
    picked = picked.applyInArrow(_central_block, "number bigint, sentence string")
    return rows.join(picked, "number", "left").select("row.*", F.lit(model).alias("model"), F.col("sentence").alias("model_output"))


def batch_generate(
    prompts: DataFrame,
    model_ids: Sequence[str],
    build: Callable[[str, dict], Predictor],
    model_input: str = "model_input",
    row_id: str | None = None,
    partitions_per_model: int | None = None,
    distinct: bool = False,
    **settings,
) -> DataFrame:
    """Run each model over all prompts and add `model`, `model_output`.

    `build(model_id, settings)` makes a predictor on the executor; it maps a list of inputs to as many outputs.
    `settings` carries temperature, top_p, max_tokens and the like. Every model is a branch of its own, so a task builds
    one predictor, and branches need no shuffle. With `partitions_per_model` the work of each is first spread by unique
    `row_id` over so many tasks, or over more if one would get more than about `TASK_BYTES`; the batch size is
    `spark.sql.execution.arrow.maxRecordsPerBatch`. Only the inputs become Python values; all other columns pass through
    as they are. With `distinct`, equal inputs go to a model once and the outputs are joined back.
    """
    if partitions_per_model and row_id is None:
        raise ValueError("spreading the work needs a unique row_id")
    if distinct:
        keyed = prompts.withColumn("_input_key", F.sha2(F.to_json(F.struct(model_input)), 256))
        once = keyed.select("_input_key", model_input).dropDuplicates(["_input_key"])
        spread = "_input_key" if partitions_per_model else None
        outputs = batch_generate(
            once, model_ids, build, model_input, spread, partitions_per_model, False, **settings
        )
        return keyed.join(outputs.drop(model_input), "_input_key").drop("_input_key")
    work = prompts
    if partitions_per_model:
        size = prompts.agg(F.sum(row_size(prompts).cast("bigint"))).first()[0] or 0
        work = prompts.repartition(max(partitions_per_model, math.ceil(size / TASK_BYTES)), F.xxhash64(row_id))
    schema = StructType(
        [*prompts.schema.fields, StructField("model", StringType()), StructField("model_output", StringType())]
    )

    def runner(model_id: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            predictor = None
            for batch in batches:
                predictor = predictor or build(model_id, settings)
                inputs = batch.column(batch.schema.get_field_index(model_input)).to_pylist()
                outputs = list(predictor(inputs)) if inputs else []
                if len(outputs) != len(inputs):
                    raise ValueError(f"{model_id} made {len(outputs)} outputs of {len(inputs)} inputs")
                names = [*batch.schema.names, "model", "model_output"]
                added = [pa.array([model_id] * len(inputs), pa.string()), pa.array(outputs, pa.string())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)

        return run

    parts = [work.mapInArrow(runner(model_id), schema) for model_id in model_ids]
    return reduce(DataFrame.unionByName, parts)
