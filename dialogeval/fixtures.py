"""Stand-in inputs derived from the tables under test (see FIXTURES.md).

The views only rearrange those tables and inject what they lack (markers, tags, ties, missing outputs), so
their size grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogeval import constants as K
from dialogeval.functions import chat, text
from dialogeval.functions.hashing import hash_number
from dialogeval.operators import entities, generate, rouge, sampling

USER_TAG, ASSISTANT_TAG = "#Person1#: ", "#Person2#: "
MODELS = ["org/lead-1", "org/tail-1", "org/longest-1", "org/user-1"]
SHORT_MODELS = [m.split("/")[-1] for m in MODELS]
LABELS = ["1", "2", "3", "4"]
LABEL_SEED = "label"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dialogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(dialog_id, dialogue, summary)` of every conversation, however long; the id is its number as text."""
    turns = table(spark, sf_dir, "conversations").where("role <> 'system'").select("conv_id", "turn", "role", "text")
    grouped = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    grouped = grouped.select(F.col("conv_id").cast("string").alias("dialog_id"), "turns")

    def tagged(turn: Column) -> Column:
        tag = F.when(turn["role"] == "user", USER_TAG).otherwise(ASSISTANT_TAG)
        return F.concat(tag, turn["text"])

    answers = F.filter("turns", lambda t: t["role"] == "assistant")
    return grouped.select(
        "dialog_id",
        F.array_join(F.transform("turns", tagged), "\n").alias("dialogue"),
        generate.first_sentence(F.try_element_at(answers, F.lit(1))["text"]).alias("summary"),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(dialog_id, response)` with one marker, two markers and stars, or (no summary) no marker."""
    starred = F.concat(F.lit("*"), "summary", F.lit("*"))
    once = F.concat("dialogue", F.lit("\n\n**Summary:** "), "summary")
    twice = F.concat(
        "dialogue", F.lit("\n\n**Summary draft:** "), starred, F.lit("\n\n**Summary:** "), starred
    )
    response = F.when(hash_number(F.col("dialog_id")) % 10 == 0, twice).otherwise(once)
    return dialogs(spark, sf_dir).select(
        "dialog_id", F.coalesce(response, "dialogue").alias("response")
    )


def tagged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(row_id, dialogue)`: copies of a document differ by their speaker tag only."""
    tag = F.when(F.col("doc_id") % 2 == 0, USER_TAG).otherwise("#Person2#:")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), F.concat(tag, "text").alias("dialogue")
    )


def second_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(row_id, messages, split)`: documents as user turns, their first sentences as answers."""
    row_id = F.concat(F.lit("c2:"), F.col("doc_id").cast("string"))
    rows = table(spark, sf_dir, "documents").select(row_id.alias("row_id"), "text")
    rows = rows.select(
        "row_id",
        F.array(
            chat.message("user", F.col("text")), chat.message("assistant", generate.first_sentence(F.col("text")))
        ).alias("messages"),
    )
    return sampling.train_test_split(rows, K.SHUFFLE_SEED, "row_id", K.TEST_FRACTION)


def last_user_sentence(dialogue: Column) -> Column:
    turn = F.split_part(dialogue, F.lit(USER_TAG), F.lit(-1))
    turn = F.split_part(turn, F.lit("\n" + ASSISTANT_TAG), F.lit(1))
    return F.when(F.contains(dialogue, F.lit(USER_TAG)), generate.first_sentence(turn))


def outputs_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(dialog_id, dialog, summary, model, model_output)` of four stand-in models.

    `tail-1` has gaps, and for some dialogues all models say the same.
    """
    cleaned = dialogs(spark, sf_dir).withColumn("dialog", text.strip_speaker_tags(F.col("dialogue")))
    mark = hash_number(F.col("dialog_id"))

    def sometimes_first(sentences: Column, other: Column) -> Column:
        return F.when(mark % 25 == 0, generate.first_of(sentences)).otherwise(other)

    models = {
        "org/lead-1": generate.first_of,
        "org/tail-1": lambda s: F.when(mark % 17 != 0, sometimes_first(s, generate.last_of(s))),
        "org/longest-1": lambda s: sometimes_first(s, generate.longest_of(s)),
        "org/user-1": lambda s: sometimes_first(s, last_user_sentence(F.col("dialogue"))),
    }
    rows = generate.generate_extractive(cleaned, "dialog", models)
    return rows.select("dialog_id", "dialog", "summary", "model", "model_output")


def short_outputs_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`outputs_long` with short model names."""
    return outputs_long(spark, sf_dir).withColumn("model", text.model_short_name(F.col("model")))


def outputs_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(dialog_id, summary, dialog, summary_by_<model>...)`; `dialog` is the full prompt."""
    rows = short_outputs_long(spark, sf_dir)
    wide = rows.groupBy("dialog_id").pivot("model", SHORT_MODELS).agg(
        F.first("model_output", ignorenulls=True)
    )
    wide = wide.withColumnsRenamed({m: f"{K.OUTPUT_COLUMN_PREFIX}{m}" for m in SHORT_MODELS})
    base = dialogs(spark, sf_dir).select(
        "dialog_id",
        "summary",
        text.build_prompt(text.strip_speaker_tags(F.col("dialogue"))).alias("dialog"),
    )
    return base.join(wide, "dialog_id")


def scores_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(dialog_id, rougeL_score_summary_by_<model>...)`."""
    scored = rouge.rouge_l(short_outputs_long(spark, sf_dir), stem=False)
    wide = scored.groupBy("dialog_id").pivot("model", SHORT_MODELS).agg(F.first("rouge_l"))
    prefix = K.SCORE_COLUMN_PREFIX + K.OUTPUT_COLUMN_PREFIX
    return wide.withColumnsRenamed({m: prefix + m for m in SHORT_MODELS})


def label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(position, model, label)` of the short model names found in the outputs."""
    models = short_outputs_long(spark, sf_dir).select("model").distinct()
    return sampling.blind_labels(models, LABEL_SEED)


def ballots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(dialog_id, winner)`: a label, a tie, or no vote."""
    vote = hash_number(F.concat(F.lit("vote:"), "dialog_id")) % 6
    winner = F.when(vote == 5, "1,3").when(vote > 0, vote.cast("string"))
    return dialogs(spark, sf_dir).select("dialog_id", winner.alias("winner"))


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(entity, type)` of capitalised spans, of the words inside them, and of the first two words of each dialogue."""
    parts = entities.pieces(F.col("dialogue"))
    spans = entities.candidate_spans(F.col("dialogue"))
    inside = F.flatten(F.transform(spans, lambda s: F.split(s, " ")))
    # After the tag come a word, what follows it, and the next word.
    phrase = F.array_compact(F.array(F.when(F.size(parts) > 5, F.array_join(F.slice(parts, 4, 3), ""))))
    spans = dialogs(spark, sf_dir).select(F.explode(F.concat(spans, inside, phrase)).alias("entity"))
    types = F.array(*[F.lit(t) for t in ("PER", "ORG", "LOC", "MISC")])
    number = (hash_number(F.col("entity")) % 4).cast("int")
    return spans.distinct().withColumn("type", F.get(types, number))


def token_vectors(spark: SparkSession, sf_dir: str, outputs: DataFrame | None = None) -> DataFrame:
    """`(token, embedding)` for the words of summaries and outputs."""
    rows = outputs_long(spark, sf_dir) if outputs is None else outputs
    both = [F.split(text.words(F.coalesce(F.col(c), F.lit(""))), " ") for c in ("summary", "model_output")]
    tokens = rows.select(F.explode(F.concat(*both)).alias("token"))
    tokens = tokens.where("token <> ''").distinct()
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    size = vectors.agg(F.count(F.lit(1))).scalar()
    placed = tokens.withColumn("vec_id", hash_number(F.col("token")) % size)
    return placed.join(vectors, "vec_id").select("token", "embedding")
