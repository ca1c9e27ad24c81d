"""Named queries over a folder of test tables; `oracle.py` states the same results in plain SQL.

Nested results are flattened to text (`|` between elements) so that engines can be compared by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogeval import constants as K
from dialogeval import fixtures as fx
from dialogeval.functions import chat, hashing, text
from dialogeval.operators import (
    aggregates,
    bertscore,
    entities,
    filters,
    generate,
    joins,
    projections,
    reshape,
    rouge,
    sampling,
)
from dialogeval.plans import evaluation, human, inference, training
from dialogeval.sources import datasets, scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Sizes of the sampling queries, small enough to cut into the smallest test tables.
SLICE = (100, 300)
LONG_SLICE = (30, 900)
SUBSET_ROWS = 50
MIX_ROWS = 10
HOLDOUT = (50, 120)
SHEET_ROWS = 15
READING_ROWS = 8
SEED = K.SHUFFLE_SEED


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def flat(values: Column) -> Column:
    return F.array_join(values, "|")


def roles(messages: str) -> Column:
    return flat(F.transform(messages, lambda m: m["role"])).alias("roles")


def contents(messages: str) -> Column:
    return flat(F.transform(messages, lambda m: m["content"])).alias("contents")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "documents")


def stored(spark: SparkSession, sf: str, view: str) -> DataFrame:
    """A view as a written table, the form in which word vectors, gazetteers and outputs are given."""
    return scratch.through_table(getattr(fx, view)(spark, sf), view)


# --- Flagship -----------------------------------------------------------------------------------


@query
def flagship(spark, sf):
    """Which extractive summariser is closest to the reference summary?"""
    dialogs = fx.dialogs(spark, sf)
    prompts = evaluation.prepare_eval_prompts(dialogs, row_id="dialog_id")
    outputs = generate.generate_extractive(prompts.select("dialog_id", "clean_dialog"), "clean_dialog")
    judged = filters.drop_missing(
        outputs.join(dialogs.select("dialog_id", "summary"), "dialog_id"), ["summary", "model_output"]
    )
    scored = rouge.rouge_l(judged, stem=False)
    means = scored.groupBy("model").agg(
        F.count(F.lit(1)).alias("num_rows"), F.avg("rouge_l").alias("mean_rouge_l")
    )
    return means.select("model", "num_rows", F.round("mean_rouge_l", 6).alias("mean_rouge_l"))


# --- Sources and sinks --------------------------------------------------------------------------


@query
def scan_dataset(spark, sf):
    return datasets.scan_dataset(
        spark,
        f"{sf}/documents.parquet",
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
        columns=["doc_id", "lang", "n_chars"],
    )


@query
def scan_csv(spark, sf):
    path = scratch.scratch_path(spark, "scan_csv")
    datasets.write_csv(fx.tagged_documents(spark, sf), path)
    other = "dialogue string, row_id bigint"  # not the order of the file
    return datasets.scan_csv(spark, path, other, multi_line=True).select("row_id", "dialogue")


@query
def write_csv(spark, sf):
    path = scratch.scratch_path(spark, "write_csv")
    rows = fx.outputs_long(spark, sf).select("dialog_id", "model", "model_output", "summary")
    datasets.write_csv(rows, path)
    return datasets.scan_csv(
        spark, path, "dialog_id string, model string, model_output string, summary string", multi_line=True
    )


@query
def write_dataset(spark, sf):
    path = scratch.scratch_path(spark, "write_dataset")
    datasets.write_dataset(training.build_training_set(fx.raw(spark, sf)), path)
    columns = ["dialog_id", "dialog", "summary", "split"]
    parts = [datasets.scan_dataset(spark, path, split=split, columns=columns) for split in ("train", "test")]
    return reshape.concat_tables(*parts)


# --- Projections --------------------------------------------------------------------------------


@query
def split_response(spark, sf):
    return projections.split_response(fx.raw(spark, sf)).select("dialog_id", "summary", "dialog")


@query
def strip_markup(spark, sf):
    return projections.strip_markup(fx.raw(spark, sf), ["response"])


@query
def build_prompt(spark, sf):
    return fx.dialogs(spark, sf).select(
        "dialog_id", text.build_prompt(F.col("dialogue")).alias("dialog")
    )


@query
def build_prompt_v2(spark, sf):
    return fx.dialogs(spark, sf).select(
        "dialog_id", text.build_prompt_one_line(F.col("dialogue")).alias("user_prompt")
    )


@query
def add_constant(spark, sf):
    return fx.dialogs(spark, sf).select("dialog_id", F.lit(K.SYSTEM_PROMPT).alias("system_prompt"))


@query
def project_keep(spark, sf):
    columns = projections.dialog_summary_columns(fx.raw(spark, sf))
    return projections.project_keep(columns, ["dialog_id", *K.TRAINING_COLUMNS])


@query
def chat_messages(spark, sf):
    rows = projections.add_messages(projections.dialog_summary_columns(fx.raw(spark, sf)))
    return rows.select("dialog_id", roles("messages"), contents("messages"))


@query
def make_prompt(spark, sf):
    """System prompt present, empty or missing by hash of the id."""
    kind = hashing.hash_number(F.col("dialog_id")) % 3
    system = F.when(kind == 0, K.SYSTEM_PROMPT).when(kind == 1, "")
    prompt = chat.make_prompt(F.col("dialogue"), system).alias("prompt")
    rows = fx.dialogs(spark, sf).select("dialog_id", prompt)
    return rows.select("dialog_id", roles("prompt"), contents("prompt"))


@query
def render_chatml(spark, sf):
    return projections.render_chatml(fx.second_corpus(spark, sf)).select("row_id", "text")


@query
def recover_dialog(spark, sf):
    prompt = text.build_prompt(text.strip_speaker_tags(F.col("dialogue")))
    return fx.tagged_documents(spark, sf).select("row_id", text.recover_dialog(prompt).alias("dialog"))


@query
def strip_speaker_tags(spark, sf):
    return fx.dialogs(spark, sf).select(
        "dialog_id", text.strip_speaker_tags(F.col("dialogue")).alias("clean_dialog")
    )


@query
def rename_by_map(spark, sf):
    letters = {f"{K.OUTPUT_COLUMN_PREFIX}{m}": c for m, c in zip(fx.SHORT_MODELS, "abcd")}
    return projections.rename_by_map(fx.outputs_wide(spark, sf).drop("dialog"), letters)


@query
def reorder_columns(spark, sf):
    outputs = [f"{K.OUTPUT_COLUMN_PREFIX}{m}" for m in fx.SHORT_MODELS]
    order = ["summary", *outputs, "dialog", "dialog_id"]
    return projections.reorder_columns(fx.outputs_wide(spark, sf), order)


@query
def model_short_name(spark, sf):
    short = text.model_short_name(F.col("model"))
    column = F.concat(F.lit(K.OUTPUT_COLUMN_PREFIX), short)
    return fx.outputs_long(spark, sf).select(
        "dialog_id", short.alias("short_name"), text.model_from_column(column).alias("from_column")
    )


@query
def normalise_text(spark, sf):
    return documents(spark, sf).select("doc_id", text.normalise_text(F.col("text")).alias("form"))


@query
def attach_column(spark, sf):
    """One column that can be computed, one that comes from another table by key."""
    prompt = text.build_prompt_one_line(F.col("dialogue")).alias("model_input")
    dialogs = fx.dialogs(spark, sf).select("dialog_id", prompt)
    return dialogs.join(fx.ballots(spark, sf), "dialog_id", "left")


# --- Filters and row limits ---------------------------------------------------------------------


@query
def drop_missing(spark, sf):
    rows = fx.outputs_long(spark, sf).select("dialog_id", "model", "summary", "model_output")
    return filters.drop_missing(rows, ["summary", "model_output"])


@query
def null_guard(spark, sf):
    spans = entities.candidate_spans(F.col("model_output"))
    return fx.outputs_long(spark, sf).select(
        "dialog_id",
        "model",
        reshape.set_size(spans).cast("bigint").alias("num_spans"),
        text.strip_speaker_tags(F.col("model_output")).alias("clean_output"),
    )


@query
def entity_type_in(spark, sf):
    return filters.entity_type_in(fx.gazetteer(spark, sf), K.ENTITY_TYPES)


@query
def head_n(spark, sf):
    return filters.head_n(fx.ballots(spark, sf), K.BALLOTS_READ, ["dialog_id"])


@query
def range_slice(spark, sf):
    return sampling.range_slice(documents(spark, sf).select("doc_id", "lang"), SEED, "doc_id", *SLICE)


@query
def range_slice_ranked(spark, sf):
    """A slice that has most of the table, with its end behind the last row of small tables."""
    rows = documents(spark, sf).select("doc_id", "lang")
    return sampling.range_slice(rows, SEED, "doc_id", *LONG_SLICE)


@query
def dedup_exact(spark, sf):
    clean = text.strip_speaker_tags(F.col("dialogue")).alias("clean_dialog")
    rows = fx.tagged_documents(spark, sf).select("row_id", clean)
    return filters.dedup_exact(rows, "clean_dialog", "row_id")


# --- Joins --------------------------------------------------------------------------------------


@query
def models_x_prompts(spark, sf):
    prompts = fx.dialogs(spark, sf).select("dialog_id", "dialogue")
    return joins.models_x_prompts(prompts, fx.MODELS)


@query
def attach_outputs(spark, sf):
    prompts = joins.models_x_prompts(fx.dialogs(spark, sf).select("dialog_id", "summary"), fx.MODELS)
    outputs = fx.outputs_long(spark, sf).select("dialog_id", "model", "model_output")
    return joins.attach_outputs(prompts, filters.drop_missing(outputs, ["model_output"]))


@query
def label_to_model(spark, sf):
    votes = joins.label_to_model(fx.ballots(spark, sf), stored(spark, sf, "label_map"))
    return votes.select("dialog_id", "winner", "model")


@query
def holdout_antijoin(spark, sf):
    rows = documents(spark, sf).select("doc_id", "source")
    used = sampling.range_slice(rows.select("doc_id"), SEED, "doc_id", 0, HOLDOUT[0])
    return joins.holdout_antijoin(rows, used, "doc_id")


# --- Reshape and sets ---------------------------------------------------------------------------


@query
def wide_to_long(spark, sf):
    return reshape.wide_to_long(fx.outputs_wide(spark, sf), ["dialog_id", "summary", "dialog"])


@query
def long_to_wide(spark, sf):
    rows = fx.short_outputs_long(spark, sf)
    return reshape.long_to_wide(rows, ["dialog_id", "summary"], fx.SHORT_MODELS)


@query
def concat_tables(spark, sf):
    first = fx.dialogs(spark, sf).select(F.col("dialog_id").alias("row_id"), "dialogue", "summary")
    second = fx.tagged_documents(spark, sf).withColumn("row_id", F.col("row_id").cast("string"))
    return reshape.concat_tables(first, second)


@query
def entity_set_difference(spark, sf):
    said = entities.candidate_spans(F.col("model_output"))
    given = entities.candidate_spans(F.col("summary"))
    return fx.outputs_long(spark, sf).select(
        "dialog_id",
        "model",
        flat(F.array_sort(reshape.set_difference(said, given))).alias("only_in_output"),
        flat(F.array_sort(reshape.set_difference(given, said))).alias("only_in_summary"),
    )


@query
def set_cardinality(spark, sf):
    spans = entities.candidate_spans(F.col("dialogue"))
    return fx.dialogs(spark, sf).select(
        "dialog_id", reshape.set_size(spans).cast("bigint").alias("num_spans")
    )


@query
def distinct_values(spark, sf):
    models = reshape.distinct_values(fx.short_outputs_long(spark, sf), "model")
    count = reshape.distinct_count(fx.short_outputs_long(spark, sf), "model").scalar()
    return models.withColumn("num_models", count)


@query
def identical_outputs(spark, sf):
    return reshape.identical_outputs(fx.outputs_long(spark, sf))


@query
def identical_outputs_wide(spark, sf):
    columns = [f"{K.OUTPUT_COLUMN_PREFIX}{m}" for m in fx.SHORT_MODELS]
    rows = fx.outputs_wide(spark, sf).select(reshape.identical_in_row(columns).alias("identical"))
    return reshape.any_true(rows, "identical")


# --- Shuffle, split, sample ---------------------------------------------------------------------


@query
def train_test_split(spark, sf):
    rows = documents(spark, sf).select("doc_id")
    return sampling.train_test_split(rows, SEED, "doc_id", K.TEST_FRACTION)


@query
def train_test_split_exact(spark, sf):
    rows = documents(spark, sf).select("doc_id")
    return sampling.train_test_split_exact(rows, SEED, "doc_id", K.TEST_FRACTION)


@query
def seeded_shuffle(spark, sf):
    rows = documents(spark, sf).select("doc_id", hashing.hash_key(SEED, F.col("doc_id")).alias("place"))
    return sampling.seeded_shuffle(rows, SEED, "doc_id")


@query
def eval_subset(spark, sf):
    first = fx.dialogs(spark, sf).select(F.concat(F.lit("d:"), "dialog_id").alias("row_id"))
    second = fx.second_corpus(spark, sf).select("row_id")
    return sampling.eval_subset([first, second], SEED, "row_id", SUBSET_ROWS)


@query
def holdout_slice(spark, sf):
    rows = documents(spark, sf).select("doc_id", "lang")
    return sampling.holdout_slice(rows, SEED, "doc_id", *HOLDOUT)


@query
def sample_n(spark, sf):
    rows = fx.dialogs(spark, sf).select("dialog_id", "summary")
    return sampling.sample_n(rows, SEED, "dialog_id", SHEET_ROWS)


@query
def blind_labels(spark, sf):
    models = reshape.distinct_values(fx.short_outputs_long(spark, sf), "model")
    labels = sampling.blind_labels(models, fx.LABEL_SEED, style="letter")
    return labels.withColumn("position", F.col("position").cast("bigint"))


@query
def human_eval_sheet(spark, sf):
    rows, labels = fx.short_outputs_long(spark, sf), fx.label_map(spark, sf)
    sheet = human.human_eval_sheet(rows, labels, fx.LABELS, SEED, SHEET_ROWS)
    return projections.rename_by_map(sheet, {label: f"label_{label}" for label in fx.LABELS})


@query
def side_by_side(spark, sf):
    return human.side_by_side(fx.short_outputs_long(spark, sf), fx.SHORT_MODELS, SEED, READING_ROWS)


# --- Aggregates ---------------------------------------------------------------------------------


def scored_outputs(spark, sf) -> DataFrame:
    rows = fx.short_outputs_long(spark, sf).select("dialog_id", "model", "summary", "model_output")
    return rouge.rouge_l(rows, stem=False)


@query
def mean_by_model(spark, sf):
    means = aggregates.mean_by_model(scored_outputs(spark, sf), ["rouge_l"])
    return means.withColumn("mean_rouge_l", F.round("mean_rouge_l", 6))


@query
def entity_totals(spark, sf):
    rows = stored(spark, sf, "short_outputs_long")
    return aggregates.entity_totals(entities.entity_scores(rows, stored(spark, sf, "gazetteer")))


@query
def mean_per_column(spark, sf):
    wide = fx.scores_wide(spark, sf)
    columns = projections.columns_matching(wide, "rougeL")
    means = aggregates.mean_per_column(wide, columns, "mean_rouge_l")
    return means.withColumn("mean_rouge_l", F.round("mean_rouge_l", 6))


@query
def describe_scores(spark, sf):
    scores = scratch.through_table(scored_outputs(spark, sf).select("model", "rouge_l"), "scores")
    stats = aggregates.describe_scores(scores, ["model"], ["rouge_l"])
    numbers = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    return stats.select("model", "score", "count", *[F.round(n, 6).alias(n) for n in numbers])


@query
def win_counts(spark, sf):
    wins = aggregates.win_counts(fx.ballots(spark, sf), fx.label_map(spark, sf))
    return wins.select("model", "label", "wins")


@query
def win_counts_ties(spark, sf):
    wins = aggregates.win_counts(fx.ballots(spark, sf), fx.label_map(spark, sf), split_ties=True)
    return wins.select("model", "label", "wins")


@query
def winner_string(spark, sf):
    return aggregates.winner_string(fx.ballots(spark, sf), "dialog_id", K.BALLOTS_READ)


# --- Scoring and inference ----------------------------------------------------------------------


@query
def rouge_l(spark, sf):
    rows = fx.short_outputs_long(spark, sf).select("dialog_id", "model", "summary", "model_output")
    scored = rouge.rouge_l(rows)
    return scored.select("dialog_id", "model", F.round("rouge_l", 6).alias("rouge_l"))


@query
def rouge_l_unstemmed(spark, sf):
    scored = scored_outputs(spark, sf)
    return scored.select("dialog_id", "model", F.round("rouge_l", 6).alias("rouge_l"))


@query
def stem_vocabulary(spark, sf):
    return rouge.stem_vocabulary(documents(spark, sf), ["text"])


def outputs_and_vectors(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = stored(spark, sf, "short_outputs_long").drop("dialog")
    return rows, scratch.through_table(fx.token_vectors(spark, sf, rows), "token_vectors")


def rounded_bert(df: DataFrame) -> DataFrame:
    return df.select("dialog_id", "model", *[F.round(s, 5).alias(s) for s in bertscore.SCORES])


@query
def bert_score(spark, sf):
    rows, vectors = outputs_and_vectors(spark, sf)
    return rounded_bert(bertscore.bert_score(rows, vectors))


@query
def bert_score_joined(spark, sf):
    """The path for vector tables too large to ship."""
    rows, vectors = outputs_and_vectors(spark, sf)
    return rounded_bert(bertscore.bert_score(rows, vectors, max_broadcast_bytes=0))


@query
def extract_entities(spark, sf):
    texts = fx.dialogs(spark, sf).select(F.explode(F.array("dialogue", "summary")).alias("text"))
    found = entities.extract_entities(texts, stored(spark, sf, "gazetteer"))
    return found.select("text", flat(F.col("entities")).alias("entities"))


@query
def batch_generate(spark, sf):
    prompts = fx.tagged_documents(spark, sf).select(
        "row_id", text.strip_speaker_tags(F.col("dialogue")).alias("model_input")
    )
    return generate.generate_extractive(prompts).select("row_id", "model", "model_output")


def central(spark, sf, max_broadcast_bytes):
    prompts = fx.tagged_documents(spark, sf).select(
        "row_id", text.strip_speaker_tags(F.col("dialogue")).alias("model_input")
    )
    found = generate.generate_central(prompts, max_broadcast_bytes=max_broadcast_bytes)
    return found.select("row_id", "model", "model_output")


@query
def batch_generate_central(spark, sf):
    """The sentence with the rarest words, by document frequencies over all dialogues."""
    return central(spark, sf, joins.MAX_BROADCAST_BYTES)


@query
def batch_generate_central_joined(spark, sf):
    """The path for vocabularies too large to broadcast."""
    return central(spark, sf, 0)


COUNTERS = ["first-word", "last-word", "count"]


def word_counter(model_id: str, settings: dict):
    """A stand-in predictor: the first or last word of the input, or of its last message, or how many there are."""
    pick = {"first-word": lambda w: w[0], "last-word": lambda w: w[-1], "count": lambda w: str(len(w))}
    said = lambda t: t if isinstance(t, str) else t[-1]["content"]
    return lambda inputs: [pick[model_id](said(t).split(settings["separator"])) for t in inputs]


@query
def batch_generate_predictor(spark, sf):
    """A carried column beyond what a double can hold, missing in some rows."""
    large = F.when(F.col("row_id") % 3 > 0, F.col("row_id") + F.lit(2**53 + 1)).alias("carried")
    prompts = fx.tagged_documents(spark, sf).select("row_id", large, F.col("dialogue").alias("model_input"))
    outputs = generate.batch_generate(
        prompts, COUNTERS, word_counter, row_id="row_id", partitions_per_model=2, separator=" "
    )
    return outputs.select("row_id", "carried", "model", "model_output")


@query
def infer_holdout(spark, sf):
    """Held-out rows through every model, one column per model."""
    columns = projections.dialog_summary_columns(fx.raw(spark, sf))
    rows = projections.project_keep(columns, ["dialog_id", *K.TRAINING_COLUMNS])
    return inference.infer_holdout(
        rows, COUNTERS, word_counter, row_id="dialog_id", used_rows=5, rows=HOLDOUT[0], separator=" "
    )


@query
def infer_dialogsum(spark, sf):
    """Distinct dialogues through every model, long."""
    outputs = inference.infer_dialogs(
        fx.tagged_documents(spark, sf), COUNTERS, word_counter, row_id="row_id", separator=" "
    )
    return outputs.select("row_id", "clean_dialog", "model", "model_output")


@query
def label_map_io(spark, sf):
    """The label map through its file."""
    path = scratch.scratch_path(spark, "label_map")
    datasets.write_label_map(fx.label_map(spark, sf), path)
    return datasets.scan_label_map(spark, path).withColumn("position", F.col("position").cast("bigint"))


@query
def dated_output(spark, sf):
    """Results of two dates under one path, the first written again by a rerun; all are read back."""
    path = scratch.scratch_path(spark, "dated")
    rows = fx.ballots(spark, sf)
    datasets.write_dated(rows.where("winner IS NULL"), path, "2024-05-01")
    datasets.write_dated(rows.where("winner IS NOT NULL"), path, "2024-05-02")
    for _ in range(2):
        datasets.write_dated(rows, path, "2024-05-01")
    found = datasets.scan_dataset(spark, path)
    return found.select("dialog_id", "winner", F.col("run_date").cast("string").alias("run_date"))


def flat_entities(df: DataFrame, input_col: str) -> DataFrame:
    return df.select(
        "dialog_id",
        "model",
        flat(F.col(f"entities_in_{input_col}")).alias("entities_in_input"),
        flat(F.col("entities_in_model_output")).alias("entities_in_output"),
        flat(F.array_sort("hallucinated_entities")).alias("hallucinated_entities"),
        flat(F.array_sort("missed_entities")).alias("missed_entities"),
        F.col("num_hallucinated_entities").cast("bigint").alias("num_hallucinated_entities"),
        F.col("num_missed_entities").cast("bigint").alias("num_missed_entities"),
    )


@query
def entity_scores(spark, sf):
    rows, listed = stored(spark, sf, "short_outputs_long"), stored(spark, sf, "gazetteer")
    return flat_entities(entities.entity_scores(rows, listed, "summary"), "summary")


@query
def entity_scores_large_gazetteer(spark, sf):
    """The path for gazetteers too large to broadcast."""
    rows, listed = stored(spark, sf, "short_outputs_long"), stored(spark, sf, "gazetteer")
    columns = ["summary", "model_output"]
    tagged = entities.with_entities(rows, columns, listed, max_broadcast_bytes=0)
    return flat_entities(entities.entity_differences(tagged, *columns), "summary")


@query
def entity_scores_distinct(spark, sf):
    """Each distinct text tagged once, its set joined back by digest."""
    rows, listed = stored(spark, sf, "short_outputs_long"), stored(spark, sf, "gazetteer")
    return flat_entities(entities.entity_scores(rows, listed, "summary", distinct=True), "summary")


@query
def entity_scores_dialog(spark, sf):
    """Entities of the outputs against those of the whole dialogue."""
    rows, listed = stored(spark, sf, "short_outputs_long"), stored(spark, sf, "gazetteer")
    return flat_entities(entities.entity_scores(rows, listed, "dialog"), "dialog")


def evaluated(spark, sf) -> DataFrame:
    outputs, vectors = outputs_and_vectors(spark, sf)
    rows = filters.drop_missing(outputs, ["summary", "model_output"])
    return evaluation.evaluate_outputs(rows, stored(spark, sf, "gazetteer"), vectors)


@query
def evaluate_outputs(spark, sf):
    return evaluated(spark, sf).select(
        "dialog_id",
        "model",
        F.col("num_hallucinated_entities").cast("bigint").alias("num_hallucinated_entities"),
        F.col("num_missed_entities").cast("bigint").alias("num_missed_entities"),
        F.round("bert_f1", 5).alias("bert_f1"),
        F.round("rouge_l", 6).alias("rouge_l"),
    )


@query
def leaderboard(spark, sf):
    board = evaluation.leaderboard(
        evaluated(spark, sf), fx.ballots(spark, sf), fx.label_map(spark, sf)
    )
    return board.withColumns(
        {
            "mean_bert_f1": F.round("mean_bert_f1", 5),
            "mean_rouge_l": F.round("mean_rouge_l", 6),
        }
    )


@query
def build_training_set(spark, sf):
    rows = training.build_training_set(fx.raw(spark, sf))
    return rows.select(
        "dialog_id", "summary", "dialog", "system_prompt", "split", roles("messages"), contents("messages")
    )


def mixed(spark, sf) -> DataFrame:
    row_id = F.concat(F.lit("d:"), "dialog_id").alias("row_id")
    raw = fx.raw(spark, sf).select(row_id, "response")
    processed = training.build_training_set(raw, row_id="row_id")
    return training.mix_corpora(
        processed.select("row_id", "messages", "split"), fx.second_corpus(spark, sf)
    )


@query
def mix_corpora(spark, sf):
    return training.training_mix(mixed(spark, sf)).select("row_id", "text")


@query
def mix_corpora_eval(spark, sf):
    subset = training.evaluation_mix(mixed(spark, sf), rows=MIX_ROWS)
    return subset.select("row_id", "text")


@query
def prepare_eval_prompts(spark, sf):
    prompts = evaluation.prepare_eval_prompts(fx.tagged_documents(spark, sf))
    return prompts.select("row_id", "clean_dialog", roles("prompt"), contents("prompt"))
