"""Prompts -> outputs -> scores -> leaderboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogeval import constants as K
from dialogeval.functions import chat, text
from dialogeval.operators import aggregates, bertscore, entities, filters, rouge, scoring
from dialogeval.operators.joins import fits


def prepare_eval_prompts(
    dialogs: DataFrame, dialogue: str = "dialogue", row_id: str = "row_id", first: int | None = None
) -> DataFrame:
    """Remove speaker tags, keep each dialogue once, build its prompt; `first` tries only a few.

    Missing dialogues get no prompt.
    """
    clean = dialogs.select(row_id, text.strip_speaker_tags(F.col(dialogue)).alias("clean_dialog"))
    clean = filters.drop_missing(clean, ["clean_dialog"])
    unique = filters.dedup_exact(clean, "clean_dialog", row_id)
    if first is not None:
        unique = filters.head_n(unique, first, [row_id])
    user = text.build_prompt_one_line(F.col("clean_dialog"))
    return unique.withColumn("prompt", chat.make_prompt(user, F.lit(K.SYSTEM_PROMPT)))


def evaluate_outputs(
    outputs: DataFrame,
    gazetteer: DataFrame | entities.Gazetteer,
    vectors: DataFrame,
    input_col: str = "summary",
    output_col: str = "model_output",
    reference_col: str = "summary",
    types: Sequence[str] = K.ENTITY_TYPES,
    stem: bool = True,
) -> DataFrame:
    """Entity differences, word-vector matching and subsequence overlap of each output.

    `input_col` is what entities are compared with (the summary, or the dialogue). Gazetteer and vectors are measured; if
    both fit, rows stay where they are and go through one Arrow function that makes all scores. Otherwise the table that
    does not fit is joined.
    """
    ready = gazetteer if isinstance(gazetteer, entities.Gazetteer) else entities.prepare(gazetteer, types)
    table = bertscore.clean_vectors(vectors)
    if ready.shared is not None and fits(table, bertscore.vector_bytes(), bertscore.MAX_BROADCAST_BYTES):
        scored = scoring.score_outputs(outputs, ready, table, input_col, output_col, reference_col, stem)
        return entities.entity_differences(scored, input_col, output_col)
    scored = rouge.rouge_l(outputs, output_col, reference_col, stem)
    scored = bertscore.bert_score(scored, vectors, output_col, reference_col)
    return entities.entity_scores(scored, ready, input_col, output_col, types)


def leaderboard(evaluated: DataFrame, votes: DataFrame, label_map: DataFrame) -> DataFrame:
    """One row per model: mean scores, entity totals, human wins. The scores are read once."""
    scores = evaluated.where(F.col("model").isNotNull()).groupBy("model").agg(
        *aggregates.score_means(["bert_f1", "rouge_l"]), *aggregates.entity_sums()
    )
    wins = aggregates.win_counts(votes, label_map).select("model", "wins")
    return scores.join(wins, "model", "left")
