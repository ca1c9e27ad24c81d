"""Inference jobs: held-out rows to a wide table, new dialogues to a long one."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogeval import constants as K
from dialogeval.functions import chat, text
from dialogeval.operators import generate, projections, reshape, sampling
from dialogeval.plans.evaluation import prepare_eval_prompts


def infer_holdout(
    processed: DataFrame,
    model_ids: Sequence[str],
    build: Callable[[str, dict], generate.Predictor],
    row_id: str,
    seed: int = K.SHUFFLE_SEED,
    used_rows: int = K.EVAL_SUBSET_ROWS,
    rows: int = K.HOLDOUT_ROWS,
    **settings,
) -> DataFrame:
    """Rows that training never looked at -> prompt without system message -> every model -> a column per model.

    The outputs come first among the columns that follow `row_id`, then the columns of `processed`.
    """
    held = sampling.holdout_slice(processed, seed, row_id, used_rows, rows)
    prompts = held.select(row_id, chat.make_prompt(F.col("dialog")).alias("model_input"))
    outputs = generate.batch_generate(prompts, model_ids, build, **settings)
    outputs = outputs.withColumn("model", text.model_short_name(F.col("model")))
    names = [m.split("/")[-1] for m in model_ids]
    wide = reshape.long_to_wide(outputs.select(row_id, "model", "model_output"), [row_id], names)
    columns = [f"{K.OUTPUT_COLUMN_PREFIX}{name}" for name in names]
    others = [c for c in processed.columns if c != row_id]
    return projections.reorder_columns(held.join(wide, row_id), [row_id, *columns, *others])


def infer_dialogs(
    dialogs: DataFrame,
    model_ids: Sequence[str],
    build: Callable[[str, dict], generate.Predictor],
    row_id: str,
    dialogue: str = "dialogue",
    first: int | None = None,
    **settings,
) -> DataFrame:
    """Dialogues without speaker tags, each once -> prompt with system message -> every model, as a long table."""
    prompts = prepare_eval_prompts(dialogs, dialogue, row_id, first)
    outputs = generate.batch_generate(prompts, model_ids, build, model_input="prompt", **settings)
    return outputs.withColumn("model", text.model_short_name(F.col("model")))
