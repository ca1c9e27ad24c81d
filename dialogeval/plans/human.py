"""Tables people read: the blind evaluation sheet and the side-by-side view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from dialogeval import constants as K
from dialogeval.operators import projections, reshape, sampling


def human_eval_sheet(
    outputs: DataFrame,
    label_map: DataFrame,
    labels: Sequence[str],
    seed: int,
    rows: int = K.HUMAN_SAMPLE_ROWS,
    key: str = "dialog_id",
) -> DataFrame:
    """`key, dialog, summary, <label...>` for a random sample of dialogues, models hidden.

    The sample is a top-k over ids; only its rows are labelled and pivoted.
    """
    ids = outputs.select(key).distinct()
    sample = sampling.sample_n(ids, seed, key, rows)
    chosen = outputs.join(sample, key, "left_semi").join(label_map.select("model", "label"), "model")
    wide = reshape.long_to_wide(chosen, [key, "dialog", "summary"], labels, prefix="", model="label", key=[key])
    return projections.reorder_columns(wide, [key, "dialog", "summary", *labels])


def side_by_side(
    outputs: DataFrame,
    models: Sequence[str],
    seed: int,
    rows: int = K.READING_SAMPLE_ROWS,
    key: str = "dialog_id",
) -> DataFrame:
    """Dialogue, reference and every output of a few random dialogues."""
    sample = sampling.sample_n(outputs.select(key).distinct(), seed, key, rows)
    chosen = outputs.join(sample, key, "left_semi")
    return reshape.long_to_wide(chosen, [key, "dialog", "summary"], models, key=[key])
