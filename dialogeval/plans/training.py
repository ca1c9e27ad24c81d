"""Raw responses -> training tables; mixing of two corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dialogeval import constants as K
from dialogeval.operators import projections, reshape, sampling


def build_training_set(
    raw: DataFrame,
    seed: int = K.SHUFFLE_SEED,
    row_id: str = "dialog_id",
    test_fraction: float = K.TEST_FRACTION,
    exact: bool = True,
) -> DataFrame:
    """Clean, wrap in prompts, add messages and a split. One map stage from scan to write.

    The test split has exactly `ceil(test_fraction * n)` rows, whose bound is found from the ids alone beforehand. A
    stream has no count: with `exact` off each row decides by a threshold on its hash key.
    """
    columns = projections.dialog_summary_columns(raw)
    kept = projections.project_keep(columns, [row_id, *K.TRAINING_COLUMNS])
    rows = projections.add_messages(kept)
    if not exact:
        return sampling.train_test_split(rows, seed, row_id, test_fraction)
    bound = sampling.exact_bound(raw, seed, row_id, test_fraction)
    return sampling.split_before(rows, seed, row_id, bound)


def mix_corpora(processed: DataFrame, second: DataFrame) -> DataFrame:
    """Render both corpora and concatenate them; `split` stays a column. No shuffle."""
    first = processed if "text" in processed.columns else projections.render_chatml(processed)
    return reshape.concat_tables(first, projections.render_chatml(second))


def training_mix(mixed: DataFrame) -> DataFrame:
    return mixed.where("split = 'train'")


def evaluation_mix(
    mixed: DataFrame, seed: int = K.SHUFFLE_SEED, row_id: str = "row_id", rows: int = K.EVAL_SUBSET_ROWS
) -> DataFrame:
    """The first `rows` shuffled rows of both test splits."""
    return sampling.eval_subset([mixed.where("split = 'test'")], seed, row_id, rows)
