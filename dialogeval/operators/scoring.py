"""All scores of an output in one pass of Python: overlap, word-vector matching and entity sets.

The JVM normalises each text once; one Arrow function takes it and what is left to do. Outputs of one dialogue stand
together in most tables and share its reference: a task remembers the last references, stemmed, looked up and tagged, so
that k outputs cost them once. Rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogeval.functions import text
from dialogeval.functions.stem import scoring_stem
from dialogeval.operators.bertscore import SCORES, counted_places, match_of, ship_vectors
from dialogeval.operators.entities import Gazetteer, entity_finder
from dialogeval.operators.joins import whole_row
from dialogeval.operators.rouge import STEM_MEMORY, overlap_f

# Texts of which a task remembers the words, and the longest such text.
REMEMBERED_TEXTS, REMEMBERED_CHARS = 64, 1 << 16
RESULT = (
    "rouge_l double, bert_precision double, bert_recall double, bert_f1 double,"
    " given_entities array<string>, said_entities array<string>"
)


def score_outputs(
    df: DataFrame,
    gazetteer: Gazetteer,
    vectors: DataFrame,
    input_col: str,
    output_col: str,
    reference_col: str,
    stem: bool = True,
) -> DataFrame:
    """Add `rouge_l`, `bert_precision`, `bert_recall`, `bert_f1` and the entity sets of input and output.

    Scores are NULL where a text is missing; a missing text has no entities. The gazetteer must be one that is shared, and
    the vectors (one a token) must have been measured.
    """
    shipped, listed = ship_vectors(vectors), gazetteer.shared

    @F.pandas_udf(RESULT)
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        place, unit = shipped.value
        tagged = entity_finder(listed.value)
        stemmed = lru_cache(STEM_MEMORY)(scoring_stem) if stem else str

        def side(words: str) -> tuple:
            return [stemmed(w) for w in words.split()], counted_places(words, place)

        remembered = lru_cache(REMEMBERED_TEXTS)(side)
        for said, given, input_text, said_words, given_words in batches:
            rows = []
            for s, g, i, sw, gw in zip(said, given, input_text, said_words, given_words):
                scores = (None,) * 4
                if s is not None and g is not None:
                    predicted = side(sw)
                    expected = remembered(gw) if len(gw) <= REMEMBERED_CHARS else side(gw)
                    scores = (overlap_f(predicted[0], expected[0]), *match_of(predicted[1], expected[1], unit))
                rows.append((*scores, tagged(i), tagged(s)))
            yield pd.DataFrame(rows, columns=["rouge_l", *SCORES, "given_entities", "said_entities"])

    said, given = F.col(output_col), F.col(reference_col)
    found = score(said, given, F.col(input_col), text.words(said), text.words(given)).alias("found")
    held = df.select(whole_row(df), found)
    scores = [F.col(f"found.{n}").alias(n) for n in ("rouge_l", *SCORES)]
    sets = [F.col("found.given_entities").alias(f"entities_in_{input_col}"), F.col("found.said_entities").alias(f"entities_in_{output_col}")]
    return held.select("row.*", *scores, *sets)
