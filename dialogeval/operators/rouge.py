"""Longest-common-subsequence overlap of two texts (ROUGE-L).

Scoring is row-local: the JVM normalises both texts to blank-separated words, and one Arrow batch function
counts. No shuffle, so hot texts or models cannot skew it. The subsequence length is computed with bit
vectors (Hyyro 2004): one integer operation per word instead of a row of a table, which keeps whole long
texts affordable.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from dialogeval.functions import text
from dialogeval.functions.stem import scoring_stem


def common_subsequence_length(left: list[str], right: list[str]) -> int:
    """Length of the longest common subsequence; bit i of `row` is 0 once `left[i]` ends a longer one."""
    where: dict[str, int] = {}
    for i, word in enumerate(left):
        where[word] = where.get(word, 0) | 1 << i
    full = (1 << len(left)) - 1
    row = full
    for word in right:
        hits = row & where.get(word, 0)
        if hits:
            row = ((row + hits) | (row - hits)) & full
    return len(left) - row.bit_count()


def overlap_f(predicted: list[str], expected: list[str]) -> float:
    if not predicted or not expected:
        return 0.0
    common = common_subsequence_length(expected, predicted)
    if not common:
        return 0.0
    precision, recall = common / len(predicted), common / len(expected)
    return 2 * precision * recall / (precision + recall)


# Frequent words are stemmed once per task; the memory of a task stays bounded.
STEM_MEMORY = 1 << 16


@F.pandas_udf(DoubleType())
def _rouge_l_stemmed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    stem = lru_cache(maxsize=STEM_MEMORY)(scoring_stem)
    for predicted, expected in batches:
        scores = [
            overlap_f([stem(w) for w in p.split()], [stem(w) for w in e.split()])
            for p, e in zip(predicted, expected)
        ]
        yield pd.Series(scores, dtype="float64")


@F.pandas_udf(DoubleType())
def _rouge_l_plain(predicted: pd.Series, expected: pd.Series) -> pd.Series:
    scores = [overlap_f(p.split(), e.split()) for p, e in zip(predicted, expected)]
    return pd.Series(scores, dtype="float64")


@F.pandas_udf(StringType())
def _stem_words(words: pd.Series) -> pd.Series:
    return words.map(scoring_stem)


def rouge_l_column(predicted: Column, expected: Column, stem: bool = True) -> Column:
    """F-measure in [0, 1]; 0 if a side has no words, NULL if a text is missing."""
    score = _rouge_l_stemmed if stem else _rouge_l_plain
    empty = F.lit("")
    value = score(
        F.coalesce(text.words(predicted), empty), F.coalesce(text.words(expected), empty)
    )
    return F.when(predicted.isNotNull() & expected.isNotNull(), value)


def rouge_l(
    df: DataFrame, output_col: str = "model_output", reference_col: str = "summary", stem: bool = True
) -> DataFrame:
    """Add `rouge_l`."""
    return df.withColumn("rouge_l", rouge_l_column(F.col(output_col), F.col(reference_col), stem))


def stem_vocabulary(df: DataFrame, columns: list[str]) -> DataFrame:
    """`(token, stem)` of every distinct word; each word is stemmed once, however often it occurs."""
    split = [F.split(text.words(F.coalesce(F.col(c), F.lit(""))), " ") for c in columns]
    tokens = df.select(F.explode(F.concat(*split)).alias("token"))
    vocabulary = tokens.where("token <> ''").distinct()
    return vocabulary.withColumn("stem", _stem_words("token"))
