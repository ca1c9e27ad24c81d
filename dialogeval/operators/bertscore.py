"""Greedy token matching on word vectors (the BERTScore formula on a vector table).

Every word of the output is matched to the most similar word of the reference (precision) and the other way
round (recall); F1 is their harmonic mean, without idf weights. Vectors come from a `(token, embedding)`
table, so this is the matching of BERTScore and not its contextual encoder. Words without a vector are left
out; a side without any known word scores 0.

A row never turns into word pairs: similarities of one row are a small matrix product inside an Arrow batch.

A vector table that fits goes to every worker. With a larger one, rows are worked on in blocks: each block fetches the
vector of each of its distinct words once, and its rows meet that store. So a word costs a vector once a block and not
once a row, and rows travel as words only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from dialogeval.functions import text
from dialogeval.operators.joins import salted_join, whole_row
from dialogeval.sources import scratch

# A vector table up to this size is shipped to the workers once; a larger one is joined.
MAX_BROADCAST_BYTES = 32 * 1024 * 1024
SCORES = ["bert_precision", "bert_recall", "bert_f1"]
RESULT = StructType([StructField(name, DoubleType()) for name in SCORES])
# Rows of the similarity matrix computed at a time; bounds memory for very long texts.
BLOCK = 1024
# The vectors of a block of rows take about so many bytes; a block has at most so many rows (a power of two).
STORE_BYTES, MOST_BLOCK_ROWS = 64 * 1024 * 1024, 4096


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Scale rows to length one; an all-zero row stays zero and is similar to nothing."""
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


def greedy_match(
    said: np.ndarray, said_count: np.ndarray, given: np.ndarray, given_count: np.ndarray
) -> tuple[float, float, float]:
    """Precision, recall, F1 from unit vectors of the distinct words and how often each occurs."""
    if not len(said) or not len(given):
        return 0.0, 0.0, 0.0
    best_said = np.empty(len(said))
    best_given = np.full(len(given), -np.inf)
    for start in range(0, len(said), BLOCK):
        similarity = said[start : start + BLOCK] @ given.T
        best_said[start : start + BLOCK] = similarity.max(axis=1)
        np.maximum(best_given, similarity.max(axis=0), out=best_given)
    precision = float(best_said @ said_count / said_count.sum())
    recall = float(best_given @ given_count / given_count.sum())
    total = precision + recall
    return precision, recall, 2 * precision * recall / total if total > 0 else 0.0


def bert_score(
    df: DataFrame,
    vectors: DataFrame,
    output_col: str = "model_output",
    reference_col: str = "summary",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Add `bert_precision`, `bert_recall`, `bert_f1`; NULL where a text is missing.

    The size of the vector table is measured first (one small aggregate). Up to `max_broadcast_bytes` its
    vectors go to the workers and scoring needs no shuffle; beyond it words are joined to their vectors. Rows need
    no key. A token listed several times has the smallest of its vectors; a vector with a NaN is none.
    """
    table = clean_vectors(vectors)
    size, width = table.agg(F.sum(vector_bytes().cast("bigint")), F.max(F.size("embedding"))).first()
    if max_broadcast_bytes > 0 and (size or 0) <= max_broadcast_bytes:
        return _score_with_shipped_vectors(df, table, output_col, reference_col)
    return _score_with_joined_vectors(df, table, width or 1, output_col, reference_col)


def clean_vectors(vectors: DataFrame) -> DataFrame:
    """One vector a token."""
    whole = F.col("token").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", F.isnan)
    return vectors.where(whole).groupBy("token").agg(F.min("embedding").alias("embedding"))


def vector_bytes() -> Column:
    return F.coalesce(F.size("embedding"), F.lit(0)) * 8 + F.octet_length("token") + 48


def ship_vectors(table: DataFrame):
    """Broadcast of the place of each token and the matrix of unit vectors; the caller has measured the table."""
    rows = table.select("token", "embedding").toPandas()
    matrix = np.array(rows["embedding"].tolist(), dtype="float64") if len(rows) else np.empty((0, 1))
    place = {token: i for i, token in enumerate(rows["token"])}
    return table.sparkSession.sparkContext.broadcast((place, unit_rows(matrix)))


def counted_places(words: str, place: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the distinct known words of a text, and how often each occurs."""
    counts = Counter(place[w] for w in words.split() if w in place)
    rows = np.fromiter(counts.keys(), dtype=np.int64, count=len(counts))
    return rows, np.fromiter(counts.values(), dtype=np.float64, count=len(counts))


def match_of(said: tuple[np.ndarray, np.ndarray], given: tuple[np.ndarray, np.ndarray], unit: np.ndarray):
    return greedy_match(unit[said[0]], said[1], unit[given[0]], given[1])


def _word_columns(output: Column, reference: Column) -> list[Column]:
    return [F.coalesce(text.words(c), F.lit("")) for c in (output, reference)]


def _scores(found: Column, output: Column, reference: Column) -> list[Column]:
    present = output.isNotNull() & reference.isNotNull()
    return [F.when(present, F.coalesce(found[n], F.lit(0.0))).alias(n) for n in SCORES]


def _score_with_shipped_vectors(df: DataFrame, table: DataFrame, output_col: str, reference_col: str) -> DataFrame:
    shipped = ship_vectors(table)

    @F.pandas_udf(RESULT)
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        place, unit = shipped.value
        for said, given in batches:
            rows = [match_of(counted_places(s, place), counted_places(g, place), unit) for s, g in zip(said, given)]
            yield pd.DataFrame(rows, columns=SCORES, dtype="float64")

    found = score(*_word_columns(F.col(output_col), F.col(reference_col))).alias("found")
    held = df.select(whole_row(df), found)
    sides = [F.col(f"row.`{c}`") for c in (output_col, reference_col)]
    return held.select("row.*", *_scores(F.col("found"), *sides))


def _score_block(key: tuple, rows: pa.Table, store: pa.Table) -> pa.Table:
    place = {token: i for i, token in enumerate(store["token"].to_pylist())}
    width = len(store["embedding"][0].values) if len(store) else 0
    flat = store["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False) if width else np.empty(0)
    unit = unit_rows(flat.reshape(-1, width).astype("float64")) if width else np.empty((0, 1))
    scores = [
        match_of(counted_places(s, place), counted_places(g, place), unit)
        for s, g in zip(rows["said"].to_pylist(), rows["given"].to_pylist())
    ]
    columns = list(zip(*scores)) if scores else [()] * len(SCORES)
    return pa.table([rows["number"], *[pa.array(c, pa.float64()) for c in columns]], names=["number", *SCORES])


def _score_with_joined_vectors(
    df: DataFrame, table: DataFrame, width: int, output_col: str, reference_col: str
) -> DataFrame:
    """Every row is stored with a number of its own, and all its columns beside it. The distinct words of a block meet the
    vector table; a word is at most once in a block, and one of all blocks is salted."""
    said, given = _word_columns(*[F.col(f"row.`{c}`") for c in (output_col, reference_col)])
    rows = scratch.through_table(df.select(F.monotonically_increasing_id().alias("number"), whole_row(df)), "scored_rows")
    split = F.array_distinct(F.concat(F.split(said, " "), F.split(given, " ")))
    words = rows.agg(F.avg(F.size(split))).first()[0] or 1.0
    most = STORE_BYTES / (8 * words * width)
    block = F.shiftright("number", max(0, min(int(most), MOST_BLOCK_ROWS).bit_length() - 1)).alias("block")

    tokens = rows.select(block, F.explode(split).alias("token")).where("token <> ''").distinct()
    store = salted_join(scratch.through_table(tokens, "block_words"), table, "token", ["block"])
    sides = rows.select(block, "number", said.alias("said"), given.alias("given"))
    schema = "number bigint, " + ", ".join(f"{n} double" for n in SCORES)
    scored = sides.groupBy("block").cogroup(store.select("block", "token", "embedding").groupBy("block"))
    scored = scored.applyInArrow(_score_block, schema).select("number", F.struct(*SCORES).alias("found"))
    sides = [F.col(f"row.`{c}`") for c in (output_col, reference_col)]
    return rows.join(scored, "number", "left").select("row.*", *_scores(F.col("found"), *sides))
