"""Toxicity by cumulative-link ordinal regression on sparse word features.

P(grade >= k) = sigmoid(w . x - t_k) with one weight vector for all thresholds t_1 < t_2 < ... The features are the words
and beginnings of words (for languages that inflect) that labelled toxic and clean documents use at significantly
different rates. Labels say only toxic or not; toxic
documents are graded by the terciles of how many of these words they use, so that severity has an order to learn.
The output is the expected grade.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogeval.llm import batches
from dialogeval.sources import scratch

# Labelled documents of either class that the model is fitted on, chosen by hash of their id.
SAMPLE_PER_CLASS = 6_000
# Words kept as features, and the z-score of their two rates that is asked of them.
MAX_WORDS = 4_096
MIN_Z = 6.0
# Beginnings of so many code points are features beside the whole words.
PREFIXES = (4, 5)
GRADES = 3

SCHEMA = (
    "doc_id bigint, expected_severity double, p_toxic double, severity int, toxic boolean, grades array<double>, n_terms bigint"
)


class Model:
    """`words` sorted; weights per word; thresholds ascending, infinite if there is nothing to learn from."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.words, self.weights, self.thresholds = words, weights, thresholds

    def grades(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for every score and k."""
        p = 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -40, 40)))
        return np.where(np.isinf(self.thresholds), 0.0, p)


def _features(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words and beginnings of the rows of a slice, and where each row begins."""
    words = batches.words(data, offsets, table)
    kinds = [words.hashes, *(batches.mix(batches.prefixes(data, words, table, n) + np.uint64(n)) for n in PREFIXES)]
    return np.stack(kinds, 1).ravel(), words.first * len(kinds)


def _terms(own: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Places of the known words in `own`, each once."""
    if not len(known):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
    return np.unique(at[known[at] == own])


def _rate(data: np.ndarray, offsets: np.ndarray, model: Model, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(grade >= k) of every row of a slice, and the number of known features it has."""
    rows, (found, first) = len(offsets) - 1, _features(data, offsets, table)
    at, hit = np.zeros(len(found), np.int64), np.zeros(len(found), bool)
    if len(model.words):
        at = np.minimum(np.searchsorted(model.words, found), len(model.words) - 1)
        hit = model.words[at] == found
    where = np.flatnonzero(hit)
    row = np.searchsorted(first, where, side="right") - 1
    pairs = np.unique(np.stack([row, at[where]], 1), axis=0)
    p = model.grades(np.bincount(pairs[:, 0], model.weights[pairs[:, 1]], rows))
    return p, np.bincount(pairs[:, 0], minlength=rows)


def _distinct_words(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = batches.word_table()
    for batch in stream:
        for lo, hi, data, offsets in batches.slices(batch.column(1)):
            found, first = _features(data, offsets, table)
            sets = [np.unique(found[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = pa.array(np.concatenate(sets).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(ends), values)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lists], ["toxic", "words"])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample_per_class: int = SAMPLE_PER_CLASS,
    min_z: float = MIN_Z,
    max_words: int = MAX_WORDS,
) -> Model:
    """Fit on at most `sample_per_class` labelled documents of either class, with the `max_words` most telling features.

    Several labels of one document count as its highest; NULL labels and ids are left out. Without both classes nothing
    is toxic.
    """
    spark = docs.sparkSession
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), np.full(GRADES, np.inf))
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg((F.max("toxic") > 0).alias("toxic"))
    order = F.xxhash64("id", F.lit("toxicity")), F.col("id")
    some = [known.where(F.col("toxic") == t).orderBy(*order).limit(sample_per_class) for t in (F.lit(True), F.lit(False))]
    chosen = scratch.through_table(some[0].unionByName(some[1]), "labelled")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    sample = texts.select("toxic", "text").mapInArrow(_distinct_words, "toxic boolean, words array<bigint>")
    sample = scratch.through_table(sample, "sample")
    sizes = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(True, 0), sizes.get(False, 0)
    if not n1 or not n0:
        return nothing
    used = sample.select(F.explode("words").alias("word"), F.col("toxic").cast("int").alias("t"))
    used = used.groupBy("word").agg(F.sum("t").alias("in_toxic"), F.count(F.lit(1)).alias("in_all"))
    rate = F.col("in_all") / (n1 + n0)
    spread = F.sqrt(rate * (1 - rate) * (1 / n1 + 1 / n0) + 1e-12)
    z = (F.col("in_toxic") / n1 - (F.col("in_all") - F.col("in_toxic")) / n0) / spread
    best = used.where("in_all >= 3").select("word", z.alias("z")).where(F.abs("z") >= min_z)
    best = best.orderBy(F.desc(F.abs("z")), "word").limit(max_words).collect()
    if not best:
        return nothing
    pairs = sorted((row["word"] & 0xFFFFFFFFFFFFFFFF, row["z"] > 0) for row in best)
    words = np.array([w for w, _ in pairs], np.uint64)
    up = np.array([u for _, u in pairs])
    shared = spark.sparkContext.broadcast(words)

    def find(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            lists = batch.column(1)
            ends = lists.offsets.to_numpy()
            values = lists.values.to_numpy().view(np.uint64)
            rows = [_terms(values[a:b], shared.value).tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int32()))], ["toxic", "terms"])

    found = sample.mapInArrow(find, "toxic boolean, terms array<int>").groupBy("toxic", "terms").count().collect()
    found = sorted((row["terms"], row["toxic"], row["count"]) for row in found)
    terms = [np.array(t, np.int64) for t, _, _ in found]
    toxic = np.array([t for _, t, _ in found])
    weight = np.array([c for _, _, c in found], float)
    return _fit(words, terms, _grade(terms, toxic, weight, up), weight)


def _grade(terms: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, up: np.ndarray) -> np.ndarray:
    """0 for clean documents, 1 to GRADES for toxic ones by terciles of the number of their toxic words."""
    uses = np.array([up[t].sum() for t in terms])
    order = np.sort(np.repeat(uses[toxic], weight[toxic].astype(int)))
    cuts = [order[len(order) * k // GRADES] for k in range(1, GRADES)]
    return np.where(toxic, 1 + sum((uses > c).astype(int) for c in cuts), 0)


def _fit(words: np.ndarray, terms: list[np.ndarray], grade: np.ndarray, weight: np.ndarray) -> Model:
    """Maximum likelihood with a weak ridge, by gradient steps of adaptive size."""
    rows = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
    cols = np.concatenate(terms) if len(rows) else np.zeros(0, np.int64)
    total = weight.sum()
    w, gaps = np.zeros(len(words)), np.array([2.0, *[0.5] * (GRADES - 1)])
    slow = [np.zeros(len(words) + GRADES), np.zeros(len(words) + GRADES)]
    for step in range(1, 1501):
        t = np.cumsum(np.concatenate([gaps[:1], np.logaddexp(0, gaps[1:])]))
        score = np.bincount(rows, w[cols], len(terms))
        p = 1 / (1 + np.exp(-np.clip(score[:, None] - t[None, :], -40, 40)))
        upper = np.concatenate([np.ones((len(terms), 1)), p, np.zeros((len(terms), 1))], 1)
        prob = np.maximum(upper[np.arange(len(terms)), grade] - upper[np.arange(len(terms)), grade + 1], 1e-12)
        slope = np.concatenate([np.zeros((len(terms), 1)), p * (1 - p), np.zeros((len(terms), 1))], 1)
        high, low = slope[np.arange(len(terms)), grade], slope[np.arange(len(terms)), grade + 1]
        by_score = -weight * (high - low) / prob / total
        by_t = np.zeros(GRADES)
        for k in range(GRADES):
            by_t[k] = (weight * (np.where(grade == k + 1, high, 0) - np.where(grade == k, low, 0)) / prob).sum() / total
        by_gap = np.cumsum(by_t[::-1])[::-1].copy()
        by_gap[1:] *= 1 / (1 + np.exp(-gaps[1:]))
        grad = np.concatenate([np.bincount(cols, by_score[rows], len(words)) + 1e-5 * w, by_gap])
        slow[0] = 0.9 * slow[0] + 0.1 * grad
        slow[1] = 0.99 * slow[1] + 0.01 * grad**2
        move = 0.05 * (slow[0] / (1 - 0.9**step)) / (np.sqrt(slow[1] / (1 - 0.99**step)) + 1e-9)
        w, gaps = w - move[: len(words)], gaps - move[len(words) :]
    return Model(words, w, np.cumsum(np.concatenate([gaps[:1], np.logaddexp(0, gaps[1:])])))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of `docs` (doc_id, text): expected severity, P(toxic), likeliest grade, P(grade >= k).

    Texts that are NULL, empty or without known features get the grades of the thresholds alone. Repeated rows and NULL ids
    keep their rows; no documents give no rows. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.words, model.weights, model.thresholds))

    def rate(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, table = Model(*shared.value), batches.word_table()
        for batch in stream:
            for lo, hi, data, offsets in batches.slices(batch.column(1)):
                p, n_terms = _rate(data, offsets, model, table)
                exact = np.concatenate([1 - p[:, :1], p[:, :-1] - p[:, 1:], p[:, -1:]], 1)
                ends = pa.array(np.arange(0, (hi - lo + 1) * p.shape[1], p.shape[1]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(p.sum(1)),
                        pa.array(p[:, 0]),
                        pa.array(exact.argmax(1).astype(np.int32)),
                        pa.array(p[:, 0] >= 0.5),
                        pa.ListArray.from_arrays(ends, pa.array(p.ravel())),
                        pa.array(n_terms),
                    ],
                    ["doc_id", "expected_severity", "p_toxic", "severity", "toxic", "grades", "n_terms"],
                )

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(rate, SCHEMA)


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` without the rows that the model calls toxic, fitted on the labelled ones among them; columns unchanged.

    NULL and empty texts have no features and stay unless the thresholds alone say toxic; equal texts, repeated rows and
    ties share one fate. Without labels of both classes all rows stay; no documents give no rows.
    """
    model = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((model.words, model.weights, model.thresholds))

    @F.pandas_udf("boolean")
    def toxic(texts: pd.Series) -> pd.Series:
        model, table, column = Model(*shared.value), batches.word_table(), pa.array(texts, pa.string(), from_pandas=True)
        parts = [_rate(data, offsets, model, table)[0][:, 0] >= 0.5 for _, _, data, offsets in batches.slices(column)]
        return pd.Series(np.concatenate(parts) if parts else [], dtype=bool)

    return docs.where(~toxic(F.col("text").cast("string")))
