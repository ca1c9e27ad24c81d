"""Mixing sources to target weights by temperature, with DataFrame functions only.

The weight of a source is its share of all words to the power of an exponent, normalised. The exponent is bisected: it is
the one whose weights have the target entropy, or the larger one that keeps the repetition of every source within the
limit. Weights are then realised within a budget of words: a source is read in blocks, each a permutation of all its
documents by a hash of its own, and the last block is cut where the source has its share of the budget.

Running sums inside a permutation are taken in two levels. A permutation is cut by its hash into parts of about
PART_ROWS documents, whatever share of all documents the source holds; parts are summed first.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogeval.functions.hashing import HASH_SPACE, hash_key
from dialogeval.sources import scratch

# Share of the largest possible entropy, and how often a document may be read on average.
ENTROPY_SHARE = 0.95
MAX_REPEATS = 4.0
MAX_EXPONENT = 16.0
SEED = "mix"
PART_ROWS = 4096
# Each job halves the interval of the exponent this many times.
HALVINGS, JOBS = 4, 10

_NO_SOURCE = "-"


def token_count(text: Column) -> Column:
    """Number of runs of other characters than white space; NULL has none."""
    pieces = F.split(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+")
    return F.size(F.array_remove(pieces, "")).cast("bigint")


def source_totals(docs: DataFrame) -> DataFrame:
    """(s, tokens, docs, text_key, ...) of the documents and of their sources are stored by the callers below."""
    named = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(_NO_SOURCE))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        named.alias("s"),
        token_count(F.col("text")).alias("n_tokens"),
        F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_key"),
    )


def find_exponent(sources: DataFrame, budget: float | None, entropy_share: float, max_repeats: float) -> tuple[float, float, float]:
    """Exponent, its normaliser and the budget for sources with `tokens`; every step is one aggregate over sources."""
    facts = sources.agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("n"), F.min("tokens"), F.max("tokens"))
    total, count, least, most = facts.first()
    if not count:
        return 1.0, 1.0, 0.0
    budget = float(total if budget is None else budget)
    target = entropy_share * log(count)
    share = F.col("tokens") / F.lit(float(total))

    def sums(points: list[float]) -> list[tuple[float, float]]:
        columns = [f(F.pow(share, F.lit(a))) for a in points for f in (F.sum, lambda x: F.sum(x * F.log(share)))]
        row = sources.agg(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
        return [(row[2 * i], row[2 * i + 1]) for i in range(len(points))]

    def too_flat(a: float, z: float, e: float) -> bool:
        """Is a larger exponent needed?"""
        entropy = log(z) - a * e / z
        repeats = max((x / total) ** (a - 1) for x in (least, most)) / z * budget / total
        # Weights beyond the shares themselves would only repeat the largest source.
        return entropy > target or (a < 1 and repeats > max_repeats)

    low, high = 0.0, MAX_EXPONENT
    if not too_flat(0.0, *sums([0.0])[0]):
        high = 0.0
    for _ in range(JOBS if high else 0):
        steps = 1 << HALVINGS
        points = [low + (high - low) * i / steps for i in range(1, steps)]
        values = sums(points)
        inside = [too_flat(a, z, e) for a, (z, e) in zip(points, values, strict=True)]
        a, b = 0, steps
        while b - a > 1:
            middle = (a + b) // 2
            a, b = (middle, b) if inside[middle - 1] else (a, middle)
        low, high = (points[a - 1] if a else low), (points[b - 1] if b < steps else high)
    exponent = round(high, 9)
    return exponent, sums([exponent])[0][0], budget


def mix_sources(
    docs: DataFrame,
    budget_tokens: float | None = None,
    entropy_share: float = ENTROPY_SHARE,
    max_repeats: float = MAX_REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """One row per reading of a document of `docs` (doc_id, text, source): block, position and the source's weight.

    The budget is the number of words of all documents if not given; tokens are words. `position`, from 0 to 1, orders the
    stream: at every point of it each source has had its weight's share, up to one document. A source exceeds its share
    of the budget by less than its last document. The repetition limit gives way where the budget itself exceeds it. NULL
    is a source of its own. Sources without words have no weight and are not read; documents without words are read
    with their neighbours. Repeated rows are documents of their own. No documents give no rows. Other columns are
    ignored.
    """
    base = scratch.through_table(source_totals(docs), "mix_documents")
    sources = base.groupBy("s").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    sources = scratch.through_table(sources.where("tokens > 0"), "mix_sources")
    exponent, norm, budget = find_exponent(sources, budget_tokens, entropy_share, max_repeats)
    total = F.lit(float(sources.agg(F.sum("tokens")).first()[0] or 1))
    weight = F.pow(F.col("tokens") / total, F.lit(exponent)) / F.lit(norm)
    plan = sources.withColumn("weight", F.round(weight, 12)).withColumn("quota", F.col("weight") * F.lit(budget))
    plan = plan.withColumn("last", F.floor(F.col("quota") / F.col("tokens")).cast("int"))
    plan = plan.withColumn("parts", F.ceil(F.col("docs") / PART_ROWS).cast("int"))
    plan = scratch.through_table(plan, "mix_plan")

    picks = base.join(plan, "s").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("last"))))
    key = hash_key(seed, F.col("block"), F.col("doc_id"), F.col("text_key"))
    picks = picks.withColumn("key", key)
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint") / F.lit(float(HASH_SPACE))
    picks = picks.withColumn("part", F.floor(place * F.col("parts")).cast("int"))
    part = ["s", "block", "part"]
    before = Window.partitionBy("s", "block").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = picks.groupBy(*part).agg(F.sum("n_tokens").alias("of_part"))
    parts = parts.withColumn("offset", F.sum("of_part").over(before) - F.col("of_part")).drop("of_part")
    parts = scratch.through_table(parts, "mix_parts")
    done = F.col("block") * F.col("tokens") + F.col("offset")
    picks = picks.join(parts, part).where(done < F.col("quota"))
    inside = Window.partitionBy(*part).orderBy("key", "doc_id", "text_key").rowsBetween(Window.unboundedPreceding, 0)
    picks = picks.withColumn("done", done + F.sum("n_tokens").over(inside) - F.col("n_tokens"))
    return picks.where("done < quota").select(
        "doc_id",
        "source",
        "n_tokens",
        "block",
        F.round(F.col("done") / F.col("quota"), 9).alias("position"),
        "weight",
    )
