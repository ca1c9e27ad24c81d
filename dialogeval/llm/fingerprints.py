"""Document fingerprints by winnowing, with DataFrame functions only.

A text is a sequence of lower-cased words. Every run of GRAM words has a Karp-Rabin hash, a polynomial of the word hashes
modulo a prime; of every WINDOW neighbouring hashes the smallest is kept, the rightmost one if several are equal,
together with its position. Two texts that share a run of GRAM + WINDOW - 1 words share a kept hash inside it.

Hash and position are packed in one number whose order is that of the rule: hash first, then the later position. The
minimum of a window then takes as many steps as its size has binary digits, each a pass over neighbours.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogeval.sources import scratch

GRAM = 4
WINDOW = 8
PRIME = (1 << 31) - 1
BASE = 28_629_151

_SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_LAST = (1 << 32) - 1
# Stands for a NULL id in the order.
_BEFORE_ALL = Decimal(-(1 << 63) - 1)


def _least_with(step: int):
    """The smaller of an element and the one `step` further on."""
    return lambda x, i: F.least(x, F.get("_m", i + step))


def with_fingerprint(df: DataFrame, text: str, into: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Add `into`: array<bigint> of the kept grams of a string column, in order of their windows.

    NULL, empty and wordless texts have an empty array; a text of fewer than `gram` words is one gram. Texts with equal
    words have equal fingerprints.
    """
    factors = [pow(BASE, gram - 1 - j, PRIME) >> 2 for j in range(gram)]  # products of them fit 60 bits
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), _SEPARATORS), "")
    df = df.withColumn("_w", F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(PRIME)))
    count = F.size("_w")

    def packed(i: Column) -> Column:
        terms = [F.coalesce(F.get("_w", i + j), F.lit(0)) * factors[j] for j in range(gram)]
        value = terms[0]
        for term in terms[1:]:
            value = value + term
        return F.shiftleft(value % PRIME, 32) + (F.lit(_LAST) - i)

    starts = F.sequence(F.lit(0), F.greatest(count - gram, F.lit(0)))
    empty = F.array().cast("array<bigint>")
    df = df.withColumn("_m", F.when(count > 0, F.transform(starts, packed)).otherwise(empty))
    df = df.withColumn("_n", F.greatest(F.size("_m") - window + 1, F.lit(1)))
    width = 1
    while width < window:
        step = min(width, window - width)
        # `least` leaves out neighbours beyond the end.
        df = df.withColumn("_m", F.transform("_m", _least_with(step)))
        width += step
    return df.withColumn(into, F.array_distinct(F.slice("_m", 1, F.col("_n")))).drop("_w", "_m", "_n")


def gram_hashes(fingerprint: Column) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.array_distinct(F.transform(fingerprint, lambda v: F.shiftright(v, 32).cast("int")))


def as_text(fingerprint: Column) -> Column:
    """`hash:position` of every kept gram, joined by blanks; positions count words."""
    one = lambda v: F.concat_ws(":", F.shiftright(v, 32), F.lit(_LAST) - v.bitwiseAND(_LAST))
    return F.array_join(F.transform(fingerprint, one), " ")


def likeness(a: Column, b: Column) -> Column:
    """Shared share of two sets of hashes; two empty ones are equal."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


def _ring(ids: DataFrame) -> DataFrame:
    """(o, next) of every distinct id: the next smaller one, and the largest behind the smallest.

    Ids are sorted over all partitions and stored; neighbours are found inside each part, and across parts from one row
    a part.
    """
    parts = ids.repartitionByRange("o").sortWithinPartitions("o").withColumn("part", F.spark_partition_id())
    parts = scratch.through_table(parts, "ids")
    ends = parts.groupBy("part").agg(F.max("o").alias("o"))
    # One row for each partition of the sort.
    above = Window.orderBy("o").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("part", F.coalesce(F.lag("o").over(Window.orderBy("o")), F.max("o").over(above)).alias("edge"))
    below = F.lag("o").over(Window.partitionBy("part").orderBy("o"))
    return parts.withColumn("below", below).join(F.broadcast(ends), "part").select(
        "o", "n", F.coalesce("below", "edge").alias("next")
    )


def fingerprints_with_edits(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): fingerprints of the text and of its edited text, and likeness.

    The edited text has the last third of the code points, rounded down, replaced by as many of the first of the next
    document in descending `doc_id`, or by all it has; behind the last document comes the first. NULL texts are empty. A
    NULL id counts as the smallest. Rows of one id are followed by the same document, and the next document of an id
    with several rows is the one of the smallest text. No documents give no rows; a document alone follows itself.
    Other columns are ignored.
    """
    # One column for order and id, so that both readers of the shuffled texts need the same two columns and share it.
    order = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(_BEFORE_ALL).cast("decimal(20,0)"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = docs.select(order.alias("o"), text.alias("text"))
    ring = _ring(source.groupBy("o").agg(F.max(F.length("text")).alias("n")))
    # What the document `o` gives: so many code points, to the document `to`.
    gives = scratch.through_table(ring.select(F.col("next").alias("o"), F.col("o").alias("to"), "n"), "ring")

    placed = source.repartition("o")
    prefix = F.substring("text", F.lit(1), F.floor(F.col("n") / 3).cast("int"))
    given = with_fingerprint(placed.join(gives, "o"), "text", "own")
    given = given.select("to", prefix.alias("prefix"), gram_hashes(F.col("own")).alias("hashes"))
    given = given.repartition("to").groupBy("to").agg(F.min(F.struct("prefix", "hashes")).alias("next"))
    both = placed.join(given, F.col("o") == F.col("to")).withColumn("n_chars", F.length("text").cast("bigint"))
    kept = F.col("n_chars") - F.floor(F.col("n_chars") / 3)
    more = F.substring("next.prefix", F.lit(1), (F.col("n_chars") - kept).cast("int"))
    both = both.withColumn("edited", F.concat(F.substring("text", F.lit(1), kept.cast("int")), more))
    both = with_fingerprint(with_fingerprint(both, "text", "own"), "edited", "new")
    both = both.withColumn("own_hashes", gram_hashes(F.col("own"))).withColumn("new_hashes", gram_hashes(F.col("new")))
    doc_id = F.when(F.col("o") > F.lit(_BEFORE_ALL), F.col("o")).cast("bigint")
    return both.select(
        doc_id.alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("new")).alias("edited_fingerprint"),
        likeness(F.col("own_hashes"), F.col("new_hashes")).alias("near_edited"),
        likeness(F.col("own_hashes"), F.col("next.hashes")).alias("near_next"),
    )
