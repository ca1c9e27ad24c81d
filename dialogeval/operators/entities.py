"""Dictionary entity tagging and entity differences.

An entity occurs where a piece of the text that begins and ends at the edge of a word equals an entry of the
`(entity, type)` table; words are runs of letters and digits. So single words, acronyms, names in any script, and phrases
inside longer runs of capitals are found. The longest entry wins: an occurrence inside a longer one does not count. The
table stands where a neural tagger would stand and gives the same shape of result, a set of entity texts per text.

A table that fits is sent to every task, which makes a trie of its entries' pieces once and walks each text along it. A
larger one is joined: a Bloom filter of the entries, one 64-bit block an entry, drops nearly all runs of words that are no
entry before anything is shuffled. `Gazetteer` is such a table made ready; it can be kept for many calls.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogeval import constants as K
from dialogeval.operators.joins import fits, salted_join, whole_row
from dialogeval.operators.reshape import set_difference, set_or_empty, set_size
from dialogeval.sources import scratch

SPAN_PATTERN = "[A-Z][a-z]+(?: [A-Z][a-z]+)*"
# Words, and what stands between them.
PIECES = "[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+"
# A gazetteer up to this size is sent to every task.
MAX_BROADCAST_BYTES = 16 * 1024 * 1024
# The Bloom filter has a 64-bit block for so many entries, and at most so many blocks; beyond that it drops less.
ENTRIES_PER_BLOCK, MOST_BLOCKS = 4, 1 << 20
# Texts whose entities a task remembers: rows of one dialogue stand together and share its summary.
REMEMBERED_TEXTS, REMEMBERED_CHARS = 256, 1 << 16
# From so many rows a text on, distinct texts are tagged once and their sets joined back.
COPIES = 3.0


def candidate_spans(text: Column) -> Column:
    """Distinct runs of capitalised words."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(SPAN_PATTERN), F.lit(0)))


def pieces(text: Column) -> Column:
    """Words and what stands between them, alternating; together they are the text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECES), F.lit(0))


# A node of the trie maps a piece to the next node; this key holds the entry that ends at the node.
_ENTRY = None


def entity_trie(entries: Iterable[str]) -> dict:
    """Nested dictionaries of the pieces of all entries that begin and end with a word."""
    root: dict = {}
    for entry in entries:
        parts = re.findall(r"[^\W_]+|[\W_]+", entry)
        if len(parts) % 2 and parts[0][0].isalnum():
            node = root
            for part in parts:
                node = node.setdefault(part, {})
            node[_ENTRY] = entry
    return root


def find_entities(text: str, trie: dict) -> list[str]:
    """Sorted distinct entries that occur in a text, in one walk; the trie ends a step where no entry goes on."""
    if trie.keys().isdisjoint(re.findall(r"[^\W_]+", text)):
        return []
    parts = re.findall(r"[^\W_]+|[\W_]+", text)
    out, reach, count = set(), 0, len(parts)
    for i in range(0 if parts[0][0].isalnum() else 1, count, 2):
        node, at, name, end = trie.get(parts[i]), i + 1, None, 0
        while node is not None:
            if _ENTRY in node:
                name, end = node[_ENTRY], at
            if at == count:
                break
            node, at = node.get(parts[at]), at + 1
        # What lies inside an earlier entry ends no later than the furthest end so far.
        if end > reach:
            out.add(name)
            reach = end
    return sorted(out)


@dataclass(frozen=True)
class Gazetteer:
    """A gazetteer made ready: read, measured and indexed once, whatever number of texts or batches is tagged with it.

    `shared` holds the names if they fit and is sent to each executor once. Otherwise `listed` is a stored table of the
    entities, `blocks` its stored Bloom filter and `lengths` the numbers of pieces that entries have. `version` is a digest
    of the entries.
    """

    version: str
    shared: Any
    listed: DataFrame
    lengths: list[int]
    blocks: DataFrame | None
    block_count: int


def prepare(
    gazetteer: DataFrame, types: Sequence[str] = K.ENTITY_TYPES, max_broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> Gazetteer:
    """Read `(entity, type)` once; nothing that is tagged with the result reads it again."""
    listed = gazetteer.where(F.col("type").isin(*types)).select("entity").where("entity <> ''").distinct()
    listed = scratch.through_table(listed, "gazetteer")
    mark, count = listed.agg(F.sum(F.xxhash64("entity").cast("decimal(38,0)")), F.count(F.lit(1))).first()
    version = f"{count}:{mark or 0}"
    if fits(listed, F.octet_length("entity") + 64, max_broadcast_bytes):
        shared = gazetteer.sparkSession.sparkContext.broadcast([r["entity"] for r in listed.toLocalIterator()])
        return Gazetteer(version, shared, listed, [], None, 0)
    size = F.size(pieces(F.col("entity")))
    lengths = sorted(r["n"] for r in listed.select(size.alias("n")).distinct().collect() if r["n"] % 2)
    block_count = min(MOST_BLOCKS, max(1, -(-count // ENTRIES_PER_BLOCK)))
    block, mask = _bloom(F.col("entity"), block_count)
    blocks = listed.groupBy(block.alias("block")).agg(F.bit_or(mask).alias("bits"))
    return Gazetteer(version, None, listed, lengths, scratch.through_table(blocks, "entity_bits"), block_count)


def _bloom(entity: Column, blocks: int) -> tuple[Column, Column]:
    """Block of an entity, and its four bits in there."""
    high = F.xxhash64(F.lit(7), entity)
    places = [F.shiftrightunsigned(high, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(4)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), place) for place in places]
    mask = bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])
    return F.pmod(F.xxhash64(entity), F.lit(blocks).cast("bigint")), mask


def with_entities(
    df: DataFrame,
    columns: Sequence[str],
    gazetteer: DataFrame | Gazetteer,
    types: Sequence[str] = K.ENTITY_TYPES,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    distinct: bool | None = False,
) -> DataFrame:
    """Add a sorted set `entities_in_<column>` for each text column; a missing text has none.

    A table that is no `Gazetteer` yet is measured first. Up to the limit it goes to every task and each row is tagged where
    it is, without keys and without a shuffle; a task remembers the last texts. Beyond it the pieces of text are joined
    to it. With `distinct`, each distinct text of all columns is tagged once, and its set joined back by digest; None
    decides by the measured number of rows a text.
    """
    ready = gazetteer if isinstance(gazetteer, Gazetteer) else prepare(gazetteer, types, max_broadcast_bytes)
    if ready.shared is None:
        return _with_joined_entities(df, columns, ready)
    if distinct is None:
        distinct = copies_per_text(df, columns) >= COPIES
    if distinct:
        texts = F.explode(F.array(*[F.struct(_digest(c).alias("digest"), F.col(c).alias("text")) for c in columns])).alias("t")
        once = df.select(texts).select("t.digest", "t.text").where("text IS NOT NULL")
        # Copies collapse before the shuffle.
        once = once.groupBy("digest").agg(F.min("text").alias("text"))
        return _joined_back(df, columns, once.select("digest", _tagger(ready)(F.array("text"))[0].alias("names")))
    tagged = _tagger(ready)(F.array(*[F.col(c) for c in columns]))
    held = df.select(whole_row(df), tagged.alias("sets"))
    return held.select("row.*", *[F.col("sets")[k].alias(f"entities_in_{c}") for k, c in enumerate(columns)])


def _tagger(ready: Gazetteer):
    shared = ready.shared

    @F.pandas_udf("array<array<string>>")
    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        found = entity_finder(shared.value)
        for texts in batches:
            yield pd.Series([[found(t) for t in row] for row in texts], dtype=object)

    return tag


def entity_finder(entries: Iterable[str]):
    """A function from a text to its entities that keeps those of the last texts."""
    trie = entity_trie(entries)
    remembered = lru_cache(REMEMBERED_TEXTS)(lambda text: find_entities(text, trie))

    def found(text: str | None) -> list[str]:
        if not text:
            return []
        return remembered(text) if len(text) <= REMEMBERED_CHARS else find_entities(text, trie)

    return found


def copies_per_text(df: DataFrame, columns: Sequence[str]) -> float:
    """How many rows a distinct text has on average, about, over all columns."""
    texts = df.select(F.explode(F.array(*[F.xxhash64(c) for c in columns])).alias("h"))
    rows, different = texts.agg(F.count(F.lit(1)), F.approx_count_distinct("h", 0.02)).first()
    return rows / max(different, 1)


def _digest(column: str) -> Column:
    """128 bits of a text; NULL for a missing one."""
    return F.unhex(F.md5(F.col(column).cast("binary")))


def _joined_back(df: DataFrame, columns: Sequence[str], sets: DataFrame) -> DataFrame:
    """Put the sets (digest, names) of texts beside the rows. Both sides are read as stored, so that adaptive execution
    divides the rows of a frequent text."""
    sets = scratch.through_table(sets, "entity_sets")
    rows = df.select(whole_row(df), *[_digest(c).alias(f"digest_{k}") for k, c in enumerate(columns)])
    rows = scratch.through_table(rows, "tagged_rows")
    for k in range(len(columns)):
        side = sets.select(F.col("digest").alias(f"digest_{k}"), F.col("names").alias(f"names_{k}"))
        rows = rows.join(side, f"digest_{k}", "left")
    return rows.select(
        "row.*", *[set_or_empty(F.col(f"names_{k}")).alias(f"entities_in_{c}") for k, c in enumerate(columns)]
    )


def listed_runs(df: DataFrame, columns: Sequence[str], ready: Gazetteer) -> DataFrame:
    """(digest, i, j, entity): runs of pieces of the texts that are entries, and the few others that the filter lets through.

    Runs of equal texts are the same rows and collapse before they are shuffled; texts are not shuffled at all.
    """

    def runs(column: str) -> Column:
        parts = pieces(F.col(column))
        # Words are every other piece, so the places of two words differ by an even number.
        first = F.when(F.get(parts, F.lit(0)).rlike("^[\\p{L}\\p{N}]"), 0).otherwise(1)
        starts = F.filter(F.sequence(F.lit(0), F.size(parts)), lambda i: i % 2 == first)

        def at(i: Column) -> Column:
            ends = F.filter(F.array(*[F.lit(n) for n in ready.lengths]), lambda n: i + n <= F.size(parts))
            return F.transform(
                ends,
                lambda n: F.struct(
                    i.alias("i"), (i + n).alias("j"), F.array_join(F.slice(parts, i + 1, n), "").alias("entity")
                ),
            )

        return F.flatten(F.transform(starts, at))

    both = F.explode(F.array(*[F.struct(_digest(c).alias("digest"), runs(c).alias("runs")) for c in columns])).alias("t")
    spans = df.select(both).select("t.digest", F.explode("t.runs").alias("run")).select("digest", "run.*")
    block, mask = _bloom(F.col("entity"), ready.block_count)
    spans = spans.withColumns({"block": block, "mask": mask}).join(F.broadcast(ready.blocks), "block")
    spans = spans.where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    return spans.select("digest", "i", "j", "entity").distinct()


def _with_joined_entities(df: DataFrame, columns: Sequence[str], ready: Gazetteer) -> DataFrame:
    """Runs of pieces meet the table, those that many texts share with salts; then the longest of each text are taken in one
    sweep by place, and the sets go back to the rows of each text."""
    if not ready.lengths:
        empty = F.array().cast("array<string>")
        return df.withColumns({f"entities_in_{c}": empty for c in columns})
    # Both sides of the join and the search for frequent runs read them.
    spans = scratch.through_table(listed_runs(df, columns, ready), "runs")
    found = salted_join(spans, ready.listed, "entity", ["digest", "i"])
    sweep = Window.partitionBy("digest").orderBy("i", F.desc("j")).rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("j").over(sweep), F.lit(0))
    longest = found.withColumn("reach", reach).where("j > reach")
    sets = longest.groupBy("digest").agg(F.array_sort(F.collect_set("entity")).alias("names"))
    return _joined_back(df, columns, sets)


def extract_entities(
    texts: DataFrame,
    gazetteer: DataFrame | Gazetteer,
    column: str = "text",
    types: Sequence[str] = K.ENTITY_TYPES,
) -> DataFrame:
    """One row per distinct text: `(text, entities)`, the set empty if nothing is found. Copies collapse in the map tasks."""
    distinct = texts.select(column).where(F.col(column).isNotNull()).distinct()
    found = with_entities(distinct, [column], gazetteer, types)
    return found.withColumnRenamed(f"entities_in_{column}", "entities")


def entity_differences(df: DataFrame, input_col: str, output_col: str) -> DataFrame:
    """Hallucinated = in the output only; missed = in the input only; and their counts."""
    given, said = F.col(f"entities_in_{input_col}"), F.col(f"entities_in_{output_col}")
    return df.withColumns(
        {"hallucinated_entities": set_difference(said, given), "missed_entities": set_difference(given, said)}
    ).withColumns(
        {
            "num_missed_entities": set_size(F.col("missed_entities")),
            "num_hallucinated_entities": set_size(F.col("hallucinated_entities")),
        }
    )


def entity_scores(
    df: DataFrame,
    gazetteer: DataFrame | Gazetteer,
    input_col: str = "summary",
    output_col: str = "model_output",
    types: Sequence[str] = K.ENTITY_TYPES,
    distinct: bool | None = False,
) -> DataFrame:
    """Add the entity sets of both texts, their differences and counts; `distinct` as in `with_entities`."""
    tagged = with_entities(df, [input_col, output_col], gazetteer, types, distinct=distinct)
    return entity_differences(tagged, input_col, output_col)
