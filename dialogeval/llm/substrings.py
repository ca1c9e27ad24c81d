"""Removal of repeated lines and sentences.

Units are lines, and inside of lines the sentences; a short sentence makes a unit with as many of the next ones of its line
as it takes to be long enough, so that passages of short sentences are found wherever they stand. A unit is normalised to
its words (A-Z lower-cased, white space dropped) and hashed to 128 bits, whatever kind of unit it is. The digests are grouped
over all documents; the occurrence in the document of the smallest id, the first one there, stays, and every other one
that does not overlap it is removed. What stays keeps its offsets in the original.

Only digests travel: documents that repeat a unit are found by one aggregate that keeps the smallest id, so a line
that a third of all documents share is one row per task; its join back is one of two stored tables, which adaptive
execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogeval.llm import batches
from dialogeval.sources import scratch

# Shorter units repeat by chance or by grammar and stay.
LINE_WORDS = 3
SENTENCE_WORDS = 10

_UNITS = "high bigint, low bigint, doc_id bigint, text_key bigint, start int, end int, again boolean"
SCHEMA = (
    "doc_id bigint, text string, n_chars bigint, n_removed bigint, removed array<struct<start:int,end:int>>,"
    " kept array<struct<start:int,end:int>>"
)


def _units(line_words: int, sentence_words: int):
    def units(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = batches.white_space_table()
        for batch in stream:
            for lo, hi, data, offsets in batches.slices(batch.column(1)):
                found = batches.words(data, offsets, table)
                lines = batches.lines(data, offsets, found)
                count = len(found.start)
                chars = batches.char_positions(data)
                begins, stops, lows, highs = [], [], [], []
                begin = np.flatnonzero(lines.new)
                stop = np.append(begin[1:], count)[: len(begin)]
                keep = stop - begin >= line_words
                begins.append(begin[keep])
                stops.append(stop[keep])
                lows.append(lines.low[begin[keep]])
                highs.append(lines.high[begin[keep]])
                first = np.flatnonzero(lines.sentence)
                # The first end of a sentence that is far enough, if the line goes on so long.
                bound = np.append(first, count)
                far = np.minimum(np.searchsorted(bound, first + sentence_words), len(bound) - 1)
                last = np.maximum(bound[far], np.append(first[1:], count)[: len(first)])
                line_stop = np.append(begin[1:], count)[np.searchsorted(begin, first, side="right") - 1] if count else last
                ends_line = last == line_stop
                keep = (last - first >= sentence_words) & (last <= line_stop) & ~(lines.new[first] & ends_line)
                first, last, ends_line = first[keep], last[keep], ends_line[keep]
                begins.append(first)
                stops.append(last)
                lows.append(found.start[first])
                following = np.append(found.start, len(data))[last]
                highs.append(np.where(ends_line, found.end[last - 1] if count else last, following))
                begin, stop, low, high = (np.concatenate(x) for x in (begins, stops, lows, highs))
                row = np.searchsorted(found.first, begin, side="right") - 1
                one = batches.run_hashes(found.hashes, begin, stop, 11)
                two = batches.run_hashes(found.hashes, begin, stop, 23)
                # Occurrences behind the first of one document go whatever other documents hold.
                order = np.lexsort((begin, two, one, row))
                leads = np.ones(len(order), bool)
                a, b = order[1:], order[:-1]
                leads[1:] = (row[a] != row[b]) | (one[a] != one[b]) | (two[a] != two[b])
                leader = order[np.maximum.accumulate(np.where(leads, np.arange(len(order)), 0))] if len(order) else order
                again = np.zeros(len(order), bool)
                again[order] = begin[order] >= stop[leader]
                base = chars[offsets[row]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        batch.column(0).slice(lo, hi - lo).take(pa.array(row)),
                        batch.column(2).slice(lo, hi - lo).take(pa.array(row)),
                        pa.array((chars[low] - base).astype(np.int32)),
                        pa.array((chars[high] - base).astype(np.int32)),
                        pa.array(again),
                    ],
                    ["high", "low", "doc_id", "text_key", "start", "end", "again"],
                )

    return units


def _cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        rows = []
        for doc_id, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            text = text or ""
            removed, kept, at = [], [], 0
            for span in sorted(spans or (), key=lambda s: (s["start"], -s["end"])):
                if removed and span["start"] < removed[-1]["end"]:
                    removed[-1]["end"] = max(removed[-1]["end"], span["end"])
                else:
                    removed.append({"start": span["start"], "end": span["end"]})
            for span in [*removed, {"start": len(text), "end": len(text)}]:
                if span["start"] > at:
                    kept.append({"start": at, "end": span["start"]})
                at = max(at, span["end"])
            left = "".join(text[s["start"] : s["end"]] for s in kept) if removed else text
            rows.append((doc_id, left, len(left), len(removed), removed, kept))
        yield batches.record_batch(rows, SCHEMA)


def dedup_substrings(
    docs: DataFrame, line_words: int = LINE_WORDS, sentence_words: int = SENTENCE_WORDS
) -> DataFrame:
    """One row per row of `docs` (doc_id, text): the text that stays, and removed and kept spans in code points.

    Lines of fewer than `line_words` words stay, and so do sentences that are shorter than `sentence_words` together with
    all that follow in their line, unless an earlier unit holds them. A removed line takes its line feed along. NULL and
    empty texts stay empty. Rows of one id are one document if their texts are equal; if they differ, they rank alike and
    all keep what no smaller id holds. NULL ids rank last and likewise among each other. No documents give no rows. Other
    columns are ignored.
    """
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("text_key", F.xxhash64("text"))
    units = scratch.through_table(source.mapInArrow(_units(line_words, sentence_words), _UNITS), "units")
    rank = F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1))
    first = units.groupBy("high", "low").agg(F.min(rank).alias("first"), F.max(rank).alias("last"))
    first = scratch.through_table(first.where("first < last").drop("last"), "repeated")
    later = units.where("NOT again").join(first, ["high", "low"]).where(rank > F.col("first"))
    columns = ["doc_id", "text_key", "start", "end"]
    # All occurrences of a unit in a document go if another document comes first.
    spans = later.select(columns).unionByName(units.where("again").select(columns))
    spans = spans.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.text_key") == F.col("s.text_key"))
    joined = source.alias("d").join(spans.alias("s"), same, "left").select("d.doc_id", "d.text", "s.spans")
    return joined.mapInArrow(_cut, SCHEMA)
