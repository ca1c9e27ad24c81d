"""Benchmark decontamination by winnowing.

Every text is a sequence of lower-cased words. Of each run of `window` consecutive words the fingerprint keeps the
smallest hash of its k-grams (the rightmost one if several are equal), so two texts that share a run of `window`
words share a fingerprint of it. Training fingerprints are looked up among those of the benchmark, and each hit is
extended word by word in both directions; a shared run of at least `window` words is contamination. An item with
fewer words is one run of its own length and its own only k-gram.

A benchmark of at most `INDEX_WORDS` words is sent to the tasks, which index it once each; documents are not shuffled.
A larger one stays on Spark: its fingerprints are joined with those of blocks of documents on the hash, each block fetches
the items it shares a fingerprint with once, in parts of at most `INDEX_WORDS` words, and hits are extended behind the join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogeval.llm import batches
from dialogeval.operators.joins import whole_row
from dialogeval.sources import scratch

WINDOW = 10
GRAM = 5
# Words of benchmark items that a task indexes at a time: 8 bytes each, and about 24 more for their fingerprints.
INDEX_WORDS = 1 << 20
# Documents in a block of the joined path, as a power of two.
BLOCK_BITS = 8

SCHEMA = (
    "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean,"
    " items array<string>, spans array<struct<start:int,end:int>>"
)
_HITS = "number bigint, n_words bigint, items array<string>, words binary, starts binary, ends binary"


def _winnow(gram_hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest of every `window` neighbouring hashes, the rightmost of equal ones."""
    n = len(gram_hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best = np.arange(n)
    low = gram_hashes[:n]
    for j in range(1, window):
        other = gram_hashes[j : n + j]
        take = other <= low
        low = np.where(take, other, low)
        best = np.where(take, np.arange(j, n + j), best)
    return np.unique(best)


def _windows_of(length: int, window: int, gram: int) -> tuple[int, int]:
    """Gram length and number of grams in a window for runs of `length` words."""
    k = min(gram, length)
    return (k, window - k + 1) if length == window else (length, 1)


class Index:
    """Fingerprints of one group of benchmark items: for each run length, gram hash -> places in the items."""

    def __init__(self, items: list[tuple[str, str]], window: int, gram: int):
        table = batches.word_table()
        column = pa.array([text for _, text in items], pa.string())
        self.names = [name for name, _ in items]
        parts = [batches.words(data, offsets, table) for _, _, data, offsets in batches.slices(column)]
        counts = np.concatenate([np.diff(w.first) for w in parts]) if parts else np.zeros(0, np.int64)
        self.words = np.concatenate([w.hashes for w in parts]) if parts else np.zeros(0, np.uint64)
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.window, self.gram = window, gram
        self.lookup = {}
        runs = np.minimum(counts, window)
        for length in sorted({int(x) for x in runs} - {0}):
            k, of = _windows_of(length, window, gram)
            hashes, places, owners = [], [], []
            for i in np.flatnonzero(runs == length):
                grams = batches.grams(self.words[self.first[i] : self.first[i + 1]], k)
                at = _winnow(grams, of)
                hashes.append(grams[at])
                places.append(at + self.first[i])
                owners.append(np.full(len(at), i))
            hashes, places, owners = (np.concatenate(x) for x in (hashes, places, owners))
            order = np.argsort(hashes, kind="stable")
            self.lookup[length] = (hashes[order], places[order], owners[order])

    def scan(self, own: np.ndarray) -> tuple[np.ndarray, set[int]]:
        """Which words of one document lie in an occurring window, and the items whose windows occur."""
        hit, found = np.zeros(len(own) + 1, np.int64), set()
        for length, (hashes, places, owners) in self.lookup.items():
            if len(own) < length:
                continue
            k, of = _windows_of(length, self.window, self.gram)
            grams = batches.grams(own, k)
            at = _winnow(grams, of)
            left = np.searchsorted(hashes, grams[at], side="left")
            right = np.searchsorted(hashes, grams[at], side="right")
            # Extend each pair of equal grams; a pair on the diagonal of a run that is known brings nothing new.
            reached: dict[tuple[int, int], int] = {}
            for i in np.flatnonzero(right > left):
                here = int(at[i])
                for j in range(int(left[i]), int(right[i])):
                    there, item = int(places[j]), int(owners[j])
                    low, high = int(self.first[item]), int(self.first[item + 1])
                    if reached.get((item, there - here), -1) >= here + k:
                        continue
                    back = min(here, there - low)
                    same = own[here - back : here][::-1] == self.words[there - back : there][::-1]
                    back = back if same.all() else int(np.argmin(same))
                    ahead = min(len(own) - here, high - there)
                    same = own[here : here + ahead] == self.words[there : there + ahead]
                    ahead = ahead if same.all() else int(np.argmin(same))
                    reached[item, there - here] = here + ahead
                    if back + ahead >= length:
                        hit[here - back] += 1
                        hit[here + ahead] -= 1
                        found.add(item)
        return np.cumsum(hit)[:-1] > 0, found


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    steps = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def _hits(index: Index, numbers: pa.Array, texts: pa.Array, table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(number, text) to hits."""
    for lo, hi, data, offsets in batches.slices(texts):
        words = batches.words(data, offsets, table)
        rows = []
        for r in range(hi - lo):
            a, b = int(words.first[r]), int(words.first[r + 1])
            mask, found = index.scan(words.hashes[a:b])
            start = end = where = np.flatnonzero(mask)
            if len(where):
                begin, stop = offsets[r], offsets[r + 1]
                chars = batches.char_positions(data[begin:stop])
                start = chars[words.start[a:b][where] - begin]
                end = chars[words.end[a:b][where] - begin]
            names = sorted(index.names[i] for i in found)
            packed = [np.asarray(x, np.int64).tobytes() for x in (where, start, end)]
            rows.append((numbers[lo + r].as_py(), b - a, names, *packed))
        yield batches.record_batch(rows, _HITS)


def _scanner(shared, window: int, gram: int):
    """Batches of (number, text) to hits. `shared` holds the items, whose index each task builds once."""

    def scan(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, table = Index(shared.value, window, gram), batches.word_table()
        for batch in stream:
            yield from _hits(index, batch.column(0), batch.column(1), table)

    return scan


def _finish(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hits of one document, of any number of parts of the benchmark, to its row; its number stands for its id."""
    for batch in stream:
        rows = []
        for row in batch.to_pylist():
            names = sorted(set(row["items"] or ()))
            where, start, end = (np.frombuffer(row[c] or b"", np.int64) for c in ("words", "starts", "ends"))
            where, at = np.unique(where, return_index=True)
            spans = []
            if len(where):
                cuts = np.flatnonzero(np.diff(where) > 1)
                first, last = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(where) - 1]])
                spans = [{"start": int(start[at][a]), "end": int(end[at][b])} for a, b in zip(first, last, strict=True)]
            sha = hashlib.sha256(",".join(names).encode()).hexdigest()
            rows.append((row["number"], row["n_words"], len(where), len(names), sha, len(where) > 0, names, spans))
        yield batches.record_batch(rows, SCHEMA)


def _items(benchmark: DataFrame) -> DataFrame:
    """(item, text, size): all items with a text; no text has more than `size` words."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return items.where("item IS NOT NULL AND text IS NOT NULL").withColumn("size", F.floor(F.length("text") / 2) + 1)


def _shared_items(items: DataFrame, index_words: int):
    """Broadcast of all items if they fit, else None."""
    words = items.agg(F.sum("size")).first()[0] or 0
    if words > index_words:
        return None
    return items.sparkSession.sparkContext.broadcast([(r["item"], r["text"]) for r in items.collect()])


def _item_prints(window: int, gram: int):
    """(place, text) of items to (run, hash, place): the fingerprints, and the length of the runs that they stand for."""

    def prints(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for place, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for run, (hashes, _, _) in Index([("", text)], window, gram).lookup.items():
                    own = np.unique(hashes)
                    columns = [np.full(len(own), run, np.int32), own.view(np.int64), np.full(len(own), place)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["run", "hash", "place"])

    return prints


def _document_prints(runs: list[int], window: int, gram: int):
    """(block, text) to (run, hash, block): the fingerprints for runs of each of the lengths that items have."""

    def prints(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = batches.word_table()
        for batch in stream:
            for lo, hi, data, offsets in batches.slices(batch.column(1)):
                words, blocks = batches.words(data, offsets, table), batch.column(0).slice(lo, hi - lo).to_numpy()
                found: dict[tuple[int, int], list[np.ndarray]] = {}
                for r in range(hi - lo):
                    own = words.hashes[words.first[r] : words.first[r + 1]]
                    for run in runs:
                        if len(own) >= run:
                            k, of = _windows_of(run, window, gram)
                            grams = batches.grams(own, k)
                            found.setdefault((int(blocks[r]), run), []).append(grams[_winnow(grams, of)])
                for (block, run), hashes in found.items():
                    own = np.unique(np.concatenate(hashes))
                    columns = [np.full(len(own), run, np.int32), own.view(np.int64), np.full(len(own), block)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["run", "hash", "block"])

    return prints


def _block_scanner(window: int, gram: int):
    def scan(key: tuple, docs: pa.Table, items: pa.Table) -> pa.Table:
        table = batches.word_table()
        index = Index(list(zip(items["item"].to_pylist(), items["text"].to_pylist(), strict=True)), window, gram)
        docs = docs.combine_chunks()
        found = [b for part in docs.to_batches() for b in _hits(index, part["number"], part["text"], table)]
        some = pa.Table.from_batches(found, found[0].schema) if found else batches.record_batch([], _HITS)
        return pa.table(some)

    return scan


def _joined_hits(rows: DataFrame, items: DataFrame, window: int, gram: int, index_words: int) -> DataFrame:
    """Hits (number, items, words, starts, ends) of the documents `rows` (number, text) that share a fingerprint with items."""
    items = scratch.through_table(items.withColumn("place", F.monotonically_increasing_id()), "items")
    listed = items.select("place", "text").mapInArrow(_item_prints(window, gram), "run int, hash bigint, place bigint")
    listed = scratch.through_table(listed, "item_prints")
    runs = sorted(r["run"] for r in listed.select("run").distinct().collect())
    block = F.shiftright("number", BLOCK_BITS).alias("block")
    prints = rows.select(block, "text").mapInArrow(_document_prints(runs, window, gram), "run int, hash bigint, block bigint")
    # A fingerprint that many blocks have is a frequent key on one side only; adaptive execution divides it.
    prints = scratch.through_table(prints, "prints")
    pairs = scratch.through_table(prints.join(listed, ["run", "hash"]).select("block", "place").distinct(), "pairs")
    sizes = pairs.join(items.select("place", "size"), "place").groupBy("block")
    parts = scratch.through_table(sizes.agg(F.ceil(F.sum("size") / index_words).cast("int").alias("parts")), "parts")
    part = F.pmod(F.xxhash64("place"), F.col("parts")).cast("int").alias("part")
    fetched = pairs.join(parts, "block").select("block", "place", part).join(items, "place").select("block", "part", "item", "text")
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    there = rows.select("number", "text", block).join(parts, "block").select("block", part, "number", "text")
    found = there.groupBy("block", "part").cogroup(fetched.groupBy("block", "part"))
    found = found.applyInArrow(_block_scanner(window, gram), _HITS).where(F.size("items") > 0)
    return found.groupBy("number").agg(
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        *[F.unhex(F.array_join(F.collect_list(F.hex(c)), "")).alias(c) for c in ("words", "starts", "ends")],
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    index_words: int = INDEX_WORDS,
) -> DataFrame:
    """One row per row of `docs` (doc_id, text): words, words in occurring benchmark windows, items and spans.

    `spans` are the hit words as code points, neighbours united. NULL and wordless texts have no words and are
    clean; NULL `doc_id`s and repeated rows keep their rows; NULL items and items without words never occur; several
    items of one id count once. An empty benchmark leaves every document clean, no documents give no rows. Other
    columns are ignored.
    """
    source = docs.select(F.col("doc_id").cast("bigint").alias("number"), F.col("text").cast("string").alias("text"))
    items = _items(benchmark)
    shared = _shared_items(items, index_words)
    if shared is not None:
        # The id itself is the number that hits carry.
        return source.mapInArrow(_scanner(shared, window, gram), _HITS).mapInArrow(_finish, SCHEMA)
    rows = source.select(F.monotonically_increasing_id().alias("number"), F.col("number").alias("doc_id"), "text")
    rows = scratch.through_table(rows, "documents")
    found = _joined_hits(rows.select("number", "text"), items, window, gram, index_words)
    counted = rows.select("doc_id", "number", "text").mapInArrow(_counts, "doc_id bigint, number bigint, n_words bigint")
    joined = counted.join(found, "number", "left")
    return joined.select(F.col("doc_id").alias("number"), "n_words", "items", "words", "starts", "ends").mapInArrow(_finish, SCHEMA)


def _counts(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = batches.word_table()
    for batch in stream:
        for lo, hi, data, offsets in batches.slices(batch.column(2)):
            counts = pa.array(np.diff(batches.words(data, offsets, table).first), pa.int64())
            ids = [batch.column(k).slice(lo, hi - lo) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*ids, counts], ["doc_id", "number", "n_words"])


def keep_clean(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    index_words: int = INDEX_WORDS,
) -> DataFrame:
    """`docs` without the rows whose text holds a window of an item; columns unchanged.

    NULL and wordless texts stay, and so does everything if the benchmark is empty; repeated rows share one fate.
    """
    items = _items(benchmark)
    shared = _shared_items(items, index_words)
    if shared is None:
        rows = docs.select(F.monotonically_increasing_id().alias("number"), whole_row(docs))
        rows = scratch.through_table(rows, "documents")
        texts = rows.select("number", F.col("row.text").cast("string").alias("text"))
        found = _joined_hits(texts, items, window, gram, index_words).select("number")
        return rows.join(found, "number", "left_anti").select("row.*")

    @F.pandas_udf("boolean")
    def free(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, table = Index(shared.value, window, gram), batches.word_table()
        for texts in parts:
            column, out = pa.array(texts, pa.string(), from_pandas=True), []
            for _, _, data, offsets in batches.slices(column):
                words = batches.words(data, offsets, table)
                ends = zip(words.first[:-1], words.first[1:], strict=True)
                out += [not index.scan(words.hashes[a:b])[1] for a, b in ends]
            yield pd.Series(out, dtype=bool)

    return docs.where(free(F.col("text").cast("string")))
