"""Near duplicates by MinHash: many universal hash minima, bands, verified signatures, stars.

1. A document is the set of its distinct shingles; equal sets are one class. The signature of a set has, for each of
   `HASHES` universal hash functions (a * x + b modulo 2**64, the high bits), the smallest value over the set.
2. `ROWS` minima are a band, and sets that agree in a band share a bucket. A pair of similarity 0.85 shares no bucket with
   probability (1 - 0.85 ** 4) ** 32, about 5e-11.
3. In each bucket one set is the pivot and meets the others: pairs are never formed among all. A pair goes on if its
   signatures agree in as many minima as a link leaves room for, and is a link if its full sets say so.
4. Links give components by alternating large-star and small-star. Pairs inside a component need no test, so the bands
   join a few at a time: the first one ties most copies, and the buckets of the next ones that lie in one component go.
5. The buckets that still hold several components are cut into blocks of `BLOCK_SHINGLES`. A task takes the full sets of
   a block and asks for the links of those outside of its most common component, over inverted lists; it returns the links
   that join components, not pairs. Where a bucket has several blocks, the sets that are outside of the bucket's most
   common component after that are sent to its other blocks. So every pair of a bucket was tested or lies in one
   component, whatever the bucket's size.

What is common to a bucket is counted and chosen by aggregates that combine on the map side; joins are between stored
tables, whose frequent keys adaptive execution splits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogeval.llm import batches
from dialogeval.llm.components import CELL_BITS, cells_used
from dialogeval.sources import scratch

SHINGLE_WORDS = 5
PERCENT = 85
HASHES = 128
ROWS = 4
BANDS = HASHES // ROWS
# Bands that join in each round.
ROUNDS = (1, 3, BANDS - 4)
# Full sets that a task holds at a time have so many shingles, or are one set.
BLOCK_SHINGLES = 1 << 17
# Standard deviations below the expected agreement at which a pair of signatures is given up.
DEVIATIONS = 7.0

_SETS = "doc_id bigint, n_shingles bigint, digest binary, text_key bigint, signature binary"
_BUCKETS = "band int, key bigint, class bigint, size bigint"
_FOUND = "digest binary, shingles binary"


def _functions() -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands of the universal hash functions, from a fixed seed."""
    values = batches.mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return values[:HASHES] | np.uint64(1), values[HASHES:]


def _shingles(words: batches.Words) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of all rows, with repetitions, and where each row's begin."""
    grams = batches.grams(words.hashes, SHINGLE_WORDS)
    size = np.diff(words.first)
    count = np.where(size >= SHINGLE_WORDS, size - SHINGLE_WORDS + 1, np.minimum(size, 1))
    first = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(first[-1], np.uint64)
    long = size >= SHINGLE_WORDS
    take = np.repeat(words.first[:-1] - first[:-1], count) + np.arange(first[-1])
    whole = np.repeat(long, count)
    out[whole] = grams[take[whole]]
    for r in np.flatnonzero((size > 0) & ~long).tolist():
        a, b = words.first[r], words.first[r + 1]
        out[first[r]] = batches.grams(words.hashes[a:b], int(b - a))[0]
    return out, first


def _distinct(values: np.ndarray) -> np.ndarray:
    own = np.sort(values)
    keep = np.ones(len(own), bool)
    np.not_equal(own[1:], own[:-1], out=keep[1:])
    return own[keep]


def _digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def signatures(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(row, hash function) smallest hash of each row's values; rows must not be empty."""
    factors, summands = _functions()
    out = np.empty((len(first) - 1, HASHES), np.uint32)
    # Blocks of whole rows that fit the processor's cache.
    lo, hashed = 0, np.empty(0, np.uint64)
    while lo < len(first) - 1:
        hi = max(int(np.searchsorted(first, first[lo] + (1 << 15), side="right")) - 1, lo + 1)
        own, begins = values[first[lo] : first[hi]], first[lo:hi] - first[lo]
        if len(hashed) < len(own):
            hashed = np.empty(len(own), np.uint64)
        for k in range(HASHES):
            np.multiply(own, factors[k], out=hashed[: len(own)])
            np.add(hashed[: len(own)], summands[k], out=hashed[: len(own)])
            out[lo:hi, k] = np.minimum.reduceat(hashed[: len(own)], begins) >> np.uint64(32)
        lo = hi
    return out


def _sets(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every document; the first one of a set in the task carries the signature."""
    table, met = batches.white_space_table(), set()
    for batch in stream:
        for lo, hi, data, offsets in batches.slices(batch.column(1)):
            values, first = _shingles(batches.words(data, offsets, table))
            sizes, digests, new = [], [], []
            for r in range(hi - lo):
                own = _distinct(values[first[r] : first[r + 1]])
                digest = _digest(own)
                sizes.append(len(own))
                digests.append(digest)
                if len(own) and digest not in met:
                    met.add(digest)
                    new.append(r)
            signed: list[bytes | None] = [None] * (hi - lo)
            if new:
                many = np.diff(first)[new]
                begin = np.cumsum(many) - many
                take = np.arange(many.sum()) + np.repeat(first[new] - begin, many)
                for r, signature in zip(new, signatures(values[take], np.append(begin, many.sum())), strict=True):
                    signed[r] = signature.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, hi - lo),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    batch.column(2).slice(lo, hi - lo),
                    pa.array(signed, pa.binary()),
                ],
                ["doc_id", "n_shingles", "digest", "text_key", "signature"],
            )


def _banded(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (class, size, signature) to one row for each band."""
    for batch in stream:
        n = len(batch)
        minima = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(n, BANDS, ROWS)
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (n, BANDS))
        for j in range(ROWS):
            key = batches.mix(key * np.uint64(0x9E3779B97F4A7C15) + minima[:, :, j])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.tile(np.arange(BANDS, dtype=np.int32), n)),
                pa.array(key.reshape(-1).view(np.int64)),
                pa.array(np.repeat(batch.column(0).to_numpy(), BANDS)),
                pa.array(np.repeat(batch.column(1).to_numpy(), BANDS)),
            ],
            ["band", "key", "class", "size"],
        )


def _fetcher(shared):
    """Rows (text, text_key) of wanted texts to their digests and sets, once a task."""

    def fetch(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, table, met = shared.value, batches.white_space_table(), set()
        for batch in stream:
            keys = batch.column(1).to_numpy().view(np.uint64) >> np.uint64(64 - CELL_BITS)
            some = batch.column(0).filter(pa.array(wanted[keys.astype(np.int64)]))
            for _, _, data, offsets in batches.slices(some):
                values, first = _shingles(batches.words(data, offsets, table))
                rows = []
                for r in range(len(first) - 1):
                    own = _distinct(values[first[r] : first[r + 1]])
                    if len(own) and (digest := _digest(own)) not in met:
                        met.add(digest)
                        rows.append((digest, own.tobytes()))
                if rows:
                    yield batches.record_batch(rows, _FOUND)

    return fetch


def least_agreement(percent: int = PERCENT) -> int:
    """Equal minima of two signatures that a linked pair has but for chance of one in 10**11."""
    share = percent / 100
    return int(HASHES * share - DEVIATIONS * (HASHES * share * (1 - share)) ** 0.5)


def _agreeing(least: int):
    def agree(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("one", "two")
            )
            yield batch.select(["a", "b"]).filter(pa.array((one == two).sum(axis=1) >= least))

    return agree


def _linked(percent: int):
    def linked(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            keep = []
            for one, two in zip(batch.column("one"), batch.column("two"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (one, two))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return linked


def _with_both(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """Rows (a, b, one, two): the value of each end."""
    one = values.select(F.col("class").alias("a"), F.col(column).alias("one"))
    two = values.select(F.col("class").alias("b"), F.col(column).alias("two"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour or itself."""
    both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return both.where("v > u").join(low, "u").selectExpr("v AS u", "low AS v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is tied to the smallest of them."""
    down = edges.selectExpr("greatest(u, v) AS u", "least(u, v) AS v")
    low = down.groupBy("u").agg(F.min("v").alias("low"))
    tied = down.join(low, "u").where("v <> low").selectExpr("v AS u", "low AS v")
    return tied.unionByName(low.selectExpr("u", "low AS v")).distinct()


def star_components(edges: DataFrame) -> DataFrame:
    """(class, label) of every node in `edges` (u, v) that is not the smallest of its component.

    Alternates large-star and small-star until the edges are stars and stay.
    """
    edges = scratch.through_table(edges.where("u <> v"), "edges")
    seen = None
    while True:
        edges = scratch.through_table(large_star(edges), "large")
        edges = scratch.through_table(small_star(edges), "small")
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            return edges.selectExpr("u AS class", "v AS label")
        seen = tuple(mark)


def _members(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Buckets with the component of each set."""
    if labels is None:
        return buckets.withColumn("label", F.col("class"))
    return buckets.join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))


def _open(members: DataFrame) -> DataFrame:
    """(band, key, common) of the buckets that hold several components: the most frequent one, the smallest of several."""
    sizes = members.groupBy("band", "key", "label").agg(F.count(F.lit(1)).alias("sets"))
    first = F.min(F.struct(-F.col("sets"), "label").alias("m"))["label"]
    return sizes.groupBy("band", "key").agg(F.count(F.lit(1)).alias("labels"), first.alias("common")).where("labels > 1").drop("labels")


def _forest_links(names: list[int], labels: list[int], sets: list[np.ndarray], asks: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (a, b) that join all labels which links of the asking sets join."""
    _, label = np.unique(labels, return_inverse=True)
    sizes = np.array([len(x) for x in sets])
    _, element = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)[np.argsort(element, kind="stable")]
    starts = np.concatenate([[0], np.cumsum(np.bincount(element))])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    found = []
    # Links inside the most common component are of no use, so only the others ask.
    common = np.bincount(label).argmax()
    for x in np.flatnonzero(asks & (label != common)).tolist():
        own = element[bounds[x] : bounds[x + 1]]
        lengths = starts[own + 1] - starts[own]
        at = np.repeat(starts[own] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        shared = np.bincount(owner[at], minlength=len(sets))
        linked = np.flatnonzero((100 * shared >= percent * (sizes[x] + sizes - shared)) & (label != label[x]))
        for y in linked.tolist():
            if label[y] != label[x]:
                found.append((names[x], names[y]))
                label[label == label[x]] = label[y]
    return found


def _block_linker(percent: int):
    """Rows (unit, class, label, asks, shingles), sorted by unit, to links (a, b)."""

    def links(unit: list) -> Iterator[pa.RecordBatch]:
        names, labels, asks, packed = zip(*unit, strict=True)
        if len(set(labels)) > 1:
            sets = [np.frombuffer(p, np.uint64) for p in packed]
            found = _forest_links(names, labels, sets, np.array(asks), percent)
            if found:
                yield batches.record_batch(found, "a bigint, b bigint")

    def link(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, unit = None, []
        for batch in stream:
            for name, *row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if name != at and unit:
                    yield from links(unit)
                    unit = []
                at = name
                unit.append(row)
        if unit:
            yield from links(unit)

    return link


def _unit_links(units: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) inside the units of rows (unit, class, label, asks)."""
    rows = units.join(sets, "class").select("unit", "class", "label", "asks", "shingles")
    found = rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(_block_linker(percent), "a bigint, b bigint")
    return scratch.through_table(found.selectExpr("a AS u", "b AS v"), "links")


def _further(labels: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """Labels after more links (u, v)."""
    if not links.limit(1).count():
        return labels
    return star_components(links if labels is None else links.unionByName(labels.selectExpr("class AS u", "label AS v")))


def _in_blocks(left: DataFrame, labels: DataFrame | None, sets: DataFrame, percent: int, block_shingles: int) -> DataFrame | None:
    """Labels after the links of all pairs in the buckets `left` (band, key, class, size)."""
    unit = F.xxhash64("band", "key", "block").alias("unit")
    members = scratch.through_table(_members(left, labels), "members")
    sizes = members.groupBy("band", "key").agg(F.ceil(F.sum("size") / block_shingles).cast("int").alias("blocks"))
    sizes = sizes.join(_open(members), ["band", "key"]).select("band", "key", "blocks")
    members = members.join(scratch.through_table(sizes, "open"), ["band", "key"])
    members = members.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    members = scratch.through_table(members, "blocks")
    if not members.limit(1).count():
        return labels
    labels = _further(labels, _unit_links(members.select(unit, "class", "label", F.lit(True).alias("asks")), sets, percent))

    members = scratch.through_table(_members(members.where("blocks > 1").drop("label"), labels), "members")
    members = scratch.through_table(members.join(_open(members), ["band", "key"]), "open")
    if not members.limit(1).count():
        return labels
    asking = members.where("label <> common")
    parts = asking.groupBy("band", "key").agg(F.ceil(F.sum("size") / block_shingles).cast("int").alias("parts"))
    parts = scratch.through_table(parts, "parts")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    part = F.pmod(F.xxhash64("class", F.lit(1)), F.col("parts")).cast("int")
    columns = ["band", "key", "class", "label"]
    sent = asking.join(parts, ["band", "key"]).select(*columns, other, part.alias("part"), F.lit(True).alias("asks"))
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    there = members.join(parts, ["band", "key"]).select(*columns, "block", part, F.lit(False).alias("asks"))
    # A set that asks in its own block is there twice, under one label.
    units = sent.unionByName(there).select(F.xxhash64("band", "key", "block", "part").alias("unit"), "class", "label", "asks")
    return _further(labels, _unit_links(units, sets, percent))


def _link_rounds(
    buckets: DataFrame, signed: DataFrame, sets: DataFrame, percent: int, block_shingles: int
) -> DataFrame | None:
    """Labels (class, label) of all sets that link, from all buckets (band, key, class, size); None if none does."""
    labels, done, left, least = None, 0, None, least_agreement(percent)
    for count in ROUNDS:
        fresh = buckets.where(F.col("band").between(done, done + count - 1))
        done += count
        left = fresh if left is None else left.unionByName(fresh)
        members = scratch.through_table(_members(left, labels), "members")
        outside = members.join(scratch.through_table(_open(members), "open"), ["band", "key"])
        outside = scratch.through_table(outside, "outside")
        # Two sets of the most common component need no test, so the pivot comes from outside of it.
        chosen = outside.where("label <> common").groupBy("band", "key")
        chosen = chosen.agg(F.min(F.struct(F.xxhash64("class", "key").alias("h"), "class", "size", "label")).alias("p"))
        chosen = chosen.select(
            "band", "key", F.col("p.class").alias("pivot"), F.col("p.size").alias("p_size"), F.col("p.label").alias("p_label")
        )
        chosen = scratch.through_table(chosen, "pivots")
        met = scratch.through_table(outside.join(chosen, ["band", "key"]), "met")
        near = F.least("size", "p_size") * 100 >= F.greatest("size", "p_size") * percent
        pairs = met.where((F.col("label") != F.col("p_label")) & near)
        pairs = pairs.select(F.least("class", "pivot").alias("a"), F.greatest("class", "pivot").alias("b")).distinct()
        pairs = scratch.through_table(pairs, "pairs")
        alike = _with_both(pairs, signed, "signature").mapInArrow(_agreeing(least), "a bigint, b bigint")
        alike = scratch.through_table(alike, "alike")
        links = _with_both(alike, sets, "shingles").mapInArrow(_linked(percent), "a bigint, b bigint")
        labels = _further(labels, scratch.through_table(links.selectExpr("a AS u", "b AS v"), "links"))
        # The pivot has met everybody.
        left = met.where("class <> pivot").select("band", "key", "class", "size")
    return _in_blocks(left, labels, sets, percent, block_shingles)


def minhash_components(docs: DataFrame, percent: int = PERCENT, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per row of `docs` (doc_id, text): `n_shingles`, `component_id`, `kept` and `class` (digest of the set, hex).

    Sets whose intersection is at least `percent` percent of their union link. A text of fewer than five words is its only
    shingle; NULL and wordless texts have the empty set, link with nothing and are their own component. `component_id` is
    the smallest id that links reach; NULL ids keep their rows and are never the smallest, and a component without any
    other id is NULL. Rows whose id is the component's are kept, all of them if several rows have it. Repeated rows keep
    their rows. No documents give no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_key")
    )
    first = scratch.through_table(source.mapInArrow(_sets, _SETS), "sets")
    digest = F.lower(F.hex("digest")).alias("digest")
    signed = first.where("signature IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct("text_key", "n_shingles", "signature")).alias("s")
    )
    # Numbers instead of digests from here on; they are given once, as the table is written.
    signed = signed.select(
        F.monotonically_increasing_id().alias("class"), digest, F.col("s.text_key").alias("text_key"),
        F.col("s.n_shingles").alias("size"), F.col("s.signature").alias("signature"),
    )
    signed = scratch.through_table(signed, "classes")
    buckets = signed.select("class", "size", "signature").mapInArrow(_banded, _BUCKETS)
    buckets = scratch.through_table(buckets, "bands")
    shared = buckets.groupBy("band", "key").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1").select("band", "key")
    shared = scratch.through_table(shared, "shared")
    buckets = scratch.through_table(buckets.join(shared, ["band", "key"]), "buckets")
    several = scratch.through_table(buckets.select("class").distinct(), "several")

    wanted = scratch.through_table(signed.join(several, "class").select("class", "digest", "text_key", "signature"), "wanted")
    cells = spark.sparkContext.broadcast(cells_used(wanted, "text_key"))
    sets = source.select("text", "text_key").mapInArrow(_fetcher(cells), _FOUND).select(digest, "shingles")
    sets = sets.join(wanted.select("class", "digest"), "digest").groupBy("class").agg(F.first("shingles").alias("shingles"))
    sets = scratch.through_table(sets, "shingles")
    labels = _link_rounds(buckets, wanted.select("class", "signature"), sets, percent, block_shingles)

    placed = first.select("doc_id", "n_shingles", digest)
    if labels is None:
        placed = placed.withColumn("leader", F.col("digest"))
    else:
        leader = labels.join(signed.select("class", "digest"), "class")
        leader = leader.join(signed.select(F.col("class").alias("label"), F.col("digest").alias("leader")), "label")
        leader = scratch.through_table(leader.select("digest", "leader"), "leaders")
        placed = placed.join(leader, "digest", "left").withColumn("leader", F.coalesce("leader", "digest"))
    placed = scratch.through_table(placed, "placed")
    empty = F.col("n_shingles") == 0
    smallest = placed.where(~empty).groupBy("leader").agg(F.min("doc_id").alias("smallest"))
    smallest = scratch.through_table(smallest, "smallest")
    component: Column = F.when(empty, F.col("doc_id")).otherwise(F.col("smallest"))
    return placed.join(smallest, "leader", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.col("digest").alias("class"),
    )
