"""N-gram Jaccard join of documents: size-aware, light sets by subsets and heavy sets by inverted lists.

A document is the set of its distinct shingles. Two documents link when `100 * intersection >= 80 * union`; the result
is the component of every document under these links.

1. One pass writes size and digest of every set, and counts in a table of fixed size in how many sets each shingle
   occurs. Equal sets are one class from here on.
2. Sets of at most `boundary` shingles are light. Each emits, for every pair of sizes that it can be part of, the
   subsets that a partner would have to share: two light sets link exactly when they have such a subset in common. The
   boundary is where the sum of subsets over the sizes that occur becomes dearer than scanning lists.
3. Heavy sets are found by inverted lists: a set is listed under its first shingles in the order of their hashes, so many
   that it has at least `wanted(n)` of them in common with any partner. Light sets that can have a heavy partner are
   listed too. Shingles that no other set lists go, then sets with fewer than `wanted` left, then of each set the most
   frequent shingles, one fewer than `wanted`: what all pairs must share is still there, common passages are not.
   In each list, sorted by size, every set is tied to its predecessor if their sizes allow a link, so a list of m sets
   gives m - 1 ties and never pairs. Lists of frequent shingles are cut into salted parts.
4. Ties give candidate groups; links never leave a group. The sets of the groups are fetched once, and inside each
   group links are followed from set to set over inverted lists, until no unvisited set is left. Groups of more than
   `GROUP_SHINGLES` are cut into blocks by hash, twice in different ways; links inside blocks usually join the whole
   group, which is then done. Where they don't, the sets outside of the group's most common component are sent to its
   blocks; two sets inside of it need no test. Only if half of a group is outside is each pair of its blocks worked on,
   which is then the cheaper way to the same links.

Hashes have 64 bits, digests 128; ties and groups may contain too much, never too little.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialogeval.llm import batches
from dialogeval.llm.components import CELL_BITS, add_counts, cells_of, cells_used, components, count_batches, forest
from dialogeval.operators.joins import fits, whole_row
from dialogeval.sources import scratch

SHINGLE_WORDS = 5
PERCENT = 80
# No set beyond this size is ever light; the number of subsets grows fast.
MOST_LIGHT = 16
# Share of a set that its list entries must have in common with a partner's: more entries, fewer candidates.
COMMON_PERCENT = 10
# A table of candidate groups up to this size is sent to all tasks.
MAX_GROUP_BYTES = 16 << 20
# A candidate group beyond this many shingles is worked on in blocks.
GROUP_SHINGLES = 1 << 18
# A shingle found in more sets than this has its list cut into parts.
LIST_PART = 2048

_CLASSES = "doc_id bigint, n_shingles bigint, digest binary, class bigint, block int, counts binary"
_POSTINGS = "key bigint, class bigint, size int, salt int"
_SETS = "digest binary, class bigint, shingles binary"
_LINKS = "a string, b string"


def overlap_needed(a: int, b: int, percent: int = PERCENT) -> int:
    """Smallest intersection that links sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


def smallest_partner(n: int, percent: int = PERCENT) -> int:
    return -(-percent * n // 100)


def _shingle_sets(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of every row."""
    words = batches.words(data, offsets, table)
    grams = batches.grams(words.hashes, SHINGLE_WORDS)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= SHINGLE_WORDS:
            own = np.sort(grams[a : b - SHINGLE_WORDS + 1])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            yield own[keep]
        elif b > a:
            yield batches.grams(words.hashes[a:b], b - a)
        else:
            yield np.zeros(0, np.uint64)


def _digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _class(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _classes(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, table, met = np.zeros(1 << CELL_BITS, np.uint32), batches.white_space_table(), set()
    for batch in stream:
        for lo, hi, data, offsets in batches.slices(batch.column(1)):
            ids, sizes, digests, new = batch.column(0).slice(lo, hi - lo), [], [], []
            for own in _shingle_sets(data, offsets, table):
                digest = _digest(own)
                sizes.append(len(own))
                digests.append(digest)
                if digest not in met:
                    met.add(digest)
                    new.append(own)
            if new:
                counts += np.bincount(cells_of(np.concatenate(new)), minlength=len(counts)).astype(np.uint32)
            none = pa.nulls(hi - lo)
            columns = [ids, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())]
            columns += [pa.array([_class(d) for d in digests], pa.int64())]
            columns += [none.cast(pa.int32()), none.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "class", "block", "counts"])
    rows = [(None, None, None, None, *row) for row in count_batches(counts)]
    fields = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * 6
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, fields, strict=True)],
        ["doc_id", "n_shingles", "digest", "class", "block", "counts"],
    )


def _subset_cost(n: int) -> int:
    """Number of subsets that a light set of n shingles emits."""
    return sum(comb(n, overlap_needed(n, b)) for b in range(smallest_partner(n), n * 100 // PERCENT + 1))


def _common(n: int) -> int:
    return max(1, -(-COMMON_PERCENT * n // 100))


def _prefix(n: int) -> int:
    """Shingles under which a heavy set is listed."""
    return min(n, n - smallest_partner(n) + _common(n))


def wanted(n: int) -> int:
    """Listed shingles that a heavy set has in common with any partner."""
    return _common(smallest_partner(n))


def light_boundary(sizes: dict[int, int]) -> int:
    """Largest light size: light sets cost their subsets, heavy ones their lists and the set that is fetched."""
    best, at, total = 0, 0, 0
    for n in range(1, MOST_LIGHT + 1):
        total += sizes.get(n, 0) * (_subset_cost(n) - _prefix(n) - n)
        if total < best:
            best, at = total, n
    return at


def _list_parts(counts: np.ndarray) -> np.ndarray:
    """For each cell the parts that the lists of its shingles are cut into."""
    mean = counts.mean()
    excess = np.maximum(counts - (mean + 6 * np.sqrt(mean)), 0)
    return np.clip(np.ceil(excess / LIST_PART), 1, 1 << 12).astype(np.uint16)


def _poster(shared, boundary: int):
    def post(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, table, met = shared.value, batches.white_space_table(), set()
        listed_from = smallest_partner(boundary + 1)
        for batch in stream:
            for _, _, data, offsets in batches.slices(batch.column(0)):
                keys, owners, sizes, salts = [], [], [], []
                for own in _shingle_sets(data, offsets, table):
                    n = len(own)
                    if not n or (digest := _digest(own)) in met:
                        continue
                    met.add(digest)
                    name = _class(digest)
                    found, cut = [], []
                    if n <= boundary:
                        found.append(_subset_keys(own))
                        cut.append(np.zeros(len(found[0]), np.int32))
                    if n >= listed_from:
                        own = own[: _prefix(n)]
                        found.append(own)
                        many = parts[cells_of(own)].astype(np.int64)
                        cut.append(np.where(many > 1, 1 + (name & 0xFFFFFF) % many, 0).astype(np.int32))
                    size = sum(map(len, found))
                    keys += found
                    salts += cut
                    owners.append(np.full(size, name, np.int64))
                    sizes.append(np.full(size, n, np.int32))
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(keys).view(np.int64)),
                            pa.array(np.concatenate(owners)),
                            pa.array(np.concatenate(sizes)),
                            pa.array(np.concatenate(salts)),
                        ],
                        ["key", "class", "size", "salt"],
                    )

    return post


def _subset_keys(own: np.ndarray) -> np.ndarray:
    """A hash for every pair of sizes and every subset that such a pair must share."""
    n, found = len(own), []
    for other in range(smallest_partner(n), n * 100 // PERCENT + 1):
        small, large = sorted((n, other))
        need = overlap_needed(small, large)
        if need > n:
            continue
        subsets = np.array(list(combinations(range(n), need)))
        key = np.full(len(subsets), small * 1000 + large, np.uint64)
        for j in range(need):
            key = batches.mix(key * np.uint64(0x9E3779B97F4A7C15) + own[subsets[:, j]])
        found.append(key)
    return np.concatenate(found)


def _shared(postings: DataFrame, boundary: int) -> DataFrame:
    """The entries that are left after the filters of step 3."""
    window = Window.partitionBy("key", "salt").orderBy("class")
    other = (F.lag("class").over(window) != F.col("class")) | (F.lead("class").over(window) != F.col("class"))
    # The parts of a cut list know nothing of each other; its shingle is frequent anyway.
    shared = postings.withColumn("other", other).where("other OR salt > 0").drop("other").distinct()
    shared = scratch.through_table(shared, "shared")
    smallest = F.ceil(F.col("size") * PERCENT / 100)
    least = F.greatest(F.ceil(smallest * COMMON_PERCENT / 100), F.lit(1))
    least = F.when(F.col("size") <= boundary, F.lit(1)).otherwise(least)
    enough = shared.groupBy("class", "size").agg(F.count(F.lit(1)).alias("left")).where(F.col("left") >= least)
    enough = scratch.through_table(enough.select("class"), "enough")
    shared = scratch.through_table(shared.join(enough, "class", "left_semi"), "shared")
    lists = shared.groupBy("key").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    lists = scratch.through_table(lists, "lists")
    rarest = Window.partitionBy("class").orderBy("sets", "key")
    placed = shared.join(lists, "key").select("*", F.row_number().over(rarest).alias("place"))
    left = F.count(F.lit(1)).over(Window.partitionBy("class"))
    return placed.withColumn("left", left).where(F.col("place") <= F.col("left") - least + 1).select(
        "key", "class", "size", "salt"
    )


def _ties(postings: DataFrame) -> DataFrame:
    """Neighbours of the sorted lists whose sizes allow a link; parts of one list are tied through a few of their sets."""
    window = Window.partitionBy("key", "salt").orderBy("size", "class")
    # Sizes in steps of about 5 %; the first set of each step stands for its part of the list.
    step = F.floor(F.log("size") * 20)
    rows = postings.select(
        "key", "salt", "class", "size", F.lag("class").over(window).alias("prev"), F.lag("size").over(window).alias("low")
    )
    tie = (F.col("prev") != F.col("class")) & (F.col("low") * 100 >= F.col("size") * PERCENT)
    stands = (F.col("salt") > 0) & (F.col("low").isNull() | (step != F.floor(F.log("low") * 20)))
    rows = rows.select(
        "key", "class", "size", F.when(tie, F.col("prev")).alias("prev"), F.coalesce(stands, F.lit(False)).alias("stands")
    ).where("prev IS NOT NULL OR stands")
    # Ties of one list and of the lists beside it become one tree for each set of sets that they connect.
    rows = rows.mapInArrow(_trees, "class bigint, size int, prev bigint, key bigint, stands boolean")
    rows = scratch.through_table(rows, "ties")
    across = Window.partitionBy("key").orderBy("size", "class")
    parts = rows.where("stands").select(
        "class", "size", F.lag("class").over(across).alias("prev"), F.lag("size").over(across).alias("low")
    )
    # Two sets that may link stand up to two steps apart from their stand-ins.
    parts = parts.where("prev <> class AND low * 10 >= size * 7")
    ties = rows.where("prev IS NOT NULL").selectExpr("prev AS a", "class AS b")
    return ties.unionByName(parts.selectExpr("prev AS a", "class AS b"))


def _trees(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_())
    schema = pa.schema(list(zip(("class", "size", "prev", "key", "stands"), kinds, strict=True)))
    pairs, stands = [], []
    for batch in stream:
        table = pa.Table.from_batches([batch]).select(schema.names)
        stands.append(table.filter(table["stands"]))
        tied = table.filter(table["prev"].is_valid())
        pairs.append(np.stack([tied["prev"].to_numpy(), tied["class"].to_numpy()], 1))
        if sum(map(len, pairs)) > 1 << 20:
            pairs = [forest(np.concatenate(pairs))]
    for table in stands:
        none = pa.nulls(len(table), pa.int64())
        yield from table.set_column(2, "prev", none).cast(schema).to_batches()
    edges = forest(np.concatenate(pairs)) if pairs else np.zeros((0, 2), np.int64)
    size = len(edges)
    columns = [pa.array(edges[:, 1]), pa.nulls(size, pa.int32()), pa.array(edges[:, 0]), pa.nulls(size, pa.int64())]
    yield pa.RecordBatch.from_arrays([*columns, pa.array(np.zeros(size, bool))], schema=schema)


def _fetcher(shared):
    def fetch(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, table, met = shared.value, batches.white_space_table(), set()
        for batch in stream:
            for _, _, data, offsets in batches.slices(batch.column(0)):
                rows = []
                for own in _shingle_sets(data, offsets, table):
                    if not len(own) or (digest := _digest(own)) in met:
                        continue
                    name = _class(digest)
                    if wanted[(name & 0xFFFFFFFFFFFFFFFF) >> (64 - CELL_BITS)]:
                        met.add(digest)
                        rows.append((digest, name, own.tobytes()))
                if rows:
                    yield batches.record_batch(rows, _SETS)

    return fetch


def link_components(sets: list[np.ndarray]) -> np.ndarray:
    """Smallest index that each set reaches by links; sets are sorted arrays of distinct values."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    _, element = np.unique(values, return_inverse=True)
    owner = np.repeat(np.arange(m), sizes)
    order = np.argsort(element, kind="stable")
    lists, starts = owner[order], np.concatenate([[0], np.cumsum(np.bincount(element))])
    bounds = np.concatenate([[0], np.cumsum(sizes)])

    def linked(x: int) -> np.ndarray:
        own = element[bounds[x] : bounds[x + 1]]
        lengths = starts[own + 1] - starts[own]
        at = np.repeat(starts[own] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        shared = np.bincount(lists[at], minlength=m)
        return 100 * shared >= PERCENT * (sizes[x] + sizes - shared)

    label = np.full(m, -1)
    for root in range(m):
        if label[root] >= 0:
            continue
        label[root] = root
        pending = [root]
        while pending:
            rest = np.flatnonzero(label < 0)
            if not len(rest):
                return label
            if len(rest) < len(pending):
                # Fewer sets are outside than wait inside: ask them instead.
                inside = label == root
                pending = [int(y) for y in rest if (linked(int(y)) & inside).any()]
                label[pending] = root
                continue
            near = np.flatnonzero(linked(pending.pop()) & (label < 0))
            label[near] = root
            pending += near.tolist()
    return label


def _link_groups(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (task, digest, shingles), sorted by task, to links of each set with the first of its component."""
    task, group = None, {}

    def links() -> Iterator[pa.RecordBatch]:
        if len(group) > 1:
            names = sorted(group)
            label = link_components([np.frombuffer(group[d], np.uint64) for d in names])
            rows = [(names[i].hex(), names[j].hex()) for j, i in enumerate(label) if i != j]
            if rows:
                yield batches.record_batch(rows, _LINKS)

    for batch in stream:
        for name, digest, packed in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if name != task:
                yield from links()
                task, group = name, {}
            group[digest] = packed
    yield from links()


def _links(tasks: DataFrame) -> DataFrame:
    """Links (a, b) inside each task of rows (task, digest, shingles)."""
    sorted_tasks = tasks.repartition("task").sortWithinPartitions("task")
    return scratch.through_table(sorted_tasks.mapInArrow(_link_groups, _LINKS), "links")


def jaccard_components(docs: DataFrame, group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """One row per row of `docs` (doc_id, text): `n_shingles`, `component_id` and `class` (digest of the set, hex).

    A text of fewer than five words is its only shingle; NULL and wordless texts have the empty set, link with nothing
    and are their own component. NULL `doc_id`s keep their rows and are never the smallest id of a component; a
    component without any other id is NULL. Repeated rows keep their rows. No documents give no rows. Other columns
    are ignored.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = scratch.through_table(source.mapInArrow(_classes, _CLASSES), "sets")
    sets = first.where("block IS NULL").select("doc_id", "n_shingles", F.lower(F.hex("digest")).alias("digest"), "class")
    counts = add_counts(first.where("block IS NOT NULL").select("block", "counts"))
    small = sets.where(F.col("n_shingles").between(1, MOST_LIGHT)).groupBy("n_shingles").count().collect()
    boundary = light_boundary({row["n_shingles"]: row["count"] for row in small})

    postings = source.select("text").mapInArrow(
        _poster(spark.sparkContext.broadcast(_list_parts(counts)), boundary), _POSTINGS
    )
    groups = components(_ties(_shared(postings, boundary))).selectExpr("node AS class", "component AS g")
    groups = scratch.through_table(groups, "groups")
    cells = spark.sparkContext.broadcast(cells_used(groups, "class"))

    sizes = groups.join(sets.groupBy("class").agg(F.max("n_shingles").alias("n")), "class")
    sizes = sizes.groupBy("g").agg(F.ceil(F.sum("n") / group_shingles).cast("int").alias("blocks"))
    sizes = scratch.through_table(groups.join(sizes, "g"), "groups")
    few = F.broadcast(sizes) if fits(sizes, F.lit(40), MAX_GROUP_BYTES) else sizes
    found = source.select("text").mapInArrow(_fetcher(cells), _SETS).join(few, "class")
    found = scratch.through_table(found.select("g", "blocks", "digest", "shingles"), "found")
    cut = F.explode(F.when(F.col("blocks") > 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0))))
    block = F.pmod(F.xxhash64("digest", "cut"), F.col("blocks"))
    tasks = found.withColumn("cut", cut).select(F.concat_ws(":", "g", "cut", block).alias("task"), "digest", "shingles")
    links = _links(tasks)
    linked = components(links).selectExpr("node AS digest", "component AS leader")

    # Groups in blocks that are still in several components.
    name = F.lower(F.hex("digest"))
    size = (F.octet_length("shingles") / 8).cast("bigint").alias("size")
    parts = found.where("blocks > 1").select("g", "blocks", name.alias("digest"), size).join(linked, "digest", "left")
    parts = scratch.through_table(parts.withColumn("leader", F.coalesce("leader", "digest")), "parts")
    leaders = parts.groupBy("g", "leader").agg(F.count(F.lit(1)).alias("sets")).groupBy("g")
    leaders = leaders.agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(-F.col("sets"), "leader").alias("m"))["leader"].alias("common"))
    outside = parts.join(leaders.where("n > 1"), "g").where("leader <> common").select("g", "blocks", "digest", "size")
    outside = scratch.through_table(outside, "outside")
    if outside.limit(1).count():
        whole = parts.groupBy("g").agg(F.sum("size").alias("all"))
        deals = outside.groupBy("g").agg(F.sum("size").alias("out")).join(whole, "g")
        few = (F.col("out") * 2 < F.col("all")).alias("few")
        deals = scratch.through_table(deals.select("g", few, F.ceil(F.col("out") / group_shingles).cast("int").alias("deals")), "deals")
        many, deals = deals.where("NOT few").select("g"), deals.where("few").select("g", "deals")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        deal = F.pmod(F.xxhash64("digest"), F.col("deals")).cast("int").alias("deal")
        sets_of = found.select("g", "blocks", name.alias("digest"), F.col("digest").alias("own"), "shingles")
        sent = outside.join(deals, "g").select("g", "digest", every("blocks").alias("block"), deal)
        sent = sent.join(sets_of.select("digest", "own", "shingles"), "digest")
        there = sets_of.join(deals, "g").withColumn("block", F.pmod(F.xxhash64("own", F.lit(1)), F.col("blocks")).cast("int"))
        there = there.select("digest", "g", "block", every("deals").alias("deal"), "own", "shingles")
        task = F.concat_ws(":", "g", "block", "deal").alias("task")
        tasks = sent.select(task, F.col("own").alias("digest"), "shingles").unionByName(
            there.select(task, F.col("own").alias("digest"), "shingles")
        )
        own = F.pmod(F.xxhash64("digest"), F.col("blocks"))
        pairs = found.join(many, "g").select("g", "digest", "shingles", own.alias("own"), every("blocks").alias("other"))
        pair = F.concat_ws(":", F.lit("pair"), "g", F.least("own", "other"), F.greatest("own", "other"))
        tasks = tasks.unionByName(pairs.select(pair.alias("task"), "digest", "shingles"))
        links = links.unionByName(_links(tasks))
        linked = components(links).selectExpr("node AS digest", "component AS leader")

    # The empty set links with nothing, not even with itself.
    empty = F.col("n_shingles") == 0
    placed = sets.join(linked, "digest", "left").select(
        "doc_id", "n_shingles", "digest", F.coalesce("leader", "digest").alias("leader")
    )
    placed = scratch.through_table(placed, "placed")
    smallest = placed.where(~empty).groupBy("leader").agg(F.min("doc_id").alias("smallest"))
    smallest = scratch.through_table(smallest, "smallest")
    return placed.join(smallest, "leader", "left").select(
        "doc_id",
        "n_shingles",
        F.when(empty, F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"),
        F.col("digest").alias("class"),
    )


def keep_smallest(docs: DataFrame) -> DataFrame:
    """`docs` without the documents that link to one of a smaller id; one document of each component stays.

    Of repeated rows of one id all stay, and so do NULL ids.
    """
    dropped = jaccard_components(docs).where("component_id <> doc_id").select(F.col("doc_id").alias("dropped")).distinct()
    return docs.select(whole_row(docs)).join(dropped, F.col("row.doc_id") == F.col("dropped"), "left_anti").select("row.*")
