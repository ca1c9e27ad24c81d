"""Merkle manifest of a table: one tree of digests per source, one tree over the sources, and a proof for every row.

Nodes carry the interval of leaf ranks that they cover. A level has a third of the nodes of the one below, so levels are
taken `LEVELS` at a time: a bucket is the interval that a node `LEVELS` levels up covers, and holds at most
`FAN ** LEVELS` nodes and their ancestors. A containment join inside the bucket attaches to each node the ancestors whose
intervals contain its own; its siblings on a level are the nodes that cover the parent's interval without its own.

Ranks come from a sort by ranges: each row's place in its partition, and counts of rows per partition and source, so no
source is ever in one task. Texts are hashed where they are read and never shuffled; only digests travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogeval.sources import scratch

FAN = 3
# Levels of a tree that one join covers; a bucket has at most FAN ** LEVELS nodes.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# No tree is higher than this: FAN ** 40 leaves are beyond 64 bits.
_HIGHEST = 40

_BITS = 33  # monotonically_increasing_id keeps the place in the partition in this many bits


def digest(*values: Column) -> Column:
    return F.sha2(F.concat(*values), 256)


def leaf_of(values: dict[str, Column]) -> Column:
    """Digest of the fields in order, each with its length; NULL differs from every value."""
    parts = []
    for field in FIELDS:
        value = values[field].cast("string")
        said = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(said, F.lit("-")))
    return digest(*parts)


def _height(n: Column) -> Column:
    """Levels above the leaves of a tree of `n` leaves."""
    steps = [F.when(n > F.lit(FAN**k), F.lit(1)).otherwise(F.lit(0)) for k in range(_HIGHEST) if FAN**k < 1 << 63]
    return sum(steps[1:], steps[0])


def ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """`rows` with `rank` in its tree by `order`, the number `leaves` of the tree's rows and its `height`."""
    stored = scratch.through_table(
        rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order).withColumn("at", F.monotonically_increasing_id()),
        "sorted",
    )
    stored = stored.withColumn("part", F.shiftright("at", _BITS))
    counts = stored.groupBy("part", tree).agg(F.min("at").alias("begin"), F.count(F.lit(1)).alias("here"))
    # One row for each partition that a tree reaches into.
    before = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "part",
        tree,
        (F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("begin")).alias("shift"),
        F.sum("here").over(Window.partitionBy(tree)).alias("leaves"),
    )
    joined = stored.join(counts, ["part", tree]).withColumn("rank", F.col("at") + F.col("shift"))
    return joined.withColumn("height", _height(F.col("leaves"))).drop("at", "part", "shift")


def _above(level: Column) -> Column:
    """The next level of a sorted list of nodes (lo, hi, hash)."""

    def parent(i: Column) -> Column:
        run = F.slice(level, i * FAN + 1, FAN)
        return F.struct(
            F.element_at(run, 1)["lo"].alias("lo"),
            F.element_at(run, -1)["hi"].alias("hi"),
            F.sha2(F.array_join(F.transform(run, lambda x: x["hash"]), ""), 256).alias("hash"),
        )

    return F.transform(F.sequence(F.lit(0), F.floor((F.size(level) - 1) / FAN).cast("int")), parent)


def _buckets(nodes: DataFrame, size: int) -> DataFrame:
    """The nodes of each bucket of `size` leaves and their ancestors in it, as lists l0, l1, ...; `height` is what is left."""
    bucket = F.floor(F.col("lo") / size).cast("bigint")
    level = F.array_sort(F.collect_list(F.struct("lo", "hi", "hash")))
    out = nodes.groupBy("tree", bucket.alias("bucket")).agg(level.alias("l0"), F.max("height").alias("height"))
    for k in range(1, LEVELS + 1):
        up = F.when(F.col("height") >= k, _above(F.col(f"l{k - 1}")))
        out = out.withColumn(f"l{k}", up)
    return out


def _containing(level: Column, lo: Column, hi: Column) -> Column:
    return F.element_at(F.filter(level, lambda x: (x["lo"] <= lo) & (hi <= x["hi"])), 1)


def _steps(lo: Column, hi: Column) -> Column:
    """For each level of a bucket the digests beside the ancestor of lo:hi: before it and behind it in its run."""
    steps = []
    for k in range(LEVELS):
        level = F.col(f"l{k}")
        own = F.struct(lo.alias("lo"), hi.alias("hi")) if k == 0 else _containing(level, lo, hi)
        parent = _containing(F.col(f"l{k + 1}"), lo, hi)

        def beside(kind: str, level=level, own=own, parent=parent) -> Column:
            inside = F.filter(
                level,
                lambda x: (parent["lo"] <= x["lo"])
                & (x["hi"] <= parent["hi"])
                & ((x["hi"] <= own["lo"]) if kind == "left" else (x["lo"] >= own["hi"])),
            )
            return F.array_join(F.transform(inside, lambda x: x["hash"]), "").alias(kind)

        steps.append(F.when(F.col("height") > k, F.struct(beside("left"), beside("right"))))
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def trees(leaves: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Proofs (tree, lo, proof) of all leaves and roots (tree, root) of all trees.

    `leaves` has tree, rank, height and hash and is a stored table; no tree is higher than `most`. A proof is an array of
    (left, right), one a level from the leaf up.
    """
    nodes = leaves.select("tree", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "hash", "height")
    floors, size = [], 1
    while True:
        size *= FAN**LEVELS
        buckets = scratch.through_table(_buckets(nodes, size), "buckets")
        floors.append((nodes, buckets, size))
        if FAN**most <= size:
            break
        top = F.element_at(F.coalesce(*[F.col(f"l{k}") for k in range(LEVELS, -1, -1)]), 1)
        left = F.greatest(F.col("height") - LEVELS, F.lit(0))
        nodes = buckets.select("tree", top["lo"].alias("lo"), top["hi"].alias("hi"), top["hash"].alias("hash"), left.alias("height"))
    top = F.element_at(F.coalesce(*[F.col(f"l{k}") for k in range(LEVELS, -1, -1)]), 1)
    roots = buckets.select("tree", top["hash"].alias("root"))
    above = None
    for nodes, buckets, size in reversed(floors):
        own = nodes.select("tree", "lo", "hi", F.floor(F.col("lo") / size).cast("bigint").alias("bucket"))
        joined = own.join(buckets, ["tree", "bucket"])
        proof = _steps(F.col("lo"), F.col("hi"))
        if above is None:
            found = joined.select("tree", "lo", proof.alias("proof"))
        else:
            higher = above.select("tree", F.floor(F.col("lo") / size).cast("bigint").alias("bucket"), F.col("proof").alias("higher"))
            found = joined.join(higher, ["tree", "bucket"]).select("tree", "lo", F.concat(proof, "higher").alias("proof"))
        above = found if size == FAN**LEVELS else scratch.through_table(found, "proofs")
    return above, roots


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda at, s: F.sha2(F.concat(s["left"], at, s["right"]), 256))


def manifest(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """One row per row of `docs` (doc_id, source, lang, n_chars, text): its leaf, the root of its source, the root of all,
    the proof as an array of (left, right) per level, the leaf of the row with the text `changed` (an expression over these
    columns; the text itself if not given), the root that this leaf folds to and whether it is the root of all.

    Leaves of a source ascend by id, NULL first; rows of one id follow their digests, and equal rows are leaves of their
    own. Sources ascend bytewise, NULL first; an empty source is a source. NULL fields have a mark of their own. A lone leaf
    is its subroot, a lone subroot the root, and their proofs are empty. No rows give no rows. Other columns are ignored.
    """
    plain = docs.select(*[F.col(c).cast("bigint" if c in ("doc_id", "n_chars") else "string").alias(c) for c in FIELDS])
    own = {c: F.col(c) for c in FIELDS}
    text = F.col("text") if changed is None else changed
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))
    leaf = leaf_of(own)
    other = leaf if changed is None else F.when(text.eqNullSafe(F.col("text")), leaf).otherwise(leaf_of({**own, "text": text}))
    rows = plain.select("doc_id", tree.alias("tree"), leaf.alias("hash"), other.alias("changed"))
    # The sort reads its input twice: to find its ranges, and to deal it. Texts are read and hashed once.
    rows = scratch.through_table(rows, "digests")
    leaves = scratch.through_table(ranked(rows, "tree", ["doc_id", "hash"]), "leaves")
    proofs, subroots = trees(leaves, _most(leaves))

    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("hash"))
    tops = scratch.through_table(ranked(tops, "tree", ["name"]), "sources")
    upper, root = trees(tops, _most(tops))
    upper = tops.join(upper.withColumnRenamed("lo", "rank"), ["tree", "rank"]).join(root, "tree")
    upper = upper.select(F.col("name").alias("tree"), F.col("hash").alias("subroot"), F.col("proof").alias("upper"), "root")
    upper = scratch.through_table(upper, "upper")

    joined = leaves.join(proofs.withColumnRenamed("lo", "rank"), ["tree", "rank"]).join(upper, "tree")
    joined = joined.withColumn("proof", F.concat("proof", "upper"))
    folded = joined.withColumn("folded_root", fold(F.col("changed"), F.col("proof")))
    return folded.select(
        "doc_id",
        F.col("hash").alias("leaf"),
        "subroot",
        "root",
        "proof",
        F.col("changed").alias("changed_leaf"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _most(leaves: DataFrame) -> int:
    return leaves.agg(F.max("height")).first()[0] or 0


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)
