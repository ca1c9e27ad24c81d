"""Secret scans: certain secrets by pattern, weak candidates by their complementary parts.

A credential often has several parts: an access identifier, a secret and an endpoint. Weak candidates of any one kind are
everywhere, so they are reported only if a part of another kind stands within `scope` code points of them in the same
text: an identifier or an endpoint near a secret, a secret near an identifier or an endpoint. This interval join is
evaluated as two sorted sweeps over the parts of a text, which look only for the nearest part of each role before and
behind; no pairs are formed.

Everything is DataFrame functions. A match is placed by the lengths of the pieces and matches before it, so offsets are
code points. Only the parts found are shuffled, by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogeval.operators.joins import whole_row

SCOPE = 200
MARK = "[SECRET]"

# Kinds in the order of the report. Weak candidates have a least length and no greatest one. `assign` takes failing matches too, because they use up text; of the next two a run
# that is too short holds no other match, so the pattern asks for the length itself.
PATTERNS = {
    "assign": "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": "AKIA[A-Z0-9]{14,}",
    "hex": "[0-9a-f]{16,}",
    "weak_id": "(?<![A-Za-z0-9])(?=[A-Z]*+[0-9])[A-Z0-9]{16,}+(?![A-Za-z0-9])",
    "weak_secret": "(?<![A-Za-z0-9+/])(?=[A-Z0-9+/]*+[a-z])(?=[a-z0-9+/]*+[A-Z])(?=[A-Za-z+/]*+[0-9])[A-Za-z0-9+/]{24,}+",
    "endpoint": "(?:https?|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9._:@/-]+",
}
KINDS = list(PATTERNS)
BASE_KINDS = 3
MIN_ASSIGNED = 12
# What any text with a match holds; all other texts skip the kind.
HINTS = {
    "assign": "(?i)passw|secret|token|api_?key",
    "access": "AKIA",
    "hex": "[0-9a-f]{16}",
    "weak_id": "[A-Z0-9]{16}",
    "weak_secret": "[A-Za-z0-9+/]{24}",
    "endpoint": "://",
}
ROLES = {
    "id": ["access", "weak_id"],
    "secret": ["assign", "hex", "weak_secret"],
    "endpoint": ["endpoint"],
}
COMPLETED_BY = {"id": ["secret"], "secret": ["id", "endpoint"], "endpoint": ["secret"]}

_KEY = ["doc_id", "text_key"]


def _matches(text: Column, kind: str) -> Column:
    """Number in the text, gap before, length and counted length of every match of a kind."""
    number, pattern = KINDS.index(kind), F.lit(PATTERNS[kind])
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.regexp_extract_all(text, pattern, F.lit(2)) if kind == "assign" else whole
    parts = F.arrays_zip(F.split(text, PATTERNS[kind], -1).alias("gap"), whole.alias("whole"), counted.alias("counted"))
    rows = F.transform(
        parts,
        lambda p, i: F.struct(
            F.lit(number).alias("kind"),
            i.alias("i"),
            F.length(p["gap"]).alias("gap"),
            F.length(p["whole"]).alias("length"),
            F.length(p["counted"]).alias("counted"),
        ),
    )
    # The piece behind the last match belongs to none.
    rows = F.filter(rows, lambda r: r["length"].isNotNull())
    empty = F.array().cast("array<struct<kind:int,i:int,gap:int,length:int,counted:int>>")
    return F.when(text.rlike(HINTS[kind]), rows).otherwise(empty)


def _is(kinds: list[str]) -> Column:
    return F.col("kind").isin([KINDS.index(k) for k in kinds])


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, text_key, copies, found) for each distinct pair of id and text of `docs` (doc_id, text).

    `copies` counts equal rows; `found` is a sorted array of (start, kind, end, free): `kind` numbers KINDS, `free` is
    where the text before the span is no longer covered by earlier spans. NULL texts are empty.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    marker = F.struct(
        F.lit(-1).alias("kind"), *[F.lit(0).alias(c) for c in ("i", "gap", "length", "counted")]
    )
    parts = F.concat(F.array(marker), *[_matches(F.col("text"), kind) for kind in KINDS])
    rows = source.select("doc_id", F.xxhash64("text").alias("text_key"), F.explode(parts).alias("p"))
    rows = rows.select(*_KEY, "p.*").repartition(*_KEY)
    # Equal rows give equal parts.
    rows = rows.groupBy(*_KEY, "kind", "i").agg(
        *[F.max(c).alias(c) for c in ("gap", "length", "counted")], F.count(F.lit(1)).alias("copies")
    )
    before = Window.partitionBy(*_KEY, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("length")).over(before).cast("int")
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("length"))
    rows = rows.where((F.col("kind") != KINDS.index("assign")) | (F.col("counted") >= MIN_ASSIGNED))

    ahead = Window.partitionBy(*_KEY).orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    back = Window.partitionBy(*_KEY).orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    near, base = {}, F.col("kind").between(0, BASE_KINDS - 1)
    for role, kinds in ROLES.items():
        rows = rows.withColumn(f"before_{role}", F.max(F.when(_is(kinds), F.col("end"))).over(ahead))
        near[role] = F.coalesce(F.col("start") - F.col(f"before_{role}") <= scope, F.lit(False))
    rows = rows.withColumn("before_base", F.max(F.when(base, F.col("end"))).over(ahead))
    for role, kinds in ROLES.items():
        rows = rows.withColumn(f"behind_{role}", F.min(F.when(_is(kinds), F.col("start"))).over(back))
        near[role] = near[role] | F.coalesce(F.col(f"behind_{role}") - F.col("end") <= scope, F.lit(False))
    rows = rows.withColumn("behind_base", F.min(F.when(base, F.col("start"))).over(back))
    completed = F.lit(False)
    for role, others in COMPLETED_BY.items():
        for other in others:
            completed = completed | (_is(ROLES[role]) & near[other])
    # A weak candidate that a certain one covers is no other secret.
    covered = F.coalesce(F.col("before_base") > F.col("start"), F.lit(False)) | F.coalesce(
        F.col("behind_base") < F.col("end"), F.lit(False)
    )
    rows = rows.where((F.col("kind") < BASE_KINDS) | (completed & ~covered))
    free = F.coalesce(F.max(F.when(F.col("kind") >= 0, F.col("end"))).over(ahead), F.lit(0))
    span = F.struct("start", "kind", "end", F.greatest("free", F.lit(0)).alias("free"))
    return rows.withColumn("free", free).groupBy(*_KEY).agg(
        F.max(F.when(F.col("kind") < 0, F.col("copies"))).alias("copies"),
        F.array_sort(F.collect_list(F.when(F.col("kind") >= 0, span))).alias("found"),
    )


def _report(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(found, one), ",")


def scan_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per row of `docs` (doc_id, text): numbers of certain secrets, digest of their spans, and all spans.

    NULL and empty texts have none. Repeated rows keep their rows, and so do NULL ids. No documents give no rows. Other
    columns are ignored.
    """
    found = find_secrets(docs, scope)
    base = F.filter("found", lambda s: s["kind"] < BASE_KINDS)
    kinds = F.transform("found", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{KINDS[k]}")
        for k in range(BASE_KINDS)
    ]
    return found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "doc_id", *counts, F.sha2(_report(base), 256).alias("base_sha256"), _report(F.col("found")).alias("spans")
    )


def redact_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """`docs` with every reported span replaced by a mark; `n_chars`, if there, is counted anew; columns unchanged."""
    spans = find_secrets(docs, scope).where(F.size("found") > 0).select("doc_id", "text_key", "found")
    text = F.col("row.text").cast("string")
    same = F.col("row.doc_id").cast("bigint").eqNullSafe(F.col("doc_id")) & (
        F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("text_key")
    )
    joined = docs.select(whole_row(docs)).join(spans, same, "left")
    pieces = F.transform(
        "found",
        lambda s: F.when(
            s["start"] >= s["free"],
            F.concat(F.substring(text, s["free"] + 1, s["start"] - s["free"]), F.lit(MARK)),
        ).otherwise(F.lit("")),
    )
    last = F.array_max(F.transform("found", lambda s: s["end"]))
    clean = F.concat(F.array_join(pieces, ""), F.substring(text, last + 1, F.length(text)))
    out = F.when(F.col("found").isNull(), F.col("row.text")).otherwise(clean)
    changed = {"text": out}
    if "n_chars" in docs.columns:
        counted = F.when(F.col("found").isNull(), F.col("row.n_chars"))
        changed["n_chars"] = counted.otherwise(F.length(clean)).cast(docs.schema["n_chars"].dataType)
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(f"row.`{c}`") for c in docs.columns])
