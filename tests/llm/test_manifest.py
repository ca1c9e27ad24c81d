from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from dialogeval.llm import manifest
from dialogeval.llm.queries import QUERIES

KINDS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(hashes):
    """The root, and for each leaf its (left, right) digests per level."""
    level, groups, proofs = list(hashes), [[i] for i in range(len(hashes))], [[] for _ in hashes]
    while len(level) > 1:
        up, below = [], []
        for a in range(0, len(level), 3):
            run = level[a : a + 3]
            for k in range(len(run)):
                for i in groups[a + k]:
                    proofs[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(H(*run))
            below.append([i for g in groups[a : a + 3] for i in g])
        level, groups = up, below
    return level[0], proofs


def brute(rows, change):
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    first = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]))
    for name in names:
        by[name].sort(key=first)
    lower = {name: climb([leaf(r, r["text"]) for r in by[name]]) for name in names}
    root, upper = climb([lower[n][0] for n in names]) if names else (None, [])
    out = []
    for name, above in zip(names, upper, strict=True):
        subroot, proofs = lower[name]
        for r, proof in zip(by[name], proofs, strict=True):
            at = leaf(r, change(r))
            for left, right in proof + above:
                at = H(left, at, right)
            siblings = "".join(a + b for a, b in proof + above)
            out.append((r["doc_id"], leaf(r, r["text"]), subroot, root, H(siblings), at, at == root))
    return sorted(out, key=str)


def tamper(r):
    even = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
    return r["text"].replace("\n", "") if even and r["text"] is not None else r["text"]


def found(df):
    digest = manifest.proof_digest(F.col("proof")).alias("proof_sha256")
    rows = df.select("doc_id", "leaf", "subroot", "root", digest, "folded_root", "verified").collect()
    return sorted([tuple(r) for r in rows], key=str)


def tampered():
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def test_tables_against_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = QUERIES["op12_merkle_manifest"](spark, sf_dir).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows, tamper)


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (2, 3, 4), (27, 28, 1, 82), (5,) * 30, (730, 1)])
def test_shapes_of_trees(spark, sizes):
    rows = [(i * 7, f"t{i}\n", "en", f"s{k}", i) for k, n in enumerate(sizes) for i in range(n)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, KINDS)
    assert found(manifest.manifest(df, tampered())) == brute(df.collect(), tamper)


def test_edges(spark):
    rows = [(None, None, None, None, None), (None, "a\n", "en", None, 2), (5, "", "", "", 0), (5, "", "", "", 0), (5, "ü\n\n", "de", "", -3),
            (-7, "x" * 300_000 + "\n", "en", "é", 1), (8, "\n", "en", "z", 1), (1, "-", "-", "-", 1)]
    df = spark.createDataFrame(rows, KINDS).selectExpr("*", "1 AS rank", "'x' AS tree", "2 AS hash", "3 AS proof", "4 AS lo")
    assert found(manifest.manifest(df, tampered())) == brute(df.collect(), tamper)
    assert all(r["verified"] for r in manifest.manifest(df).collect())
    assert manifest.manifest(df.limit(0)).count() == 0
