from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from dialogeval.llm import fingerprints as fp
from dialogeval.llm.queries import QUERIES


def winnow(hashes, window):
    picked = []
    for i in range(max(1, len(hashes) - window + 1)):
        part = hashes[i : i + window]
        if part:
            low = min(part)
            picked.append(i + max(j for j, h in enumerate(part) if h == low))
    return sorted(set(picked))


def test_windows_keep_the_rightmost_minimum(spark):
    words = "a b c a b c a b c d e f g a b c d e f g h i j k l m n o p a b c a b c".split()
    for count in (0, 1, 3, 4, 5, 11, 12, 13, 35):
        text = " ".join(words[:count])
        df = spark.createDataFrame([(text,)], "text string")
        # Grams of one word and windows of one give every gram.
        every = fp.with_fingerprint(df, "text", "f", window=1).select("f").first()["f"]
        kept = fp.with_fingerprint(df, "text", "f").select("f").first()["f"]
        hashes = {(1 << 32) - 1 - (v & 0xFFFFFFFF): v >> 32 for v in every}
        series = [hashes[i] for i in sorted(hashes)]
        assert len(series) == (max(count - fp.GRAM + 1, 1) if count else 0)
        assert sorted((1 << 32) - 1 - (v & 0xFFFFFFFF) for v in kept) == (winnow(series, fp.WINDOW) if count else [])


def test_a_shared_run_shares_a_fingerprint(spark):
    run = " ".join(f"r{i}" for i in range(fp.GRAM + fp.WINDOW - 1))
    texts = [(" ".join(f"x{i}" for i in range(40)) + " " + run, run + " " + " ".join(f"y{i}" for i in range(40)))]
    df = spark.createDataFrame(texts, "a string, b string")
    df = fp.with_fingerprint(fp.with_fingerprint(df, "a", "fa"), "b", "fb")
    shared = df.select(F.array_intersect(fp.gram_hashes(F.col("fa")), fp.gram_hashes(F.col("fb"))).alias("s"))
    assert shared.first()["s"]


def test_edits_against_brute_force(spark, sf_dir):
    rows = QUERIES["op1_fingerprints"](spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids, near = sorted(texts), 0
    assert sorted(r["doc_id"] for r in rows) == ids
    for r in rows:
        text, at = texts[r["doc_id"]], ids.index(r["doc_id"])
        cut = len(text) // 3
        edited = text[: len(text) - cut] + texts[ids[at - 1]][:cut]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        near += r["near_edited"] > r["near_next"]
    assert near > 0.9 * len(rows)


def test_edges(docs_of):
    rows = fp.fingerprints_with_edits(
        docs_of((1, None, "s"), (2, "", "s"), (3, "a b c d e f", "s"), (3, "a b c d e f", "s"), (None, "ü ß", "s"))
    ).collect()
    by = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r) for r in rows), key=lambda x: x[:2])
    assert len(rows) == 5
    null, one, two, three, again = (r for _, _, r in by)
    assert three == again and three["n_chars"] == 11
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert one["edited_sha256"] == two["edited_sha256"] == sha("") and one["fingerprint"] == "" and one["near_edited"] == 1.0
    assert three["edited_sha256"] == sha("a b c d ")  # the next document, 2, has nothing to give
    assert null["edited_sha256"] == sha("ü a")  # the smallest is followed by the largest
    assert fp.fingerprints_with_edits(docs_of((7, "one two three", "s"))).first()["near_next"] == 1.0
    assert fp.fingerprints_with_edits(docs_of()).count() == 0
