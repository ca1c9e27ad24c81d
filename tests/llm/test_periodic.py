from __future__ import annotations

import random
import re
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np

from dialogeval.llm import periodic
from dialogeval.llm.queries import QUERIES


def brute(words):
    """(start, length, period) by comparing every word with the one p behind it."""
    n, found = len(words), []
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            s = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            stretch = words[s : i + p]
            if len(stretch) >= max(24, 3 * p) and not any(stretch[d:] == stretch[:-d] for d in range(1, p)):
                found.append((s, len(stretch), p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(doc_id, text, plant=False):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if plant and n and doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    kept = " ".join(w for i, w in enumerate(words) if not any(s + p <= i < s + m for s, m, p in runs))
    return n, runs, best, kept


def found(df):
    plain = lambda r: (r["start"], r["length"], r["period"])
    return [
        (r["doc_id"], r["n_words"], [plain(x) for x in r["runs"]], r["best"] and plain(r["best"]), r["collapsed"])
        for r in df.collect()
    ]


def test_cover_has_every_difference():
    assert {(a - b) % periodic.MODULUS for a in periodic.COVER for b in periodic.COVER} == set(range(periodic.MODULUS))


def test_extensions_against_direct_comparison():
    rng = np.random.default_rng(4)
    for letters, n in ((1, 90), (2, 300), (3, 700)):
        text = rng.integers(1, letters + 1, n).astype(np.uint64)
        text[200:320] = text[40:160] if n > 400 else text[200:320]
        text = np.append(text, np.uint64(99))
        i, j = np.triu_indices(n, 1)
        long = np.array([next(k for k in range(n + 1) if text[a + k] != text[b + k]) for a, b in zip(i, j, strict=True)])
        assert (periodic.Extensions(text).lce(i, j) == long).all()


def test_runs_against_brute_force(docs_of):
    rng, texts = random.Random(8), []
    for case in range(160):
        words = [f"w{rng.randrange(1 + case % 5 * 3)}" for _ in range(rng.randrange(90))]
        for _ in range(rng.randrange(4)):
            unit = [f"w{rng.randrange(3)}" for _ in range(rng.randrange(1, 13))]
            size, at = rng.randrange(20, 150), rng.randrange(len(words) + 1)
            words[at:at] = (unit * 150)[:size]
        texts.append(rng.choice((" ", "\n", "\t ")).join(words) + rng.choice(("", " ")))
    texts += ["a " * 23, "a " * 24, "A a " * 40, "a b " * 100 + "b a " * 100, "x " + ("y " * 30 + "z ") * 5, "é\x00 " * 50]
    assert found(periodic.periodic_runs(docs_of(*texts)).orderBy("doc_id")) == [(i, *expected(i, t)) for i, t in enumerate(texts)]


def test_long_texts_and_edges(docs_of):
    rng = random.Random(2)
    unit = [f"w{rng.randrange(10**9)}" for _ in range(7001)]
    long = " ".join((unit * 5)[:30000])
    one = "na " * 9000
    rows = [(1, long, "s"), (2, None, "s"), (3, "", "s"), (4, " \t\n", "s"), (None, "b " * 30, "s"), (None, "b " * 30, "s"), (7, one, "s")]
    df = docs_of(*rows).selectExpr("*", "1 AS runs", "2 AS best", "3 AS n_words")
    got = {(r[0], r[1]): r[2:] for r in found(periodic.periodic_runs(df))}
    assert got == {
        (1, 30000): ([(0, 30000, 7001)], (0, 30000, 7001), " ".join(unit)),
        (2, 0): ([], None, ""),
        (3, 0): ([], None, ""),
        (4, 0): ([], None, ""),
        (None, 30): ([(0, 30, 1)], (0, 30, 1), "b"),
        (7, 9000): ([(0, 9000, 1)], (0, 9000, 1), "na"),
    }
    assert periodic.periodic_runs(df).count() == 7
    assert periodic.periodic_runs(docs_of()).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    digest = lambda s: sha256(s.encode()).hexdigest()
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = {}
    for doc_id, text in texts:
        n, runs, best, kept = expected(doc_id, text, plant=True)
        row = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want[doc_id] = (len(runs), *row, digest("".join(f"{s},{m},{p}\n" for s, m, p in runs)), digest(kept))
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = {r["doc_id"]: tuple(r[c] for c in names) for r in QUERIES["op11_periodic_runs"](spark, sf_dir).collect()}
    assert got == want
    assert sum(1 for r in want.values() if r[0]) > 5
