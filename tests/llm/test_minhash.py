from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np

from dialogeval.llm import minhash
from dialogeval.llm.queries import QUERIES


def sets_of(texts):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return sets


def brute(texts):
    """{id: (n_shingles, component, kept)}"""
    sets, label, lists = sets_of(texts), {i: i for i in texts}, defaultdict(list)

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in sorted(sets):
        shared = defaultdict(int)
        for g in sets[i]:
            for j in lists[g]:
                shared[j] += 1
            lists[g].append(i)
        for j, n in shared.items():
            if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_tables_against_brute_force(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert found(QUERIES["op13_minhash_dedup"](spark, sf_dir)) == brute(texts)


def test_pairs_at_the_limit(docs_of):
    rng, texts = random.Random(11), []
    for size in (1, 4, 5, 6, 9, 10, 11, 12, 24, 40, 120):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        texts.append(" ".join(base))
        for _ in range(9):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                kind, at = rng.randrange(3), rng.randrange(len(copy))
                if kind == 0:
                    copy[at] = f"v{rng.randrange(10**6)}"
                elif kind == 1:
                    copy.append(f"v{rng.randrange(10**6)}")
                elif len(copy) > 1:
                    copy.pop(rng.choice((0, -1)))
            texts.append("\t".join(copy).upper())
    assert found(minhash.minhash_components(docs_of(*texts))) == brute(dict(enumerate(texts)))


def test_a_bucket_of_many_components(docs_of):
    """Sets around one base, mostly too far apart to link, in one block and in several."""
    rng = random.Random(6)
    base, texts = [f"w{i}" for i in range(300)], []
    for i in range(70):
        words = list(base)
        for _ in range(2 + i % 5):
            words[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
        if i % 7 == 0:
            texts.append(" ".join([*words, "tail"]))
    want = brute(dict(enumerate(texts)))
    sizes = defaultdict(int)
    for _, component, _ in want.values():
        sizes[component] += 1
    assert len(sizes) > 5 and max(sizes.values()) > 5
    assert found(minhash.minhash_components(docs_of(*texts))) == want
    assert found(minhash.minhash_components(docs_of(*texts), block_shingles=2000)) == want


def test_links_of_a_block():
    sets = [np.arange(a, a + 40, dtype=np.uint64) for a in (0, 2, 4, 6, 100, 101, 300)]
    names, labels = [10, 11, 12, 13, 14, 15, 16], [1, 1, 2, 3, 4, 5, 6]
    links = minhash._forest_links(names, labels, sets, np.ones(7, bool), 85)
    assert sorted(tuple(sorted(x)) for x in links) == [(11, 12), (12, 13), (14, 15)]
    asks = np.array([False] * 6 + [True])
    assert minhash._forest_links(names, labels, sets, asks, 85) == []


def test_chains_of_links(docs_of):
    words, texts = [f"w{i}" for i in range(80)], []
    for i in range(25):
        words = words[2:] + [f"n{i}", f"m{i}"]
        texts.append(" ".join(words))
    random.Random(1).shuffle(texts)
    got = found(minhash.minhash_components(docs_of(*texts)))
    assert got == brute(dict(enumerate(texts))) and {c for _, c, _ in got.values()} == {0}


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    both = np.concatenate([values[:2000], values[1000:], values[:1]])
    a, b, c = minhash.signatures(both, np.array([0, 2000, 4000, 4001]))
    assert abs((a == b).mean() - 1 / 3) < 0.15
    direct = values[:1][0] * minhash._functions()[0] + minhash._functions()[1]
    assert (c == direct >> np.uint64(32)).all()


def test_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(30)] + [(200, 201), (201, 200), (7, 7)]
    random.Random(2).shuffle(edges)
    got = {r["class"]: r["label"] for r in minhash.star_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}, 201: 200}


def test_edges(docs_of):
    df = docs_of((5, None, "s"), (6, "", "s"), (7, " \t\n", "s"), (9, "One two", "s"), (8, "one TWO", "s"), (8, "one TWO", "s"),
                 (None, "one two", "s"), (None, "lone text", "s"), (10, "far " * 90_000, "s"), (11, "far " * 50_000, "s"))
    df = df.selectExpr("*", "1 AS label", "2 AS digest", "3 AS text_key", "4 AS band")
    rows = minhash.minhash_components(df).collect()
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in rows)
    assert got == sorted([("5", 0, "5", True), ("6", 0, "6", True), ("7", 0, "7", True), ("9", 1, "8", False), ("8", 1, "8", True),
                          ("8", 1, "8", True), ("None", 1, "8", False), ("None", 1, "None", True), ("10", 1, "10", True), ("11", 1, "10", False)])
    assert minhash.minhash_components(docs_of()).count() == 0
    assert {r["component_id"] for r in minhash.minhash_components(docs_of("a b", "c d")).collect()} == {0, 1}
