from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np

from dialogeval.llm import components, jaccard
from dialogeval.llm.queries import QUERIES


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(texts):
    """{id: (n_shingles, component)}"""
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered(t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    lists, label = defaultdict(list), {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in sorted(sets):
        for g in sets[i]:
            lists[g].append(i)
    for i in sorted(sets):
        shared = defaultdict(int)
        for g in sets[i]:
            for j in lists[g]:
                if j > i:
                    shared[j] += 1
        for j, n in shared.items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_tables_against_brute_force(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert found(QUERIES["op2_ngram_jaccard"](spark, sf_dir)) == brute(texts)


def test_small_and_large_sets_at_the_limit(docs_of):
    rng, texts = random.Random(5), []
    for size in (1, 3, 4, 5, 6, 8, 9, 10, 12, 13, 14, 20, 40, 90):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        texts.append(" ".join(base))
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                kind, at = rng.randrange(3), rng.randrange(len(copy))
                if kind == 0:
                    copy[at] = f"v{rng.randrange(10**6)}"
                elif kind == 1:
                    copy = copy + [f"v{rng.randrange(10**6)}"]
                elif len(copy) > 1:
                    copy.pop(rng.choice((0, -1)))
            texts.append(rng.choice(("", " ")) + "\t".join(copy).upper())
    assert found(jaccard.jaccard_components(docs_of(*texts))) == brute(dict(enumerate(texts)))


def test_chains_through_blocks_of_a_large_group(docs_of):
    words, texts = [f"w{i}" for i in range(60)], []
    for i in range(30):
        words = words[2:] + [f"n{i}", f"m{i}"]
        texts.append(" ".join(words))
    texts += [" ".join(f"z{i}" for i in range(50))] * 3
    random.Random(1).shuffle(texts)
    expected = brute(dict(enumerate(texts)))
    assert len({c for _, c in expected.values()}) == 2
    assert found(jaccard.jaccard_components(docs_of(*texts), group_shingles=150)) == expected


def test_lists_of_frequent_shingles_in_parts(docs_of, monkeypatch):
    monkeypatch.setattr(jaccard, "_list_parts", lambda counts: np.full(len(counts), 3, np.uint16))
    base = [f"w{i}" for i in range(40)]
    texts = [" ".join([*base, *(f"x{i}{j}" for j in range(i % 9))]) for i in range(60)]
    assert found(jaccard.jaccard_components(docs_of(*texts))) == brute(dict(enumerate(texts)))


def test_edges(docs_of):
    df = docs_of((5, None, "s"), (6, "", "s"), (7, " \t\n", "s"), (9, "One two", "s"), (8, "one TWO", "s"), (8, "one TWO", "s"),
                 (None, "one two", "s"), (None, "lone text", "s"))
    rows = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in jaccard.jaccard_components(df).collect())
    assert rows == sorted([("5", 0, "5"), ("6", 0, "6"), ("7", 0, "7"), ("9", 1, "8"), ("8", 1, "8"), ("8", 1, "8"),
                           ("None", 1, "8"), ("None", 1, "None")])
    assert jaccard.jaccard_components(docs_of()).count() == 0
    kept = jaccard.keep_smallest(df)
    assert kept.columns == df.columns and kept.where("doc_id = 9").count() == 0 and kept.count() == 7


def test_boundary_follows_the_cost():
    assert jaccard.light_boundary({}) == 0
    assert jaccard.light_boundary({4: 10, 30: 5}) == 4
    assert jaccard.light_boundary({4: 1, 12: 1000}) == 4


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 100) for i in range(40)] + [(7, 7)]
    random.Random(2).shuffle(edges)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}}
    tree = components.forest(np.array(edges))
    assert {(int(a), int(b)) for a, b in tree} == {(0, i) for i in range(1, 61)} | {(100, 100 + i) for i in range(1, 40)}
