from __future__ import annotations

import math
import re
from collections import defaultdict

import pytest

from dialogeval.llm import mixing as m
from dialogeval.llm.queries import QUERIES


def check(rows, texts, budget=None, entropy_share=m.ENTROPY_SHARE, max_repeats=m.MAX_REPEATS):
    """Weights, order and budget of a mix against sums over its documents; returns the weights."""
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    tokens = defaultdict(int)
    for _, text, source in texts:
        tokens[source] += count(text)
    tokens = {s: n for s, n in tokens.items() if n}
    total = sum(tokens.values())
    budget = budget or total
    weights = {r["source"]: r["weight"] for r in rows}
    assert set(weights) == set(tokens) and abs(sum(weights.values()) - 1) < 1e-6
    entropy = -sum(w * math.log(w) for w in weights.values())
    repeats = max(weights[s] * budget / tokens[s] for s in tokens)
    natural = -sum(n / total * math.log(n / total) for n in tokens.values())
    assert repeats <= max(max_repeats, budget / total) + 1e-5
    flat = max(1 / len(tokens) * budget / n for n in tokens.values()) <= max_repeats
    if flat and natural < entropy_share * math.log(len(tokens)):
        assert abs(entropy - entropy_share * math.log(len(tokens))) < 1e-5
    for source, n in tokens.items():
        own = [r for r in rows if r["source"] == source]
        quota, read = weights[source] * budget, sum(r["n_tokens"] for r in own)
        longest = max(count(t) for _, t, s in texts if s == source)
        assert quota - 1e-3 <= read < quota + longest + 1e-3
        docs = sum(s == source for _, _, s in texts)
        blocks = defaultdict(list)
        for r in own:
            blocks[r["block"]].append(r)
        for block, part in blocks.items():
            if (block + 1) * n <= quota:
                assert len(part) == docs  # a full permutation
            done = 0
            for r in sorted(part, key=lambda r: (r["position"], r["n_tokens"])):
                assert abs(r["position"] - min(1, (block * n + done) / quota)) < 1e-6
                done += r["n_tokens"]
    return weights


def test_tables(spark, sf_dir):
    texts = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = QUERIES["op5_mix_sources"](spark, sf_dir).collect()
    check(rows, texts)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, QUERIES["op5_mix_sources"](spark, sf_dir).collect()))


@pytest.mark.parametrize("part_rows", [4096, 3])
@pytest.mark.parametrize(("budget", "share", "repeats"), [(None, 0.9, 50.0), (None, 1.0, 2.0), (900.0, 0.5, 3.0), (9000.0, 0.99, 4.0)])
def test_targets_and_blocks(docs_of, monkeypatch, part_rows, budget, share, repeats):
    monkeypatch.setattr(m, "PART_ROWS", part_rows)
    texts = [(i, "w " * (1 + i % 7), "big" if i % 3 else ("mid" if i % 2 else "small")) for i in range(300)]
    texts += [(1000 + i, "x", "tiny") for i in range(9)] + [(2000, "a b c", None), (2001, "", "no words")]
    rows = m.mix_sources(docs_of(*texts), budget, share, repeats).collect()
    check(rows, texts, budget, share, repeats)


def test_edges(docs_of):
    assert m.mix_sources(docs_of()).count() == 0
    assert m.mix_sources(docs_of((1, None, "a"), (2, "", None))).count() == 0
    rows = m.mix_sources(docs_of((1, "a b", "a"), (1, "a b", "a"), (None, "c", "a"))).collect()
    assert sorted((str(r["doc_id"]), r["block"], r["weight"]) for r in rows) == [("1", 0, 1.0), ("1", 0, 1.0), ("None", 0, 1.0)]
