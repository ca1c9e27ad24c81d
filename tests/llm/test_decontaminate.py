from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest

from dialogeval.llm import decontaminate as d
from dialogeval.llm.queries import QUERIES

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items):
    windows = defaultdict(set)
    for item, text in items:
        w = words_of(text)
        m = min(10, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            windows[tuple(w[k : k + m])].add(str(item))
    out = []
    for i, text in texts:
        w, found, hit = words_of(text), set(), set()
        for m in {len(k) for k in windows}:
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in windows:
                    found |= windows[tuple(w[k : k + m])]
                    hit |= set(range(k, k + m))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((str(i), len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out)


def rows_of(df):
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return sorted((str(r[names[0]]), *(r[n] for n in names[1:])) for r in df.collect())


def table(spark, name, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").select("*").collect()]


def test_tables_against_brute_force(spark, sf_dir):
    texts = [(r[0], r[1]) for r in table(spark, "documents", sf_dir)]
    items = [(r[0], r[1]) for r in table(spark, "benchmark", sf_dir)]
    assert rows_of(QUERIES["op6_decontamination"](spark, sf_dir)) == brute(texts, items)


@pytest.mark.parametrize("index_words", [d.INDEX_WORDS, 40])
def test_repetitive_texts_and_short_items(spark, docs_of, index_words):
    rng = random.Random(3)
    draw = lambda n: " ".join(rng.choice("abcA1") for _ in range(n))
    items = [(i, draw(rng.choice((0, 1, 3, 9, 10, 11, 25)))) for i in range(12)] + [(3, "x y"), (99, None), (None, "q r s")]
    texts = [(i, draw(rng.choice((0, 2, 8, 12, 30, 80)))) for i in range(40)] + [(100, None), (None, "x, y!"), (100, None), (7, "Q r s")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    expected = brute(texts, [i for i in items if i[0] is not None])
    docs = docs_of(*[(i, t, "s") for i, t in texts])
    assert rows_of(d.decontaminate(docs, benchmark, index_words=index_words)) == expected
    kept = d.keep_clean(docs, benchmark, index_words=index_words)
    assert kept.columns == docs.columns and kept.count() == sum(not e[-1] for e in expected)


def test_spans_are_code_points(spark, docs_of):
    benchmark = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id bigint, text string")
    text = "Über ß: ONE two three four five six seven eight nine, tén one two three four five six seven eight nine ten!"
    row = d.decontaminate(docs_of(text), benchmark).first()
    assert [text[s["start"] : s["end"]] for s in row["spans"]] == ["one two three four five six seven eight nine ten"]


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert rows_of(d.decontaminate(docs_of("a b"), none)) == brute([(0, "a b")], [])
    assert d.decontaminate(docs_of(), none).count() == 0
