from __future__ import annotations

import random

import numpy as np

from dialogeval.llm import licenses, toxicity
from dialogeval.llm.queries import QUERIES


def corpus(spark, docs_of, n=400, seed=1):
    """Documents of which a third uses words that the others never do, more of them in worse ones; half are labelled."""
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(5, 60))]
        bad = i % 3 == 0
        for _ in range(rng.randrange(1, 7) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(("vile", "Nasty!", f"rotten{rng.randrange(9)}")))
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 1, int(bad)))
    return docs_of(*rows), spark.createDataFrame(labels[: n // 2], "doc_id bigint, quality int, toxic int"), labels


def test_toxicity_on_held_out_rows(spark, docs_of):
    docs, labelled, labels = corpus(spark, docs_of)
    model = toxicity.fit(docs, labelled)
    assert (np.diff(model.thresholds) > 0).all()
    rows = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = labels[200:]
    assert sum(rows[i]["toxic"] == bool(t) for i, _, t in held) >= 0.97 * len(held)
    assert not any(rows[i]["toxic"] for i, _, t in held if not t)
    for r in rows.values():
        assert abs(sum(r["grades"]) - r["expected_severity"]) < 1e-9 and r["grades"] == sorted(r["grades"], reverse=True)
    few = [rows[i]["expected_severity"] for i, _, t in held if t and rows[i]["n_terms"] <= 2]
    many = [rows[i]["expected_severity"] for i, _, t in held if t and rows[i]["n_terms"] >= 5]
    assert np.mean(many) > np.mean(few) + 0.3
    kept = toxicity.keep_clean(docs, labelled)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in rows.items() if not r["toxic"]}


def test_toxicity_edges(spark, docs_of):
    docs = docs_of((1, None, "s"), (1, None, "s"), (None, "vile", "s"), (3, "", "s"))
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1, 1), (1, 1, None), (3, 0, 1), (3, 0, 0)], "doc_id bigint, quality int, toxic int")
    for labels in (none, odd):
        rows = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
        assert len(rows) == 4 and not any(r["toxic"] for r in rows) and {r["expected_severity"] for r in rows} == {0.0}
        assert toxicity.keep_clean(docs, labels).count() == 4
    assert toxicity.score(docs_of(), toxicity.fit(docs, none)).count() == 0


def test_toxicity_of_very_long_texts_and_few_words(spark, docs_of):
    docs, labelled, _ = corpus(spark, docs_of)
    model = toxicity.fit(docs, labelled, max_words=2)
    assert len(model.words) == 2
    model = toxicity.fit(docs, labelled)
    long = "word " * 300_000
    rows = toxicity.score(docs_of(long, long + "vile nasty vile nasty rotten1 rotten2"), model).orderBy("doc_id").collect()
    assert [r["n_terms"] > 0 for r in rows] == [False, True] and rows[1]["p_toxic"] > rows[0]["p_toxic"]


def test_scores_follow_the_weights(docs_of):
    """The scoring part against its formula, from given weights."""
    table = toxicity.batches.word_table()
    data = np.frombuffer(b"vile rot", np.uint8)
    found, _ = toxicity._features(data, np.array([0, len(data)]), table)
    words, weights = np.sort(found[[0, 3]]), np.array([1.5, -0.25])
    by_word = dict(zip(words.tolist(), weights.tolist(), strict=True))
    model = toxicity.Model(words, weights, np.array([0.0, 1.0, 3.0]))
    texts = {0: (), 1: (0,), 2: (3,), 3: (0, 3)}
    rows = toxicity.score(docs_of("x", "Vile vile!", "rot", "rot vile x"), model).collect()
    for r in rows:
        score = sum(by_word[int(found[k])] for k in texts[r["doc_id"]])
        want = [1 / (1 + np.exp(t - score)) for t in model.thresholds]
        assert np.allclose(r["grades"], want) and np.isclose(r["expected_severity"], sum(want)) and r["toxic"] == (want[0] >= 0.5)


def test_toxicity_of_the_labelled_rows(spark, sf_dir):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op7_toxicity"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert not any(r["toxic"] for r in rows if labels.get(r["doc_id"]) == 0)


def test_licences_on_held_out_variations(spark, docs_of):
    held = licenses.variations(["some other words that say nothing at all", "plain prose of a page"], 4, seed=99)
    texts = docs_of(*[t for t, _ in held])
    rows = {r["doc_id"]: r["families"] for r in licenses.scan_licenses(texts).collect()}
    right = false = known = 0
    for i, (_, y) in enumerate(held):
        name = licenses.FAMILIES[y]
        if name == licenses.UNKNOWN:
            false += bool(rows[i])
        else:
            known += 1
            right += rows[i] == [name]
    assert right >= 0.9 * known and false <= 2


def test_licence_spans_and_tables(spark, sf_dir, docs_of):
    notice = "Licensed under CC BY-NC 4.0."
    text = f"ü first line\n  {notice}\n" + "word " * 100 + f"end. {notice} " + "word " * 100 + "\nYou need a driving licence."
    row = licenses.scan_licenses(docs_of(text, None, "")).orderBy("doc_id").collect()
    assert row[0]["families"] == ["cc-by-nc"]
    assert text[row[0]["paragraphs"][0]["start"] : row[0]["paragraphs"][0]["end"]] == notice
    assert [r["n_paragraphs"] for r in row[1:]] == [0, 0]
    assert licenses.scan_licenses(docs_of()).count() == 0
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op4_license_scan"](spark, sf_dir).collect():
        assert bool(r["families"]) == any(c in texts[r["doc_id"]].lower() for c in ("licen", "all rights reserved"))
