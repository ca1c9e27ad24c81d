from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dialogeval.functions.stem import scoring_stem, stem
from dialogeval.operators import bertscore, entities, rouge
from dialogeval.plans import evaluation
from dialogeval.sources import scratch

# Examples printed in Porter (1980), with the results of the complete algorithm.
PORTER = {
    "caresses": "caress", "ponies": "poni", "caress": "caress", "cats": "cat", "agreed": "agre",
    "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat",
    "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall",
    "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi",
    "relational": "relat", "conditional": "condit", "rational": "ration", "digitizer": "digit",
    "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope",
    "formaliti": "formal", "sensitiviti": "sensit", "triplicate": "triplic", "formative": "form",
    "electrical": "electr", "goodness": "good", "revival": "reviv", "allowance": "allow",
    "inference": "infer", "adjustable": "adjust", "replacement": "replac", "adoption": "adopt",
    "activate": "activ", "effective": "effect", "probate": "probat", "rate": "rate", "cease": "ceas",
    "controll": "control", "roll": "roll",
}


@pytest.mark.parametrize("word, expected", PORTER.items())
def test_published_stems(word, expected):
    assert stem(word) == expected


def test_later_additions():
    words = {"ties": "tie", "dies": "die", "tied": "tie", "skies": "sky", "dying": "die", "enjoy": "enjoy",
             "by": "by", "news": "news", "geologi": "geolog", "fully": "fulli", "possibly": "possibl"}
    assert {w: stem(w) for w in words} == words
    assert scoring_stem("was") == "was"


def table_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        above = row[:]
        for j, y in enumerate(b):
            row[j + 1] = above[j] + 1 if x == y else max(row[j], above[j + 1])
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=90), st.lists(st.sampled_from("abcd"), max_size=90))
def test_common_subsequence_against_the_table(a, b):
    assert rouge.common_subsequence_length(a, b) == table_lcs(a, b)
    assert rouge.overlap_f(a, b) == pytest.approx(rouge.overlap_f(b, a))
    assert rouge.overlap_f(a, a) == (1.0 if a else 0.0)


def test_rouge_l_edge_rows(spark):
    rows = [
        ("same", "The cat sat", "the CAT sat!"),
        ("none", "dog", "cat"),
        ("empty", "", "cat"),
        ("symbols", "...", "cat"),
        ("missing", None, "cat"),
        ("stem", "meetings discussed", "meeting discuss"),
    ]
    df = spark.createDataFrame(rows, "id string, model_output string, summary string")
    found = {r.id: r.rouge_l for r in rouge.rouge_l(df).collect()}
    assert found == {"same": 1.0, "none": 0.0, "empty": 0.0, "symbols": 0.0, "missing": None, "stem": 1.0}
    plain = {r.id: r.rouge_l for r in rouge.rouge_l(df, stem=False).collect()}
    assert plain["stem"] == 0.0 and plain["same"] == 1.0


def test_long_texts_are_scored_whole(spark):
    long_text = " ".join(f"w{i}" for i in range(20_000))
    df = spark.createDataFrame([(long_text, long_text + " tail")], "model_output string, summary string")
    score = rouge.rouge_l(df, stem=False).first().rouge_l
    assert score == pytest.approx(2 * 20_000 / 40_001)


def test_stem_vocabulary(spark):
    df = spark.createDataFrame([("Cats cats RUNNING",), (None,), ("...",)], "text string")
    stems = {r.token: r.stem for r in rouge.stem_vocabulary(df, ["text"]).collect()}
    assert stems == {"cats": "cat", "running": "run"}


VECTORS = {"a": [1.0, 0.0], "b": [0.0, 2.0], "c": [3.0, 3.0], "z": [0.0, 0.0]}


def brute_force(said, given):
    said = [np.array(VECTORS[w]) for w in said.split() if w in VECTORS]
    given = [np.array(VECTORS[w]) for w in given.split() if w in VECTORS]
    if not said or not given:
        return 0.0, 0.0, 0.0

    def cosine(x, y):
        size = np.linalg.norm(x) * np.linalg.norm(y)
        return float(x @ y / size) if size else 0.0

    p = np.mean([max(cosine(s, g) for g in given) for s in said])
    r = np.mean([max(cosine(s, g) for s in said) for g in given])
    return p, r, 2 * p * r / (p + r) if p + r > 0 else 0.0


BERT_ROWS = [
    ("1", "a b c", "a b c"),
    ("2", "a a a b", "c unknown"),
    ("3", "unknown", "a"),
    ("4", "", "a"),
    ("5", "a", "b"),
    ("6", "z a", "z"),
    ("7", "c b b", "a b a a"),
]


@pytest.mark.parametrize("limit", [bertscore.MAX_BROADCAST_BYTES, 0], ids=["shipped", "joined"])
def test_bert_score_against_brute_force(spark, limit):
    df = spark.createDataFrame(BERT_ROWS, "dialog_id string, model_output string, summary string")
    df = df.withColumn("model", F.lit("m"))
    vectors = spark.createDataFrame(list(VECTORS.items()), "token string, embedding array<float>")
    scored = bertscore.bert_score(df, vectors, max_broadcast_bytes=limit)
    assert scored.columns == [*df.columns, *bertscore.SCORES]
    found = {r.dialog_id: (r.bert_precision, r.bert_recall, r.bert_f1) for r in scored.collect()}
    for key, said, given_text in BERT_ROWS:
        assert found[key] == pytest.approx(brute_force(said, given_text)), key


@pytest.mark.parametrize("limit", [bertscore.MAX_BROADCAST_BYTES, 0], ids=["shipped", "joined"])
def test_bert_score_of_a_missing_text_is_missing(spark, limit):
    df = spark.createDataFrame(
        [("1", "m", None, "a"), ("2", "m", "a", None)],
        "dialog_id string, model string, model_output string, summary string",
    )
    vectors = spark.createDataFrame(list(VECTORS.items()), "token string, embedding array<float>")
    scored = bertscore.bert_score(df, vectors, max_broadcast_bytes=limit)
    assert [r.bert_f1 for r in scored.collect()] == [None, None]


def test_bert_score_without_any_vectors(spark):
    df = spark.createDataFrame([("1", "m", "a", "a")], "dialog_id string, model string, model_output string, summary string")
    vectors = spark.createDataFrame([], "token string, embedding array<float>")
    for limit in (1, 0, -1):
        assert bertscore.bert_score(df, vectors, max_broadcast_bytes=limit).first().bert_f1 == 0.0


def test_blocks_do_not_change_the_match():
    rng = np.random.default_rng(0)
    said = bertscore.unit_rows(rng.normal(size=(2500, 8)))
    given_rows = bertscore.unit_rows(rng.normal(size=(40, 8)))
    similarity = said @ given_rows.T
    p, r, _ = bertscore.greedy_match(said, np.ones(2500), given_rows, np.ones(40))
    assert p == pytest.approx(similarity.max(axis=1).mean())
    assert r == pytest.approx(similarity.max(axis=0).mean())


def test_both_paths_agree_on_repeated_rows_tokens_and_missing_keys(spark):
    listed = [("sun", [1.0, 0.0]), ("sun", [0.0, 1.0]), ("moon", [0.6, 0.8]), ("odd", [float("nan"), 1.0]), (None, [1.0, 1.0])]
    vectors = spark.createDataFrame(listed, "token string, embedding array<float>")
    rows = [("1", "m", "sun moon", "moon"), ("1", "m", "sun", "moon sun"), ("1", None, "moon", "moon odd"), (None, None, "odd", "sun")]
    df = spark.createDataFrame(rows, "dialog_id string, model string, summary string, model_output string")
    found = []
    for limit in (bertscore.MAX_BROADCAST_BYTES, 0):
        scored = bertscore.bert_score(df, vectors, max_broadcast_bytes=limit).collect()
        found.append(sorted((str(r.dialog_id), str(r.model), r.summary, *(round(r[s], 6) for s in bertscore.SCORES)) for r in scored))
    assert found[0] == found[1] and len(found[0]) == 4
    assert {r[2]: r[-1] for r in found[0]}["odd"] == 0.0 and {r[2]: r[-1] for r in found[0]}["moon"] == 1.0


def test_clashing_columns_keep_their_values(spark):
    df = spark.createDataFrame([(77, "s", "b", "x y", "x")], "_row int, _score string, found string, model_output string, summary string")
    vectors = spark.createDataFrame([("x", [1.0, 0.0]), ("y", [0.0, 1.0])], "token string, embedding array<float>")
    for limit in (bertscore.MAX_BROADCAST_BYTES, 0):
        row = bertscore.bert_score(df, vectors, max_broadcast_bytes=limit).first()
        assert tuple(row)[:5] == (77, "s", "b", "x y", "x") and row.bert_recall == pytest.approx(1.0)


def test_vectors_are_fetched_once_a_block(spark, monkeypatch):
    stored, kept = scratch.through_table, {}
    monkeypatch.setattr(scratch, "through_table", lambda df, name: kept.setdefault(name, stored(df, name)))
    df = spark.createDataFrame([("sun moon sun", f"moon w{i % 3}") for i in range(600)], "model_output string, summary string").coalesce(1)
    vectors = spark.createDataFrame([("sun", [1.0] * 64), ("moon", [0.5] * 64)], "token string, embedding array<float>")
    assert bertscore.bert_score(df, vectors, max_broadcast_bytes=0).count() == 600
    assert kept["block_words"].count() == 5


def test_all_scores_in_one_pass(spark):
    rows = [("1", "m", "Ann saw Bob", "Ann saw the dogs"), ("1", "n", "Ann saw Bob", None), ("2", "m", None, "Bob"), ("2", "n", "", "Ann"),
            ("3", "m", "dogs running", "a dog runs with Bob")]
    df = spark.createDataFrame(rows, "found string, row string, summary string, model_output string")
    listed = spark.createDataFrame([("Ann", "PER"), ("Bob", "PER")], "entity string, type string")
    vectors = spark.createDataFrame([("ann", [1.0, 0.0]), ("dogs", [0.3, 1.0]), ("bob", [0.5, 0.5])], "token string, embedding array<float>")
    for stem in (True, False):
        fused = evaluation.evaluate_outputs(df, listed, vectors, stem=stem)
        assert fused._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
        apart = entities.entity_scores(bertscore.bert_score(rouge.rouge_l(df, stem=stem), vectors), listed)
        assert fused.columns == apart.columns
        assert sorted(map(str, fused.collect())) == sorted(map(str, apart.collect()))
