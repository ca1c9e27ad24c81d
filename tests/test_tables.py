from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from dialogeval.functions import text
from dialogeval.operators import aggregates, entities, filters, generate, joins, projections, reshape
from dialogeval.plans import evaluation, human

# --- Filters, reshape, sets ---------------------------------------------------------------------


def test_dedup_keeps_the_first_row_and_all_columns(spark):
    rows = [(i, "hot" if i % 3 else f"t{i}", i * 10) for i in range(300)] + [(300, None, 0), (301, None, 1)]
    df = spark.createDataFrame(rows, "id int, x string, y int").repartition(7)
    first = {}
    for i, x, y in rows:
        first.setdefault(x, (i, x, y))
    kept = filters.dedup_exact(df, "x", "id")
    assert kept.columns == ["id", "x", "y"]
    assert sorted(map(tuple, kept.collect())) == sorted(first.values())
    narrow = filters.dedup_exact(df.select("id", "x"), "x", "id")
    assert sorted(r.id for r in narrow.collect()) == sorted(v[0] for v in first.values())


def test_wide_to_long_and_back(spark):
    wide = spark.createDataFrame(
        [("1", "s1", "p", "x", "y"), ("2", "s2", "q", None, "z"), ("3", None, "r", "a", "b")],
        "dialog_id string, summary string, dialog string, `summary_by_m-1` string, `summary_by_m.2` string",
    )
    long = reshape.wide_to_long(wide, ["dialog_id", "summary", "dialog"])
    assert sorted((r.dialog_id, r.model, r.model_output) for r in long.collect()) == [
        ("1", "m-1", "x"), ("1", "m.2", "y"), ("2", "m.2", "z"),
    ]
    back = reshape.long_to_wide(long, ["dialog_id", "summary", "dialog"], ["m-1", "m.2"])
    expected = wide.where("summary is not null")
    assert back.columns == wide.columns
    assert sorted(map(str, back.collect())) == sorted(map(str, expected.collect()))


def test_concat_fills_missing_columns(spark):
    a, b = spark.sql("select 1 as x, 'p' as y"), spark.sql("select 2 as x")
    assert sorted(map(tuple, reshape.concat_tables(a, b).collect()), key=str) == [(1, "p"), (2, None)]


def test_set_difference_and_size_with_missing_sets(spark):
    df = spark.sql(
        "select * from values (array('a','a','b'), array('b')), (null, array('b')), (array('a'), null) t(l, r)"
    ).select("l", "r")
    rows = df.select(
        reshape.set_difference(F.col("l"), F.col("r")), reshape.set_size(F.col("l"))
    ).collect()
    assert [(r[0], r[1]) for r in rows] == [(["a"], 3), ([], 0), (["a"], 1)]


def test_identical_outputs(spark):
    rows = [("1", " Yes\n"), ("1", "yes"), ("2", "yes"), ("2", "no"), ("3", "yes"), ("3", None), ("4", None)]
    df = spark.createDataFrame(rows, "dialog_id string, model_output string")
    found = {r.dialog_id: r.identical for r in reshape.identical_outputs(df).collect()}
    assert found == {"1": True, "2": False, "3": False, "4": False}
    wide = spark.createDataFrame(
        [("a", "A "), ("a", "b"), ("a", None), (None, None)], "`x.1` string, y string"
    )
    flags = wide.select(reshape.identical_in_row(["x.1", "y"]).alias("identical"))
    assert [r.identical for r in flags.collect()] == [True, False, False, False]
    assert reshape.any_true(flags, "identical").first()[0] is True


# --- Aggregates ---------------------------------------------------------------------------------


@pytest.mark.parametrize("accuracy, few", [(20, True), (1000, True), (1000, False)])
def test_quantiles_are_exact_on_skewed_values(spark, monkeypatch, accuracy, few):
    monkeypatch.setattr(aggregates, "fits", lambda *args: few)
    rng = random.Random(1)
    groups = {
        "hot": [0.0] * 700 + [rng.random() for _ in range(1301)],
        "one": [0.25],
        "two": [1.0, 2.0],
        "ties": [0.5] * 400,
        "wide": [rng.gauss(0, 1e6) for _ in range(997)],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("hot", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    wanted = {"lo": 0.0, "q25": 0.25, "q50": 0.5, "p99": 0.99, "hi": 1.0}
    found = aggregates.exact_quantiles(df, ["g"], "v", wanted, accuracy=accuracy)
    result = {r.g: r for r in found.collect()}
    assert set(result) == set(groups)
    for g, values in groups.items():
        for name, q in wanted.items():
            assert result[g][name] == pytest.approx(np.quantile(values, q), rel=1e-12), (g, name)


def test_describe_ignores_missing_and_nan(spark):
    df = spark.createDataFrame(
        [("m", 1.0, 5.0), ("m", 2.0, None), ("m", float("nan"), 7.0), ("m", 4.0, 9.0), ("n", 3.0, None)],
        "model string, a double, b double",
    )
    found = {(r.model, r.score): r for r in aggregates.describe_scores(df, ["model"], ["a", "b"]).collect()}
    assert set(found) == {("m", "a"), ("m", "b"), ("n", "a")}
    row = found["m", "a"]
    assert (row["count"], row.min, row.q25, row.q50, row.q75, row.max) == (3, 1.0, 1.5, 2.0, 3.0, 4.0)
    assert row.mean == pytest.approx(7 / 3) and row.std == pytest.approx(np.std([1, 2, 4], ddof=1))
    assert found["n", "a"].std is None


def test_means_skip_nan_and_rows_without_a_model(spark):
    df = spark.createDataFrame(
        [("m", 1.0), ("m", float("nan")), ("m", None), (None, 9.0)], "model string, s double"
    )
    assert [tuple(r) for r in aggregates.mean_by_model(df, ["s"]).collect()] == [("m", 1.0)]
    wide = df.select(F.col("s").alias("a.b"))
    assert aggregates.mean_per_column(wide, ["a.b"], "mean").first().asDict() == {"model": "a.b", "mean": 5.0}


LABELS = [(1, "x", "1"), (2, "y", "2"), (3, "z", "3")]


def test_win_counts_keep_zeros_and_count_ties_only_when_asked(spark):
    labels = spark.createDataFrame(LABELS, "position int, model string, label string")
    votes = spark.createDataFrame(
        list(enumerate(["1", "1", "1, 3", None, "9"])), "dialog_id int, winner string"
    )
    wins = {r.model: r.wins for r in aggregates.win_counts(votes, labels).collect()}
    assert wins == {"x": 2, "y": 0, "z": 0}
    ties = {r.model: r.wins for r in aggregates.win_counts(votes, labels, split_ties=True).collect()}
    assert ties == {"x": 3, "y": 0, "z": 1}
    named = joins.label_to_model(votes, labels)
    assert sorted(r.model for r in named.collect()) == ["x", "x"]


def test_winner_string_reads_the_first_ballots(spark):
    ballots = spark.createDataFrame(
        [(i, None if i == 1 else str(i % 4)) for i in range(10)], "id int, winner string"
    )
    assert aggregates.winner_string(ballots.repartition(4), "id", 5).first()[0] == "0,2,3,0"


# --- Entities -----------------------------------------------------------------------------------


def brute_entities(text, listed):
    text, found = text or "", []
    for name in listed:
        for m in re.finditer(rf"(?<![^\W_]){re.escape(name)}(?![^\W_])", text):
            found.append((m.start(), m.end(), name))
    inside = lambda a, b: b[0] <= a[0] and a[1] <= b[1] and a[:2] != b[:2]
    return sorted({a[2] for a in found if not any(inside(a, b) for b in found)})


def test_entity_scores_against_brute_force(spark):
    gazetteer = [("Ann", "PER"), ("Ann", "ORG"), ("New York", "LOC"), ("Acme", "ORG"), ("Monday", "MISC")]
    rows = [
        ("1", "m", "Ann met Bob in New York", "Ann left Acme"),
        ("2", "m", "nothing here", None),
        ("3", "m", "Monday. Acme", "Acme Monday. Ann. Ann"),
        ("3", "n", "Monday. Acme", "Acme on Monday"),
        ("4", "m", None, "Ann"),
    ]
    df = spark.createDataFrame(rows, "dialog_id string, model string, summary string, model_output string")
    table = spark.createDataFrame(gazetteer, "entity string, type string")
    listed = {e for e, t in gazetteer if t in ("PER", "ORG", "LOC")}
    scored = entities.entity_scores(df, table)
    found = {(r.dialog_id, r.model): r for r in scored.collect()}
    assert scored.columns[:4] == df.columns and len(found) == len(rows)
    for dialog_id, model, summary, output in rows:
        row = found[dialog_id, model]
        given, said = brute_entities(summary, listed), brute_entities(output, listed)
        assert (row.entities_in_summary, row.entities_in_model_output) == (given, said)
        assert sorted(row.hallucinated_entities) == sorted(set(said) - set(given))
        assert sorted(row.missed_entities) == sorted(set(given) - set(said))
        assert row.num_hallucinated_entities == len(set(said) - set(given))
        assert row.num_missed_entities == len(set(given) - set(said))
    totals = aggregates.entity_totals(scored).where("model = 'm'").first()
    assert totals.hallucinated_entities == sum(found[k].num_hallucinated_entities for k in found if k[1] == "m")


def test_entity_types_are_a_parameter(spark):
    df = spark.createDataFrame([("Ann. Monday",), ("Ann. Monday",), (None,)], "text string")
    table = spark.createDataFrame([("Ann", "PER"), ("Monday", "MISC")], "entity string, type string")
    assert [tuple(r) for r in entities.extract_entities(df, table).collect()] == [("Ann. Monday", ["Ann"])]
    misc = entities.extract_entities(df, table, types=["MISC"]).first()
    assert misc.entities == ["Monday"]
    assert entities.extract_entities(df, table, types=["LOC"]).first().entities == []


def test_entities_of_any_form_without_keys(spark):
    table = [("IBM", "ORG"), ("Ann", "PER"), ("Bob", "PER"), ("NATO", "ORG"), ("Ann McDonald", "PER"), ("São Paulo", "LOC"), ("x-ray 2", "ORG"), ("Paulo", "PER")]
    texts = [
        ("IBM hired Ann. Yesterday Bob left. Dr Ann McDonald of NATO", ["Ann", "Ann McDonald", "Bob", "IBM", "NATO"]),
        ("Ann McDonald, Bobby and IBMs", ["Ann McDonald"]),
        ("to São Paulo by x-ray 2", ["São Paulo", "x-ray 2"]),
        ("Paulo; São  Paulo", ["Paulo"]),
        ("", []),
        (None, []),
    ]
    rows = [(None, "m", t) for t, _ in texts] + [("1", None, "Ann"), ("1", None, "Bob")]
    df = spark.createDataFrame(rows, "dialog_id string, model string, text string")
    listed = spark.createDataFrame(table, "entity string, type string")
    expected = sorted([(str(t), e) for t, e in texts] + [("Ann", ["Ann"]), ("Bob", ["Bob"])])
    for limit in (entities.MAX_BROADCAST_BYTES, 0):
        tagged = entities.with_entities(df, ["text"], listed, max_broadcast_bytes=limit)
        assert sorted((str(r.text), r.entities_in_text) for r in tagged.collect()) == expected
    local = entities.with_entities(df, ["text"], listed)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in local


def hot_rows(spark):
    """Two thirds of all rows name one entity, the others one each; some name an unlisted one."""
    letters = F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")
    return spark.range(0, 30_000, numPartitions=8).select(
        F.col("id").alias("dialog_id"),
        F.when(F.col("id") % 3 > 0, "Hot").otherwise(F.concat(F.lit("N"), letters)).alias("text"),
    )


def test_tagging_with_a_large_gazetteer_is_the_same(spark):
    rows = hot_rows(spark)
    table = rows.where("dialog_id % 6 <> 0").select(F.col("text").alias("entity")).distinct()
    table = table.withColumn("type", F.lit("PER"))
    found = []
    for limit in (entities.MAX_BROADCAST_BYTES, 0):
        tagged = entities.with_entities(rows, ["text"], table, max_broadcast_bytes=limit)
        found.append(sorted((r.dialog_id, r.entities_in_text[0]) for r in tagged.collect() if r.entities_in_text))
    assert found[0] == found[1] and len(found[0]) == 25_000


def test_hot_key_is_spread_over_partitions(spark):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = hot_rows(spark)
        table = rows.select("text").distinct().withColumn("n", F.lit(1))
        sizes = {}
        for name, joined in {
            "plain": rows.join(table, "text"),
            "salted": joins.salted_join(rows, table, "text", ["dialog_id"]),
        }.items():
            per_task = joined.groupBy(F.spark_partition_id()).count().collect()
            sizes[name] = sorted(r["count"] for r in per_task)
            assert sum(sizes[name]) == 30_000
        assert sizes["plain"][-1] > 20_000
        assert sizes["salted"][-1] < 8_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_label_lookup_when_the_map_is_not_small(spark, monkeypatch):
    monkeypatch.setattr(joins, "fits", lambda *args: False)
    labels = spark.createDataFrame(LABELS, "position int, model string, label string")
    votes = spark.range(100).select(
        F.col("id").alias("dialog_id"), F.when(F.col("id") < 90, "2").when(F.col("id") < 95, "1").alias("winner")
    )
    counts = joins.label_to_model(votes, labels).groupBy("model").count()
    assert {r.model: r["count"] for r in counts.collect()} == {"y": 90, "x": 5}


# --- Generation and plans -----------------------------------------------------------------------


def test_extractive_models(spark):
    df = spark.createDataFrame([(1, "Bb. Long one. Same len"), (2, "..."), (3, None)], "id int, model_input string")
    found = {(r.id, r.model): r.model_output for r in generate.generate_extractive(df).collect()}
    assert found[1, "org/lead-1"] == "Bb" and found[1, "org/tail-1"] == "Same len"
    assert found[1, "org/longest-1"] == "Long one"
    assert {v for (i, _), v in found.items() if i > 1} == {None} and len(found) == 9


@pytest.mark.parametrize("spread", [None, 3])
def test_predictors_run_on_prompt_messages(spark, spread):
    def build_echo(model_id, settings):
        return lambda inputs: [f"{model_id}:{settings['temperature']}:{m[-1]['content']}" for m in inputs]

    dialogs = spark.createDataFrame([(i, f"#Person1#: t{i % 5}") for i in range(40)], "row_id int, dialogue string")
    prompts = evaluation.prepare_eval_prompts(dialogs).select("row_id", "prompt")
    assert prompts.count() == 5
    out = generate.batch_generate(
        prompts, ["a/x", "b/y"], build_echo, model_input="prompt", row_id="row_id",
        partitions_per_model=spread, temperature=0.2,
    )
    rows = out.collect()
    assert out.columns == ["row_id", "prompt", "model", "model_output"] and len(rows) == 10
    for r in rows:
        assert r.model_output == f"{r.model}:0.2:{r.prompt[-1].content}"


def test_equal_inputs_go_to_a_model_once_and_other_columns_are_untouched(spark):
    def build(model_id, settings):
        assert model_id in ("m", "n")
        return lambda inputs: [f"{model_id}{x}{len(inputs) == len(set(inputs))}" for x in inputs]

    rows = [(2**53 + 1, "a"), (None, "a"), (3, "b"), (4, None)]
    df = spark.createDataFrame(rows, "big bigint, model_input string").repartition(1)
    for distinct in (False, True):
        out = generate.batch_generate(df, ["m", "n"], build, distinct=distinct).collect()
        assert sorted((str(r.big), str(r.model_input), r.model) for r in out) == sorted(
            (str(b), str(x), m) for b, x in rows for m in ("m", "n")
        )
        assert all(r.model_output == f"{r.model}{r.model_input}{distinct}" for r in out)


def test_a_predictor_must_answer_every_input(spark):
    df = spark.createDataFrame([("x",), ("y",)], "model_input string")
    with pytest.raises(Exception, match="1 outputs of"):
        generate.batch_generate(df.repartition(1), ["m"], lambda m, s: lambda inputs: inputs[:1]).collect()


def test_spreading_needs_a_row_id(spark):
    df = spark.createDataFrame([("x",)], "model_input string")
    with pytest.raises(ValueError, match="row_id"):
        generate.batch_generate(df, ["m"], lambda m, s: None, partitions_per_model=2)


def test_prompts_drop_missing_dialogues_and_stop_early(spark):
    dialogs = spark.createDataFrame([(1, None), (2, "b"), (3, "a"), (4, "b")], "row_id int, dialogue string")
    assert sorted(r.row_id for r in evaluation.prepare_eval_prompts(dialogs).collect()) == [2, 3]
    assert [r.row_id for r in evaluation.prepare_eval_prompts(dialogs, first=1).collect()] == [2]


def test_attach_outputs_keeps_prompts_without_output(spark):
    prompts = joins.models_x_prompts(spark.createDataFrame([("1",), ("2",)], "dialog_id string"), ["a", "b"])
    outputs = spark.createDataFrame([("1", "a", "x")], "dialog_id string, model string, model_output string")
    rows = joins.attach_outputs(prompts, outputs).collect()
    assert len(rows) == 4 and sum(r.model_output is None for r in rows) == 3


def test_human_sheet_hides_models(spark):
    rows = [(str(d), f"d{d}", f"s{d}", m, f"{m}{d}") for d in range(30) for m in "xyz"]
    outputs = spark.createDataFrame(
        rows, "dialog_id string, dialog string, summary string, model string, model_output string"
    )
    labels = spark.createDataFrame(LABELS, "position int, model string, label string")
    sheet = human.human_eval_sheet(outputs, labels, ["1", "2", "3"], seed=1, rows=7)
    assert sheet.columns == ["dialog_id", "dialog", "summary", "1", "2", "3"]
    got = sheet.collect()
    assert len(got) == 7 and all(r["2"] == f"y{r.dialog_id}" for r in got)
    view = human.side_by_side(outputs, ["x", "y", "z"], seed=1, rows=4)
    assert view.count() == 4 and "summary_by_z" in view.columns


def test_columns_and_renames(spark):
    df = spark.createDataFrame([(1, 2)], "`a.x` int, b int")
    assert projections.columns_matching(df, "a.") == ["a.x"]
    assert projections.rename_by_map(df, {"b": "c"}).columns == ["a.x", "c"]
    assert df.select(text.py_strip(F.lit(" x "))).first()[0] == "x"


def test_quantiles_sort_small_intervals_only(spark, monkeypatch):
    values = [((i * 7919) % 20_011) / 3 for i in range(20_000)] + [5.0] * 9_000
    df = spark.createDataFrame([("a", v) for v in values] + [("b", float(i % 3)) for i in range(50)], "g string, v double")
    steps, narrowed = [], aggregates._narrowed
    monkeypatch.setattr(aggregates, "_narrowed", lambda *a: steps.append(narrowed(*a)) or steps[-1])
    found = {r.g: r for r in aggregates.exact_quantiles(df, ["g"], "v", {"x": 0.31, "y": 0.5}, accuracy=10, most_sorted=40).collect()}
    assert [found["a"].x, found["a"].y] == pytest.approx(list(np.quantile(values, [0.31, 0.5])), rel=1e-12)
    assert [found["b"].x, found["b"].y] == pytest.approx(list(np.quantile([i % 3 for i in range(50)], [0.31, 0.5])))
    sizes = [s.rows.agg(F.max("_values")).first()[0] for s in steps]
    assert sizes[0] > 40 >= sizes[-1]


def test_no_texts_in_sorted_aggregates(spark):
    rows = [(str(i), f"d{i}", f"s{i}", m, f" Out {m if i % 2 else 'x'}") for i in range(6) for m in ("a", "b")]
    df = spark.createDataFrame(rows, "dialog_id string, dialog string, summary string, model string, model_output string")
    labels = spark.createDataFrame([(1, "a", "1"), (2, "b", "2")], "position int, model string, label string")
    plans = [
        reshape.long_to_wide(df, ["dialog_id", "summary"], ["a", "b"]),
        reshape.identical_outputs(df),
        human.human_eval_sheet(df, labels, ["1", "2"], 3, 4),
        human.side_by_side(df, ["a", "b"], 3, 4),
    ]
    for plan in plans:
        assert "SortAggregate" not in plan._jdf.queryExecution().executedPlan().toString()
    same = {r.dialog_id: r.identical for r in plans[1].collect()}
    assert same == {str(i): i % 2 == 0 for i in range(6)}
    sheet = plans[2].collect()
    assert len(sheet) == 4 and all(r["dialog"] == f"d{r.dialog_id}" and r["summary"] == f"s{r.dialog_id}" for r in sheet)
    assert all(r["1"] == (" Out a" if int(r.dialog_id) % 2 else " Out x") for r in sheet)


def test_long_to_wide_with_missing_and_repeated_outputs(spark):
    rows = [("1", "d", "a", "z"), ("1", "d", "a", "y"), ("1", "d", "b", None), ("2", None, "c", "q"), ("3", "e", "b", "w")]
    df = spark.createDataFrame(rows, "id string, dialog string, model string, model_output string")
    for key in (None, ["id"]):
        wide = reshape.long_to_wide(df, ["id", "dialog"], ["a", "b"], prefix="", key=key)
        assert wide.columns == ["id", "dialog", "a", "b"]
        assert sorted(map(tuple, wide.collect()), key=str) == [("1", "d", "y", None), ("2", None, None, None), ("3", "e", None, "w")]


def test_trie_walks_do_not_depend_on_entry_lengths():
    listed = ["a b c", "b c d e", "c", "e f", " x", "x ", "", "a  b", "x_y"]
    trie = entities.entity_trie(listed)
    assert entities.find_entities("a b c d e f, a  b x_y", trie) == ["a  b", "a b c", "b c d e", "e f", "x_y"]
    assert entities.find_entities("nothing", trie) == entities.find_entities("", trie) == []
    long = entities.entity_trie([" ".join(["w"] * 5000)])
    assert entities.find_entities("w " * 4000, long) == []


def test_filter_drops_runs_before_the_shuffle(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[i : i + 30]) for i in range(0, 370, 10)]
    df = spark.createDataFrame([(t,) for t in texts] * 3, "text string")
    listed = [w for i, w in enumerate(words) if i % 20 == 0] + ["w5 w6 w7", "w101 w102"]
    table = spark.createDataFrame([(w, "PER") for w in listed], "entity string, type string")
    ready = entities.prepare(table, max_broadcast_bytes=0)
    runs = entities.listed_runs(df, ["text"], ready).collect()
    matches = {(bytes(r.digest), r.i, r.j) for r in runs if r.entity in listed}
    assert len(matches) <= len(runs) <= 1.1 * len(matches) + 10  # of three lengths from every word of three copies
    tagged = entities.with_entities(df, ["text"], ready)
    assert all(r.entities_in_text == brute_entities(r.text, listed) for r in tagged.collect())


def test_distinct_texts_are_tagged_once(spark):
    rows = [("1", f"Ann met Bob {i // 4}", f"Bob {i}") for i in range(40)] + [("2", None, "Ann")]
    df = spark.createDataFrame(rows, "_row string, digest_0 string, names string")
    table = spark.createDataFrame([("Ann", "PER"), ("Bob", "PER")], "entity string, type string")
    columns = ["digest_0", "names"]
    assert 1.2 < entities.copies_per_text(df, columns) < 2.2
    found = [
        sorted(map(tuple, entities.with_entities(df, columns, table, distinct=d, max_broadcast_bytes=limit).collect()), key=str)
        for d, limit in ((False, 1 << 20), (True, 1 << 20), (None, 1 << 20), (False, 0))
    ]
    assert found[0] == found[1] == found[2] == found[3]
    assert found[0][0] == ("1", "Ann met Bob 0", "Bob 0", ["Ann", "Bob"], ["Bob"])


def test_central_sentence(spark):
    rows = [
        ("1", "The cat. The zebra sat. the the"),
        ("2", "the cat. the cat"),
        ("3", "... !!! "),
        ("4", None),
        ("5", "the!! . Quark? the\nthe cat sat"),
        ("5", "the!! . Quark? the\nthe cat sat"),
    ]
    df = spark.createDataFrame(rows, "number string, model_input string")
    weights = spark.createDataFrame([("cat", 10), ("zebra", 40), ("the", 1)], "token string, weight bigint")
    expected = [("1", "The zebra sat"), ("2", "the cat"), ("3", "!!!"), ("4", None), ("5", "the cat sat"), ("5", "the cat sat")]
    for limit in (1 << 20, 0):
        given = generate.generate_central(df, weights=weights, max_broadcast_bytes=limit)
        assert given.columns == ["number", "model_input", "model", "model_output"]
        assert sorted((r.number, r.model_output) for r in given.collect()) == expected
    measured = {r.token: r.weight for r in generate.word_weights(df, "model_input").collect()}
    assert measured["zebra"] == round(math.log(5) * 1e6) and measured["the"] == round(math.log(5 / 4) * 1e6)
    own = {r.number: r.model_output for r in generate.generate_central(df).collect()}
    assert own["1"] == "The zebra sat" and own["5"] == "Quark? the"


def central_by_hand(dialogue, weight):
    """The sentence with the highest mean weight, the first of equal ones."""
    said = [x.strip() for x in (dialogue or "").replace("\n", ".").split(".") if x.strip()]
    means = [(sum(weight.get(t, 0) for t in s.split()) / len(s.split()), -i) for i, s in enumerate(said)]
    return said[-max(means)[1]] if said else None


def central_corpus(spark, parts):
    texts = [". ".join(f"w{i % 7} w{(i * j) % 11} w{j} the w{(i + j) % 5}" for j in range(6)) for i in range(90)]
    rows = [(i, t) for i, t in enumerate([*texts, texts[0], None, "", " . \n"])]
    return rows, spark.createDataFrame(rows, "number int, model_input string").repartition(parts)


def looked_up(monkeypatch):
    """Counts the rows that meet the weights."""
    met, join = [], generate.lookup_join
    monkeypatch.setattr(generate, "lookup_join", lambda rows, *a, **b: met.append(rows.count()) or join(rows, *a, **b))
    return met


def test_a_block_looks_up_its_distinct_words_once(spark, monkeypatch):
    met = looked_up(monkeypatch)
    rows, df = central_corpus(spark, 2)
    weight = {r.token: r.weight for r in generate.word_weights(df, "model_input").collect()}
    found = {r.number: r.model_output for r in generate.generate_central(df).collect()}
    assert found == {i: central_by_hand(t, weight) for i, t in rows}
    words = {w for _, t in rows for w in (t or "").replace(".", "").split()}
    assert met[0] <= 2 * len(words)  # not a row for every sentence and word


def test_blocks_meet_weights_too_large_to_broadcast(spark, monkeypatch):
    met = looked_up(monkeypatch)
    rows, df = central_corpus(spark, 3)
    weights = [("the", 5), ("w1", 9), ("w1", 2), ("w4", None), ("w10", 30), (None, 7), ("unheard", 99)]
    table = spark.createDataFrame(weights, "token string, weight bigint")
    summed = {"the": 5, "w1": 11, "w10": 30}
    expected = sorted((i, str(central_by_hand(t, summed))) for i, t in rows)
    for most_rows in (1, 8, 4096):
        monkeypatch.setattr(generate, "MOST_BLOCK_ROWS", most_rows, raising=False)
        found = generate.generate_central(df, weights=table, max_broadcast_bytes=0)
        assert sorted((r.number, str(r.model_output)) for r in found.collect()) == expected
    assert met[0] > met[1] > met[2]  # larger blocks look fewer words up


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_blocks_go_to_more_tasks_than_usual_when_texts_are_large(spark, monkeypatch, limit):
    monkeypatch.setattr(generate, "TASK_BYTES", 1000, raising=False)
    rows, df = central_corpus(spark, 3)
    weight = {"the": 5, "w1": 11, "w10": 30}
    table = spark.createDataFrame([*weight.items()], "token string, weight bigint")
    found = generate.generate_central(df, weights=table, max_broadcast_bytes=limit)
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.number, str(r.model_output)) for r in found.collect()) == sorted((i, str(central_by_hand(t, weight))) for i, t in rows)


def test_spread_grows_with_the_prompts(spark, monkeypatch):
    monkeypatch.setattr(generate, "TASK_BYTES", 10_000, raising=False)
    rows = [(i, f"{i} " + "x" * 400) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id int, model_input string").repartition(1)
    build = lambda m, s: lambda inputs: [f"{m}{len(x)}" for x in inputs]
    run = lambda d: generate.batch_generate(d, ["a"], build, row_id="row_id", partitions_per_model=2)
    sizes = [len(part) for part in run(df).rdd.glom().collect()]
    assert sum(sizes) == 200 and max(sizes) < 60 and len(sizes) == 9
    assert run(df.limit(5)).rdd.getNumPartitions() == 2  # few prompts are spread as asked
    assert sorted(r.model_output for r in run(df).collect()) == sorted(f"a{len(x)}" for _, x in rows)
