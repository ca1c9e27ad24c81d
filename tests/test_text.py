from __future__ import annotations

from pyspark.sql import functions as F

from dialogeval import constants as K
from dialogeval.functions import chat, text
from dialogeval.operators import projections

import pytest


def evaluate(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


NASTY = ["", " a ", "\ta\n", "\xa0a　", "\x1ca\x85", "a ", None, "​a", "  ", "a b"]


def test_strip_is_pythons_strip(spark):
    assert evaluate(spark, NASTY, text.py_strip) == [v if v is None else v.strip() for v in NASTY]


def test_whitespace_list_is_complete():
    assert set(K.PY_WHITESPACE) == {c for c in map(chr, range(0x110000)) if c.isspace()}


def test_normalise_text(spark):
    values = ["  ÀB ", "ǅ\n", "İX", "ΑΣ", None]
    assert evaluate(spark, values, text.normalise_text) == [
        v if v is None else v.lower().strip() for v in values
    ]


RESPONSES = ["d", "d **Summary: s", "d **Summary a **Summary b", "**Summary", "", None, "a|b.*c"]


def test_split_response_with_none_one_and_two_markers(spark):
    parts = [v if v is None else v.split("**Summary") for v in RESPONSES]
    assert evaluate(spark, RESPONSES, text.summary_part) == [p and p[-1] for p in parts]
    assert evaluate(spark, RESPONSES, text.dialog_part) == [p and p[0] for p in parts]


def test_strip_markup_glues_lines(spark):
    assert evaluate(spark, ["A: hi\nB: **yo** ", None], text.strip_markup) == ["A hiB yo", None]


def test_strip_speaker_tags(spark):
    values = [
        "#Person1#: Hi\n#Person12#: Yo",
        "#Person1# no colon",
        "#Person٣#:\xa0　: arabic digit",
        "#Person#: none",
        "Person1: x",
        None,
    ]
    assert evaluate(spark, values, text.strip_speaker_tags) == [
        "Hi Yo",
        "no colon",
        "arabic digit",
        "#Person#: none",
        "Person1: x",
        None,
    ]


def test_prompt_and_its_inverse(spark):
    dialogs = ["hello {x} %s \\n $1", " padded ", "", None]
    prompts = evaluate(spark, dialogs, text.build_prompt)
    assert prompts[0].endswith("\n\n **Conversation:** \n\n hello {x} %s \\n $1")
    assert prompts[3] is None
    assert evaluate(spark, prompts, text.recover_dialog) == ["hello {x} %s \\n $1", "padded", "", None]
    one_line = evaluate(spark, dialogs, text.build_prompt_one_line)[0]
    assert one_line.endswith("conversation. **Conversation:** hello {x} %s \\n $1")


def test_model_names(spark):
    assert evaluate(spark, ["org/a-1", "b", "x/y/z"], text.model_short_name) == ["a-1", "b", "z"]
    names = ["summary_by_a", "summary_by_summary_by_b", "c"]
    assert evaluate(spark, names, text.model_from_column) == ["a", "b", "c"]


def test_sentences(spark):
    values = ["One. Two\n\n Three .", "...", "", None, "no stop"]
    assert evaluate(spark, values, text.sentences) == [["One", "Two", "Three"], [], [], None, ["no stop"]]


def test_chat_messages_and_rendering(spark):
    df = spark.createDataFrame([("s", "u", "a"), ("", "u", None)], "s string, u string, a string")
    full = chat.chat_messages(F.col("s"), F.col("u"), F.col("a"))
    rows = df.select(chat.render_chat(full), chat.render_chat(full, add_generation_prompt=True)).collect()
    assert rows[0][0] == (
        "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"
    )
    assert rows[1][1].endswith("<|im_start|>assistant\n<|im_end|>\n<|im_start|>assistant\n")


@pytest.mark.parametrize("system, roles", [("s", ["system", "user"]), ("", ["user"]), (None, ["user"])])
def test_empty_system_prompt_is_left_out(spark, system, roles):
    df = spark.createDataFrame([(system, "u")], "s string, u string")
    prompt = df.select(chat.make_prompt(F.col("u"), F.col("s"))).first()[0]
    assert [m["role"] for m in prompt] == roles


def test_reorder_refuses_missing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert projections.reorder_columns(df, ["b", "a"]).columns == ["b", "a"]
    with pytest.raises(ValueError, match="c"):
        projections.reorder_columns(df, ["a", "c"])
    assert projections.project_keep(df, ["b", "zz"]).columns == ["b"]


def test_expand_struct_and_nan(spark):
    df = spark.sql("select 1 as id, struct(2 as p, 3 as q) as s")
    assert projections.expand_struct(df, "s").columns == ["id", "p", "q"]
    values = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double")
    kept = values.select(projections.missing_to_null(F.col("v"))).collect()
    assert [r[0] for r in kept] == [None, 1.0, None]
