"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialogeval import constants as K


def py_strip(text: Column) -> Column:
    """Trim every code point Python counts as whitespace (Spark's `trim` only removes blanks)."""
    return F.btrim(text, F.lit(K.PY_WHITESPACE))


def normalise_text(text: Column) -> Column:
    """Lower-case and strip, the form in which two outputs are compared."""
    return py_strip(F.lower(text))


def summary_part(response: Column) -> Column:
    """Text after the last summary marker; the whole text when there is none."""
    return F.split_part(response, F.lit(K.SUMMARY_MARKER), F.lit(-1))


def dialog_part(response: Column) -> Column:
    """Text before the first summary marker; the whole text when there is none."""
    return F.split_part(response, F.lit(K.SUMMARY_MARKER), F.lit(1))


def strip_markup(text: Column) -> Column:
    """Delete newlines, asterisks and colons (lines are glued, not spaced), then strip."""
    for char in K.MARKUP_CHARS:
        text = F.replace(text, F.lit(char), F.lit(""))
    return py_strip(text)


def strip_speaker_tags(text: Column) -> Column:
    """Remove `#Person<n>#` tags with the colons and blanks behind them; newlines become blanks."""
    return F.replace(F.regexp_replace(text, K.SPEAKER_TAG_PATTERN, ""), F.lit("\n"), F.lit(" "))


def build_prompt(dialog: Column) -> Column:
    return F.concat(F.lit(K.PROMPT_PREFIX), dialog)


def build_prompt_one_line(dialog: Column) -> Column:
    return F.concat(F.lit(K.PROMPT_PREFIX_ONE_LINE), dialog)


def recover_dialog(prompt: Column) -> Column:
    """Inverse of `build_prompt` for dialogs that do not themselves contain the separator."""
    return py_strip(F.split_part(prompt, F.lit(K.DIALOG_SEPARATOR), F.lit(-1)))


def model_short_name(model_id: Column) -> Column:
    """`org/name` -> `name`."""
    return F.substring_index(model_id, "/", -1)


def model_from_column(column_name: Column) -> Column:
    """`summary_by_name` -> `name`; every occurrence of the prefix text goes."""
    return F.replace(column_name, F.lit(K.OUTPUT_COLUMN_PREFIX), F.lit(""))


def sentences(text: Column) -> Column:
    """Non-blank stripped pieces between full stops and newlines."""
    pieces = F.transform(F.split(text, r"[.\n]"), py_strip)
    return F.filter(pieces, lambda piece: piece != "")


def words(text: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits, joined by single blanks."""
    return F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))
