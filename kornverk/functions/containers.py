"""The text of a stored answer, read in the ways the steps of the pipeline read it; they accept different things on purpose."""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .text import _col

_BAD_ESCAPE = re.compile(r'\\([^"\\/bfnrtu])')
_LITERAL_START = re.compile(r'"text".*?:\s*', re.S)
_AFTER_LITERAL = re.compile(r"\s*")


def _object(value: str, parse: Callable[[str], object]) -> dict | None:
    """The object in ``value``; None for anything else. Raises ValueError where it can't be parsed."""
    try:
        got = parse(value)
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError) as e:
        raise ValueError(str(e)) from None
    return got if isinstance(got, dict) else None


def _own_text(got: dict | None) -> str | None:
    text = got.get("text") if got else None
    return text if isinstance(text, str) else None


def literal_text(value: str | None) -> tuple[bool, str | None]:
    """(whether it is a Python dict literal, its ``text``)."""
    try:
        got = None if value is None else _object(value, ast.literal_eval)
    except ValueError:
        got = None
    return got is not None, _own_text(got)


def answer_text(result: str | None, response: str | None = None, text: str | None = None) -> str | None:
    """The first of ``text``, ``result`` and ``response`` with a text; what isn't JSON is itself the text, JSON without one has none."""
    if text is not None:
        return text
    for value in (result, response):
        if value is None:
            continue
        try:
            found = _own_text(_object(value, json.loads))
        except ValueError:
            return value
        if found is not None:
            return found
    return None


def _adjacent_literals(value: str) -> str | None:
    """The string literals after the key ``text``, with a space between any two that have none."""
    m = _LITERAL_START.search(value)
    if not m:
        return None
    decoder, at, found = json.JSONDecoder(), m.end(), ""
    seen = False
    while value[at : at + 1] == '"':
        try:
            part, at = decoder.raw_decode(value, at)
        except ValueError:
            return None
        gap = " " if found and part and not found[-1].isspace() and not part[0].isspace() else ""
        found, seen = found + gap + part, True
        at = _AFTER_LITERAL.match(value, at).end()
    return found if seen and value[at : at + 1] in ("", "}", ",") else None


def recovered_text(value: str | None) -> str | None:
    """JSON, else JSON without its invalid escapes, else adjacent string literals."""
    if value is None:
        return None
    repaired = _BAD_ESCAPE.sub(r"\1", value)
    try:
        return _own_text(_object(value, json.loads))
    except ValueError:
        pass
    if repaired != value:
        try:
            found = _own_text(_object(repaired, json.loads))
        except ValueError:
            found = None
        if found is not None:
            return found
    first = _adjacent_literals(value)
    return first if first is not None else _adjacent_literals(repaired)


def spoken_output(value: str | None) -> tuple[str | None, str | None]:
    """(the string under ``output``, or what is wrong with the answer)."""
    if value is None or not value.strip():
        return None, "empty response"
    try:
        got = _object(value, json.loads)
    except ValueError:
        inner = re.search(r"\{.*\}", value, re.S)
        if not inner:
            return None, "no valid JSON"
        try:
            got = _object(inner.group(), json.loads)
        except ValueError as e:
            return None, f"no valid JSON: {e}"
    if got is None:
        return None, "JSON is not an object"
    out = got.get("output")
    return (out, None) if isinstance(out, str) else (None, "no string output")


@pandas_udf(T.StructType([T.StructField("valid", T.BooleanType()), T.StructField("text", T.StringType())]))
def _literal(values: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for s in values:
        yield pd.DataFrame([literal_text(v) for v in s], columns=["valid", "text"])


@pandas_udf(T.StringType())
def _answer(values: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for three in values:
        yield pd.Series([answer_text(*row) for row in zip(*three)], dtype=object)


@pandas_udf(T.StringType())
def _recovered(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in values:
        yield pd.Series([recovered_text(v) for v in s], dtype=object)


@pandas_udf(T.StructType([T.StructField("output", T.StringType()), T.StructField("error", T.StringType())]))
def _spoken(values: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for s in values:
        yield pd.DataFrame([spoken_output(v) for v in s], columns=["output", "error"])


def literal_text_of(c: Column | str) -> Column:
    """struct<valid, text> by ``literal_text``."""
    return _literal(_col(c))


def answer_text_of(result: Column | str, response: Column | None = None, text: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return _answer(_col(result), none if response is None else response, none if text is None else text)


def recovered_text_of(c: Column | str) -> Column:
    return _recovered(_col(c))


def spoken_output_of(c: Column | str) -> Column:
    """struct<output, error> by ``spoken_output``."""
    return _spoken(_col(c))


def text_written_back(text: Column | str) -> Column:
    """The stored form of a changed text: an object with nothing but ``text``."""
    return F.to_json(F.struct(_col(text).alias("text")))
