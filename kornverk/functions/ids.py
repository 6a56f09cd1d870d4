"""Identifiers and their order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, strip

_NUMBERED = r"(?s)^(.*)_(\d+)$"
#: The generation of an id that has none.
LAST_GENERATION = 10**9


def normalize_identifier(c: Column | str) -> Column:
    """Lower case, only the letters a-z, æ, ø and å; å written with a combining ring counts."""
    ring = F.replace(F.lower(strip(c)), F.lit("a\u030a"), F.lit("å"))
    return F.regexp_replace(ring, "[^a-zæøå]", "")


def base36(c: Column | str, width: int = 3) -> Column:
    """Lower-case base 36, padded with zeros, never cut."""
    digits = F.lower(F.conv(_col(c).cast("string"), 10, 36))
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def term_id(normalized: Column | str, number: Column | str, width: int = 3) -> Column:
    """The first six letters, or ``term``, and the number in base 36."""
    head = F.substring(_col(normalized), 1, 6)
    return F.concat(F.when(head == "", "term").otherwise(head), F.lit("_"), base36(number, width))


def prompt_id(term: Column | str, number: Column | str) -> Column:
    return F.format_string("%s_%03d", _col(term), _col(number).cast("bigint"))


def id_prefix(c: Column | str) -> Column:
    """What stands before the last ``_`` and digits; null where an id doesn't end so."""
    return F.when(_col(c).rlike(_NUMBERED), F.regexp_extract(_col(c), _NUMBERED, 1))


def id_number(c: Column | str) -> Column:
    return F.when(_col(c).rlike(_NUMBERED), F.regexp_extract(_col(c), _NUMBERED, 2).try_cast("bigint"))


def generation(c: Column | str) -> Column:
    return F.coalesce(id_number(c), F.lit(LAST_GENERATION).cast("bigint"))


def generation_prefix(c: Column | str) -> Column:
    return F.coalesce(id_prefix(c), F.lit(""))


def record_id(c: Column | str, file: Column | str, line: Column | str) -> Column:
    """The id as text, else ``<file>:<line>``."""
    return F.coalesce(_col(c).cast("string"), F.concat(_col(file), F.lit(":"), _col(line).cast("string")))
