"""Text functions as Column expressions; white space, words and digits are those of Python's str and re."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space as Python strips and splits it.
SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"
_ENDS = rf"^{SPACE}+|{SPACE}+$"
_SENTENCE_GAP = rf"(?<=[.!?]){SPACE}+"
_SENTENCE_GAP_QUOTED = rf"(?:(?<=[.!?])|(?<=[.!?]['»’])){SPACE}+"
#: The letters and digits that terms and phrases may have.
_ALLOWED = "0-9A-Za-zÆØÅæøå"
_PHRASE_BAD = rf"[^{_ALLOWED} ,\-−]"
_TERM_NO_NUMBER = rf"^(?!\d+(-\d+)*$)[{_ALLOWED}-]+$"
#: What any chemical name has.
_CHEMICAL_HINT = r"\S-\S|\d,\d|(?iu:alfa|beta|gamma|delta|epsilon|kappa)"
#: Marks of chemical names.
_CHEMICAL = {
    "plain range": r"^\d+[-,]\d+$",
    "prefix": r"^(cis|trans|ortho|para|meta|[NOLSD])-[a-z0-9]",
    "bond": r"(?iu)[A-Za-zÆØÅæøå]-\d+(,\d+)*-[A-Za-zÆØÅæøå]",
    "suffix": r"(?iuU)(ase|yl|id|at|in|an|ol|en)\b",
    "structure": r"(?iu)(\d+,\d+|alfa|beta|gamma|delta|epsilon|kappa)",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), _ENDS, "")


def is_blank(c: Column | str) -> Column:
    """True for null too."""
    return F.coalesce(strip(c) == "", F.lit(True))


def _filled(parts: Column) -> Column:
    return F.filter(parts, lambda x: x != "")


def split_space(c: Column | str) -> Column:
    return _filled(F.split(_col(c), rf"{SPACE}+"))


def sentences(c: Column | str) -> Column:
    """Split after ``.``, ``!`` or ``?`` with white space; a text without such a gap is one sentence."""
    return F.split(_col(c), _SENTENCE_GAP)


def sentences_quoted(c: Column | str) -> Column:
    """Like ``sentences``, with a closing quote after the mark too; parts are stripped, blank ones dropped; a blank text gives itself."""
    s = strip(c)
    parts = _filled(F.transform(F.split(s, _SENTENCE_GAP_QUOTED), strip))
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(s))


def phrase_candidates(c: Column | str) -> Column:
    """What stands in parentheses, then the parts between colons and ``" - "``; the parentheses stay in those parts."""
    c = _col(c)
    inside = F.transform(F.regexp_extract_all(c, F.lit(r"\(([^)]+)\)"), 1), strip)
    parts = F.flatten(F.transform(F.split(c, ":"), lambda p: F.transform(F.split(strip(p), " - "), strip)))
    return _filled(F.concat(inside, parts))


def clean_phrase(c: Column | str) -> Column:
    """Stripped, ``%`` spelt out; null if blank or with other characters than letters, digits, space, comma, hyphen and minus."""
    s = F.replace(strip(c), F.lit("%"), F.lit("prosent"))
    return F.when((s != "") & ~s.rlike(_PHRASE_BAD), s)


def is_complex_chemical(c: Column | str) -> Column:
    c = _col(c)
    has = {k: c.rlike(p) for k, p in _CHEMICAL.items()}
    hyphens = F.length(c) - F.length(F.replace(c, F.lit("-"), F.lit("")))
    long_name = (F.length(c) > 12) & (hyphens >= 2) & c.rlike(r"\d")
    return ~has["plain range"] & (has["prefix"] | has["bond"] | (has["suffix"] & has["structure"]) | long_name)


def tokens(c: Column | str) -> Column:
    """Words with hyphens kept: no numbers, and none with letters outside the alphabet of terms. Chemical names are taken apart.

    Only texts that have a chemical name are taken apart and joined again; all others are split once.
    """
    chemical = lambda t: t.rlike(_CHEMICAL_HINT) & is_complex_chemical(t)
    space = split_space(c)
    apart = F.array_join(F.transform(space, lambda t: F.when(chemical(t), F.regexp_replace(t, rf"[^{_ALLOWED}]+", " ")).otherwise(t)), " ")
    plain = F.when(_col(c).rlike(_CHEMICAL_HINT) & F.exists(space, chemical), apart).otherwise(_col(c))
    bare = F.transform(F.split(plain, r"[^\p{L}\p{N}_-]+"), lambda t: F.btrim(t, F.lit("-")))
    return F.filter(bare, lambda t: t.rlike(_TERM_NO_NUMBER))


def sentence_tokens(c: Column | str) -> Column:
    """array<struct<token, start>>: the tokens of all sentences in order; ``start`` marks the first that is left of its sentence."""
    per = F.transform(sentences(c), tokens)
    return F.flatten(F.transform(per, lambda ts: F.transform(ts, lambda t, i: F.struct(t.alias("token"), (i == 0).alias("start")))))


def is_titlecase(c: Column | str) -> Column:
    """The first letter upper case, the rest lower case with at least one letter."""
    rest = F.substring(_col(c), 2, 1_000_000)
    return _col(c).rlike(r"^\p{Lu}") & rest.rlike(r"\p{Ll}") & ~rest.rlike(r"[\p{Lu}\p{Lt}]")


def is_lower(c: Column | str) -> Column:
    return _col(c).rlike(r"\p{Ll}") & ~_col(c).rlike(r"[\p{Lu}\p{Lt}]")


def hyphen_candidates(c: Column | str) -> Column:
    """Runs of hyphen parts shorter than the whole, by start and then end: of three characters or more, with a letter, each once."""
    parts = _filled(F.split(_col(c), "-"))
    n = F.size(parts)
    runs = F.flatten(F.transform(parts, lambda _, i: F.transform(F.slice(parts, i + 1, n), lambda __, j: F.struct(i.alias("i"), j.alias("j"), F.array_join(F.slice(parts, i + 1, j + 1), "-").alias("s")))))
    kept = F.filter(runs, lambda r: (r["j"] + 1 < n) & (F.length(r["s"]) >= 3) & r["s"].rlike(r"\p{L}"))
    return F.when(n >= 2, F.array_distinct(F.transform(kept, lambda r: r["s"]))).otherwise(F.array().cast("array<string>"))


def has_forbidden_speech_chars(c: Column | str) -> Column:
    return _col(c).rlike("[0-9-]")


def without_invalid_escapes(c: Column | str) -> Column:
    """Backslashes before what JSON can't escape are dropped."""
    return F.regexp_replace(_col(c), r'\\([^"\\/bfnrtu])', "$1")


def fill_template(template: Column | str, values: dict[str, Column | str]) -> Column:
    """``${name}`` and ``$name`` replaced, ``$$`` as one dollar; a name without a value, or a stray dollar, raises an error, extra values don't matter."""
    text = _col(template)
    mark, held = "\ue000", "\ue001"
    text = F.replace(text, F.lit("$$"), F.lit(held))
    text = F.regexp_replace(text, r"\$(?:\{([A-Za-z_][A-Za-z0-9_]*)\}|([A-Za-z_][A-Za-z0-9_]*))", mark + "$1$2" + mark)
    text = F.when(text.contains("$"), F.raise_error(F.concat(F.lit("stray dollar in template: "), _col(template)))).otherwise(text)
    pieces = F.split(text, mark)  # names at odd places, so that values are never read as names
    known = reduce(lambda rest, kv: (lambda x, k=kv[0], v=kv[1], r=rest: F.when(x == k, _col(v)).otherwise(r(x))), values.items(), lambda x: F.raise_error(F.concat(F.lit("template has no value for "), x)).cast("string"))
    return F.array_join(F.transform(pieces, lambda x, i: F.when(i % 2 == 1, known(x)).otherwise(F.replace(x, F.lit(held), F.lit("$")))), "")
