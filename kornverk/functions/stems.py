"""Norwegian stems by the published Snowball rules, and the key under which inflected forms of a term meet."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# Vowels, endings and the letters that may stand before a final s.
_VOWELS = "aeiouyæåø"
_ENDINGS = sorted("a e ede ande ende ane ene hetene en heten ar er heter as es edes endes enes hetenes ens hetens ers ets et het ast s erte ert".split(), key=len, reverse=True)
_DERIVED = sorted("leg eleg ig eig lig elig els lov elov slov hetslov".split(), key=len, reverse=True)
_BEFORE_S = frozenset("bcdfghjlmnoprtvyz")


def _region(word: str) -> int:
    """Where the region begins in which endings are taken off: after the first consonant behind a vowel, three letters in at least."""
    for i in range(1, len(word)):
        if word[i] not in _VOWELS and word[i - 1] in _VOWELS:
            return max(i + 1, 3)
    return len(word)


@lru_cache(100_000)
def stem(word: str) -> str:
    word = word.lower()
    start = _region(word)
    ending = next((e for e in _ENDINGS if word.endswith(e) and len(word) - len(e) >= start), "")
    if ending in ("erte", "ert"):
        word = word[: -len(ending)] + "er"
    elif ending == "s":
        before = word[:-1]
        if before and (before[-1] in _BEFORE_S or before[-1] == "k" and len(before) > 1 and before[-2] not in _VOWELS):
            word = before
    elif ending:
        word = word[: -len(ending)]
    if word.endswith(("dt", "vt")) and len(word) - 2 >= start:
        word = word[:-1]
    ending = next((e for e in _DERIVED if word.endswith(e) and len(word) - len(e) >= start), "")
    return word[: -len(ending)] if ending else word


def stem_key(term: str | None) -> str | None:
    """The hyphen parts lower-cased and stemmed; numbers stay as they are."""
    if term is None:
        return None
    return "-".join(p if not p or p.isnumeric() else stem(p) for p in term.lower().split("-"))


@pandas_udf(T.StringType())
def _stem_keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(stem_key, na_action="ignore")


def stem_key_of(c: Column | str) -> Column:
    """``stem_key`` of a column; call it on distinct terms."""
    return _stem_keys(c)
