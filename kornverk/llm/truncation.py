"""Texts that were cut at a field limit or in a transfer.

A hashed logistic regression over the closing characters, the punctuation of the text and its distance to a limit. Positives
are made by cutting intact values at random places that end no sentence; intact values, and texts without any end
marks, are negatives. A bounded sample of values trains it, once; every record is then scored. Limits aren't given: a length
at which many more texts of one source end openly than at the lengths around it is one, counted over all records.
"""

from __future__ import annotations

import random
import re
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..arrow import map_columns, one_delivery
from .sentences import spans
from .text import CUT, OBJECT, result_text

#: About so many rows train the classifier, chosen by a hash; twice as many at most.
SAMPLE = 4000
DIM = 1 << 18

_MARKS = ".!?…。！？؟।॥｡"
_CLOSERS = "”’')]」』»\"“`*_"
_QUOTES = (("«", "»"), ("„", "“"), ("「", "」"), ("『", "』"))
_LAST = re.compile(r"(\S*?)([^\w\s]*)\Z")
_DIGITS = re.compile(r"\d+")
_WORDY = re.compile(r"[^\W_]")


@lru_cache(200_000)
def _slot(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) % DIM


def _end_class(s: str) -> str:
    """What the stripped text ends with."""
    if s.endswith(("...", "…")):
        return "dots"
    core = s.rstrip(_CLOSERS)
    c = core[-1:] or s[-1]
    if c == ";" and any("Ͱ" <= x <= "Ͽ" for x in core[-30:]):
        return "mark"
    if c in _MARKS:
        return "mark" if core == s else "mark quoted"
    if core != s:
        return "closer"
    return "letter" if c.isalpha() else "digit" if c.isdigit() else "lost" if c == "�" else f"other {c}"


def is_open(s: str) -> bool:
    """Whether a stripped text ends in a letter, digit, lost character or dots; for the search of limits."""
    return _end_class(s) in ("letter", "digit", "lost", "dots")


def _shares(s: str, at: list[tuple[int, int]]) -> str:
    """How many of the sentences before the last end with a mark."""
    before = at[:-1]
    marked = sum(s[b - 1] in _MARKS or s[b - 1] in _CLOSERS or s[b - 1] == ";" for _, b in before)
    return "none" if not before or not marked else "few" if 3 * marked < len(before) else "some" if 3 * marked < 2 * len(before) else "most"


def features(s: str, kind: str, at: list[tuple[int, int]]) -> list[int]:
    """Slots of a stripped text without those of its limit."""
    end, share = _end_class(s), _shares(s, at)
    word, tail = _LAST.match(s, max(map(s.rfind, " \n\t\xa0")) + 1).groups()
    word = _DIGITS.sub("0", word[-40:].lower())
    low = _DIGITS.sub("0", s[-12:].lower())
    balance = sum(s.count(a) - s.count(b) for a, b in _QUOTES if a in s)
    last = s[at[-1][0] :] if at else s
    # behind an end mark only the whole word tells an abbreviation from an end; its letters would also fit other words
    near = [f"w {word}{tail}|{balance > 0}", f"q {balance > 0}|{end}", "-", "--", "---"] if end.startswith("mark") else [f"c1 {low[-1:]}", f"c2 {low[-2:]}", f"c3 {low[-3:]}", f"l {min(len(last) // 20, 4)}|{end}", f"q {balance > 0}|{end}"]
    names = ["bias", f"e {end}", f"s {share}", f"es {end}|{share}", f"k {kind == CUT}", f"ks {kind == CUT}|{end}|{share}", f"n {min(len(at), 2)}|{end}|{share}", *near]
    return [_slot(n) for n in names]


def limit_features(s: str, at_limit: bool) -> list[int]:
    return [_slot(f"lim {at_limit}"), _slot(f"lim {at_limit}|{_end_class(s)}")]


def _examples(s: str, rng: random.Random) -> list[tuple[str, str, bool, bool]]:
    """(text, kind, at a limit, cut) of examples made from one intact text."""
    at = spans(s)
    if len(at) < 2:
        return []
    ends = {b for _, b in at}
    out = [(s, CUT if rng.random() < 0.02 else OBJECT, rng.random() < 0.03, False)]
    places = [n for n in (rng.randrange(len(s) // 4, len(s)) for _ in range(2)) if s[:n].rstrip() and len(s[:n].rstrip()) not in ends and at[0][1] < n]
    dotted = [m.end() for m in re.finditer(r"\.(?=\s)", s) if m.end() not in ends and at[0][1] < m.end()]
    if dotted:
        places += [rng.choice(dotted)]
    for n in places:
        part, kind, how = s[:n].rstrip(), OBJECT, rng.random()
        if how < 0.2:
            kind = CUT
        elif how < 0.3 and part[-1].isalnum():
            part += "�" if how < 0.25 else "..."
        out.append((part, kind, kind == OBJECT and rng.random() < 0.5, True))
    if rng.random() < 0.25:  # the same without any end marks, as a whole and cut: such texts are written so
        bare = "\n".join(s[a:b].rstrip(_MARKS + _CLOSERS) for a, b in at)
        out.append((bare, OBJECT, rng.random() < 0.1, False))
        out.append((bare[: rng.randrange(len(bare) // 2, len(bare))].rstrip(), OBJECT, rng.random() < 0.3, False))
    return [x for x in out if x[0]]


def train(texts: list[str], seed: int = 42, rounds: int = 300) -> np.ndarray:
    """Weights from intact texts; the same for the same texts."""
    rng = random.Random(seed)
    rows, labels = [], []
    for s in texts:
        for part, kind, at_limit, cut in _examples(s, rng):
            rows.append(features(part, kind, spans(part)) + limit_features(part, at_limit))
            labels.append(cut)
    if not rows:
        return np.zeros(DIM)
    x, y = np.array(rows), np.array(labels, np.float64)
    flat, w, grown = x.ravel(), np.zeros(DIM), np.full(DIM, 1e-6)
    width = x.shape[1]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(w[x].sum(1), -30, 30)))
        g = np.bincount(flat, np.repeat(p - y, width), DIM) / len(y) + 1e-5 * w
        grown += g * g
        w -= 0.5 * g / np.sqrt(grown)
    return w


def _intact(raw: str | None) -> str | None:
    text, kind = result_text(raw)
    s = (text or "").strip()
    return s if s and kind != CUT and _end_class(s).startswith("mark") else None


def trained(df: DataFrame, key: str, result: str, sample: int = SAMPLE) -> list[float]:
    """Weights from about ``sample`` rows, twice as many at most, whose hashes lie below a bound set by the number of rows."""
    rows = df.where(F.col(key).isNotNull() & F.col(result).isNotNull()).select(F.xxhash64(F.col(key), F.length(result)).alias("h"), F.col(result).alias("r"))
    n = rows.count()
    share = min(1.0, sample / max(n, 1))
    chosen = rows.where(F.col("h") <= F.lit(int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1)).limit(2 * sample).collect()
    return train([s for x in sorted(chosen) if (s := _intact(x.r))]).tolist()


def score_text(text: str | None, kind: str, at: list[tuple[int, int]], w: list[float]) -> tuple[int, bool, float, float] | None:
    """(length, open, score away from a limit, score at one), above 0 if cut; None for a text without letters or digits.

    A text with no end mark at any of its sentences isn't cut, as it is written so; the last one's doesn't count.
    """
    if not text or not _WORDY.search(text):
        return None
    s = text.strip()
    base = sum(w[i] for i in features(s, kind, at))
    away, near = (base + sum(w[i] for i in limit_features(s, x)) for x in (False, True))
    return len(text), is_open(s), away, near


def with_limits(scores: DataFrame, around: int = 15, times: int = 4, least: int = 3) -> DataFrame:
    """``scores`` (source, length, open, away, near, ...) with ``cut``: by ``near`` where the length is a limit of its source.

    A length is a limit where ``least`` texts or more end openly, ``times`` as many as at the lengths ``around`` it on average.
    """
    counts = scores.groupBy("source", "length").agg(F.count_if("open").alias("n")).where("n > 0")
    w = Window.partitionBy("source").orderBy("length").rangeBetween(-around, around)
    limit = counts.withColumn("rest", (F.sum("n").over(w) - F.col("n")) / (2 * around)).where((F.col("n") >= least) & (F.col("n") >= times * F.col("rest"))).select(F.col("source").alias("_s"), F.col("length").alias("_l"), F.lit(True).alias("at_limit"))
    joined = scores.join(limit, F.col("source").eqNullSafe(F.col("_s")) & (F.col("length") == F.col("_l")), "left").drop("_s", "_l")
    return joined.withColumn("cut", F.when(F.col("at_limit"), F.col("near") > 0).otherwise(F.col("away") > 0))


def truncation(df: DataFrame, key: str, result: str, source: str, sample: int = SAMPLE) -> DataFrame:
    """(key, source, cut) of every record whose text has a letter or digit.

    Deliveries of one key count once; of unequal ones the smallest in (length, open, score, source) stands. Null keys and
    results, and blank texts, have no row; a null source is a source of its own. An empty table gives an empty result.
    """
    weights = df.sparkSession.sparkContext.broadcast(trained(df, key, result, sample))
    kind = dict(df.dtypes)[key]

    def run(c: dict) -> dict:
        out: dict[str, list] = {n: [] for n in ("k", "source", "length", "open", "away", "near")}
        for k, raw, source in zip(c["k"], c["r"], c["source"]):
            text, how = result_text(raw)
            if text and (got := score_text(text, how, spans(text.strip()), weights.value)):
                for name, v in zip(out, (k, source, *got)):
                    out[name].append(v)
        return out

    rows = df.select(F.col(key).alias("k"), F.col(result).alias("r"), F.col(source).alias("source")).where("k IS NOT NULL AND r IS NOT NULL")
    scores = map_columns(rows, run, f"k {kind}, source string, length int, open boolean, away double, near double")
    one = one_delivery(scores, "k", "length", "open", "away", "near", "source")
    return with_limits(one).select(F.col("k").alias(key), F.col("source").alias(source), "cut")


def share_by_source(cut: DataFrame, source: str) -> DataFrame:
    """(source, records, cut_records, cut_share) of the result of ``truncation``."""
    return cut.groupBy(source).agg(F.count("*").alias("records"), F.count_if("cut").alias("cut_records")).withColumn("cut_share", F.col("cut_records") / F.col("records"))
