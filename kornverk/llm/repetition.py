"""Repetition inside a single document, by suffix arrays.

The words of a group of documents form one integer text; windows never cross a document. Prefix doubling ranks all its
suffixes with vectorised sorts; neighbours in the suffix array give the longest common prefixes, whose intervals are the
maximal repeated runs. All but the first place of a run are repeated, and their spans are united.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arrow import map_columns, one_delivery
from .text import result_text, words


#: Words of the documents that share one suffix array; a longer document has one of its own. The result doesn't depend on it.
GROUP_WORDS = 200_000


def _dense(a: np.ndarray) -> tuple[np.ndarray, int]:
    u, inv = np.unique(a, return_inverse=True)
    return inv.astype(np.int64), len(u)


def repeated(lists: list[list[str]], run: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Of each list of words: how many words lie in a run of ``run`` words that already occurred, and the longest repeat."""
    covered, longest = np.zeros(len(lists), np.int64), np.zeros(len(lists), np.int64)
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    active = np.flatnonzero(sizes > run)
    if not len(active):
        return covered, longest
    ids: dict[str, int] = {}
    word = np.fromiter((ids.setdefault(w, len(ids)) for d in active for w in lists[d]), np.int64)
    doc = np.repeat(active, sizes[active])
    step, levels = 1, []
    rank, n_ranks = _dense(doc * (len(ids) + 1) + word)
    while True:
        if step >= 4 or step >= run:  # documents whose windows all differ are done, where windows are no longer than a run
            twice = np.bincount(rank, minlength=n_ranks)[rank] > 1
            if step <= run:
                keep = np.zeros(len(lists), bool)
                keep[doc[twice]] = True
                m = keep[doc]
                if not m.all():
                    word, doc, rank, levels = word[m], doc[m], rank[m], [x[m] for x in levels]
                    if not len(doc):
                        return covered, longest
            if not twice.any():
                levels.append(rank)
                break
        levels.append(rank)
        n = len(doc)
        nxt = np.zeros(n, np.int64)
        if step < n:
            inside = doc[step:] == doc[:-step]
            nxt[:-step][inside] = rank[step:][inside] + 1
        step *= 2
        rank, n_ranks = _dense(rank * (nxt.max() + 2) + nxt)
        if n_ranks == n:
            levels.append(rank)
            break
    n = len(doc)
    order = np.argsort(rank, kind="stable")
    starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    ends = np.repeat(np.r_[starts[1:], n], np.diff(np.r_[starts, n]))
    a, b = order[:-1], order[1:]
    lcp = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        ok = (x < ends[a]) & (y < ends[b]) & (doc[a] == doc[b])
        same = np.zeros(n - 1, bool)
        same[ok] = levels[k][x[ok]] == levels[k][y[ok]]
        lcp[same] += 1 << k
    np.maximum.at(longest, doc[a], np.where(lcp >= run, lcp, 0))
    group = np.r_[0, np.cumsum(lcp < run)]
    first = np.full(group[-1] + 1, n, np.int64)
    np.minimum.at(first, group, order)
    again = order[order > first[group]]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + run, -1)
    inside = np.cumsum(edge[:-1]) > 0
    np.add.at(covered, doc[inside], 1)
    return covered, longest


def repetition(df: DataFrame, key: str, result: str, run: int = 5) -> DataFrame:
    """(key, words, repeated_words, repeated_share, longest_repeat) of the text of every record.

    A word is repeated if it lies in a run of ``run`` words that already occurred, beginning at an earlier word; the first
    occurrence does not count. A record without text, or without words, has share 0. Deliveries of one key count once; rows
    with a null key are left out; an empty table gives an empty result; extra columns are ignored.
    """

    def fn(c: dict) -> dict:
        out = {"k": c["k"], "words": [], "repeated_words": [], "longest_repeat": []}
        held: list[list[str]] = []
        size = 0

        def count() -> None:
            covered, longest = repeated(held, run)
            out["words"] += map(len, held)
            out["repeated_words"] += covered.tolist()
            out["longest_repeat"] += longest.tolist()
            held.clear()

        for r in c["r"]:
            w = words(t) if (t := result_text(r)[0]) else []
            if held and size + len(w) > GROUP_WORDS:
                count()
                size = 0
            held.append(w)
            size += len(w)
        count()
        return out

    kind = dict(df.dtypes)[key]
    got = map_columns(df.select(F.col(key).alias("k"), F.col(result).alias("r")).where("k IS NOT NULL"), fn, f"k {kind}, words bigint, repeated_words bigint, longest_repeat bigint")
    one = one_delivery(got, "k", "words", "repeated_words", "longest_repeat")
    return one.select(F.col("k").alias(key), "words", "repeated_words", F.when(F.col("words") > 0, F.col("repeated_words") / F.col("words")).otherwise(0.0).alias("repeated_share"), "longest_repeat")
