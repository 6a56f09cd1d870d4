"""Evaluation texts in documents: the words of every document run through the suffix automaton of the test items."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arrow import map_columns
from .automaton import SuffixAutomaton
from .lookalike import consistent
from .text import words

#: Words of items in one automaton (about 1 KB each, where it is built and where it is used); more items are taken in several.
ITEM_WORDS = 100_000


def _automata(items: DataFrame, key: str, text: str, most: int) -> Iterator[SuffixAutomaton]:
    lines: list[list[str]] = []
    labels: list = []
    size = 0
    for k, t in items.select(key, text).where(F.col(key).isNotNull() & F.col(text).isNotNull()).toLocalIterator():
        w = words(consistent(t))
        if size and size + len(w) > most:
            yield SuffixAutomaton(*lines, labels=labels)
            lines, labels, size = [], [], 0
        lines.append(w)
        labels.append(k)
        size += len(w)
    if lines:
        yield SuffixAutomaton(*lines, labels=labels)


def leak_spans(docs: DataFrame, doc_key: str, items: DataFrame, item_key: str, text: str = "text", run: int = 12, most: int = ITEM_WORDS) -> DataFrame:
    """(doc_key, item_key, first_word, end_word, words): each longest stretch of words of a document that lies in runs of ``run`` words or more of an item.

    Words are those of the consistent form; ``words`` is the number of words of the document. Null keys and texts are left out; empty tables give an empty result.
    """
    kinds = dict(docs.dtypes)[doc_key], dict(items.dtypes)[item_key]
    rows = docs.select(F.col(doc_key).alias("k"), F.col(text).alias("t")).where("k IS NOT NULL AND t IS NOT NULL")
    schema = f"k {kinds[0]}, i {kinds[1]}, first_word int, end_word int, words int"
    out = docs.sparkSession.createDataFrame([], schema)
    for automaton in _automata(items, item_key, text, most):
        shared = docs.sparkSession.sparkContext.broadcast(automaton)

        def find(c: dict, shared=shared) -> dict:
            found = {"k": [], "i": [], "first_word": [], "end_word": [], "words": []}
            known = shared.value
            for k, t in zip(c["k"], c["t"]):
                line = words(consistent(t))
                open_: dict = {}
                for end, (state, size) in enumerate(known.matches(line), 1):
                    if size < run:
                        continue
                    for item in known.holders(state, run):
                        spans = open_.setdefault(item, [])
                        if spans and spans[-1][1] >= end - run:
                            spans[-1][1] = end
                        else:
                            spans.append([end - run, end])
                for item, spans in open_.items():
                    for a, b in spans:
                        for name, v in zip(found, (k, item, a, b, len(line))):
                            found[name].append(v)
            return found

        out = out.unionByName(map_columns(rows, find, schema))
    return out.select(F.col("k").alias(doc_key), F.col("i").alias(item_key), "first_word", "end_word", "words")


def leaks(docs: DataFrame, doc_key: str, items: DataFrame, item_key: str, text: str = "text", run: int = 12) -> DataFrame:
    """(doc_key, item_key) of every document that holds ``run`` consecutive words of an item."""
    return leak_spans(docs, doc_key, items, item_key, text, run).select(doc_key, item_key).distinct()


def leak_shares(docs: DataFrame, doc_key: str, items: DataFrame, item_key: str, text: str = "text", run: int = 12) -> DataFrame:
    """(doc_key, item_key, longest, leaked_words, leaked_share) of the same pairs, to drop spans or documents by length or share."""
    spans = leak_spans(docs, doc_key, items, item_key, text, run)
    n = F.col("end_word") - F.col("first_word")
    return spans.groupBy(doc_key, item_key).agg(F.max(n).alias("longest"), F.sum(n).alias("leaked_words"), (F.sum(n) / F.max("words")).alias("leaked_share"))
