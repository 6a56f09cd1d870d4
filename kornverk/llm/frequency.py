"""Frequency of every distinct term, or run of terms, and of the records that hold it.

Suffix-sorted counting: every record gives its suffixes, cut after ``max_n`` terms. They are routed by their first term,
sorted in reverse lexicographic order, and one pass with a stack adds the counts of all prefixes. A suffix also carries from
which prefix length on it is the first of its record; records are thus counted exactly without shipping sets of ids, and
equal suffixes can be added up before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NGRAMS = "ngram array<string>, occurrences bigint, records bigint"
_ARROW = pa.schema([("ngram", pa.list_(pa.string())), ("occurrences", pa.int64()), ("records", pa.int64())])


def clean_terms(terms: Column) -> Column:
    """Trimmed of Unicode white space and lower-cased; null and blank terms are left out."""
    bare = F.transform(terms, lambda t: F.lower(F.regexp_replace(t, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")))
    return F.filter(bare, lambda t: t.isNotNull() & (t != ""))


def _stack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of all prefixes of suffixes that come in reverse lexicographic order: a prefix ends once a suffix lacks it."""
    path: list[str] = []
    occurrences: list[int] = []
    records: list[int] = []
    done: tuple[list, list, list] = ([], [], [])

    def pop(to: int) -> None:
        while len(path) > to:
            n, r = occurrences.pop(), records.pop()
            done[0].append(path.copy())
            done[1].append(n)
            done[2].append(r)
            path.pop()
            if occurrences:
                occurrences[-1] += n

    def out() -> pa.RecordBatch:
        b = pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(done, _ARROW)], schema=_ARROW)
        for x in done:
            x.clear()
        return b

    for b in batches:
        for suffix, fresh, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            same = 0
            while same < len(path) and same < len(suffix) and path[same] == suffix[same]:
                same += 1
            pop(same)
            for t in suffix[same:]:
                path.append(t)
                occurrences.append(0)
                records.append(0)
            occurrences[-1] += n
            for k in range(fresh, len(path)):
                records[k] += n
        if len(done[0]) > 10_000:
            yield out()
    pop(0)
    yield out()


def ngram_frequencies(df: DataFrame, terms: str, max_n: int = 1, salts: int = 16) -> DataFrame:
    """(ngram, n, occurrences, records) for every run of up to ``max_n`` terms; one row of ``df`` is one record.

    Null or empty arrays and null terms add nothing; repeated terms of a record count as occurrences each and as one record;
    an empty table gives an empty result. Extra columns are ignored. Where ``max_n`` > 1, a first term is routed to ``salts``
    places by its second term, so that no term holds a task, and single terms are added up once more.
    """
    seq = df.select(F.filter(terms, lambda t: t.isNotNull()).alias("s")).where("size(s) > 0")
    cut = seq.select(F.array_sort(F.transform("s", lambda _, i: F.slice("s", i + 1, F.lit(max_n)))).alias("u"))
    each = cut.select("u", F.posexplode("u").alias("i", "suffix")).withColumn("before", F.expr("get(u, i - 1)"))
    lcp = sum((F.when((F.size("before") >= k) & (F.slice("before", 1, k) == F.slice("suffix", 1, k)), 1).otherwise(0) for k in range(1, max_n + 1)), F.lit(0))
    counted = each.select("suffix", F.coalesce(F.when(F.col("before").isNotNull(), lcp), F.lit(0)).alias("fresh")).groupBy("suffix", "fresh").agg(F.count("*").alias("n"))
    route = [F.col("suffix")[0]] + ([F.pmod(F.hash(F.get("suffix", F.lit(1))), F.lit(salts))] if max_n > 1 else [])
    # of equal suffixes with several "fresh" lengths the order is immaterial
    found = counted.repartition(*route).sortWithinPartitions(F.desc("suffix")).mapInArrow(_stack, _NGRAMS)
    if max_n > 1:
        found = found.where("size(ngram) > 1").unionByName(found.where("size(ngram) = 1").groupBy("ngram").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records")))
    return found.select("ngram", F.size("ngram").alias("n"), "occurrences", "records")


def mark(frequencies: DataFrame, rare_below: int, common_above: Column) -> DataFrame:
    """Adds ``mark``: ``rare`` in fewer than ``rare_below`` records, ``common`` in more than ``common_above``, else null."""
    return frequencies.withColumn("mark", F.when(F.col("records") < rare_below, "rare").when(F.col("records") > common_above, "common"))
