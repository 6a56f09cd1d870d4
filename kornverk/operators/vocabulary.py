"""Vocabulary of a terminology: phrases, terms, their counts in the terminology and in a corpus, ranks and ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids, stems, text
from .ordering import max_rank, numbered


def cleaned_phrases(phrases: DataFrame, phrase: str = "phrase", order: str = "ord") -> DataFrame:
    """(phrase, ord, place): every different clean phrase, with the raw phrase and the place in it where it first stands."""
    each = phrases.select(F.col(order).alias("o"), F.posexplode(text.phrase_candidates(phrase)).alias("p", "c"))
    clean = each.select(text.clean_phrase("c").alias("phrase"), F.struct("o", "p").alias("at")).where("phrase IS NOT NULL")
    return clean.groupBy("phrase").agg(F.min("at").alias("at")).select("phrase", F.col("at.o").alias("ord"), F.col("at.p").alias("place"))


def term_set(phrases: DataFrame, phrase: str = "phrase") -> DataFrame:
    """(term): every different token of two characters or more of the raw phrases."""
    return phrases.select(F.explode(text.tokens(phrase)).alias("term")).where(F.length("term") > 1).distinct()


def distinct_occurrences(occurrences: DataFrame) -> DataFrame:
    """Rows equal in all columns once, only those with a word and a count."""
    return occurrences.where((F.col("word") != "") & F.col("count").isNotNull()).dropDuplicates()


def corpus_counts(occurrences: DataFrame) -> DataFrame:
    """(word, corpus_count)."""
    return occurrences.groupBy("word").agg(F.sum("count").alias("corpus_count"))


def with_stem_keys(df: DataFrame, term: str, key: str = "stem_key") -> DataFrame:
    """``df`` with the stem key of ``term``, computed once for each different term."""
    keys = df.select(F.col(term).alias("_t")).distinct().withColumn(key, stems.stem_key_of("_t"))
    return df.join(keys, F.col(term).eqNullSafe(F.col("_t"))).drop("_t")


def term_usage(phrases: DataFrame, terms: DataFrame, phrase: str = "phrase") -> DataFrame:
    """(term, snomed_count, usage): occurrences in the clean phrases, repeats counted, and the different phrases in order."""
    found = phrases.select(F.col(phrase).alias("phrase"), F.explode(text.tokens(phrase)).alias("term")).join(terms, "term", "left_semi")
    per = found.groupBy("term", "phrase").agg(F.count("*").alias("n"))
    return per.groupBy("term").agg(F.sum("n").alias("snomed_count"), F.array_sort(F.collect_list("phrase")).alias("usage"))


def variant_groups(terms: DataFrame) -> DataFrame:
    """(stem_key, variants): the terms that share a stem key."""
    return with_stem_keys(terms, "term").groupBy("stem_key").agg(F.array_sort(F.collect_set("term")).alias("variants"))


def merged_corpus_counts(counts: DataFrame) -> DataFrame:
    """(stem_key, corpus_count) over every word of the corpus."""
    return with_stem_keys(counts, "word").groupBy("stem_key").agg(F.sum("corpus_count").alias("corpus_count"))


def entries(terms: DataFrame, usage: DataFrame, counts: DataFrame) -> DataFrame:
    """(term, snomed_count, corpus_count, usage), a row for each term; what has no count has 0."""
    words = counts.select(F.col("word").alias("term"), "corpus_count")
    zero = F.lit(0).cast("bigint")
    return terms.join(usage, "term", "left").join(words, "term", "left").select("term", F.coalesce("snomed_count", zero).alias("snomed_count"), F.coalesce("corpus_count", zero).alias("corpus_count"), F.coalesce("usage", F.array().cast("array<string>")).alias("usage"))


def merged_entries(terms: DataFrame, usage: DataFrame, counts: DataFrame) -> DataFrame:
    """(stem_key, term, snomed_count, corpus_count, usage, variants), a row for each stem key.

    The term is the variant with most occurrences; then the one whose own spelling is a stem key with the higher corpus
    count, the shortest, the first.
    """
    keyed = with_stem_keys(terms, "term")
    corpus = merged_corpus_counts(counts)
    spelt = corpus.select(F.col("stem_key").alias("term"), F.col("corpus_count").alias("spelt_count"))
    zero = F.lit(0).cast("bigint")
    one = keyed.join(usage, "term", "left").join(spelt, "term", "left").withColumn("n", F.coalesce("snomed_count", zero))
    best = F.struct(-F.col("n"), -F.coalesce("spelt_count", zero), F.length("term"), F.col("term"))
    groups = one.groupBy("stem_key").agg(F.min_by("term", best).alias("term"), F.sum("n").alias("snomed_count"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("usage", F.array().cast("array<string>")))))).alias("usage"), F.array_sort(F.collect_set("term")).alias("variants"))
    return groups.join(corpus, "stem_key", "left").select("stem_key", "term", "snomed_count", F.coalesce("corpus_count", zero).alias("corpus_count"), "usage", "variants")


def within_band(df: DataFrame, min_snomed: int = 0, max_corpus: int = 100) -> DataFrame:
    return df.where((F.col("snomed_count") >= min_snomed) & (F.col("corpus_count") <= max_corpus))


def score(alpha: float = 0.7) -> Column:
    return F.lit(float(alpha)) * F.log1p("snomed_count") + F.lit(1.0 - float(alpha)) * F.log1p("corpus_count")


def ranked(df: DataFrame, alpha: float = 0.7, cap: int | None = None) -> DataFrame:
    """``df`` with ``score`` and ``rank``, the number of rows that score as high or higher; tied rows beyond ``cap`` go as a whole."""
    out = max_rank(df.withColumn("score", score(alpha)), "score")
    return out if cap is None else out.where(F.col("rank") <= cap)


def in_rank_order(df: DataFrame, tie: str = "term") -> DataFrame:
    """By score, the best first; ties by the stem key where terms are merged, else by the term."""
    return df.orderBy(F.desc("score"), tie)


def with_term_ids(df: DataFrame, width: int = 3) -> DataFrame:
    """``df`` with ``term_id``: six letters of the term and its place in the order of normalised terms; ``term_000`` for a blank one."""
    normal = df.withColumn("_norm", ids.normalize_identifier("term"))
    spelt = normal.where(~text.is_blank("term")).select("_norm", "term").distinct()
    placed = numbered(spelt, F.substring("_norm", 1, 2), [F.col("_norm"), F.col("term")], "_no")
    keyed = placed.select(F.col("term").alias("_term"), ids.term_id("_norm", "_no", width).alias("term_id"))
    return normal.join(keyed, F.col("term") == F.col("_term"), "left").drop("_norm", "_term").withColumn("term_id", F.coalesce("term_id", F.lit("term_000")))


def occurrences_in_order(occurrences: DataFrame, order: str) -> DataFrame:
    return occurrences.orderBy(F.desc("count"), order)


def vocabulary(phrases: DataFrame, occurrences: DataFrame, merge: bool = False, min_snomed: int = 0, max_corpus: int = 100, alpha: float = 0.7, cap: int | None = 10_000) -> DataFrame:
    """The ranked vocabulary of ``phrases`` (phrase, ord) against ``occurrences`` (word, count)."""
    terms, clean = term_set(phrases), cleaned_phrases(phrases)
    counts = corpus_counts(distinct_occurrences(occurrences))
    rows = (merged_entries if merge else entries)(terms, term_usage(clean, terms), counts)
    out = with_term_ids(ranked(within_band(rows, min_snomed, max_corpus), alpha, cap))
    return out.withColumn("n_variants", F.size("variants")) if merge else out


def representative(variants: DataFrame, stem: str = "stem_key") -> DataFrame:
    """The first row of each stem by ``n`` falling, ``spelt_count`` falling, length and spelling of ``term``."""
    w = Window.partitionBy(stem).orderBy(F.desc("n"), F.desc("spelt_count"), F.length("term"), "term")
    return variants.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
