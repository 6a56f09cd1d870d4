"""Queries over whole tables, one or more for each operator, and the SQL that DuckDB checks them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import containers, ids, text
from ..operators import chunking, coverage, matching, ordering, plan, prompts, quality, records, scores, vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
LIMITS = quality.Limits(3, 400, 600)


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# Tables as the operators want them, in Spark and in SQL.
_WS = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]"


def _strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _filled_sql(x: str) -> str:
    return f"[t FOR t IN {x} IF t IS NOT NULL AND {_strip_sql('t')} <> '']"


def _chemical_sql(t: str) -> str:
    def m(p: str) -> str:
        return f"regexp_matches({t}, '{p}')"

    suffix = m(r"(?i)(ase|yl|id|at|in|an|ol|en)($|[^\p{L}\p{N}_])")
    structure = m(r"(?i)(\d+,\d+|alfa|beta|gamma|delta|epsilon|kappa)")
    long_name = f"length({t}) > 12 AND length({t}) - length(replace({t}, '-', '')) >= 2 AND " + m(r"\d")
    return f"(NOT {m(r'^\d+[-,]\d+$')} AND ({m(r'^(cis|trans|ortho|para|meta|[NOLSD])-[a-z0-9]')} OR {m(r'(?i)[A-Za-zÆØÅæøå]-\d+(,\d+)*-[A-Za-zÆØÅæøå]')} OR ({suffix} AND {structure}) OR ({long_name})))"


def _tokens_sql(x: str) -> str:
    space = f"[t FOR t IN regexp_split_to_array({x}, '{_WS}+') IF t <> '']"
    rough = f"flatten([CASE WHEN {_chemical_sql('t')} THEN regexp_split_to_array(t, '[^0-9A-Za-zÆØÅæøå]+') ELSE [t] END FOR t IN {space}])"
    words = f"flatten([regexp_split_to_array(t, '[^\\p{{L}}\\p{{N}}_-]+') FOR t IN {rough}])"
    bare = f"[regexp_replace(t, '^-+|-+$', '', 'g') FOR t IN {words}]"
    return f"[t FOR t IN {bare} IF regexp_matches(t, '^[0-9A-Za-zÆØÅæøå-]+$') AND NOT regexp_matches(t, '^\\d+(-\\d+)*$')]"


def _candidates_sql(x: str) -> str:
    inside = f"[{_strip_sql('p')} FOR p IN regexp_extract_all({x}, '\\(([^)]+)\\)', 1)]"
    parts = f"flatten([[{_strip_sql('q')} FOR q IN string_split({_strip_sql('p')}, ' - ')] FOR p IN string_split({x}, ':')])"
    return f"[c FOR c IN list_concat({inside}, {parts}) IF c <> '']"


_PHRASES = "phrases AS (SELECT CAST(p_partkey AS BIGINT) AS ord, p_name || ' (' || p_type || '): ' || p_brand || ' - ' || p_name AS phrase FROM part)"
_RAW_USAGE = "usages AS (SELECT rank, unnest(usage) AS phrase FROM snomed)"
_CLEAN = f"cands AS (SELECT unnest({_candidates_sql('phrase')}) AS c FROM usages), clean AS (SELECT DISTINCT c2 AS phrase FROM (SELECT replace({_strip_sql('c')}, '%', 'prosent') AS c2 FROM cands) WHERE c2 <> '' AND NOT regexp_matches(c2, '[^0-9A-Za-zÆØÅæøå ,\\-−]'))"
_TERMS = f"terms AS (SELECT DISTINCT t AS term FROM (SELECT unnest({_tokens_sql('phrase')}) AS t FROM usages) WHERE length(t) > 1)"
_USED = f"hits AS (SELECT phrase, unnest({_tokens_sql('phrase')}) AS term FROM clean), used AS (SELECT term, count(*) AS snomed_count, list_sort(list(DISTINCT phrase)) AS usage FROM hits WHERE term IN (SELECT term FROM terms) GROUP BY term)"
_CORPUS = f"corpus AS (SELECT t AS word, count(*) AS corpus_count FROM (SELECT unnest({_tokens_sql('text')}) AS t FROM documents) GROUP BY t)"
_ENTRIES = "entries AS (SELECT terms.term, coalesce(snomed_count, 0) AS snomed_count, coalesce(corpus_count, 0) AS corpus_count, coalesce(usage, []) AS usage FROM terms LEFT JOIN used USING (term) LEFT JOIN corpus ON word = terms.term)"
_VOCAB = ", ".join([_RAW_USAGE, _CLEAN, _TERMS, _USED, _CORPUS, _ENTRIES])


def _phrases(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "part").select(F.col("p_partkey").cast("bigint").alias("ord"), F.concat("p_name", F.lit(" ("), "p_type", F.lit("): "), "p_brand", F.lit(" - "), "p_name").alias("phrase"))


def _usages(spark: SparkSession, d: str) -> DataFrame:
    """Phrases of the terminology that stand with its terms."""
    return _t(spark, d, "snomed").select("rank", F.explode("usage").alias("phrase")).select("phrase", F.col("rank").alias("ord")).where("phrase IS NOT NULL")


def _occurrences(spark: SparkSession, d: str) -> DataFrame:
    words = _t(spark, d, "documents").select(F.explode(text.tokens("text")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("count"))


def _plan(spark: SparkSession, d: str) -> DataFrame:
    """Plan rows that are equal once, ordered by need and spelling as the plan is first written."""
    rows = _t(spark, d, "terms_to_use").dropDuplicates()
    return rows.withColumn("ord", F.xxhash64("term_id", "term"))


def _records(spark: SparkSession, d: str) -> DataFrame:
    """One delivery of each answer, placed by its output_id."""
    rows = _t(spark, d, "outputs").where("output_id IS NOT NULL")
    return rows.groupBy("output_id").agg(F.min(F.struct("id", "template", "prompt", "result", "used_terms")).alias("r")).select("output_id", "r.*")


_REC = "rec AS (SELECT output_id, any_value(id) AS id, any_value(template) AS template, any_value(prompt) AS prompt, any_value(result) AS result, any_value(used_terms) AS used_terms FROM outputs WHERE output_id IS NOT NULL GROUP BY output_id)"
_PLAN = "plan AS (SELECT DISTINCT * FROM terms_to_use)"


def _distinct_sql(x: str) -> str:
    """Distinct elements that aren't blank, in the order of their spelling."""
    return f"list_sort(list_distinct({_filled_sql(x)}))"


_PRESENT = f"present AS (SELECT term, count(*) AS used FROM (SELECT unnest({_distinct_sql('used_terms')}) AS term FROM rec) GROUP BY term)"
_REQUIRED = f"required AS (SELECT term, max(greatest(0, coalesce(target_count, 0) - coalesce(corpus_count, 0))) AS required FROM plan WHERE {_strip_sql('term')} <> '' GROUP BY term)"


# Vocabulary.


@query(f"WITH {_PHRASES} SELECT ord, unnest({_candidates_sql('phrase')}) AS candidate FROM phrases")
def phrase_candidates(spark: SparkSession, d: str) -> DataFrame:
    return _phrases(spark, d).select("ord", F.explode(text.phrase_candidates("phrase")).alias("candidate"))


@query(f"WITH {_PHRASES}, c AS (SELECT ord, unnest({_candidates_sql('phrase')}) AS c, generate_subscripts({_candidates_sql('phrase')}, 1) AS p FROM phrases), k AS (SELECT replace({_strip_sql('c')}, '%', 'prosent') AS phrase, ord FROM c) SELECT phrase, min(ord) AS ord FROM k WHERE phrase <> '' AND NOT regexp_matches(phrase, '[^0-9A-Za-zÆØÅæøå ,\\-−]') GROUP BY phrase")
def phrases_clean(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary.cleaned_phrases(_phrases(spark, d)).select("phrase", "ord")


@query(f"SELECT doc_id, unnest({_tokens_sql('text')}) AS token FROM documents")
def term_tokens(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", F.explode(text.tokens("text")).alias("token"))


@query(f"WITH {_RAW_USAGE}, {_TERMS} SELECT term FROM terms")
def term_set(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary.term_set(_usages(spark, d))


@query(f"WITH {_CORPUS} SELECT word, corpus_count FROM corpus")
def corpus_counts(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary.corpus_counts(_occurrences(spark, d)).select("word", F.col("corpus_count").cast("bigint").alias("corpus_count"))


@query("SELECT DISTINCT term AS word, corpus_count AS count FROM terms_to_use WHERE term <> '' AND corpus_count IS NOT NULL")
def occurrence_distinct(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary.distinct_occurrences(_t(spark, d, "terms_to_use").select(F.col("term").alias("word"), F.col("corpus_count").alias("count")))


@query(f"WITH {_RAW_USAGE}, {_CLEAN}, {_TERMS}, {_USED} SELECT term, CAST(snomed_count AS BIGINT) AS snomed_count, array_to_string(usage, '|') AS usage FROM used")
def term_usage(spark: SparkSession, d: str) -> DataFrame:
    rows = _usages(spark, d)
    return vocabulary.term_usage(vocabulary.cleaned_phrases(rows), vocabulary.term_set(rows)).select("term", "snomed_count", F.array_join("usage", "|").alias("usage"))


@query(f"WITH {_VOCAB} SELECT term, CAST(snomed_count AS BIGINT) AS snomed_count, CAST(corpus_count AS BIGINT) AS corpus_count, array_to_string(usage, '|') AS usage FROM entries")
def vocab_entries(spark: SparkSession, d: str) -> DataFrame:
    rows = _usages(spark, d)
    terms = vocabulary.term_set(rows)
    out = vocabulary.entries(terms, vocabulary.term_usage(vocabulary.cleaned_phrases(rows), terms), vocabulary.corpus_counts(_occurrences(spark, d)))
    return out.select("term", "snomed_count", "corpus_count", F.array_join("usage", "|").alias("usage"))


_SCORED = "scored AS (SELECT *, 0.7::DOUBLE * ln(1 + snomed_count::DOUBLE) + (1 - 0.7::DOUBLE) * ln(1 + corpus_count::DOUBLE) AS score FROM entries WHERE corpus_count <= 100), ranked AS (SELECT *, count(*) OVER (ORDER BY score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rank FROM scored)"


@query(f"WITH {_VOCAB}, {_SCORED} SELECT CAST(rank AS BIGINT) AS rank, term, CAST(snomed_count AS BIGINT) AS snomed_count, CAST(corpus_count AS BIGINT) AS corpus_count FROM ranked WHERE rank <= 10000")
def vocab_rank(spark: SparkSession, d: str) -> DataFrame:
    """The ranked vocabulary: tokens of the terminology, their counts there and in all documents, band, score, rank and cap."""
    return vocabulary.vocabulary(_usages(spark, d), _occurrences(spark, d)).select("rank", "term", "snomed_count", "corpus_count")


_B36 = "CASE WHEN {0} < 46656 THEN substr('0123456789abcdefghijklmnopqrstuvwxyz', CAST({0} // 1296 AS BIGINT) + 1, 1) || substr('0123456789abcdefghijklmnopqrstuvwxyz', CAST({0} // 36 % 36 AS BIGINT) + 1, 1) || substr('0123456789abcdefghijklmnopqrstuvwxyz', CAST({0} % 36 AS BIGINT) + 1, 1) END"
_NORM = f"regexp_replace(replace(lower({_strip_sql('term')}), chr(97) || chr(778), 'å'), '[^a-zæøå]', '', 'g')"


@query(f"WITH n AS (SELECT DISTINCT term, {_NORM} AS norm FROM terms_to_use WHERE {_strip_sql('term')} <> ''), o AS (SELECT term, norm, row_number() OVER (ORDER BY norm, term) - 1 AS no FROM n) SELECT term, CASE WHEN norm = '' THEN 'term' ELSE substr(norm, 1, 6) END || '_' || {_B36.format('no')} AS term_id FROM o")
def term_ids(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "terms_to_use").select("term").where(~text.is_blank("term")).distinct()
    return vocabulary.with_term_ids(rows).select("term", "term_id")


@query()
def variant_groups(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary.variant_groups(vocabulary.term_set(_usages(spark, d)))


@query()
def merged_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary.vocabulary(_usages(spark, d), _occurrences(spark, d), merge=True).drop("score")


@query("WITH v AS (SELECT unnest(variants) AS variant, term_id, corpus_count FROM terms_to_use WHERE corpus_count IS NOT NULL), n AS (SELECT term_id, variant, max(corpus_count) AS n FROM v WHERE variant IS NOT NULL GROUP BY term_id, variant) SELECT term_id, arg_min(variant, {'a': -n, 'b': length(variant), 'c': variant}) AS term FROM n GROUP BY term_id")
def representative(spark: SparkSession, d: str) -> DataFrame:
    v = _t(spark, d, "terms_to_use").where("corpus_count IS NOT NULL").select("term_id", "corpus_count", F.explode("variants").alias("term")).where("term IS NOT NULL")
    n = v.groupBy("term_id", "term").agg(F.max("corpus_count").alias("n")).withColumn("spelt_count", F.lit(0))
    return vocabulary.representative(n, "term_id").select("term_id", "term")


@query("SELECT rank, term, corpus_count, CAST(count(*) OVER (ORDER BY corpus_count DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS place FROM snomed WHERE corpus_count IS NOT NULL")
def max_rank(spark: SparkSession, d: str) -> DataFrame:
    return ordering.max_rank(_t(spark, d, "snomed").where("corpus_count IS NOT NULL").select("rank", "term", "corpus_count"), "corpus_count", "place")


# Plan.


@query(f"SELECT coalesce(CASE WHEN {_strip_sql('term_id')} <> '' THEN term_id END, '') AS term_id, term, coalesce(corpus_count, 0) AS corpus_count, CAST(100 AS BIGINT) AS target_count, greatest(0, 100 - coalesce(corpus_count, 0)) AS target_remaining, array_to_string({_filled_sql('variants')}, '|') AS variants FROM snomed WHERE {_strip_sql('term')} <> ''")
def plan_init(spark: SparkSession, d: str) -> DataFrame:
    return plan.init_plan(_t(spark, d, "snomed")).select("term_id", "term", "corpus_count", "target_count", "target_remaining", F.array_join("variants", "|").alias("variants"))


@query(f"WITH {_REC}, {_PRESENT} SELECT term, CAST(used AS BIGINT) AS used FROM present")
def presence_counts(spark: SparkSession, d: str) -> DataFrame:
    return plan.presence_counts(_records(spark, d))


@query(f"WITH {_PLAN}, {_REC}, {_PRESENT} SELECT term_id, plan.term, coalesce(used, 0) AS used_in_output, greatest(0, coalesce(target_count, 0) - coalesce(corpus_count, 0) - coalesce(used, 0)) AS target_remaining FROM plan LEFT JOIN present ON present.term = plan.term")
def plan_update(spark: SparkSession, d: str) -> DataFrame:
    return plan.updated_plan(_plan(spark, d), _records(spark, d)).select("term_id", "term", "used_in_output", "target_remaining")


@query("SELECT (count(*) > 0 AND coalesce(max(target_remaining), 0) <= 0) AS complete FROM terms_to_use")
def plan_complete(spark: SparkSession, d: str) -> DataFrame:
    return plan.is_complete(_t(spark, d, "terms_to_use"))


@query(f"WITH {_PLAN} SELECT term_id, term, CAST(ceil((CASE WHEN coalesce(target_remaining, -1) >= 0 THEN target_remaining ELSE greatest(0, coalesce(target_count, 0) - coalesce(corpus_count, 0) - coalesce(used_in_output, 0)) END)::DOUBLE / 6.1::DOUBLE) AS BIGINT) AS target_remaining FROM plan")
def target_estimate(spark: SparkSession, d: str) -> DataFrame:
    return plan.estimated_targets(_plan(spark, d)).select("term_id", "term", "target_remaining")


@query(f"WITH {_PLAN}, {_REQUIRED} SELECT term, CAST(required AS BIGINT) AS required FROM required")
def required_counts(spark: SparkSession, d: str) -> DataFrame:
    return plan.required_counts(_plan(spark, d))


@query("SELECT term_id, term, target_remaining FROM (SELECT DISTINCT term_id, term, target_remaining FROM terms_to_use) ORDER BY target_remaining DESC, term DESC, term_id LIMIT 50")
def plan_first(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "terms_to_use").select("term_id", "term", "target_remaining").distinct()
    return rows.orderBy(F.desc_nulls_last("target_remaining"), F.desc("term"), "term_id").limit(50)


# Matching.


@query(r"SELECT doc_id, unnest([s FOR s IN string_split(regexp_replace(text, '([.!?])[\s\p{Z}\x0b\x1c-\x1f\x{85}]+', '\1' || chr(1), 'g'), chr(1))]) AS sentence FROM documents")
def sentences(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", F.explode(text.sentences("text")).alias("sentence"))


_SURF = f"rows AS (SELECT term, unnest(list_concat([term], coalesce({_filled_sql('variants')}, []))) AS surface FROM plan WHERE {_strip_sql('term')} <> ''), surf AS (SELECT DISTINCT surface FROM rows)"


@query(f"WITH {_PLAN}, {_SURF} SELECT surface FROM surf")
def plan_surfaces(spark: SparkSession, d: str) -> DataFrame:
    return matching.surfaces(_plan(spark, d)).select("surface")


_SENT = r"string_split(regexp_replace(text, '([.!?])[\s\p{Z}\x0b\x1c-\x1f\x{85}]+', '\1' || chr(1), 'g'), chr(1))"
_TOK = f"tok AS (SELECT doc_id, unnest(flatten([[{{'token': t, 'start': i = 1}} FOR t, i IN {_tokens_sql('s')}] FOR s IN {_SENT}])) AS x FROM documents)"


@query(f"WITH terms AS (SELECT DISTINCT term FROM terms_to_use WHERE {_strip_sql('term')} <> ''), {_TOK}, c AS (SELECT doc_id, x.token AS token, CASE WHEN x.start AND regexp_matches(x.token, '^\\p{{Lu}}') AND regexp_matches(substr(x.token, 2), '\\p{{Ll}}') AND NOT regexp_matches(substr(x.token, 2), '[\\p{{Lu}}\\p{{Lt}}]') THEN lower(x.token) END AS low, x.token LIKE '%-%' AS compound FROM tok), h AS (SELECT doc_id, coalesce(a.term, b.term) AS term FROM c LEFT JOIN terms a ON a.term = token LEFT JOIN terms b ON b.term = low WHERE NOT compound) SELECT DISTINCT doc_id, term FROM h WHERE term IS NOT NULL")
def used_terms_exact(spark: SparkSession, d: str) -> DataFrame:
    """Terms in documents by spelling and title case, in words without a hyphen."""
    terms = _plan(spark, d).select("term", "ord", F.lit(None).cast("array<string>").alias("variants"))
    each = _t(spark, d, "documents").select("doc_id", F.explode(text.sentence_tokens("text")).alias("t")).select("doc_id", "t.token", "t.start").where(~F.col("token").contains("-"))
    return each.join(matching.matched_tokens(each, terms, stemming=False), ["token", "start"]).select("doc_id", "term").distinct()


@query()
def used_terms_full(spark: SparkSession, d: str) -> DataFrame:
    """Terms in documents with variants, stems and hyphen parts, in the order in which they first stand."""
    return matching.used_terms(_t(spark, d, "documents"), "doc_id", "text", _plan(spark, d))


@query()
def evaluated_terms(spark: SparkSession, d: str) -> DataFrame:
    return plan.evaluated(_records(spark, d), _plan(spark, d), "output_id")


# Quality.


def _judged(spark: SparkSession, d: str) -> DataFrame:
    return quality.with_reasons(_records(spark, d), LIMITS)


@query()
def validate_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _judged(spark, d).select("output_id", "filter_reason")


@query()
def accepted(spark: SparkSession, d: str) -> DataFrame:
    return quality.accepted(_judged(spark, d)).select("output_id", "id")


@query()
def reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.reason_counts(_judged(spark, d))


@query(f"WITH {_REC} SELECT count(*) FILTER (WHERE coalesce(len(used_terms), 0) < 3) AS few FROM rec")
def too_few_terms(spark: SparkSession, d: str) -> DataFrame:
    return _judged(spark, d).agg(F.count_if(F.col("filter_reason") == "too_few_used_terms").alias("few"))


@query()
def answer_texts(spark: SparkSession, d: str) -> DataFrame:
    """The text of each answer by the three readers."""
    rows = _records(spark, d).select("output_id", containers.answer_text_of("result").alias("plain"), containers.recovered_text_of("result").alias("recovered"), containers.literal_text_of("result").alias("l"))
    return rows.select("output_id", "plain", "recovered", F.col("l.text").alias("literal"), F.col("l.valid").alias("valid_literal"))


# Records.


@query("SELECT id, result FROM outputs WHERE id IS NOT NULL AND result IS NOT NULL")
def extract_id_result(spark: SparkSession, d: str) -> DataFrame:
    return records.id_result(_t(spark, d, "outputs"))


@query("SELECT id, coalesce(template, '') AS template, prompt, result, array_to_string([coalesce(t, '~') FOR t IN coalesce(used_terms, [])], '|') AS used_terms FROM outputs")
def canonical_outputs(spark: SparkSession, d: str) -> DataFrame:
    out = records.canonical(_t(spark, d, "outputs"))
    return out.withColumn("used_terms", F.array_join(F.transform("used_terms", lambda t: F.coalesce(t, F.lit("~"))), "|"))


@query("SELECT term_id, term FROM snomed UNION ALL SELECT term_id, term FROM terms_to_use")
def merge_union(spark: SparkSession, d: str) -> DataFrame:
    return records.merged(_t(spark, d, "snomed").select("term_id", "term"), _t(spark, d, "terms_to_use").select("term_id", "term"))


@query("SELECT term_id AS id, term FROM snomed WHERE term_id NOT IN (SELECT term_id FROM outputs WHERE term_id IS NOT NULL)")
def pending_prompts(spark: SparkSession, d: str) -> DataFrame:
    return records.pending(_t(spark, d, "snomed").select(F.col("term_id").alias("id"), "term"), _t(spark, d, "outputs").select(F.col("term_id").alias("id")))


@query("SELECT input_file, line_number, id FROM status_log WHERE coalesce(id, '') NOT IN (SELECT id || '_1' FROM outputs WHERE id IS NOT NULL)")
def resume_anti(spark: SparkSession, d: str) -> DataFrame:
    done = _t(spark, d, "outputs").select(F.concat("id", F.lit("_1")).alias("id"))
    return records.not_completed(_t(spark, d, "status_log").select("input_file", "line_number", "id"), done)


@query("SELECT term_id, term, corpus_count FROM snomed s WHERE NOT EXISTS (SELECT 1 FROM terms_to_use t WHERE t.term_id = s.term_id) UNION ALL SELECT term_id, term, corpus_count FROM terms_to_use")
def upsert_outputs(spark: SparkSession, d: str) -> DataFrame:
    cols = ["term_id", "term", "corpus_count"]
    return records.upserted(_t(spark, d, "snomed").select(cols), _t(spark, d, "terms_to_use").select(cols), "term_id")


@query("SELECT id, prompt FROM outputs o WHERE NOT EXISTS (SELECT 1 FROM outputs r WHERE r.id = o.id AND coalesce(len(r.used_terms), 0) < 3)")
def discard_rejected(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "outputs")
    bad = rows.where(F.coalesce(F.size("used_terms") < 3, F.lit(True)))
    return records.without_rejected(rows.select("id", "prompt"), bad.select("id"))


@query(r"SELECT regexp_extract(id, '(?s)^(.*)_(\d+)$', 1) AS term_id, max(CAST(regexp_extract(id, '(?s)^(.*)_(\d+)$', 2) AS BIGINT)) AS counter FROM outputs WHERE regexp_matches(id, '(?s)^(.*)_(\d+)$') GROUP BY 1")
def max_counters(spark: SparkSession, d: str) -> DataFrame:
    return records.max_counters(_t(spark, d, "outputs"))


@query(r"WITH rec AS (SELECT DISTINCT output_id, id FROM outputs) SELECT output_id, CASE WHEN regexp_matches(id, '(?s)^(.*)_(\d+)$') THEN CAST(regexp_extract(id, '(?s)^(.*)_(\d+)$', 2) AS BIGINT) ELSE 1000000000 END AS generation, CASE WHEN regexp_matches(id, '(?s)^(.*)_(\d+)$') THEN regexp_extract(id, '(?s)^(.*)_(\d+)$', 1) ELSE '' END AS prefix FROM rec")
def generation_keys(spark: SparkSession, d: str) -> DataFrame:
    return records.generation_keys(_t(spark, d, "outputs").select("output_id", "id").distinct(), "output_id")


@query("SELECT CASE WHEN trim(coalesce(status, '')) = '' THEN 'unknown' ELSE lower(trim(status)) END AS status, count(*) AS entries FROM status_log GROUP BY 1")
def status_totals(spark: SparkSession, d: str) -> DataFrame:
    return records.status_totals(_t(spark, d, "status_log"))


@query("SELECT coalesce(id, input_file || ':' || CAST(line_number AS VARCHAR)) AS record FROM status_log")
def fallback_ids(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "status_log").select(ids.record_id("id", "input_file", "line_number").alias("record"))


@query("SELECT doc_id FROM documents WHERE regexp_matches(text, '[0-9-]')")
def forbidden_chars(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").where(text.has_forbidden_speech_chars("text")).select("doc_id")


# Coverage.

_SPARE = "spare AS (SELECT present.term, used, coalesce(required, 0) AS required FROM present LEFT JOIN required ON required.term = present.term), each AS (SELECT output_id, unnest(" + _distinct_sql("used_terms") + ") AS term FROM rec), never AS (SELECT DISTINCT output_id FROM each JOIN spare USING (term) WHERE used - 1 < required)"


@query(f"WITH {_PLAN}, {_REC}, {_PRESENT}, {_REQUIRED}, {_SPARE} SELECT output_id FROM never")
def never_removable(spark: SparkSession, d: str) -> DataFrame:
    return coverage.never_removable(_records(spark, d), _plan(spark, d), "output_id")


@query(f"WITH {_PLAN}, {_REC}, {_PRESENT}, {_REQUIRED}, {_SPARE}, o AS (SELECT term, count(*) AS n FROM each WHERE output_id NOT IN (SELECT output_id FROM never) GROUP BY term) SELECT term, CAST(used - required AS BIGINT) AS spare FROM spare JOIN o USING (term) WHERE n > used - required")
def binding_terms(spark: SparkSession, d: str) -> DataFrame:
    return coverage.binding_terms(_records(spark, d), _plan(spark, d), "output_id")


def _low_plan(spark: SparkSession, d: str) -> DataFrame:
    """A plan most of which is filled already, so that some records can go."""
    return _plan(spark, d).withColumn("target_count", F.lit(3).cast("bigint")).withColumn("corpus_count", F.lit(0).cast("bigint"))


@query()
def prune(spark: SparkSession, d: str) -> DataFrame:
    return coverage.pruned(_records(spark, d), _low_plan(spark, d), "output_id")


def _rejected(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    judged = _judged(spark, d)
    out = quality.rejected(judged)
    looser = quality.with_reasons(out.drop("filter_reason"), quality.Limits(3, 300, 650))
    return out, quality.accepted(judged), quality.accepted(looser).select("output_id")


@query()
def restore_relational(spark: SparkSession, d: str) -> DataFrame:
    out, kept, ok = _rejected(spark, d)
    return coverage.restored(out, kept, ["too_long", "too_short"], ok, "output_id")


@query()
def restore_plan(spark: SparkSession, d: str) -> DataFrame:
    out, kept, ok = _rejected(spark, d)
    return coverage.restored(out, kept, ["too_long", "too_short"], ok, "output_id", _plan(spark, d))


# Chunks.


@query()
def chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of every answer that has a text."""
    rows = _records(spark, d).select("output_id", "result").join(chunking.split_problems(_records(spark, d), "output_id", "result").where("problem = 'no_text'"), "output_id", "left_anti")
    return chunking.split_records(rows, "output_id", "result")


@query()
def chunk_problems(spark: SparkSession, d: str) -> DataFrame:
    return chunking.split_problems(_records(spark, d), "output_id", "result")


# Prompts.


@query(r"""WITH plan AS (SELECT DISTINCT term_id, term, prompt_counter, target_remaining FROM terms_to_use WHERE target_remaining > 0 AND term_id <> '' AND term <> ''), m AS (SELECT regexp_extract(id, '(?s)^(.*)_(\d+)$', 1) AS term_id, max(CAST(regexp_extract(id, '(?s)^(.*)_(\d+)$', 2) AS BIGINT)) AS counter FROM outputs WHERE regexp_matches(id, '(?s)^(.*)_(\d+)$') GROUP BY 1), n AS (SELECT plan.term_id, term, greatest(coalesce(counter, 0), coalesce(prompt_counter, 0)) + 1 AS counter FROM plan LEFT JOIN m ON m.term_id = plan.term_id) SELECT term_id, term, counter, term_id || '_' || CASE WHEN counter < 1000 THEN lpad(CAST(counter AS VARCHAR), 3, '0') ELSE CAST(counter AS VARCHAR) END AS id FROM n""")
def prompt_sequence(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "terms_to_use").select("term_id", "term", "prompt_counter", "target_remaining").distinct()
    return prompts.prompt_sequence(rows, _t(spark, d, "outputs"))


@query("WITH pool AS (SELECT DISTINCT Scenario AS term FROM scenarios WHERE Scenario <> ''), r AS (SELECT o.id, pool.term, row_number() OVER (PARTITION BY o.id ORDER BY md5('7' || chr(31) || o.id || chr(31) || pool.term), pool.term) AS n FROM (SELECT DISTINCT term_id AS id FROM snomed WHERE term_id IS NOT NULL) o, pool) SELECT id, CAST(n - 1 AS INTEGER) AS place, term FROM r WHERE n <= 3")
def prompt_sample(spark: SparkSession, d: str) -> DataFrame:
    pool = _t(spark, d, "scenarios").where("Scenario <> ''").select(F.col("Scenario").alias("term"))
    ask = _t(spark, d, "snomed").select(F.col("term_id").alias("id")).where("id IS NOT NULL").distinct()
    return prompts.sampled_terms(ask, pool, 3, 7)


@query()
def prompts_rendered(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "terms_to_use").select("term_id", "term", "prompt_counter", "target_remaining").distinct()
    sequence = prompts.prompt_sequence(rows, _t(spark, d, "outputs"))
    body = 'Situasjon: "${scenario}"\nBruk uttrykket "${snomed_required}".\nBruk gjerne også: ${snomed_optional}.'
    return prompts.rendered(sequence, prompts.optional_terms(sequence, rows, 10, 7), prompts.usage_map(_t(spark, d, "snomed")), _t(spark, d, "scenarios"), body, "s.txt", 7)


@query()
def prompts_round_robin(spark: SparkSession, d: str) -> DataFrame:
    return prompts.round_robin(100, [("a.txt", "A: ${scenario} ${snomed_required} ${snomed_optional}"), ("b.txt", "B: ${scenario} ${snomed_required}")], _usages(spark, d), _t(spark, d, "scenarios"), 7)


@query("SELECT Scenario AS scenario, CAST(row_number() OVER (ORDER BY substr(Scenario, 1, 4), Scenario) - 1 AS BIGINT) AS number FROM scenarios WHERE Scenario <> ''")
def scenario_pool(spark: SparkSession, d: str) -> DataFrame:
    return prompts.scenarios(_t(spark, d, "scenarios"))


# Scores.


@query("SELECT count(*) AS files_total, count(*) FILTER (WHERE ok) AS files_scored, count(*) FILTER (WHERE NOT ok) AS files_failed, round(avg(mos) FILTER (WHERE ok), 9) AS mos_mean, round(median(mos) FILTER (WHERE ok), 9) AS mos_median, round(stddev_samp(mos) FILTER (WHERE ok), 9) AS mos_std, round(coalesce(sum(duration_s) FILTER (WHERE ok), 0) / 3600, 9) AS duration_hours FROM audio_scores")
def score_summary(spark: SparkSession, d: str) -> DataFrame:
    s = scores.summary(_t(spark, d, "audio_scores"))
    return s.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in s.dtypes])


@query("SELECT count(mos) AS count, round(avg(mos), 9) AS mean, round(stddev_samp(mos), 9) AS std, min(mos) AS min, round(quantile_cont(mos, 0.25), 9) AS p25, round(quantile_cont(mos, 0.5), 9) AS p50, round(quantile_cont(mos, 0.75), 9) AS p75, max(mos) AS max FROM audio_scores")
def score_describe(spark: SparkSession, d: str) -> DataFrame:
    s = scores.described(_t(spark, d, "audio_scores"))
    return s.select(*[F.round(c, 9).alias(c) if c in ("mean", "std", "p25", "p50", "p75") else F.col(c) for c in s.columns])


@query("WITH r AS (SELECT min(mos) AS lo, max(mos) AS hi FROM audio_scores), c AS (SELECT least(19, CAST(floor((mos - lo) / ((hi - lo) / 20)) AS INTEGER)) AS bin, count(*) AS n FROM audio_scores, r WHERE mos IS NOT NULL GROUP BY 1) SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * ((hi - lo) / 20), 9) AS low, round(lo + (b.bin + 1) * ((hi - lo) / 20), 9) AS high, coalesce(n, 0) AS n FROM (SELECT unnest(range(20)) AS bin) b CROSS JOIN r LEFT JOIN c ON c.bin = b.bin")
def score_hist(spark: SparkSession, d: str) -> DataFrame:
    return scores.histogram(_t(spark, d, "audio_scores")).select("bin", F.round("low", 9).alias("low"), F.round("high", 9).alias("high"), "n")


@query("WITH q AS (SELECT quantile_cont(mos, 0.25) AS a, quantile_cont(mos, 0.5) AS m, quantile_cont(mos, 0.75) AS b FROM audio_scores) SELECT min(mos) AS low, round(any_value(a), 9) AS q1, round(any_value(m), 9) AS median, round(any_value(b), 9) AS q3, max(mos) AS high FROM audio_scores, q WHERE mos >= a - 1.5::DOUBLE * (b - a) AND mos <= b + 1.5::DOUBLE * (b - a)")
def score_box(spark: SparkSession, d: str) -> DataFrame:
    return scores.box_plot(_t(spark, d, "audio_scores")).select("low", F.round("q1", 9).alias("q1"), F.round("median", 9).alias("median"), F.round("q3", 9).alias("q3"), "high")


_TOP = "SELECT rel_path, mos, mos_0_100, duration_s FROM (SELECT DISTINCT rel_path, ok, mos, mos_0_100, duration_s FROM audio_scores) WHERE ok AND mos IS NOT NULL ORDER BY mos {0}, rel_path LIMIT 10"


@query(_TOP.format("DESC"))
def top10(spark: SparkSession, d: str) -> DataFrame:
    return scores.extremes(_t(spark, d, "audio_scores").select("rel_path", "ok", "mos", "mos_0_100", "duration_s").distinct())


@query(_TOP.format("ASC"))
def bottom10(spark: SparkSession, d: str) -> DataFrame:
    return scores.extremes(_t(spark, d, "audio_scores").select("rel_path", "ok", "mos", "mos_0_100", "duration_s").distinct(), best=False)


@query("SELECT rel_path, round((mos - 1) * 25, 6) AS scaled FROM audio_scores WHERE ok")
def mos_scaled(spark: SparkSession, d: str) -> DataFrame:
    return scores.scored(_t(spark, d, "audio_scores")).select("rel_path", F.round(scores.to_hundred("mos"), 6).alias("scaled"))


@query("SELECT rel_path, error FROM audio_scores WHERE NOT ok")
def failed_files(spark: SparkSession, d: str) -> DataFrame:
    return scores.failed(_t(spark, d, "audio_scores")).select("rel_path", "error")


@query("SELECT DISTINCT rel_path FROM audio_scores ORDER BY rel_path LIMIT 20")
def first_files(spark: SparkSession, d: str) -> DataFrame:
    return scores.first_files(_t(spark, d, "audio_scores").select("rel_path").distinct(), 20, "rel_path")
