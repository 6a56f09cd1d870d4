"""Operators against small sequential models."""

import random
from itertools import combinations

import numpy as np
import pytest

from kornverk.operators import chunking, coverage, generate, matching, ordering, plan, prompts, quality, records, scores, vocabulary
from kornverk.plans.loop import fill_plan

PLAN = "term_id string, term string, corpus_count bigint, target_count bigint, used_in_output bigint, prompt_counter bigint, target_remaining bigint, variants array<string>, ord int"


def make_plan(spark, rows):
    return spark.createDataFrame([(f"t{i}", t, c, n, 0, 0, max(0, n - c), v, i) for i, (t, c, n, v) in enumerate(rows)], PLAN)


def test_ranks(spark):
    df = spark.createDataFrame([(9,), (5,), (3,), (3,), (0,)], "s int")
    assert sorted(r["rank"] for r in ordering.max_rank(df, "s").collect()) == [1, 2, 4, 4, 5]
    assert ordering.max_rank(df, "s").where("rank <= 3").count() == 2


def test_vocabulary(spark):
    phrases = spark.createDataFrame([("svulst (akutt): svulster - hjerte", 0), ("hjerte svulst", 1)], "phrase string, ord bigint")
    words = spark.createDataFrame([("hjerte", 7), ("hjerte", 7), ("svulst", 200), (None, 1), ("", 2)], "word string, count bigint")
    got = {r.term: (r.snomed_count, r.corpus_count) for r in vocabulary.vocabulary(phrases, words).collect()}
    assert got == {"hjerte": (2, 7), "akutt": (1, 0), "svulster": (1, 0)}
    merged = {r.term: (r.n_variants, r.corpus_count) for r in vocabulary.vocabulary(phrases, words, merge=True, max_corpus=500).collect()}
    assert merged["svulst"] == (2, 200)
    assert vocabulary.vocabulary(phrases.limit(0), words.limit(0)).count() == 0


@pytest.mark.parametrize("s, want", [("Tumor vokser", ["tumor"]), ("en Tumor", []), ("TUMOR", []), ("En ikke-tumor-celle.", ["tumor"]), ("tumorer og svulst, tumor", ["tumor", "kul"]), (None, []), ("", [])])
def test_used_terms(spark, s, want):
    p = make_plan(spark, [("tumor", 0, 1, None), ("kul", 0, 1, ["svulst", "v", " "]), ("v", 0, 1, [])])
    got = matching.used_terms(spark.createDataFrame([(1, s)], "id int, text string"), "id", "text", p).collect()
    assert [r.used_terms for r in got] == [want]
    assert {r.surface: r.target for r in matching.surfaces(p).collect()}["v"] == "v"


def test_plan(spark):
    p = make_plan(spark, [("a", 1, 5, None), ("b", 0, 1, None)])
    recs = spark.createDataFrame([(1, ["a", "a", " "], "{}"), (2, [], "{}"), (3, None, "a b"), (4, ["x", "b"], None)], "id int, used_terms array<string>, result string")
    assert {r.id: r.used_terms for r in plan.evaluated(recs, p, "id").collect()} == {1: ["a"], 2: [], 3: ["a", "b"], 4: ["b"]}
    assert {r.id: r.used_terms for r in plan.evaluated(recs, p, "id", "all").collect()}[2] == []
    up = {r.term: (r.used_in_output, r.target_remaining) for r in plan.updated_plan(p, recs).collect()}
    assert up == {"a": (1, 3), "b": (1, 0)}
    assert not plan.is_complete(p.limit(0)).first().complete
    hundred = p.withColumn("target_remaining", plan.F.lit(100))
    assert [plan.estimated_targets(hundred, 10, e).first().target_remaining for e in ("none", "low")] == [23, 17]


def test_quality(spark):
    def t(n):
        return str({"text": "a" * n})

    rows = [(1, ["a", "b"], t(500)), (2, None, t(500)), (3, ["a"] * 3, "x"), (4, ["a"] * 3, str({"text": "  "})), (5, ["a"] * 3, t(399)), (6, ["a"] * 3, t(400)), (7, ["a"] * 3, t(600)), (8, ["a"] * 3, t(601)), (9, [], None)]
    judged = quality.with_reasons(spark.createDataFrame(rows, "id int, used_terms array<string>, result string"), quality.Limits(3, 400, 600))
    assert {r.id: r.filter_reason for r in judged.collect()} == {1: "too_few_used_terms", 2: "too_few_used_terms", 3: "invalid_result_literal", 4: "missing_text", 5: "too_short", 6: None, 7: None, 8: "too_long", 9: "too_few_used_terms"}
    assert quality.filter_totals(judged).first() == (9, 2, 7)
    with pytest.raises(ValueError):
        quality.restore_reasons(" , ")


def scan_prune(rows, required):
    count = {}
    for _, _, terms in rows:
        for t in terms:
            count[t] = count.get(t, 0) + 1

    def turn(r):
        head, _, tail = r[1].rpartition("_")
        return (int(tail), head, r[0]) if tail.isdigit() and head else (10**9, "", r[0])

    gone = set()
    for n, _, terms in sorted(rows, key=turn, reverse=True):
        if not terms or all(count[t] - 1 >= required.get(t, 0) for t in terms):
            gone.add(n)
            for t in terms:
                count[t] -= 1
    return gone


def scan_restore(rejected, have, ids, required):
    count, back = dict(have), set()
    ids = set(ids)
    for n, rid, terms in rejected:
        if rid not in ids and any(count.get(t, 0) < required.get(t, 0) for t in terms):
            back.add(n)
            ids.add(rid)
            for t in terms:
                count[t] = count.get(t, 0) + 1
    return back


@pytest.mark.parametrize("seed", [1, 2])
def test_prune_equals_scan(spark, seed):
    rng = random.Random(seed)
    rows = [(n, rng.choice([f"a_{rng.randrange(9):03d}", f"b_{rng.randrange(4)}", "x"]), rng.sample("abcdef", rng.randrange(4))) for n in range(60)]
    p = make_plan(spark, [(t, 0, rng.randrange(12), None) for t in "abcd"])
    required = {r.term: r.target_count for r in p.collect()}
    df = spark.createDataFrame(rows, "n int, id string, used_terms array<string>")
    assert {r.n for r in coverage.pruned(df, p, "n").collect()} == scan_prune(rows, required)


def test_restore_equals_scan(spark):
    rng = random.Random(3)
    rejected = [(n, f"r{rng.randrange(30)}", rng.sample("abcdef", rng.randrange(4)), rng.choice(["too_long", "too_short"])) for n in range(50)] + [(100, "r1", ["a"], "obsolete_x"), (101, None, ["a"], "too_long")]
    kept = [("k1", ["a"]), ("r2", ["b"])]
    p = make_plan(spark, [(t, 0, rng.randrange(6), None) for t in "abcd"])
    required = {r.term: r.target_count for r in p.collect()}
    df = spark.createDataFrame(rejected, "n int, id string, used_terms array<string>, filter_reason string")
    out = spark.createDataFrame(kept, "id string, used_terms array<string>")
    may = [r[:3] for r in rejected if r[3] == "too_long" and r[1] not in (None, "r1")]
    got = {r.n: r.verdict for r in coverage.restored(df, out, ["too_long"], df.select("n"), "n", p).collect()}
    assert {n for n, v in got.items() if v == "restored"} == scan_restore(may, {"a": 1, "b": 1}, {"k1", "r2"}, required)
    assert got[101] == "invalid" and len(got) == len(rejected)


def best_cost(pieces, compat):
    best, n = None, len(pieces)
    whole = len(" ".join(pieces))
    for k in range(max(1, -(-whole // 300)), min(max(-(-whole // 150), 1), n) + 1):
        for cuts in combinations(range(1, n), k - 1):
            at = [0, *cuts, n]
            sizes = [len(" ".join(pieces[a:b])) - (a - 1 if compat and a else 0) for a, b in zip(at, at[1:])]
            if max(sizes) <= 300 and (best is None or sum(map(chunking.chunk_cost, sizes)) < best):
                best = sum(map(chunking.chunk_cost, sizes))
    return best


@pytest.mark.parametrize("compat", [True, False])
def test_chunks_cost_least(compat):
    rng = random.Random(5)
    for _ in range(60):
        pieces = ["x" * rng.randrange(10, 200) for _ in range(rng.randrange(2, 9))]
        got = chunking.best_chunks(pieces, compat)
        if got is None:
            assert best_cost(pieces, compat) is None
            continue
        assert " ".join(got) == " ".join(pieces)
        starts, sizes = 0, []
        for c in got:
            sizes.append(len(c) - (starts - 1 if compat and starts else 0))
            starts += len(c.split(" "))
        assert sum(map(chunking.chunk_cost, sizes)) == best_cost(pieces, compat)


def test_chunk_rows(spark):
    rows = [("a", '{"text": "kort"}'), ("b", '{"text": "' + "x" * 301 + '"}'), ("c", '{"text": "' + ("Dette er en setning på noen ord. " * 20).strip() + '"}')]
    df = spark.createDataFrame(rows, "id string, result string")
    got = chunking.split_records(df.withColumnRenamed("id", "k"), "k", "result", compat=False).collect()
    assert [r.id for r in got if r.k == "a"] == ["a_1"] and all(len(r.result) <= 300 + 11 for r in got)
    assert [tuple(r) for r in chunking.split_problems(df, "id", "result").collect()] == [("b", "unsplittable")]


def test_records(spark):
    df = spark.createDataFrame([("a_001", "x", None), ("a_007", None, "y"), (None, "z", "q")], "id string, result string, response string")
    assert records.id_result(df).count() == 1 and records.id_result_totals(df).first() == (1, 2)
    assert {r.result for r in records.canonical(df).collect()} == {"x", "y", "z"}
    assert [tuple(r) for r in records.max_counters(df).collect()] == [("a", 7)]
    new = spark.createDataFrame([("a_001", "n"), ("b", "m")], "id string, result string")
    assert {(r.id, r.result) for r in records.upserted(df.select("id", "result").where("id IS NOT NULL"), new).collect()} == {("a_001", "n"), ("a_007", None), ("b", "m")}
    assert records.not_completed(df, new).count() == 2 and records.pending(new, df).count() == 1 and records.has_pending(new, df)


def test_prompts(spark):
    p = make_plan(spark, [("a", 0, 2, None), ("b", 0, 0, None), (" ", 0, 3, None)])
    seq = prompts.prompt_sequence(p, spark.createDataFrame([("t0_009",), ("x",)], "id string"), all_needed=True)
    assert sorted(r.id for r in seq.collect()) == ["t0_010", "t0_011"]
    pool = spark.createDataFrame([(c,) for c in "abcde"], "phrase string")
    assert prompts.sample_rows(pool, 3, 1, "phrase").count() == 3 and prompts.sample_rows(pool, 12, 1, "phrase").count() == 12
    stage = spark.createDataFrame([("S1", "1"), ("S2", "x"), (None, "=SUM(A)")], "Scenario string, flag string")
    made = prompts.round_robin(7, [("a.txt", "${scenario}|${snomed_required}|${snomed_optional}"), ("b.b.txt", "$snomed_required")], pool, stage, 3, optional=2).collect()
    assert sorted(r.id for r in made) == ["a_1", "a_2", "a_3", "a_4", "b.b_1", "b.b_2", "b.b_3"]
    assert all(r.prompt.split("|")[0] in ("S1", "S2") and len(r.prompt.split("|")[2].split(", ")) == 2 for r in made if r.template == "a.txt")
    assert {r.scenario: r.flag for r in prompts.flags(stage, "flag").collect()} == {"S1": 1, "S2": None}


def test_scores(spark):
    schema = "rel_path string, ok boolean, mos double, mos_0_100 double, duration_s double"
    none = scores.summary(spark.createDataFrame([], schema)).first()
    assert none.files_total == 0 and np.isnan(none.mos_mean) and none.duration_hours == 0.0
    df = spark.createDataFrame([("a", True, 3.0, 50.0, 3600.0), ("b", False, None, None, None)], schema)
    got = scores.summary(df).first()
    assert (got.files_scored, got.files_failed, got.mos_median, got.duration_hours) == (1, 1, 3.0, 1.0) and np.isnan(got.mos_std)
    assert sum(r.n for r in scores.histogram(df).collect()) == 1 and scores.histogram(df).count() == 20


def test_calls(spark):
    tries = []

    def model(p):
        tries.append(p)
        if p == "bad":
            raise ValueError("no")
        return '{"output": "' + p.upper() + '"}'

    calls = generate.Calls(2, 2, 1, 0.0)
    df = spark.createDataFrame([("1", "t", "p"), ("2", "t", "bad")], "id string, template string, prompt string")
    got = {r.id: (r.result, r.error) for r in generate.new_outputs(df, model, calls).collect()}
    assert got["2"] == ("", "ValueError: no") and got["1"][1] is None
    with pytest.raises(RuntimeError):
        generate.answer_one("bad", model, calls)
    rows = [("1", '{"text": "tre-fire"}', "f", 1), ("2", '{"text": "bad"}', "f", 2), ("3", "{}", "f", 3)]
    spoken = generate.spoken_forms(spark.createDataFrame(rows, "id string, result string, file string, line_no bigint"), model, calls)
    assert {r.id: r.status for r in spoken.collect()} == {"1": "changed", "2": "failed_llm_normalization", "3": "skipped_invalid_result"}
    assert generate.failures_log(spoken).count() == 2


def test_audio(spark):
    import io
    import wave

    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes(np.zeros(16000, "<i2").tobytes())
    df = spark.createDataFrame([("a.wav", bytearray(out.getvalue())), ("b.wav", bytearray(b"x"))], "rel_path string, content binary")
    got = {r.rel_path: r for r in generate.audio_scores(df, lambda: lambda wave, rate: 1 + len(wave) / rate).collect()}
    assert got["a.wav"].mos == 2.0 and got["a.wav"].mos_0_100 == 25.0 and got["a.wav"].channels == 2 and not got["b.wav"].ok and got["b.wav"].error


def test_loop(spark):
    words = spark.createDataFrame([(1, "t0", "svulst", 1, 0, ["svulst"], ["stor svulst"])], "rank bigint, term_id string, term string, snomed_count bigint, corpus_count bigint, variants array<string>, usage array<string>")
    stage = spark.createDataFrame([("S",)], "Scenario string")
    done, out, bad = fill_plan(plan.init_plan(words, 2), words, stage, "${scenario} ${snomed_required} ${snomed_optional}", lambda p: str({"text": "En svulst. " * 40}), quality.Limits(1, 400, 600), rounds=4)
    assert done.first().target_remaining == 0 and out.count() == 2 and bad.count() == 0
