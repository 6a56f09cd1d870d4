"""Cut texts: held-out accuracy on texts cut here, and defined results for odd rows."""

import random

import pytest

from kornverk.llm.sentences import spans
from kornverk.llm.truncation import score_text, share_by_source, train, truncation

SUBJECTS = "Pasienten Legen Sykepleieren Dr. Dahl Fru Berg Moren Naboen Kirurgen".replace("Dr. Dahl", "Dr._Dahl").replace("Fru Berg", "Fru_Berg").split()
VERBS = "fikk så kjente ventet på spurte om".replace("ventet på", "ventet_på").replace("spurte om", "spurte_om").split()
THINGS = "en ny time|2,5 mg medisin kl. 12.30 hver dag|svar fra dr. Lie|vondt i hodet, bl.a. om natten|kaffe, te osv.|en prøve ca. fem ganger".split("|")


def text(rng: random.Random) -> str:
    made = [f"{rng.choice(SUBJECTS)} {rng.choice(VERBS)} {rng.choice(THINGS)}".replace("_", " ") for _ in range(rng.randrange(4, 9))]
    return " ".join(m if m.endswith(".") else m + rng.choice("..!?") for m in made)


def test_held_out():
    rng = random.Random(5)
    w = train([text(rng) for _ in range(400)]).tolist()

    def cut(s: str) -> bool:
        return score_text(s, "object", spans(s), w)[2] > 0

    whole = [text(rng) for _ in range(300)]
    parts = [p for s in whole if len(p := s[: rng.randrange(len(s) // 2, len(s))].rstrip()) not in {b for _, b in spans(s)} and p != s]
    assert sum(map(cut, whole)) <= 6
    assert sum(map(cut, parts)) >= 0.97 * len(parts)
    assert cut(whole[0] + " Da svarte dr.") and not cut(whole[0] + " Han fikk kaffe, te osv.")
    assert not cut("\n".join(s.rstrip(".!?") for s in whole[0].split(". ")).replace("!", "").replace("?", "").replace(". ", " "))


def test_rows(spark):
    rng = random.Random(6)
    rows = [(i, text(rng), "a") for i in range(300)]
    rows += [(1000, rows[0][1][:-8], "b"), (1000, rows[0][1][:-8], "b"), (1001, None, "b"), (1002, " ", None), (None, "x", "b"), (1003, "...", "b"), (1004, '{"text": "' + rows[1][1][:-8], None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "output_id bigint, result string, source string, cut int")
    got = truncation(df, "output_id", "result", "source")
    cut = {r.output_id: r.cut for r in got.collect()}
    assert cut[1000] and cut[1004] and not {1001, 1002, 1003, None} & set(cut) and sum(cut[i] for i in range(300)) <= 6
    assert {r.source: r.records for r in share_by_source(got, "source").collect()} == {"a": 300, "b": 1, None: 1}


def test_limits_count(spark):
    from kornverk.llm.truncation import with_limits

    rows = [("a", 100, True, -1.0, 1.0)] * 5 + [("a", 97, True, -1.0, 1.0), ("a", 100, False, -1.0, -1.0), ("b", 100, True, -1.0, 1.0)]
    got = with_limits(spark.createDataFrame(rows, "source string, length int, open boolean, away double, near double")).groupBy("source", "length", "open").agg({"cut": "max"}).collect()
    assert {tuple(r)[:3]: r[3] for r in got} == {("a", 100, True): True, ("a", 97, True): False, ("a", 100, False): False, ("b", 100, True): False}


@pytest.mark.parametrize("schema", ["output_id bigint, result string, source string"])
def test_empty(spark, schema):
    assert truncation(spark.createDataFrame([], schema), "output_id", "result", "source").count() == 0
