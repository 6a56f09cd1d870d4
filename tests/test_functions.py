"""Text functions, identifiers, stems and readers of answers."""

import pytest
from pyspark.sql import functions as F

from kornverk.functions import containers, ids, stems, text


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'boolean' if isinstance(v, bool) else 'bigint' if isinstance(v, int) else 'string'}" for k, v in values.items())).select(column.alias("v")).first().v


@pytest.mark.parametrize("s, want", [("12-3", []), ("7", []), ("-x-", ["x"]), ("sjögren", []), ("a_b", []), ("T-celle", ["T-celle"]), ("a b", ["a", "b"]), ("alfa-1-antitrypsin", ["alfa", "antitrypsin"]), ("blå, (rød) 5", ["blå", "rød"]), (" ", []), (None, None)])
def test_tokens(spark, s, want):
    assert one(spark, text.tokens("t"), t=s) == want


@pytest.mark.parametrize("s, want", [("1,25", False), ("cis-a", True), ("alfa-1-antitrypsin", True), ("T-celle", False), ("a-b-c-d-e-f-g-1", True)])
def test_chemical(spark, s, want):
    assert one(spark, text.is_complex_chemical("t"), t=s) is want


def test_phrases(spark):
    assert one(spark, text.phrase_candidates("t"), t="hjerte (akutt): svikt - kronisk") == ["akutt", "hjerte (akutt)", "svikt", "kronisk"]
    assert one(spark, text.clean_phrase("t"), t=" 50 % dose ") == "50 prosent dose"
    assert one(spark, text.clean_phrase("t"), t="a/b") is None


def test_sentences(spark):
    assert one(spark, text.sentences_quoted("t"), t=" «Kom.» Han gikk! ") == ["«Kom.»", "Han gikk!"]
    got = one(spark, text.sentence_tokens("t"), t="2 Tumor. Den vokser")
    assert [(r.token, r.start) for r in got] == [("Tumor", True), ("Den", True), ("vokser", False)]
    assert one(spark, text.hyphen_candidates("t"), t="ikke-tumor-celle") == ["ikke", "ikke-tumor", "tumor", "tumor-celle", "celle"]


@pytest.mark.parametrize("s, title, lower", [("Tumor", True, False), ("TUMOR", False, False), ("T", False, False), ("tumor", False, True), ("A1", False, False)])
def test_case(spark, s, title, lower):
    assert one(spark, text.is_titlecase("t"), t=s) is title and one(spark, text.is_lower("t"), t=s) is lower


def test_templates(spark):
    fill = text.fill_template(F.lit("$a og ${b} for $$5"), {"a": F.lit("${b}"), "b": F.lit("$$")})
    assert one(spark, fill, t="") == "${b} og $$ for $5"
    with pytest.raises(Exception, match="no value"):
        one(spark, text.fill_template(F.lit("${c}"), {"a": F.lit("x")}), t="")


@pytest.mark.parametrize("n, want", [(0, "000"), (35, "00z"), (36, "010"), (46656, "1000")])
def test_base36(spark, n, want):
    assert one(spark, ids.base36("n"), n=n) == want


@pytest.mark.parametrize("s, want", [("abc_012", (12, "abc")), ("abc", (10**9, "")), ("a_b_3", (3, "a_b")), (None, (10**9, ""))])
def test_generation(spark, s, want):
    assert (one(spark, ids.generation("t"), t=s), one(spark, ids.generation_prefix("t"), t=s)) == want


def test_ids(spark):
    assert one(spark, ids.normalize_identifier("t"), t=" Blå-Øye 2") == "blåøye"
    assert one(spark, ids.prompt_id("t", F.lit(1234)), t="a") == "a_1234"


@pytest.mark.parametrize("word, want", [("svulsten", "svulst"), ("svulster", "svulst"), ("operasjonene", "operasjon"), ("havnedistriktene", "havnedistrikt"), ("vaktmestere", "vaktmester"), ("farlig", "far"), ("opning", "opning")])
def test_stems(word, want):
    assert stems.stem(word) == want


def test_stem_key():
    assert stems.stem_key("T-Celler-12") == "t-cell-12" and stems.stem_key(None) is None


@pytest.mark.parametrize("s, valid, want", [('{"text": null}', False, None), ('{"text": "A" "B"}', True, "AB"), ('{"text":"a",}', True, "a"), ('{"text": "a\\/b"}', True, "a\\/b"), ('{"text": "a"} x', False, None), ("{[]: 1}", False, None), (None, False, None)])
def test_literals(s, valid, want):
    assert containers.literal_text(s) == (valid, want)


def test_answers():
    assert containers.answer_text("bare tekst") == "bare tekst"
    assert containers.answer_text('{"text": "a"}') == "a" and containers.answer_text('{"x": 1}', "b") == "b" and containers.answer_text(None) is None


@pytest.mark.parametrize("s, want", [('{"text": "A" "B"}', "A B"), ('{"text": "a\\\'b"}', "a'b"), ("ingen", None), ('{"text": 5}', None), ('{"text": "A" x', None), ('{"text": "A" "B ', None)])
def test_recovered(s, want):
    assert containers.recovered_text(s) == want


@pytest.mark.parametrize("s, want", [('noise {"output":"x"} noise', "x"), ('{"other":1}', None), ("", None), ("[1]", None)])
def test_spoken(s, want):
    got, error = containers.spoken_output(s)
    assert got == want and (error is None) == (want is not None)
