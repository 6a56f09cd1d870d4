"""Pieces of at most 300 code points and the level of their cuts."""

import random
import re

import pytest

import __spark_entry__ as driver
from kornverk.llm.pieces import byte_ranges, cut_level, cut_levels, pieces, split_pieces

SENTENCE = "Pasienten har hatt vondt i hodet siden mandag og tar tabletter. "
PARAGRAPH = (SENTENCE * 4).strip()
TEXTS = {
    "paragraph": PARAGRAPH + "\n \n" + PARAGRAPH,
    "sentence": PARAGRAPH + "\n" + PARAGRAPH,
    "word": "vondt i hodet " * 40,
    "inside_word": "Hun sa " + "a" * 400 + " og gikk. " + SENTENCE * 3,
}


@pytest.mark.parametrize("level", TEXTS)
def test_levels_and_pieces(level):
    text = TEXTS[level]
    assert cut_level(text) == level
    got = pieces(text)
    assert got[0][:2] == (0, 0)
    assert all(0 < e - s <= 300 for _, _, s, e in got)
    assert "".join(re.sub(r"\s", "", text[s:e]) for _, _, s, e in got) == re.sub(r"\s", "", text)
    for (_, _, s, e), (a, b, _, _) in zip(got, got[1:]):
        assert s <= a <= b <= e and b - a <= 60


def test_cuts_and_leads():
    text = TEXTS["sentence"]
    assert [text[s:e] for _, _, s, e in pieces(text)] == [PARAGRAPH, PARAGRAPH]
    assert [text[a:b] for a, b, _, _ in pieces(text)] == ["", "har hatt vondt i hodet siden mandag og tar tabletter."]
    text = TEXTS["inside_word"]
    assert [text[s:e] for _, _, s, e in pieces(text)][:2] == ["Hun sa", "a" * 300]
    assert [text[a:b] for a, b, _, _ in pieces(text)][:3] == ["", "Hun sa", ""]


def test_a_single_line_break_is_no_empty_line():
    for end in ("\n", "\r\n", "\r"):
        assert cut_level(PARAGRAPH + end + PARAGRAPH) == "sentence"
        assert cut_level(PARAGRAPH + end + " " + end + PARAGRAPH) == "paragraph"


def test_p7_found(spark, tmp_path):
    answers = [(i, t) for i, t in enumerate(TEXTS.values())] + [(0, TEXTS["paragraph"]), (7, '{"text": "' + SENTENCE * 6), (8, SENTENCE), (9, None)]
    df = spark.createDataFrame(answers, "output_id bigint, result string")
    df.write.parquet(f"{tmp_path}/outputs.parquet")
    assert sorted(map(tuple, driver.queries()["p7_found"](spark, str(tmp_path)).collect())) == list(enumerate(TEXTS))
    got = sorted(split_pieces(df, "output_id", "result").collect())
    assert [(r.piece_no, r.lead, r.piece) for r in got if r.output_id == 1] == [(1, "", PARAGRAPH), (2, "har hatt vondt i hodet siden mandag og tar tabletter.", PARAGRAPH)]


def lines(seed: int) -> str:
    """A text of lines that may be blank or end in any way, with quotations, spaceless and Greek lines, and long words or none."""
    rng = random.Random(seed)
    kinds = ["Hun kom kl. 12. Så gikk hun", "«Vent litt. Sett deg", "ble igjen.» Ja. ", "今日は良いです また来ます", "Πού πονάει; Εδώ; ", "; ja", "æ" * 30, "", " ", "\t", "", "1. "]
    return "".join(rng.choice(kinds) + rng.choice(["\n", "\n", "\n", "\r\n", "\r", "\x85", "\u2028", " "]) for _ in range(rng.randrange(1, 25)))


def test_ranges_give_the_levels_of_whole_texts(spark):
    texts = {i: lines(i) for i in range(600)} | {1000 + i: t for i, t in enumerate(TEXTS.values())}
    df = spark.createDataFrame(list(texts.items()) + [(1000, TEXTS["paragraph"]), (None, TEXTS["word"]), (2000, None)], "output_id bigint, result string")
    for most, size in ((60, 1), (60, 40), (110, 100)):
        got = dict(map(tuple, cut_levels(df, "output_id", "result", most, size).collect()))
        assert got == {k: cut_level(t, most) for k, t in texts.items() if len(t) > most}
        assert len(set(got.values())) == 4 or most > 60


def test_ranges_of_a_giant_text():
    text = (PARAGRAPH + "\n") * 1000 + "å" * 200
    parts = byte_ranges(text, 1 << 16)
    assert "".join(parts) == text and len(parts) == 4
    assert all(p.endswith("\n") and 1 << 16 <= len(p.encode()) < (1 << 16) + 300 for p in parts[:-1])
