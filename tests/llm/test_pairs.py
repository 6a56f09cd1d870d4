"""Defects of pairs."""

import random

import pytest

from kornverk.llm.automaton import SuffixAutomaton
from kornverk.llm.pairs import copied_words, defects, flags, is_norwegian
from kornverk.llm.sentences import spans


def brute(answer: list[str], prompt: list[str], run: int) -> int:
    inside = set()
    for i in range(len(answer) - run + 1):
        if any(answer[i : i + run] == prompt[j : j + run] for j in range(len(prompt) - run + 1)):
            inside |= set(range(i, i + run))
    return len(inside)


def test_copied_words_equal_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        prompt, answer = (rng.choices("abcd", k=rng.randrange(40)) for _ in range(2))
        if len(prompt) > 10:
            answer[2:2] = prompt[3:10]
        for run in (1, 3, 5):
            assert copied_words(answer, prompt, run) == brute(answer, prompt, run)
            assert SuffixAutomaton(prompt).covered(answer, run) == brute(answer, prompt, run)


def found(text, prompt=None):
    return flags(text, prompt, spans(text or ""))


@pytest.mark.parametrize("text", ["Beklager, men jeg kan ikke hjelpe med et notat om dette.", "I'm sorry, but I can’t write this dialogue. Feel free to ask me something else.", "Eg kan ikkje skrive denne teksten."])
def test_refusals(text):
    assert "refusal" in found(text)


@pytest.mark.parametrize(
    "text",
    [
        "Legen svarte: «Det kan jeg dessverre ikke hjelpe deg med før prøvene er klare.» Pasienten gikk hjem og sov til neste dag. Moren ringte legevakten sent på kvelden. De fikk time.",
        "Lege: Jeg kan ikke komme i dag. Pasient: Da venter jeg til i morgen.",
        "Pasienten har vondt i hodet.",
    ],
)
def test_no_refusals(text):
    assert "refusal" not in found(text)


@pytest.mark.parametrize("s, norwegian", [("Pasienten kom hjem og sov.", True), ("Eg veit ikkje kva som skjer.", True), ("Sygeplejersken havde ikke ventet det efter morgenturen.", False), ("Läraren borde hålla koll på yrseln.", False), ("The nurse was late.", False), ("Die Pflegerin kam nicht.", False), ("Ο γιατρός ήρθε.", False), ("Oligoneurospastose.", True)])
def test_language(s, norwegian):
    assert is_norwegian(s) == norwegian


def test_flags():
    assert found(None) == found("") == found(" ... ") == ["empty"]
    line = "Skriv en samtale på omtrent hundre ord om hodepine"
    assert found(line + " nå.", line) == ["echo"]
    assert found("The nurse was here. He left with her.") == ["wrong_language"]
    assert found("As a language model, I cannot provide that.") == ["refusal", "wrong_language"]


def test_rows(spark):
    rows = [(1, None, None, "a"), (1, None, None, "a"), (2, None, "Alt er bra.", None), (None, "p", "r", "a"), (3, "p", '{"text": "The nurse was here. She left the', "a")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "output_id bigint, prompt string, result string, source string, defect string")
    got = {tuple(r) for r in defects(df, "output_id", "prompt", "result", "source").collect()}
    assert {(1, "empty"), (3, "wrong_language")} <= got and {k for k, _ in got} <= {1, 3}
    assert defects(df.limit(0), "output_id", "prompt", "result", "source").count() == 0
