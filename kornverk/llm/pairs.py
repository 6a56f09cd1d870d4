"""Broken pairs of prompt and answer: empty, cut off, refused, copied from the prompt, or not Norwegian.

Copies are measured by running the words of the answer through the suffix automaton of the words of the prompt. Refusals are
found by an automaton of phrases that decline or offer something else instead, sentence by sentence, outside quotations; the
answer as a whole declines if nothing else of weight is said. Languages are voted on by the stopwords of each sentence.
"""

from __future__ import annotations

import re
from functools import cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arrow import map_columns
from .automaton import SuffixAutomaton
from .sentences import spans
from .text import result_text, words
from .truncation import SAMPLE, score_text, trained, with_limits

RUN = 5

# Phrases that decline a task (Norwegian in both forms, Swedish, Danish, English, German), and those that go with them.
DECLINES = """
jeg kan ikke|jeg kan dessverre ikke|kan jeg ikke|kan jeg dessverre ikke|jeg kan desverre ikke|jeg har ikke anledning til|jeg har dessverre ikke anledning til|jeg har ikke mulighet til|
jeg har dessverre ikke mulighet til|ikke anledning til å|jeg ønsker ikke å|jeg vil ikke|jeg må takke nei|må takke nei til|jeg må avstå|må avstå fra|jeg må avslå|må dessverre avslå|ligger utenfor det jeg|
utenfor det jeg kan|ikke være forsvarlig av meg|ikke forsvarlig av meg|ikke noe jeg har lov|har ikke lov til å|har jeg ikke lov|jeg er ikke i stand til|er jeg ikke i stand til|kan ikke bistå|kan ikke hjelpe|
ikke noe jeg kan|jeg får ikke lov|jeg kan heller ikke|jeg er nødt til å avslå|eg kan ikkje|kan eg ikkje|eg kan diverre ikkje|eg må takke nei|eg må avstå|eg ønskjer ikkje å|eg vil ikkje|har ikkje lov til|eg har ikkje høve til|
utanfor det eg kan|jag kan inte|kan jag inte|jag kan tyvärr inte|jag måste avböja|jag får inte|jeg må afvise|jeg må desværre afvise|jeg kan desværre ikke|i cannot|i can't|i can not|i won't|i will not|i'm unable|
i am unable|i'm not able|i am not able|i must decline|i have to decline|i'm not allowed|i am not allowed|not something i can|ich kann nicht|ich kann leider|kann ich nicht|kann ich leider nicht|ich muss ablehnen
"""
GOES_WITH = """
beklager|unnskyld|dessverre kan|si fra hvis|si ifra hvis|spør gjerne|ta heller kontakt|ta kontakt med|kontakt helsepersonell|håper du har forståelse|du kan omformulere|kan svare på spørsmål|jeg kan i stedet|jeg kan heller|
kan jeg i stedet|noe annet jeg kan|takk for forståelsen|gi beskjed om|orsak|sei frå om|spør gjerne|ta heller kontakt|eg kan i staden|förlåt|tyvärr|hör av dig|fråga gärna|undskyld|sig til hvis|feel free|let me know|please consult|
please contact|thank you for understanding|i can offer|i can instead|i'd be happy|i would be happy|happy to help|i'm sorry|i am sorry|i apologize|unfortunately|entschuldigung|es tut mir leid|leider|bitte wenden sie sich
"""
# Frequent words of Norwegian (both forms) and of languages it may be taken for; words of Norwegian count for it alone.
NORWEGIAN = """
og i på vi det med til ikke kan av er om at ble for har seg må når etter jeg som men så ved å ser noen ut eg ikkje dei frå ein eit då meir hennar ho han den der de du en et fra da var vil skal hun hva hvis hvordan min mitt din
dine også bare eller enn mot under over før siden noe mer mye andre alle være vært blir bli får fikk gikk går kom står sier sa hadde kunne ville skulle deretter fordi både hver hvert annenhver dette disse denne sin sitt sine ham henne
meg deg oss dere dem nå her hos uten mellom gjennom videre igjen dessverre ganske helt litt veldig ofte aldri alltid uker ganger korleis kva kvar kvifor nokon noko ikkje berre etter mykje verte vart blei vore gjer seie skjøna venta
hennes sammen saman jobber kjenner kjente derfra hatt kun lenge varer virket gis tidligere særlig allerede heller burde hans ned bør mor mora bror broren helst når skrev skreiv flere gjerne snakke følgje veke veker gonger heile høyrde trass mi rundt først ei
""".split()
OTHERS = {
    "sv": "på i om med av som kan det har den ville men var ut så under han de vi du dem och är inte att ett efter från jag hon honom hade blev nästan väg till mycket någon något några sedan också hennes för över när sig väntat måste än varje kväll veckor sjuksköterskan skrev noga vill hellre mot utan genom borde",
    "da": "i på vi det med til kan er om for har men så ved en et fra den der de du da var vil skal også eller under over før siden andre alle af ikke hvad efter blev nogle noget meget hun jeg mig dig sig hvordan hvorfor kunne skulle ville uden gennem igen aldrig altid uger gange været går siger nu sygeplejersken og at sig havde hendes spurgte sige næsten trods dage vej ældre kvinde gerne tale hellere helst mærket omkring lige sidste sidst undgå nævnte omhyggeligt klagede bør sammen mor bror hans når ned skrev flere hver anden aften",
    "en": "the and of to is was with after her his she he my a an in on for that not would about from has had been before during every who keeps did does you your it this i cannot can will must be as or at by if please thank are",
    "de": "der die das und ist nicht nach mit ein eine einen dem den des im am zu zum zur seit trotz über unter auf aus bei von vor hat war wird ich sie er wir ihr sein ihre jeden fast für gegen neben endlich lieber beinahe",
    "nl": "de het een en van niet met voor zijn haar was naar bij ook maar heeft geen wordt dat deze",
    "fr": "le la les un une des et est pas dans pour avec sur au aux du elle il nous vous qui que son sa ses après avant",
    "es": "el la los las un una y es no en por con para del al que su sus se después antes",
    "it": "il lo la gli le un una e è non di che con per del della suo sua dopo prima",
    "fi": "ja on ei se hän että mutta kun oli ovat olla tämä joka myös hänen ennen jälkeen kanssa ilman",
    "pl": "i w na z nie się jest do to że po o jak od przed przez była był jego jej",
    "is": "og er ekki að það við sem hún hann var eftir með fyrir ég af um til",
}
_WEIGHT: dict[str, dict[str, float]] = {}
for _w in NORWEGIAN:
    _WEIGHT.setdefault(_w, {})["no"] = 1.0
for _l, _list in OTHERS.items():
    for _w in _list.split():
        _WEIGHT.setdefault(_w, {})[_l] = 1.0
_WEIGHT = {w: {x: (1.0 if len(ls) == 1 else 0.4) for x in ls} for w, ls in _WEIGHT.items()}

_OTHER_LETTER = re.compile(r"[^\W\d_A-Za-zªºÀ-ɏʰ-ʸḀ-ỿﬀ-ﬆＡ-Ｚａ-ｚ]")
_LETTER = re.compile(r"[^\W\d_]")
_QUOTED = re.compile(r"«[^»]*(?:»|\Z)|\"[^\"]*\"|“[^”]*(?:”|\Z)")
_SPEAKER = re.compile(r"\s*[^\W\d_][\w .]{0,30}:\s")


def _plain(text: str) -> str:
    return text.replace("’", "'").replace("‘", "'").replace("`", "'").lower()


def copied_words(answer: list[str], prompt: list[str], run: int = RUN) -> int:
    """Words of the answer in runs of ``run`` words or more that stand in the prompt too.

    The automaton is built only where the two share a run at all.
    """
    if len(answer) < run or len(prompt) < run:
        return 0
    runs = set(zip(*(prompt[i:] for i in range(run))))
    if runs.isdisjoint(zip(*(answer[i:] for i in range(run)))):
        return 0
    return SuffixAutomaton(prompt).covered(answer, run)


@cache
def _phrases() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, lines in (("with", GOES_WITH), ("declines", DECLINES)):
        for p in lines.replace("\n", "").split("|"):
            found.add_word(f" {p} ", kind)
    found.make_automaton()
    return found


def _said(sentence: str) -> str | None:
    """``declines``, ``with`` or None."""
    bare = _QUOTED.sub(" ", _plain(sentence))
    if _SPEAKER.match(bare):
        return None
    line = " " + " ".join(re.findall(r"[\w']+", bare)) + " "
    kinds = {kind for _, kind in _phrases().iter(line)}
    return "declines" if "declines" in kinds else "with" if kinds else None


@cache
def _hints() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for p in DECLINES.replace("\n", "").split("|"):
        found.add_word(p, True)
    found.make_automaton()
    return found


def is_refusal(text: str, at: list[tuple[int, int]]) -> bool:
    """One sentence declines, and those that neither decline nor go with that make up less than half of the words and are two at most."""
    if len(at) > 12 or next(_hints().iter(" ".join(_plain(text).split())), None) is None:
        return False
    kinds = [_said(text[a:b]) for a, b in at]
    if "declines" not in kinds:
        return False
    sizes = [len(text[a:b].split()) for a, b in at]
    rest = [n for n, k in zip(sizes, kinds) if k is None]
    return len(rest) <= 2 and 2 * sum(rest) < sum(sizes)


def is_norwegian(sentence: str) -> bool:
    """By script, then by the votes of its words; a sentence without any votes for another language is."""
    if _OTHER_LETTER.search(sentence) and 2 * len(_OTHER_LETTER.findall(sentence)) > len(_LETTER.findall(sentence)):
        return False
    low = sentence.lower()
    votes: dict[str, float] = {}
    for w in words(low):
        if w in _WEIGHT:
            for lang, n in _WEIGHT[w].items():
                votes[lang] = votes.get(lang, 0.0) + n
    if not low.isascii():
        umlauts, sharp, nordic = low.count("ä") + low.count("ö"), low.count("ü") + low.count("ß"), low.count("ø") + low.count("æ")
        votes["sv"] = votes.get("sv", 0.0) + 0.5 * umlauts
        votes["de"] = votes.get("de", 0.0) + 0.5 * umlauts + 0.7 * sharp
        votes["no"] = votes.get("no", 0.0) + 0.3 * nordic
    return votes.get("no", 0.0) + 0.1 >= max(votes.values(), default=0.0)


def flags(text: str | None, prompt: str | None, at: list[tuple[int, int]]) -> list[str]:
    """Defects other than a cut."""
    if not text or not any(c.isalnum() for c in text):
        return ["empty"]
    found = []
    if is_refusal(text, at):
        found.append("refusal")
    own = words(text)
    if prompt and own and 2 * copied_words(own, words(prompt)) >= len(own):
        found.append("echo")
    foreign = sum(not is_norwegian(text[a:b]) for a, b in at)
    if 2 * foreign > len(at):
        found.append("wrong_language")
    return found


def defects(df: DataFrame, key: str, prompt: str, result: str, source: str, sample: int = SAMPLE) -> DataFrame:
    """(key, defect): a row for each of ``empty``, ``truncated``, ``refusal``, ``echo`` and ``wrong_language`` that a pair has.

    Deliveries of one key count once; of unequal ones the smallest in (flags, length, score, source) stands. A null result is
    empty, a null prompt can't be copied, null keys are left out; an empty table gives an empty result.
    """
    weights = df.sparkSession.sparkContext.broadcast(trained(df, key, result, sample))
    kind = dict(df.dtypes)[key]

    def run(c: dict) -> dict:
        out: dict[str, list] = {n: [] for n in ("k", "flags", "length", "open", "away", "near", "source")}
        for k, p, raw, source in zip(c["k"], c["p"], c["r"], c["source"]):
            text, how = result_text(raw)
            lead = len(text) - len(text.lstrip()) if text else 0
            bare = text.strip() if text else ""
            at = spans(bare)
            got = score_text(text, how, at, weights.value) if text else None
            for name, v in zip(out, (k, flags(text, p, [(a + lead, b + lead) for a, b in at]), *(got or (0, False, -1.0, -1.0)), source)):
                out[name].append(v)
        return out

    rows = df.select(F.col(key).alias("k"), F.col(prompt).alias("p"), F.col(result).alias("r"), F.col(source).alias("source")).where("k IS NOT NULL")
    each = map_columns(rows, run, f"k {kind}, flags array<string>, length int, open boolean, away double, near double, source string")
    names = ["flags", "length", "open", "away", "near", "source"]
    one = each.groupBy("k").agg(F.min(F.struct(*names)).alias("v")).select("k", *[F.col(f"v.{n}").alias(n) for n in names])
    judged = with_limits(one)
    all_ = F.concat("flags", F.when(F.col("cut"), F.array(F.lit("truncated"))).otherwise(F.array().cast("array<string>")))
    return judged.select(F.col("k").alias(key), F.explode(all_).alias("defect"))

