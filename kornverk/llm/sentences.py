"""Sentence boundaries across languages and scripts.

Spaced scripts: one pass from left to right takes or rejects each terminator by itself, by local rules over the context on
both sides (abbreviations, ordinals, decimals, quotations and labels keep a sentence going); there is no lattice of
terminators and no choice between paths. Spaceless scripts: a dictionary word lattice segments each whole run, and every
word gap is classified through the closing form or final particle before it and the opening word after it; where no space
stands in the gap, only forms that close a sentence by themselves count. A line break always ends a sentence, and so does
a space in Thai, also with a number, a quotation, a bracket or a Latin word on one side; not after a label or numbering.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arrow import map_columns, one_delivery
from .text import CUT, result_text

# Abbreviations that never end a sentence, and those that may.
NEVER_END = frozenset(
    "bl.a f.eks evt ca dr kl nr tabl kaps mikst inj prof hr fr frk st jf pkt tlf avd ev ev. t.ex d.v.s dvs z.b z.t d.h i.v i.m s.c p.o "
    "mr mrs ms vs e.g i.e no fig bzw ggf vgl inkl ekskl ang vedr maks min gj.sn f.o.m t.o.m f.kr e.kr т.е т.к т.д д-р г ул см им".split()
)
MAY_END = frozenset("osv m.m m.v mv etc o.l e.l m.fl a.m p.m usw u.s.w u.a o.ä osb o.s.v т.п др пр".split())
SINGLE = frozenset("zduтеoи")

_MARKED = (
    r"«[^»\n]*(?:»|\Z)|\"[^\"\n]*\"|“[^”\n]*”|„[^“”\n]*[“”]|「[^」\n]*」|『[^』\n]*』"
    r"|[.!?…。！？؟।॥｡]+[”’')\]」』»]*|;|[\n\r\x0b\x0c\x85  ]+"
)
_PIECES = re.compile(_MARKED)
_PIECES_SPACELESS = re.compile(_MARKED + r"|[ 　\xa0]+|[぀-ヿ㐀-鿿]+")  # for texts with such a script in them
_FULL = frozenset("。！？।॥｡؟")
_MARKS = frozenset(".!?…。！？؟।॥｡")
_BREAKS = frozenset("\n\r\x0b\x0c\x85  ")
_SPACES = frozenset(" 　\xa0")
_QUOTES = frozenset("«\"“„「『")
_CLOSERS = "”’')]」』»\"“"
_OPENERS = "«\"“„「『(['‘"
_ALNUM = re.compile(r"[^\W_]")
_NUMBERING = re.compile(r"\s*(?:[^\W\d_]{1,20}:\s*)?(?:\d{1,3}|[A-Za-z]|[ivxIVX]{1,4})\Z")
_NUMBER = re.compile(r"[\d.,/:-]*\d\Z")
_SPACELESS = re.compile(r"[぀-ヿ㐀-鿿]+")
_SPACELESS_OR_THAI = re.compile(r"[฀-๿぀-ヿ㐀-鿿]")
_THAI = re.compile(r"[฀-๿]")
_STOP = re.compile(r"[.!?…。！？](?=\s|\Z)|[\n\r\x0b\x0c\x85\u2028\u2029]")
_CONTENT = re.compile(r"[ァ-ヺ㐀-鿿]")

# Dictionary for the word lattice of spaceless scripts; values are costs (final particles and openers are cheap).
FINAL = {"です": 1, "ます": 1, "ました": 1, "でした": 1, "ません": 1, "たい": 2, "か": 3, "ね": 3, "よ": 3, "た": 3, "だ": 3, "了": 3, "吗": 1, "呢": 1, "吧": 1, "啊": 2, "的": 5, "ครับ": 1, "ค่ะ": 1, "คะ": 1, "นะ": 2, "แล้ว": 2}
OPENING = {"そして": 1, "しかし": 1, "でも": 2, "また": 2, "今日": 2, "先週": 2, "昨日": 2, "私": 3, "彼": 3, "但是": 1, "然后": 1, "今天": 1, "昨天": 1, "我": 3, "他": 3, "她": 3, "医生": 2, "病人": 2, "แต่": 1, "และ": 4, "ผู้ป่วย": 1, "แพทย์": 1, "พยาบาล": 1}
_WORDS = {**FINAL, **OPENING, **{w: 4 for w in "は が を に へ で と も の から まで より 在 和 是 有 不 没有 对 从 把 被 ที่ ใน ของ ไม่ ได้ จะ มี เป็น".split()}}
# Words that close a sentence without any mark, tags that may follow them, and words that only look or go on like that.
CLOSED = frozenset("です ます ました でした ません 吗".split())
TAGS = frozenset("か ね よ".split())
HEADS = frozenset("時 際 方 件 後 場合 通り 様 所 為 者 物 事 旨 以上 限り 間 頃 程 点 故".split())
_WORDS |= {w: 4 for w in HEADS} | {w: 1 for w in "ますます 済ます 冷ます 覚ます 励ます 悩ます 澄ます 吗啡 干吗".split()}
_LONGEST = max(map(len, _WORDS))
_UNKNOWN = 8


def lattice_words(text: str) -> list[str]:
    """Cheapest path through the dictionary word lattice; a character that no word covers stands alone."""
    best: list[tuple[int, int]] = [(0, 0)]
    for i in range(1, len(text) + 1):
        cost, start = best[i - 1][0] + _UNKNOWN, i - 1
        for j in range(max(0, i - _LONGEST), i):
            c = _WORDS.get(text[j:i])
            if c is not None and best[j][0] + c < cost:
                cost, start = best[j][0] + c, j
        best.append((cost, start))
    out, i = [], len(text)
    while i:
        out.append(text[best[i][1] : i])
        i = best[i][1]
    return out[::-1]


def _closed(run: list[str]) -> bool:
    """Whether the words end in a form that closes a sentence by itself, with or without tags."""
    i = len(run) - 1
    while i > 0 and run[i] in TAGS:
        i -= 1
    return i >= 0 and run[i] in CLOSED


def _goes_on(run: list[str]) -> bool:
    """Whether the words after a closing form open a sentence: particles and heads of a relative clause don't."""
    return run[0] in OPENING or run[0] not in HEADS and bool(_CONTENT.match(run[0]))


def _run_ends(text: str, start: int, end: int) -> Iterator[int]:
    """Ends of sentences at the word gaps of the spaceless run text[start:end], and at its end where no space follows."""
    run, at = lattice_words(text[start:end]), start
    for i, w in enumerate(run):
        at += len(w)
        if (w in CLOSED or w in TAGS) and _closed(run[max(0, i - len(TAGS)) : i + 1]):
            if _goes_on(run[i + 1 :][:1]) if at < end else text[end : end + 1].isalnum():
                yield at


def _gap_ends(text: str, start: int, end: int) -> bool:
    """Whether the gap text[start:end] of a spaceless script ends a sentence."""
    before, after = text[start - 1 : start], text[end : end + 1]
    if not _SPACELESS.match(before or " "):
        return False
    at = start
    while at > 0 and _SPACELESS.match(text[at - 1]):
        at -= 1
    left = lattice_words(text[at:start])
    m = _SPACELESS.match(text, end)
    if not m:
        return after.isalnum() and _closed(left)
    right = lattice_words(m.group())
    return left[-1] in FINAL and right[0] in OPENING or _closed(left) and _goes_on(right)


def _thai_stretch(text: str, start: int, at: int) -> bool:
    """Whether what begins at ``start`` and goes on to the first stop after ``at`` is Thai: it opens in Thai, or most of its letters are."""
    m = _STOP.search(text, at)
    part = text[start : m.start() if m else len(text)]
    thai = len(_THAI.findall(part))
    first = next((c for c in part if c.isalpha() or _THAI.match(c)), "")
    return bool(_THAI.match(first)) or thai > sum(c.isalpha() for c in part if not _THAI.match(c))


def _thai_gap(text: str, sent: int, start: int, end: int) -> tuple[bool, bool]:
    """Whether Thai stands on both sides of the space text[start:end], or on one where a boundary may be; quotes and brackets are looked through."""
    left, right = start - 1, end
    while left > sent and text[left] in _CLOSERS:
        left -= 1
    while right < len(text) and text[right] in _OPENERS:
        right += 1
    sides = [0 <= i < len(text) and bool(_THAI.match(text[i])) for i in (left, right)]
    if left == start - 1 and right == end and all(sides):
        return True, True
    before, after = text[start - 1 : start], text[end : end + 1]
    held = before == ":" or after in ",.;:!?)»”" or before in ".)" and _NUMBERING.match(text, sent, start - 1)
    return False, any(sides) and not held


def _starts(text: str, at: int, caps: bool) -> bool:
    """Whether what stands at ``at`` can open a sentence: a capital, quotation, digit or letter of a script without case."""
    c = text[at]
    if c.islower():
        return at + 1 < len(text) and text[at + 1].isupper()  # pH
    if c.isupper():
        return not (caps and at + 1 < len(text) and text[at + 1].isupper())
    return True


def _ends(text: str, line: int, sent: int, at: int, end: int) -> bool:
    """Whether the terminators text[at:end] end the sentence that began at ``sent``; ``line`` is where the line's text goes on."""
    n = len(text)
    mark = text[at]
    nxt = end
    while nxt < n and text[nxt] in " \t\xa0":
        nxt += 1
    if nxt >= n or text[nxt] in _BREAKS:
        return True
    if mark in _FULL:
        return True
    dots = text[at:end].count(".")
    word_at = at
    while word_at > sent and not text[word_at - 1].isspace() and at - word_at < 24:
        word_at -= 1
    word = text[word_at:at].lstrip("(«\"“'[„").lower()
    if nxt == end:  # no space follows
        c = text[end]
        if mark == "." and dots == 1:
            return c.isupper() and len(word) > 1 and word.isalpha() and text[at - 1].islower() and word not in NEVER_END and not (end + 1 < n and text[end + 1] == ".")
        return c.isupper() or c in _QUOTES and mark != "."
    if mark == "." and dots == 1:
        if word in NEVER_END:
            return False
        caps = word_at < at and text[word_at:at].isupper() and len(word) > 1
        if word in MAY_END:
            return _starts(text, nxt, caps)
        if _NUMBER.match(word):
            if _NUMBERING.match(text, sent, at):
                return False
            c = text[nxt]
            return (c.isupper() and nxt + 1 < n and not text[nxt + 1].isupper()) or c in _QUOTES
        if len(word) == 1 and (word in SINGLE or text[word_at:at].isupper()):
            return False
    return _starts(text, nxt, False)


def spans(text: str, start: int = 0, end: int | None = None) -> list[tuple[int, int]]:
    """(start, end) of every sentence with a letter or digit, without surrounding white space, in code points."""
    if end is not None:
        text = text[:end]
    cuts: list[int] = []
    sent = start
    greek = None
    thai_from, thai = -1, False  # where the part between end marks began for which ``thai`` holds
    base = start
    for m in (_PIECES_SPACELESS if _SPACELESS_OR_THAI.search(text, start) else _PIECES).finditer(text, start):
        a, b = m.span()
        c = text[a]
        if c in _BREAKS:
            cuts.append(a)
            sent = base = b
            continue
        if _SPACELESS.match(c):
            for b in _run_ends(text, a, b):
                cuts.append(b)
                sent = b
            continue
        if c in _SPACES:
            both, one = _thai_gap(text, sent, a, b)
            if one and not both:
                if thai_from != base:
                    thai_from, thai = base, _thai_stretch(text, base, b)
                one = thai
            if one or _gap_ends(text, a, b):
                if a > sent:
                    cuts.append(a)
                    sent = a
            continue
        if c in _QUOTES:
            if b - a < 2 or text[b - 1] not in "»\"”“」』":
                continue
            if text[b - 2] not in _MARKS or b >= len(text):
                continue
            nxt = b
            while nxt < len(text) and text[nxt] in " \t\xa0":
                nxt += 1
            if nxt >= len(text) or text[nxt] in _BREAKS or text[nxt] in _MARKS or text[nxt] in ",;:)":
                continue
            if nxt == b and not text[b].isupper():
                continue
            if not _starts(text, nxt, False):
                continue
        elif c == ";":
            if greek is None:
                greek = any("Ͱ" <= x <= "Ͽ" for x in text)
            if not greek:
                continue
            line = text.rfind("\n", 0, a) + 1
            follow = text[b:].lstrip(" ")[:1]
            if not ("Ͱ" <= text[a - 1] <= "Ͽ" or "Ͱ" <= follow <= "Ͽ" or (not follow or follow == "\n") and any("Ͱ" <= x <= "Ͽ" for x in text[max(line, sent) : a])):
                continue
        elif not _ends(text, sent, sent, a, b):
            continue
        if b > sent:
            cuts.append(b)
            sent = base = b
    cuts.append(len(text))
    out, s = [], start
    for e in cuts:
        if e > s:
            part = text[s:e]
            kept = part.strip()
            if kept and _ALNUM.search(kept):
                lead = len(part) - len(part.lstrip())
                out.append((s + lead, s + lead + len(kept)))
            s = e
    return out


def split_sentences(df: DataFrame, key: str, result: str) -> DataFrame:
    """(key, sent_no, start_pos, end_pos): each sentence of the text of ``result``; sent_no counts from 1, positions from 0.

    Deliveries of one key count once. Records whose object is cut off, without text or without any letter or digit have no
    rows; so have null keys. Extra columns of ``df`` are ignored, whatever their names. An empty table gives an empty result.
    """

    def run(c: dict) -> dict:
        keys, at = [], []
        for k, raw in zip(c["k"], c["r"]):
            text, kind = result_text(raw)
            if text and kind != CUT and (s := spans(text)):
                keys.append(k)
                at.append([x for p in s for x in p])
        return {"k": keys, "at": at}

    kind = dict(df.dtypes)[key]
    found = map_columns(df.select(F.col(key).alias("k"), F.col(result).alias("r")).where("k IS NOT NULL AND r IS NOT NULL"), run, f"k {kind}, at array<int>")
    one = one_delivery(found, "k", "at")
    each = one.select("k", "at", F.explode(F.sequence(F.lit(1), F.expr("size(at) div 2"))).alias("no"))
    return each.select(F.col("k").alias(key), F.col("no").alias("sent_no"), F.expr("at[2 * no - 2]").alias("start_pos"), F.expr("at[2 * no - 1]").alias("end_pos"))


def iter_sentences(text: str) -> Iterator[str]:
    for a, b in spans(text):
        yield text[a:b]
