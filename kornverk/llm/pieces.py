"""Pieces of long texts for speech synthesis, and how fine their cuts must be.

A piece is a range of the text. From where it begins, it goes to the last paragraph end in reach, else to the last sentence
end, else to the last word end, else as far as it may. Its lead repeats the last whole words of the piece before.

Levels of a giant text are found in byte ranges by several workers. A range goes on to the end of the line that it ends in,
since no sentence or word goes on behind a line break, and has the break before it as halo. Each range gives a table of its
longest units and of the paragraphs at its ends; prefix sums of the lengths place these in the text, and they are stitched.
"""

from __future__ import annotations

import re
from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..arrow import map_columns, one_delivery
from .sentences import spans
from .text import CUT, result_text

#: Bytes of a range; answers of no more bytes are taken whole.
RANGE = 1 << 16

LEVELS = ("paragraph", "sentence", "word", "inside_word")

_LINE_END = r"(?:\r\n|\r(?!\n)|[\n\x85  ])"
_EMPTY_LINES = re.compile(rf"{_LINE_END}(?:[^\S\n\r\x85  ]*{_LINE_END})+")
_ONE_END = re.compile(_LINE_END)
_WORD = re.compile(r"\S+")


def _paragraphs(text: str) -> list[tuple[int, int]]:
    """(start, end) of every paragraph that isn't blank, without surrounding white space."""
    out, at = [], 0
    for a, b in [*(m.span() for m in _EMPTY_LINES.finditer(text)), (len(text), len(text))]:
        part = text[at:a]
        if kept := part.strip():
            lead = len(part) - len(part.lstrip())
            out.append((at + lead, at + lead + len(kept)))
        at = b
    return out


def _units(text: str) -> list[list[tuple[int, int]]]:
    return [_paragraphs(text), spans(text), [m.span() for m in _WORD.finditer(text)]]


def cut_level(text: str, most: int = 300) -> str:
    """The first of LEVELS at whose units no unit is longer than ``most``."""
    return next((level for level, u in zip(LEVELS, _units(text)) if all(b - a <= most for a, b in u)), LEVELS[-1])


def _lead(text: str, start: int, end: int, split_before: bool, split_after: bool, lead: int) -> tuple[int, int]:
    """Range of the last whole words of the piece text[start:end], of ``lead`` code points at most; empty if there is none."""
    words = [m.span() for m in _WORD.finditer(text, start, end)]
    words = words[split_before : len(words) - split_after]
    if not words:
        return end, end
    last = first = words[-1][1]
    for a, _ in reversed(words):
        if last - a > lead:
            break
        first = a
    return (first, last) if first < last else (end, end)


def pieces(text: str, most: int = 300, lead: int = 60) -> list[tuple[int, int, int, int]]:
    """(lead_start, lead_end, start, end) of every piece in code points; white space at the cuts is in no piece."""
    ends = [[b for _, b in u] for u in _units(text)]
    out: list[tuple[int, int, int, int]] = []
    split = False  # whether the last cut was inside a word
    lead_at = (0, 0)
    at = 0
    while at < len(text):
        if m := _WORD.search(text, at):
            at = m.start()
        else:
            break
        for level in ends:
            i = bisect_right(level, at + most) - 1
            if i >= 0 and level[i] > at:
                end, inside = level[i], False
                break
        else:
            end, inside = at + most, True
        out.append((*lead_at, at, end))
        lead_at = _lead(text, at, end, split, inside, lead)
        split, at = inside, end
    return out


def _long(df: DataFrame, key: str, result: str, fn, fields: str, most: int) -> DataFrame:
    def run(c: dict) -> dict:
        keys, got = [], []
        for k, raw in zip(c["k"], c["r"]):
            text, kind = result_text(raw)
            if text and kind != CUT and len(text) > most:
                keys.append(k)
                got.append(fn(text))
        return {"k": keys, "v": got}

    kind = dict(df.dtypes)[key]
    return map_columns(df.select(F.col(key).alias("k"), F.col(result).alias("r")).where("k IS NOT NULL AND r IS NOT NULL"), run, f"k {kind}, v {fields}")


def byte_ranges(text: str, size: int) -> list[str]:
    """Parts of ``text``, each of ``size`` bytes and the rest of the line that they end in."""
    data, at, out = text.encode(), 0, []
    while at < len(data):
        end = data.find(b"\n", at + size - 1) + 1 or len(data)
        out.append(data[at:end].decode())
        at = end
    return out


def boundary_table(part: str, first: bool) -> dict:
    """Code points of a range, of its longest sentence, word and paragraph within, and the paragraphs at its ends.

    Of these, ``before`` and ``after`` tell whether they may go on in the range before and after.
    """
    paragraphs = _paragraphs(part)
    ends = sorted({paragraphs[0], paragraphs[-1]}) if paragraphs else []
    sentences = spans(part) if first else spans("\n" + part, 1)
    return {
        "n": len(part),
        "sentence": max((b - a for a, b in sentences), default=0),
        "word": max((m.end() - m.start() for m in _WORD.finditer(part)), default=0),
        "paragraph": max((b - a for a, b in paragraphs[1:-1]), default=0),
        "ends": [{"s": a, "e": b, "before": not _ONE_END.search(part, 0, a), "after": len(_ONE_END.findall(part, b)) == 1} for a, b in ends],
    }


def _ranged_levels(rows: DataFrame, kind: str, most: int, size: int) -> DataFrame:
    """(k, v): the level of each row (k, r) whose text is longer than ``most``, found in ranges of ``size`` bytes."""

    def cut(c: dict) -> dict:
        out: dict[str, list] = {n: [] for n in ("k", "row", "no", "part")}
        for k, row, raw in zip(c["k"], c["row"], c["r"]):
            text, how = result_text(raw)
            if text and how != CUT and len(text) > most:
                for no, part in enumerate(byte_ranges(text, size)):
                    for name, v in zip(out, (k, row, no, part)):
                        out[name].append(v)
        return out

    def measure(c: dict) -> dict:
        tables = [boundary_table(part, no == 0) for no, part in zip(c["no"], c["part"])]
        return {n: c[n] for n in ("k", "row", "no")} | {n: [t[n] for t in tables] for n in ("n", "sentence", "word", "paragraph", "ends")}

    parts = map_columns(rows.withColumn("row", F.monotonically_increasing_id()), cut, f"k {kind}, row bigint, no bigint, part string")
    spread = parts.repartition(rows.sparkSession.sparkContext.defaultParallelism, "row", "no")
    longest = "sentence bigint, word bigint, paragraph bigint"
    tables = map_columns(spread, measure, f"k {kind}, row bigint, no bigint, n bigint, {longest}, ends array<struct<s: bigint, e: bigint, before: boolean, after: boolean>>")
    along = Window.partitionBy("row").orderBy("no")
    ends = tables.withColumn("base", F.sum("n").over(along) - F.col("n")).select("k", "row", "no", "base", "sentence", "word", "paragraph", F.explode_outer("ends").alias("p"))
    placed = ends.withColumns({"s": F.expr("base + p.s"), "e": F.expr("base + p.e")})
    in_order = Window.partitionBy("row").orderBy("no", F.col("p.s"))
    goes_on = F.col("p.before") & F.lag("p.after").over(in_order) & (F.lag("no").over(in_order) == F.col("no") - 1)
    whole = placed.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("g", F.sum("new").over(in_order)).groupBy("row", "g")
    stitched = whole.agg(F.min("k").alias("k"), (F.max("e") - F.min("s")).alias("stitched"), *[F.max(n).alias(n) for n in ("sentence", "word", "paragraph")])
    by_row = stitched.groupBy("row").agg(F.min("k").alias("k"), F.greatest(F.max("paragraph"), F.max("stitched")).alias("paragraph"), F.max("sentence").alias("sentence"), F.max("word").alias("word"))
    level = F.lit(LEVELS[-1])
    for name in reversed(LEVELS[:-1]):
        level = F.when(F.col(name) <= most, name).otherwise(level)
    return by_row.select("k", level.alias("v"))


def cut_levels(df: DataFrame, key: str, result: str, most: int = 300, size: int = RANGE) -> DataFrame:
    """(key, cut_level) of every record whose text is longer than ``most``; cut objects and null keys are left out.

    Answers of more than ``size`` bytes are taken in ranges of so many bytes. A line that is longer is one range.
    """
    small = F.octet_length(F.col(result)) <= size  # a text is never longer than its answer
    whole = _long(df.where(small), key, result, lambda t: cut_level(t, most), "string", most)
    large = df.where(~small & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(result).alias("r"))
    found = whole.unionByName(_ranged_levels(large, dict(df.dtypes)[key], most, size))
    return one_delivery(found, "k", "v").select(F.col("k").alias(key), F.col("v").alias("cut_level"))


def split_pieces(df: DataFrame, key: str, result: str, most: int = 300, lead: int = 60) -> DataFrame:
    """(key, piece_no, lead, piece) of the same records; ``lead`` is empty at the first piece."""

    def cut(text: str) -> list[dict]:
        return [{"lead": text[a:b], "piece": text[s:e]} for a, b, s, e in pieces(text, most, lead)]

    found = _long(df, key, result, cut, "array<struct<lead: string, piece: string>>", most)
    each = one_delivery(found, "k", "v").select("k", F.posexplode("v").alias("i", "p"))
    return each.select(F.col("k").alias(key), (F.col("i") + 1).alias("piece_no"), "p.lead", "p.piece")
