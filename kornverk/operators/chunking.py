"""Texts cut into chunks of whole sentences for speech, the split of least cost."""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arrow import map_columns
from ..functions.containers import recovered_text

# The longest chunk, and the range and middle that chunks should have.
LONGEST, SHORT, MIDDLE = 300, 150, 225

_GAP = re.compile(r"(?:(?<=[.!?])|(?<=[.!?]['»’]))\s+")
_FINER = [re.compile(r"(?<=,)\s*"), re.compile(r"\s+(?=[A-ZÆØÅ])"), re.compile(r"\s+")]


def _parts(gap: re.Pattern, s: str) -> list[str]:
    return [p for p in map(str.strip, gap.split(s.strip())) if p]


def units(text: str) -> list[str]:
    """The sentences of a text; those that are too long are cut after commas, else before capitals, else at spaces."""
    found = _parts(_GAP, text) or [text.strip()]
    for finer in _FINER:
        found = [p for s in found for p in ((_parts(finer, s) or [s]) if len(s) > LONGEST else [s])]
    return found


def chunk_cost(length: int) -> int:
    return (length - MIDDLE) ** 2 + 3 * max(0, SHORT - length) ** 2 + 2 * max(0, length - LONGEST) ** 2


def best_chunks(pieces: list[str], compat: bool = True) -> list[str] | None:
    """The pieces joined to chunks at least cost over all allowed numbers of chunks; None if no split fits.

    Of equal costs the fewest chunks win, then the earliest cuts from the end. ``compat`` measures a chunk that begins at piece
    s > 0 as s - 1 characters shorter than it is, as the pipeline this follows does; such chunks may exceed the limit.
    """
    n = len(pieces)
    upto = [0]
    for p in pieces:
        upto.append(upto[-1] + len(p))

    def length(a: int, b: int) -> int:
        true = upto[b] - upto[a] + b - a - 1
        return true - (a - 1 if compat and a else 0)

    whole = upto[-1] + n - 1
    fewest, most = max(1, math.ceil(whole / LONGEST)), max(1, math.ceil(whole / LONGEST), math.ceil(whole / SHORT))
    row: dict[int, int] = {0: 0}  # cost by end, with so many chunks as rounds
    came: list[dict[int, int]] = []
    best: tuple[int, int] | None = None
    for k in range(1, min(most, n) + 1):
        nxt: dict[int, int] = {}
        source: dict[int, int] = {}
        for a in sorted(row):
            for b in range(a + 1, n + 1):
                size = length(a, b)
                if size > LONGEST:
                    if not compat:
                        break
                    continue
                cost = row[a] + chunk_cost(size)
                if b not in nxt or cost < nxt[b]:
                    nxt[b], source[b] = cost, a
        came.append(source)
        row = nxt
        if k >= fewest and n in row and (best is None or row[n] < best[0]):
            best = row[n], k
    if best is None:
        return None
    out, end = [], n
    for k in range(best[1], 0, -1):
        start = came[k - 1][end]
        out.append(" ".join(pieces[start:end]))
        end = start
    return out[::-1]


def chunks(text: str, compat: bool = True) -> list[str] | None:
    """A text within the limit is one chunk; None if a piece is too long or no split fits."""
    bare = text.strip()
    if len(bare) <= LONGEST:
        return [bare]
    pieces = units(bare)
    return None if max(map(len, pieces)) > LONGEST else best_chunks(pieces, compat)


def split_records(records: DataFrame, key: str, result: str, compat: bool = True) -> DataFrame:
    """(key, chunk_no, id, result): each chunk as a record of its own, its id that of the record and its number; what can't be split has no rows.

    Results without a text raise an error, as they do in the pipeline; ``split_problems`` lists them beforehand. A null id is to
    be filled first (``functions.ids.record_id``).
    """

    def run(c: dict) -> dict:
        return {"k": c["k"], "v": [chunks(t, compat) if (t := recovered_text(r)) is not None else None for r in c["r"]], "t": [recovered_text(r) is not None for r in c["r"]]}

    kind = dict(records.dtypes)[key]
    cut = map_columns(records.select(F.col(key).alias("k"), F.col(result).alias("r")), run, f"k {kind}, v array<string>, t boolean")
    sure = cut.withColumn("v", F.when(F.col("t"), F.col("v")).otherwise(F.raise_error(F.concat(F.lit("no text in the result of record "), F.coalesce(F.col("k").cast("string"), F.lit("null"))))))
    each = sure.select("k", F.posexplode("v").alias("i", "chunk"))
    return each.select(F.col("k").alias(key), (F.col("i") + 1).cast("bigint").alias("chunk_no"), F.concat(F.col("k").cast("string"), F.lit("_"), (F.col("i") + 1).cast("string")).alias("id"), F.to_json(F.struct(F.col("chunk").alias("text"))).alias("result"))


def split_problems(records: DataFrame, key: str, result: str, compat: bool = True) -> DataFrame:
    """(key, problem): ``no_text`` or ``unsplittable``."""

    def run(c: dict) -> dict:
        texts = [recovered_text(r) for r in c["r"]]
        return {"k": c["k"], "p": ["no_text" if t is None else "unsplittable" if chunks(t, compat) is None else None for t in texts]}

    kind = dict(records.dtypes)[key]
    got = map_columns(records.select(F.col(key).alias("k"), F.col(result).alias("r")), run, f"k {kind}, p string")
    return got.where("p IS NOT NULL").select(F.col("k").alias(key), F.col("p").alias("problem"))
