"""One consistent form of texts that look the same, and the documents that meet in it.

Look-alike strings (letters of other scripts, full-width forms, spaces, invisible characters, ligatures) are joined to classes
by union-find, so that what looks like the same string is in one class, over however many steps. The member of a class that
occurs most in all documents stands for it. A multi-pattern automaton finds the other members, longest first from the left,
and they are rewritten. Texts are taken apart into letters and accents before, and put together after, so accents need no
classes of their own. Equal forms are the groups.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arrow import checkpointed, map_batches, map_columns

# Letters of the same shape in Latin, then Greek, Cyrillic, Armenian and other scripts; ligatures and roman numerals; hyphens.
ALIKE = """
A Α А Ꭺ|B Β В Ᏼ|C С Ϲ Ꮯ Ⅽ|D Ꭰ Ⅾ|E Ε Е Ꭼ|H Η Н Ꮋ|I Ι І Ӏ Ⅰ|J Ј Ϳ Ꭻ|K Κ К K Ꮶ|L Ꮮ Ⅼ|M Μ М Ꮇ Ⅿ|N Ν|O Ο О Օ|P Ρ Р Ꮲ|Q Ԛ|R Ꭱ|S Ѕ Տ Ꮪ|T Τ Т Ꭲ|V Ѵ Ꮩ Ⅴ|W Ԝ Ꮃ|X Χ Х Ⅹ|Y Υ Ү|Z Ζ Ꮓ|
a а|c с ϲ ⅽ|d ԁ ⅾ|e е|h һ|i і ⅰ|j ј ϳ|l ӏ ⅼ|m ⅿ|o ο о օ|p р|q ԛ|s ѕ|v ν ѵ ⅴ|w ԝ|x х ⅹ|y у ү|n ո|u ս|g ց|Æ Ӕ|æ ӕ|Ə Ә|ə ә|μ µ|
- ‐ ‑|ff ﬀ|fi ﬁ|fl ﬂ|ffi ﬃ|ffl ﬄ|st ﬆ|II Ⅱ|III Ⅲ|IV Ⅳ|VI Ⅵ|VII Ⅶ|VIII Ⅷ|IX Ⅸ|XI Ⅺ|XII Ⅻ|ii ⅱ|iii ⅲ|iv ⅳ|vi ⅵ|vii ⅶ|viii ⅷ|ix ⅸ|xi ⅺ|xii ⅻ
"""
#: Invisible characters that aren't of the category of format characters.
_INVISIBLE = [0x34F, 0x61C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)]
_PLAIN = re.compile(r"[\x00-\x7f]*\Z")


def pairs_alike() -> Iterator[tuple[str, str]]:
    """Pairs of strings that look the same, the plainer one first; an invisible character looks like nothing."""
    for line in ALIKE.replace("\n", "").split("|"):
        first, *others = line.split(" ")
        yield from ((first, o) for o in others)
    for c in range(0x21, 0x7F):
        if chr(c).isalnum():
            yield chr(c), chr(c + 0xFEE0)
    for c in (*range(0x80, 0x20000), *range(0xE0000, 0xE0200)):  # none of the kinds below stands outside these
        kind = unicodedata.category(chr(c))
        if kind == "Zs":
            yield " ", chr(c)
        elif kind == "Cf" and not (0x600 <= c < 0x900 or c in (0x110BD, 0x110CD)):
            yield "", chr(c)
        elif 0x1D400 <= c < 0x1D800 and kind in ("Lu", "Ll", "Nd"):  # mathematical letters and digits
            plain = unicodedata.normalize("NFKD", chr(c))
            if plain.isascii():
                yield plain, chr(c)
    yield from (("", chr(c)) for c in _INVISIBLE)


class UnionFind:
    """Classes of strings."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, x: str) -> str:
        root = x
        while self.parent.setdefault(root, root) != root:
            root = self.parent[root]
        while self.parent[x] != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def union(self, a: str, b: str) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[b] = a

    def classes(self) -> list[list[str]]:
        out: dict[str, list[str]] = {}
        for x in self.parent:
            out.setdefault(self.find(x), []).append(x)
        return list(out.values())


@cache
def look_alike_classes() -> tuple[tuple[str, ...], ...]:
    """Transitive classes of decomposed strings, each in the order of ``pairs_alike``."""
    found = UnionFind()
    for a, b in pairs_alike():
        found.union(unicodedata.normalize("NFD", a), unicodedata.normalize("NFD", b))
    return tuple(map(tuple, found.classes()))


@cache
def _members() -> tuple[frozenset[str], tuple[str, ...]]:
    """The members of classes: characters, and longer strings."""
    every = [m for c in look_alike_classes() for m in c if m]
    return frozenset(m for m in every if len(m) == 1), tuple(m for m in every if len(m) > 1)


def count_members(texts: Iterable[str]) -> Counter:
    """How often each member of a class stands in the texts."""
    counts: Counter = Counter()
    single, longer = _members()
    for t in texts:
        apart = unicodedata.normalize("NFD", t)
        for c, n in Counter(apart).items():
            if c in single:
                counts[c] += n
        for m in longer:
            if m in apart:
                counts[m] += apart.count(m)
    return counts


def representatives(counts: Counter | None = None) -> dict[str, str]:
    """For each other member of a class the member that stands for it: the empty one if it has that, else the most frequent, else the first."""
    out = {}
    for c in look_alike_classes():
        best = "" if "" in c else max(c, key=lambda m: (counts or {}).get(m, 0))
        out |= {m: best for m in c if m != best}
    return out


class Rewriter:
    """Rewrites texts to their consistent form."""

    def __init__(self, chosen: dict[str, str]) -> None:
        self.chosen = chosen
        self.found = ahocorasick.Automaton()
        for m, new in chosen.items():
            self.found.add_word(m, (len(m), new))
        self.found.make_automaton()
        self.plain = all(not m.isascii() for m in chosen)
        self.starts = frozenset(m[0] for m in chosen)

    def __reduce__(self):
        return Rewriter, (self.chosen,)

    def __call__(self, text: str) -> str:
        if self.plain and _PLAIN.match(text):
            return text
        apart = unicodedata.normalize("NFD", text)
        if self.starts.isdisjoint(apart):  # nothing that the automaton could find
            return unicodedata.normalize("NFC", apart)
        out, at = [], 0
        for end, (n, new) in self.found.iter_long(apart):
            out += (apart[at : end + 1 - n], new)
            at = end + 1
        return unicodedata.normalize("NFC", "".join(out) + apart[at:] if out else apart)


@cache
def _default() -> Rewriter:
    return Rewriter(representatives())


def consistent(text: str) -> str:
    """The consistent form with the first member of each class, as if nothing had been counted."""
    return _default()(text)


def counted(df: DataFrame, text: str) -> Counter:
    """``count_members`` over all rows; the driver gets a number for each member of a class at most (fewer than 3,000)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            total.update(count_members(t for t in b.column(0).to_pylist() if t is not None))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["m", "n"])

    rows = map_batches(df.select(text), run, "m string, n bigint").groupBy("m").agg(F.sum("n").alias("n")).collect()
    return Counter({r.m: r.n for r in rows})


def rewriter_for(df: DataFrame, text: str):
    """A broadcast ``Rewriter`` with the representatives that are most frequent in ``df``."""
    return df.sparkSession.sparkContext.broadcast(Rewriter(representatives(counted(df, text))))


def consistent_forms(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, form) of every row; a null text has a null form."""
    kind, form = dict(df.dtypes)[key], rewriter_for(df, text)
    got = map_columns(df.select(F.col(key).alias("k"), F.col(text).alias("t")), lambda c: {"k": c["k"], "f": [None if t is None else form.value(t) for t in c["t"]]}, f"k {kind}, f string")
    return got.select(F.col("k").alias(key), F.col("f").alias("form"))


def lookalikes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key_a, key_b), the smaller first, of every two rows whose texts differ and look the same.

    ``key`` is unique; null keys and null texts are left out, extra columns don't matter, an empty table gives an empty result.
    Rows are joined by hashes of their forms, only where a form has different texts.
    """
    kind, form = dict(df.dtypes)[key], rewriter_for(df, text)
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t")).where("k IS NOT NULL AND t IS NOT NULL")
    both = map_columns(rows, lambda c: {"k": c["k"], "t": c["t"], "f": [form.value(t) for t in c["t"]]}, f"k {kind}, t string, f string")
    keyed = checkpointed(both.select("k", F.sha2("t", 256).alias("t"), F.sha2("f", 256).alias("f")))
    several = keyed.groupBy("f").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).where("lo <> hi").select("f")
    some = keyed.join(several, "f", "left_semi")
    a, b = some.select("f", F.col("k").alias("a"), F.col("t").alias("ta")), some.select("f", F.col("k").alias("b"), F.col("t").alias("tb"))
    pair = a.join(b, "f").where("ta < tb")
    return pair.select(F.least("a", "b").alias(f"{key}_a"), F.greatest("a", "b").alias(f"{key}_b"))
