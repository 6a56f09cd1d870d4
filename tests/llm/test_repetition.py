"""Repeated words against a plain count, whatever documents share a suffix array."""

import random

from kornverk.llm.repetition import repeated, repetition


def plain(words: list[str], run: int) -> tuple[int, int]:
    inside, seen, longest = set(), {}, 0
    for i in range(len(words) - run + 1):
        key = tuple(words[i : i + run])
        if key in seen:
            inside |= set(range(i, i + run))
        seen.setdefault(key, i)
    for i in range(len(words)):
        for j in range(i):
            n = 0
            while i + n < len(words) and words[i + n] == words[j + n]:
                n += 1
            longest = max(longest, n)
    return len(inside), longest if longest >= run else 0


def test_equals_plain_count_in_any_grouping():
    rng = random.Random(4)
    for _ in range(150):
        docs = [rng.choices("abcde"[: rng.randrange(1, 6)], k=rng.randrange(30)) for _ in range(rng.randrange(1, 40))]
        want = [plain(d, 3) for d in docs]
        for size in (1, 7, len(docs)):
            got = []
            for at in range(0, len(docs), size):
                got += list(zip(*map(list, repeated(docs[at : at + size], 3))))
            assert [tuple(map(int, g)) for g in got] == want


def test_rows(spark):
    loop = "Vi tar en ny prøve nå. " * 4
    rows = [(1, loop), (1, loop), (2, None), (3, ""), (4, "kort"), (None, loop), (5, "ord " * 5000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "output_id bigint, result string, words int")
    got = {r.output_id: (r.words, r.repeated_words) for r in repetition(df, "output_id", "result").collect()}
    assert got == {1: (24, 18), 2: (0, 0), 3: (0, 0), 4: (1, 0), 5: (5000, 4999)}
    assert repetition(df.limit(0), "output_id", "result").count() == 0
