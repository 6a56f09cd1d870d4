"""Texts that look the same, and test items in documents."""

import pytest

import __spark_entry__ as driver
from kornverk.llm.leaks import leak_shares, leaks
from kornverk.llm.lookalike import Rewriter, UnionFind, consistent, consistent_forms, count_members, look_alike_classes, lookalikes, representatives

ITEM = "Pasienten på avdelingen får ny medisin hver dag og sover bedre om natten nå enn før."


@pytest.mark.parametrize("a, b", [("på", "pa\u030a"), ("en dag", "en\u00a0dag"), ("en dag", "en\u2007dag"), ("sår", "s\u200bår"), ("ABC 12", "ＡＢＣ １２"), ("pose", "\u0440\u043e\u0455\u0435"), ("ov\u00f6", "\u03bf\u03bd\u043e\u0308"), ("o\u0308", "o\u200d\u0308")])
def test_look_the_same(a, b):
    assert a != b and consistent(a) == consistent(b)


@pytest.mark.parametrize("a, b", [("en dag", "en  dag"), ("nei!", "nei！"), ("a\nb", "a b"), ("Sår", "sår"), ("sar", "sår"), ("1", "l")])
def test_look_different(a, b):
    assert consistent(a) != consistent(b)


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("docs"))
    texts = ["sår på hånd", "sa\u030ar på hånd", "sår på hånd", "sår\u00a0på hånd", "Sår på hånd", None, "", "\u200b", ITEM, "Og " + ITEM.split(maxsplit=1)[1].replace("får", "f\u200bår").upper(), " ".join(ITEM.split()[:11]), " ".join(ITEM.split()[2:14])]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, "kort tekst"), (3, None)], "item_id bigint, text string").write.parquet(f"{at}/eval_items.parquet")
    return at


def test_p10_found(spark, docs):
    assert sorted(map(tuple, driver.queries()["p10_found"](spark, docs).collect())) == [(0, 1), (0, 3), (1, 2), (1, 3), (2, 3), (6, 7)]


def test_p8_found(spark, docs):
    assert sorted(map(tuple, driver.queries()["p8_found"](spark, docs).collect())) == [(8, 1), (9, 1), (11, 1)]


def test_classes_are_transitive_and_disjoint():
    uf = UnionFind()
    for a, b in (("a", "b"), ("c", "d"), ("b", "c"), ("x", "y")):
        uf.union(a, b)
    assert sorted(map(sorted, uf.classes())) == [["a", "b", "c", "d"], ["x", "y"]]
    seen = [m for c in look_alike_classes() for m in c]
    assert len(seen) == len(set(seen))


def test_the_most_frequent_member_stands_for_its_class():
    counts = count_members(["\u043e\u043e\u043e o", "p"])
    assert counts["\u043e"] == 3 and counts["o"] == 1
    form = Rewriter(representatives(counts))
    assert form("foo") == "f\u043e\u043e" and form("p") == "p" and form("\u200bo") == "\u043e"
    assert form("ﬁn") == "fin" and form("Ⅷ") == "VIII"


def test_odd_rows(spark):
    rows = [(1, None), (None, "a"), (2, ""), (3, "\u200b"), (4, "x" * 100_000 + "\u0430"), (5, "x" * 100_000 + "a"), (6, "x" * 100_000 + "a")]
    df = spark.createDataFrame([(*r, "f") for r in rows], "doc_id bigint, text string, f string")
    assert sorted(map(tuple, lookalikes(df, "doc_id", "text").collect())) == [(2, 3), (4, 5), (4, 6)]
    assert lookalikes(df.limit(0), "doc_id", "text").count() == 0
    assert {r.doc_id: r.form for r in consistent_forms(df, "doc_id", "text").collect()}[1] is None


def test_leaks_equal_plain_search(spark):
    import random

    from kornverk.llm.text import words

    rng = random.Random(2)
    items = [(i, " ".join(rng.choices("abc", k=rng.randrange(30)))) for i in range(12)] + [(50, None), (None, "a b c")]
    docs = [(i, " ".join(rng.choices("abc", k=rng.randrange(120)))) for i in range(40)] + [(90, None), (91, "")]
    a = spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, text string, words int")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    runs = {i: {tuple(words(t)[j : j + 6]) for j in range(len(words(t)) - 5)} for i, t in items if t and i is not None}
    want = {(d, i) for d, t in docs if t for i, r in runs.items() if any(tuple(words(t)[j : j + 6]) in r for j in range(len(words(t)) - 5))}
    assert set(map(tuple, leaks(a, "doc_id", b, "item_id", run=6).collect())) == want and want
    shares = {(r.doc_id, r.item_id): (r.longest, r.leaked_share) for r in leak_shares(a, "doc_id", b, "item_id", run=6).collect()}
    assert set(shares) == want and all(n >= 6 and 0 < s <= 1 for n, s in shares.values())
    assert leaks(a, "doc_id", b.limit(0), "item_id").count() == 0
