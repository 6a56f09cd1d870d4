"""Sources that cannot reach their share of the tokens, and the mix."""

import __spark_entry__ as driver
from kornverk.llm.mixing import count_tokens, document_tokens, mix, shares_reached

TEXT = "Pasienten har vondt i hodet."
DOCS = [(i, TEXT, s) for i, s in enumerate(["a", " A ", "a", "a", "b", "B", None, "other"])] + [(8, None, "a"), (9, "", "b")]
TARGETS = [("a", 0.25, 1), ("b", 0.6, 2), ("c", 0.1, 5), ("d", 0.05, 1)]


def test_p9_found(spark, tmp_path):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string, source string")
    targets = spark.createDataFrame(TARGETS, "source string, target_share double, max_uses int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    targets.write.parquet(f"{tmp_path}/mix_targets.parquet")
    # 8 texts of equal length: b has 2 * 2 of the 4.8 it should have, c and d have none
    assert sorted(r.source for r in driver.queries()["p9_found"](spark, str(tmp_path)).collect()) == ["b", "c", "d"]
    tokens = document_tokens(docs)
    assert {r.doc_id: r.tokens for r in tokens.collect()} == {i: count_tokens(t) for i, t, _ in DOCS}
    used = {r.doc_id: r.uses for r in mix(tokens, targets).collect()}
    assert used[4] == used[5] == 2 and all(used.get(i, 0) <= 1 for i in range(4)) and not {6, 7} & set(used)
    assert {r.source: (r.reached_share, r.short) for r in shares_reached(tokens, targets).collect() if r.source != "a"} == {"b": (0.5, True), "c": (0.0, True), "d": (0.0, True)}
