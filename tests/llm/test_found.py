"""The registered queries over small tables written by hand."""

import json

import duckdb
import pytest

import __spark_entry__ as driver

LOOP = "Vi tar en ny prøve nå. " * 4
ANSWERS = [
    (1, json.dumps({"text": "Dr. Dahl kom. Alt er bra."}), ["Feber", " feber ", None, ""]),
    (1, json.dumps({"text": "Dr. Dahl kom. Alt er bra."}), ["Feber", " feber ", None, ""]),
    (2, LOOP, ["feber", "hoste"]),
    (3, '{"text": "Dette er kuttet. Og så', ["FEBER\n", "hoste"]),
    (4, None, None),
    (5, "{}", ["hoste", "sår"]),
    (6, " ", [" ", None]),
    (7, None, []),
]
PLAN = [("a", 7), ("a", 7), ("b", 7), ("c", 9), ("d", None)]


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(ANSWERS, "output_id bigint, result string, used_terms array<string>").write.parquet(f"{at}/outputs.parquet")
    spark.createDataFrame(PLAN, "term_id string, corpus_count bigint").write.parquet(f"{at}/terms_to_use.parquet")
    return at


def rows(spark, name, at):
    return sorted(map(tuple, driver.queries()[name](spark, at).collect()))


def test_p1_found(spark, tables):
    want = [("corpus_count", "7", "common"), ("corpus_count", "9", "rare"), ("used_terms", "feber", "common"), ("used_terms", "hoste", "common"), ("used_terms", "sår", "rare")]
    assert rows(spark, "p1_found", tables) == want
    con = duckdb.connect()
    for t in ("outputs", "terms_to_use"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tables}/{t}.parquet/*.parquet')")
    assert sorted(con.execute(driver.oracle_sql()["p1_found"]).fetchall()) == want


def test_p4_found(spark, tables):
    assert rows(spark, "p4_found", tables) == [(2,)]


def test_p5_found(spark, tables):
    got = rows(spark, "p5_found", tables)
    assert [r for r in got if r[0] == 1] == [(1, 1, 0, 13), (1, 2, 14, 25)]
    assert {r[0] for r in got} == {1, 2}


