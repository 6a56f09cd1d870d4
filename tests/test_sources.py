"""Files of JSON lines, archives, sinks, and the resumable stream."""

import json
import zipfile

import pytest

from kornverk.sources import jsonl, sinks, terminology
from kornverk.streaming.resume import resumable

SCHEMA = "id string, n bigint"


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(x + "\n" for x in lines), encoding="utf-8")


def test_parts(tmp_path):
    assert jsonl.parts(tmp_path / "none") == []
    d = tmp_path / "d"
    put(d, "d_part_01.jsonl", "{}")
    with pytest.raises(ValueError, match="gap"):
        jsonl.parts(d)
    put(d, "d_part_00.jsonl", "{}")
    put(d, "note.txt", "x")
    assert [p.name for p in jsonl.parts(d)] == ["d_part_00.jsonl", "d_part_01.jsonl"]
    put(d, "e_part_02.jsonl", "{}")
    with pytest.raises(ValueError, match="prefixes"):
        jsonl.parts(d)
    put(tmp_path / "x", "a.jsonl", "{}")
    with pytest.raises(ValueError, match="no numbered"):
        jsonl.parts(tmp_path / "x")
    with pytest.raises(FileNotFoundError):
        jsonl.any_files(tmp_path / "none.jsonl")


def test_reading(spark, tmp_path):
    put(tmp_path, "a.jsonl", '{"id": "x", "n": 1}', "", "broken", "[1]", '{"n": 5}', '{"id": 7, "n": 2}')
    got = [(r.id, r.n, r.line_no) for r in jsonl.read(spark, tmp_path / "a.jsonl", SCHEMA).orderBy("line_no").collect()]
    assert got == [("x", 1, 1), (None, 5, 5), ("7", 2, 6)]
    assert sorted(r.id for r in jsonl.completed_ids(spark, tmp_path / "a.jsonl").collect()) == ["7", "x"]
    assert jsonl.non_empty_lines(spark, tmp_path / "a.jsonl").first().n == 5
    assert jsonl.read(spark, tmp_path / "none.jsonl", SCHEMA).count() == 0
    with pytest.raises(Exception, match="a.jsonl:3: no JSON"):
        jsonl.read_strict(spark, tmp_path / "a.jsonl", SCHEMA, ["id"]).collect()
    put(tmp_path, "b.jsonl", '{"id": "x"}')
    with pytest.raises(Exception, match="missing id or prompt"):
        jsonl.prompts(spark, tmp_path / "b.jsonl").collect()


def test_terminology(spark, tmp_path):
    put(tmp_path, "t.jsonl", json.dumps({"nb": {"akseptabel": ["b ", " "], "tilrådd": ["a"]}}), json.dumps({"nb": None}), json.dumps({"nb": {"tilrådd": ["b "]}}))
    rows = terminology.phrases(spark, tmp_path / "t.jsonl")
    assert [r.phrase for r in rows.orderBy("ord").collect()] == ["b ", "a", "b "]
    assert [r.phrase for r in terminology.distinct_phrases(rows).orderBy("ord").collect()] == ["b ", "a"]
    assert terminology.decode("blå".encode("latin-1")) == "blå"
    with zipfile.ZipFile(tmp_path / "ultra_rare.jsonl.zip", "w") as z:
        z.writestr("m.jsonl", '{"word": "w", "count": 2}\n{"count": 2, "word": "w"}\nx\n')
    put(tmp_path, "common.jsonl", '{"word": "w", "count": 3}', '{"word": "", "count": 3}', '{"word": "v"}')
    paths = terminology.occurrence_paths(tmp_path)
    assert [p.name for p in paths] == ["common.jsonl", "ultra_rare.jsonl.zip"]
    assert sorted(map(tuple, terminology.occurrences(spark, paths).collect())) == [("w", 2), ("w", 3)]
    with pytest.raises(FileNotFoundError):
        terminology.templates(tmp_path, "*.none")


def test_sinks(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("æ", None), ("b", 2), ("c", 3)], SCHEMA)
    monkeypatch.setattr(sinks, "PART_BYTES", 45)
    assert sinks.write(df, tmp_path / "out", "id") == 3
    assert [p.name for p in jsonl.parts(tmp_path / "out")] == ["out_part_00.jsonl", "out_part_01.jsonl"]
    sinks.append(df.limit(1), tmp_path / "out")
    assert jsonl.read(spark, tmp_path / "out", SCHEMA).count() == 4
    assert (tmp_path / "out" / "out_part_01.jsonl").read_text(encoding="utf-8").splitlines()[0] == '{"id":"æ","n":null}'
    sinks.rewrite(jsonl.read(spark, tmp_path / "out", SCHEMA).select("id", "n").where("n > 2").cache(), tmp_path / "out")
    assert jsonl.read(spark, tmp_path / "out", SCHEMA).count() >= 1
    sinks.write(df, tmp_path / "one.jsonl", "id")
    sinks.upsert(spark.createDataFrame([("b", 9)], SCHEMA), df, tmp_path / "one.jsonl", "id")
    assert {(r.id, r.n) for r in jsonl.read(spark, tmp_path / "one.jsonl", SCHEMA).collect()} == {("æ", None), ("b", 9), ("c", 3)}
    sinks.clear(tmp_path / "out")
    assert jsonl.parts(tmp_path / "out") == []
    assert not sinks.write_log(df.limit(0), tmp_path / "log.jsonl") and not (tmp_path / "log.jsonl").exists()


def test_report(spark, tmp_path):
    df = spark.createDataFrame([("a<", True, 3.0, 50.0, 36.0), ("b", False, None, None, None)], "rel_path string, ok boolean, mos double, mos_0_100 double, duration_s double")
    sinks.score_report(df, tmp_path / "r")
    assert "files_total" in (tmp_path / "r" / "summary.md").read_text() and "a&lt;" in (tmp_path / "r" / "report.html").read_text()


def test_stream_goes_on(spark, tmp_path):
    put(tmp_path / "in", "a.jsonl", '{"id": "1", "n": 1}', '{"id": "2", "n": 2}')
    run = lambda: resumable(spark, tmp_path / "in", SCHEMA, tmp_path / "out", tmp_path / "state", lambda b: b).awaitTermination()
    run()
    put(tmp_path / "in", "b.jsonl", '{"id": "2", "n": 2}', '{"id": "3", "n": 3}')
    run()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "2", "3"]
