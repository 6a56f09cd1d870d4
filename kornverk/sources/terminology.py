"""Terminology, word counts and other raw inputs: plain or zipped, in UTF-8 or Latin-1."""

from __future__ import annotations

import glob
import io
import json
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..arrow import map_batches
from ..operators.ordering import first_seen
from . import jsonl

# Names of the word-count tiers, and the endings of audio files.
TIERS = ("common.jsonl", "uncommon.jsonl", "rare.jsonl", "very_rare.jsonl", "extremely_rare.jsonl", "ultra_rare.jsonl.zip", "hapax_doubleton.jsonl.zip")
AUDIO = ("wav", "flac", "mp3", "m4a", "aac", "ogg", "opus", "wma", "aiff", "aif", "caf")


def decode(content: bytes) -> str:
    """UTF-8, else Latin-1, for a file as a whole."""
    try:
        return content.decode("utf-8")
    except UnicodeDecodeError:
        return content.decode("latin-1")


def _members(name: str, content: bytes) -> Iterator[str]:
    if name.endswith(".zip"):
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            for member in archive.namelist():
                yield decode(archive.read(member))
    else:
        yield decode(content)


def json_values(spark: SparkSession, paths: list[str | Path]) -> DataFrame:
    """(path, ord, record): every JSON value of plain or zipped files, in order; broken and blank lines and missing files are skipped."""
    there = [str(p) for p in paths if Path(p).exists()]
    if not there:
        return spark.createDataFrame([], "path string, ord bigint, record string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = []
                for text in _members(name, content):
                    for line in text.splitlines():
                        try:
                            found.append(json.dumps(json.loads(line), ensure_ascii=False, sort_keys=True))
                        except (ValueError, RecursionError):
                            continue
                for at in range(0, len(found), 10_000):
                    part = found[at : at + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(part)), pa.array(range(at, at + len(part)), pa.int64()), pa.array(part)], names=["path", "ord", "record"])

    return map_batches(spark.read.format("binaryFile").load(there).select("path", "content"), run, "path string, ord bigint, record string")


def phrases(spark: SparkSession, path: str | Path) -> DataFrame:
    """(phrase, ord): the accepted, then the preferred phrases of each line; blank ones are left out, none is stripped. A missing file is an error."""
    if not Path(path).exists():
        raise FileNotFoundError(path)
    rows = json_values(spark, [path]).select("ord", F.from_json("record", "nb struct<akseptabel: array<string>, `tilrådd`: array<string>>").alias("r"))
    none = F.array().cast("array<string>")
    each = rows.select("ord", F.posexplode(F.concat(F.coalesce("r.nb.akseptabel", none), F.coalesce(F.col("r.nb.`tilrådd`"), none))).alias("p", "phrase"))
    return each.where(F.trim("phrase") != "").select("phrase", (F.col("ord") * 1_000_000 + F.col("p")).alias("ord"))


def distinct_phrases(rows: DataFrame) -> DataFrame:
    """(phrase, ord): every different phrase where it first stands."""
    return first_seen(rows, "phrase", "ord")


def occurrences(spark: SparkSession, paths: list[str | Path]) -> DataFrame:
    """(word, count): the tiers one after another, objects that are equal in all their keys once; only those with a word and a whole count."""
    rows = json_values(spark, paths).select("record").distinct()
    got = rows.select(F.from_json("record", "word string, count bigint").alias("r"), F.get_json_object("record", "$.word").alias("w"))
    return got.select("r.word", "r.count").where((F.col("word") != "") & F.col("count").isNotNull())


def occurrence_paths(folder: str | Path) -> list[Path]:
    """The tiers that exist, in their order; an archive that is missing may stand there unpacked."""
    found = []
    for name in TIERS:
        choices = [Path(folder, name), Path(folder, name.removesuffix(".zip"))]
        found += [p for p in choices if p.exists()][:1]
    return found


def scenarios(spark: SparkSession, path: str | Path) -> DataFrame:
    """(Scenario, ord) of the lines that have one."""
    rows = json_values(spark, [path]).select("ord", F.get_json_object("record", "$.Scenario").alias("Scenario"))
    return rows.where("Scenario <> ''").select("Scenario", "ord")


def templates(folder: str | Path, pattern: str) -> list[tuple[str, str]]:
    """(name, text) by name, of a file or of all that a pattern with ``*`` or ``?`` finds; none is an error."""
    found = sorted(glob.glob(str(Path(folder, pattern)))) if set(pattern) & set("*?") else [str(Path(folder, pattern))] * Path(folder, pattern).is_file()
    if not found:
        raise FileNotFoundError(f"no template {pattern} in {folder}")
    return [(Path(p).name, Path(p).read_text(encoding="utf-8")) for p in found]


def instruction(path: str | Path) -> str:
    """A text file that must exist and not be blank, stripped."""
    text = Path(path).read_text(encoding="utf-8").strip()
    if not text:
        raise ValueError(f"{path} is blank")
    return text


def audio_files(spark: SparkSession, root: str | Path, recursive: bool = True, limit: int = 0) -> DataFrame:
    """(rel_path, path, content) of audio files by path; all of them for ``limit`` 0. The content is only read where it is used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(str(root))
    base = Path(root).resolve().as_uri().replace("file:///", "file:/") + "/"
    named = files.select(F.replace("path", F.lit(base), F.lit("")).alias("rel_path"), "path", "content").where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*AUDIO))
    return named.orderBy("rel_path").limit(limit) if limit else named


def score_table(spark: SparkSession, path: str | Path) -> DataFrame:
    """A CSV file with a header; types are inferred."""
    return spark.read.csv(str(path), header=True, inferSchema=True)


__all__ = ["AUDIO", "TIERS", "audio_files", "decode", "distinct_phrases", "instruction", "json_values", "jsonl", "occurrence_paths", "occurrences", "phrases", "scenarios", "score_table", "templates"]
