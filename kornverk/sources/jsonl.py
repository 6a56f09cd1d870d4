"""JSON lines in one file or in a folder of numbered parts: listing, reading with provenance, strict and permissive parsing."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..arrow import map_columns

_PART = re.compile(r"(?P<prefix>.*?)_?part_(?P<no>\d+)\.jsonl\Z", re.I | re.S)


def is_single_file(path: str | Path) -> bool:
    return Path(path).suffix.lower() == ".jsonl"


def parts(folder: str | Path) -> list[Path]:
    """The parts of a folder by number; none if it doesn't exist. Two prefixes, a gap, or lines that are no part are errors."""
    folder = Path(folder)
    if not folder.exists():
        return []
    if not folder.is_dir():
        raise NotADirectoryError(folder)
    lines = [p for p in folder.iterdir() if p.is_file() and is_single_file(p)]
    named = [(m["prefix"], int(m["no"]), p) for p in lines if (m := _PART.match(p.name))]
    if lines and not named:
        raise ValueError(f"{folder} has JSON lines but no numbered parts")
    if len({prefix for prefix, _, _ in named}) > 1:
        raise ValueError(f"{folder} has parts with several prefixes")
    numbers = sorted(no for _, no, _ in named)
    if numbers != list(range(len(numbers))):
        raise ValueError(f"the parts of {folder} don't run from 0 without a gap: {numbers}")
    return [p for _, _, p in sorted(named, key=lambda x: x[1])]


def files_of(path: str | Path) -> list[Path]:
    """A single file if it exists, else the parts of the folder."""
    path = Path(path)
    return ([path] if path.exists() else []) if is_single_file(path) else parts(path)


def any_files(path: str | Path) -> list[Path]:
    """A single file, or every file of JSON lines in a folder by name; none is an error."""
    path = Path(path)
    if is_single_file(path):
        if not path.is_file():
            raise FileNotFoundError(path)
        return [path]
    if not path.is_dir():
        raise FileNotFoundError(path)
    found = sorted(p for p in path.iterdir() if p.is_file() and is_single_file(p))
    if not found:
        raise ValueError(f"no JSON lines in {path}")
    return found


def lines(spark: SparkSession, paths: list[Path]) -> DataFrame:
    """(file, file_no, line_no, raw): every line with its number in its file, from 1, whatever it holds.

    A file is one row of a scan and is cut into lines where it is read, so numbers are exact; parts are bounded by their writer.
    """
    if not paths:
        return spark.createDataFrame([], "file string, file_no int, line_no bigint, raw string")
    order = spark.createDataFrame([(p.resolve().as_uri(), p.name, i) for i, p in enumerate(paths)], "uri string, file string, file_no int")
    whole = spark.read.text([str(p) for p in paths], wholetext=True).select(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///").alias("uri"), "value")
    named = whole.join(F.broadcast(order), "uri")
    each = named.select("file", "file_no", F.posexplode(F.split("value", "\r\n|\r|\n")).alias("i", "raw"), F.size(F.split("value", "\r\n|\r|\n")).alias("n"))
    return each.where((F.col("i") + 1 < F.col("n")) | (F.col("raw") != "")).select("file", "file_no", (F.col("i") + 1).cast("bigint").alias("line_no"), "raw")


def _parsed(raw: DataFrame) -> DataFrame:
    """``raw`` with ``error``: null for an object, ``blank``, ``no JSON`` or ``no object``; and ``record``, the object as JSON text."""

    def run(c: dict) -> dict:
        records, errors = [], []
        for r in c["raw"]:
            record, error = None, None
            if not r.strip():
                error = "blank"
            else:
                try:
                    got = json.loads(r)
                    if isinstance(got, dict):
                        record = json.dumps(got, ensure_ascii=False)
                    else:
                        error = "no object"
                except (ValueError, RecursionError):
                    error = "no JSON"
            records.append(record)
            errors.append(error)
        return c | {"record": records, "error": errors}

    return map_columns(raw, run, "file string, file_no int, line_no bigint, raw string, record string, error string")


def read(spark: SparkSession, path: str | Path, schema: str) -> DataFrame:
    """Objects of a file or folder with the fields of ``schema``, and file, file_no, line_no; blank and broken lines and other values are skipped."""
    return fields(_parsed(lines(spark, files_of(path))).where("error IS NULL"), schema)


def fields(parsed: DataFrame, schema: str) -> DataFrame:
    return parsed.select("file", "file_no", "line_no", F.from_json("record", schema).alias("_r")).select("_r.*", "file", "file_no", "line_no")


def read_strict(spark: SparkSession, path: str | Path, schema: str, required: list[str]) -> DataFrame:
    """Like ``read``, but a line that is no object, or lacks a required field, is an error that names file and line."""
    rows = _parsed(lines(spark, files_of(path))).where("error IS NULL OR error <> 'blank'")
    has = fields_present(F.col("record"), required)
    where = F.concat_ws(":", "file", F.col("line_no").cast("string"))
    wrong = F.coalesce(F.col("error"), F.when(~has, "missing " + " or ".join(required)))
    sure = rows.withColumn("record", F.when(wrong.isNotNull(), F.raise_error(F.concat(where, F.lit(": "), wrong))).otherwise(F.col("record")))
    return fields(sure, schema)


def fields_present(record: Column, names: list[str]) -> Column:
    keys = F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))
    return F.forall(F.array(*map(F.lit, names)), lambda n: F.array_contains(keys, n))


def prompts(spark: SparkSession, path: str | Path) -> DataFrame:
    """Prompts, read strictly; a template that is no text is empty."""
    rows = read_strict(spark, path, "id string, template string, prompt string", ["id", "prompt"])
    return rows.withColumn("template", F.coalesce("template", F.lit("")))


def outputs(spark: SparkSession, path: str | Path, schema: str = "id string, template string, prompt string, result string, used_terms array<string>") -> DataFrame:
    """Answers, read strictly."""
    return read_strict(spark, path, schema, ["id"])


def completed_ids(spark: SparkSession, path: str | Path) -> DataFrame:
    """(id): ids that are text or whole numbers, as text; for a run that goes on where it stopped."""
    rows = _parsed(lines(spark, files_of(path))).where("error IS NULL")
    return rows.select(F.get_json_object("record", "$.id").alias("id"), F.schema_of_variant(F.try_variant_get(F.parse_json("record"), "$.id", "variant")).alias("kind")).where("kind IN ('STRING', 'BIGINT')").select("id").distinct()


def non_empty_lines(spark: SparkSession, path: str | Path) -> DataFrame:
    """(file, n): lines that aren't blank."""
    return lines(spark, files_of(path)).where(F.trim("raw") != "").groupBy("file").agg(F.count("*").alias("n"))


def each_file(spark: SparkSession, path: str | Path, schema: str, step: Callable[[DataFrame], DataFrame], name: Callable[[str], str] = lambda f: f) -> dict[str, DataFrame]:
    """``step`` for each file of a folder, by output name; the rows of one file stay together."""
    return {name(p.name): step(fields(_parsed(lines(spark, [p])).where("error IS NULL"), schema)) for p in any_files(path)}
