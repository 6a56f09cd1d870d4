"""Calls of an outside model from within a plan; the model is a function that is handed in."""

from __future__ import annotations

import asyncio
import inspect
import time
from collections.abc import Awaitable, Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import containers, ids, text

Model = Callable[[str], str | Awaitable[str]]


@dataclass(frozen=True)
class Calls:
    concurrency: int = 50
    batch: int = 100
    retries: int = 2
    backoff_s: float = 0.5


async def _answers(prompts: list[str], model: Model, calls: Calls) -> list[tuple[str | None, str | None]]:
    gate = asyncio.Semaphore(calls.concurrency)

    async def one(prompt: str) -> tuple[str | None, str | None]:
        async with gate:
            for attempt in range(calls.retries + 1):
                try:
                    got = model(prompt)
                    return (await got if inspect.isawaitable(got) else got), None
                except Exception as e:  # whatever the model raises is a result of its own
                    error = f"{type(e).__name__}: {e}"
                    if attempt < calls.retries:
                        await asyncio.sleep(calls.backoff_s * 2**attempt)
            return None, error

    return [r for at in range(0, len(prompts), calls.batch) for r in await asyncio.gather(*map(one, prompts[at : at + calls.batch]))]


def answer_one(prompt: str, model: Model, calls: Calls = Calls()) -> str:
    """One call with its retries; the last error is raised."""
    content, error = asyncio.run(_answers([prompt], model, calls))[0]
    if error:
        raise RuntimeError(error)
    return content


def answered(prompts: DataFrame, model: Model, calls: Calls = Calls(), column: str = "prompt") -> DataFrame:
    """``prompts`` with ``content`` and ``error``: batches in order, so many calls at once, failures kept as errors."""
    schema = T.StructType([*prompts.schema.fields, T.StructField("content", T.StringType()), T.StructField("error", T.StringType())])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            got = asyncio.run(_answers(list(part[column]), model, calls))
            yield part.assign(content=[c for c, _ in got], error=[e for _, e in got])

    return prompts.mapInPandas(run, schema)


def new_outputs(prompts: DataFrame, model: Model, calls: Calls = Calls()) -> DataFrame:
    """(id, template, prompt, result, error): a failed call gives an empty result, which the quality filter rejects later."""
    got = answered(prompts.select("id", "template", "prompt"), model, calls)
    return got.select("id", "template", "prompt", F.coalesce("content", F.lit("")).alias("result"), "error")


def spoken_forms(records: DataFrame, model: Model, calls: Calls = Calls(200, 200, 0), regenerate: bool = False) -> DataFrame:
    """``records`` (id, result, file, line_no) with new results, and ``status`` and ``details``.

    Statuses: ``changed``, ``unchanged``, ``skipped`` (regeneration only touches texts with digits or hyphens),
    ``skipped_invalid_result`` without a text, ``failed_llm_normalization``. Failed rows keep their result.
    """
    rows = records.withColumn("_text", containers.recovered_text_of("result"))
    wanted = F.col("_text").isNotNull() & (text.has_forbidden_speech_chars("_text") if regenerate else F.lit(True))
    asked = answered(rows.where(wanted), model, calls, "_text").withColumn("_s", containers.spoken_output_of("content"))
    details = F.when(F.col("error").isNotNull(), F.concat(F.lit("ProviderError: "), F.col("error"))).otherwise(F.concat(F.lit("ParseError: "), F.col("_s.error")))
    out = F.when(F.col("error").isNull(), F.col("_s.output"))
    status = F.when(out.isNull(), "failed_llm_normalization").when(out == F.col("_text"), "unchanged").otherwise("changed")
    done = asked.select(*[c for c in records.columns if c != "result"], F.when(out.isNull(), F.col("result")).otherwise(containers.text_written_back(out)).alias("result"), status.alias("status"), F.when(out.isNull(), details).alias("details"))
    rest = rows.where(~F.coalesce(wanted, F.lit(False))).select(*[c for c in records.columns if c != "result"], "result", F.when(F.col("_text").isNull(), "skipped_invalid_result").otherwise("skipped").alias("status"), F.lit(None).cast("string").alias("details"))
    return done.unionByName(rest)


def failures_log(done: DataFrame) -> DataFrame:
    """(input_file, line_number, id, status, details) of rows that failed."""
    bad = done.where(F.col("status").isin("failed_llm_normalization", "skipped_invalid_result"))
    return bad.select(F.col("file").alias("input_file"), F.col("line_no").alias("line_number"), ids.record_id("id", "file", "line_no").alias("id"), "status", "details")


def decode_wave(content: bytes) -> tuple[np.ndarray, int, int]:
    """(samples by channel, rate, channels) of a PCM wave file, from -1 to 1."""
    import io
    import wave

    with wave.open(io.BytesIO(content)) as w:
        width, channels, rate = w.getsampwidth(), w.getnchannels(), w.getframerate()
        raw = w.readframes(w.getnframes())
    if width == 1:
        flat = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        flat = (((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) ^ 0x800000) - 0x800000).astype(np.float32) / 2**23
    else:
        flat = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]).astype(np.float32) / 2 ** (8 * width - 1)
    return flat.reshape(-1, channels), rate, channels


def resampled(mono: np.ndarray, rate: int, to: int = 16_000) -> np.ndarray:
    """By linear interpolation."""
    if rate == to or not len(mono):
        return mono.astype(np.float32)
    at = np.arange(round(len(mono) * to / rate)) * (rate / to)
    return np.interp(at, np.arange(len(mono)), mono).astype(np.float32)


def audio_scores(files: DataFrame, make_model: Callable[[], Callable[[np.ndarray, int], float]], decode: Callable[[bytes], tuple[np.ndarray, int, int]] = decode_wave) -> DataFrame:
    """(rel_path, ok, mos, mos_0_100, duration_s, input_sr, channels, error) of files (rel_path, content); a file that fails is a row with its error.

    ``make_model`` is called once in each task; its model gets 16 kHz mono samples. Waveforms never leave the task.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for part in parts:
            rows = []
            for path, content in zip(part["rel_path"], part["content"]):
                try:
                    wave, rate, channels = decode(bytes(content))
                    mos = float(model(resampled(wave.mean(axis=1), rate), 16_000))
                    rows.append((path, True, mos, (mos - 1) * 25, len(wave) / rate, rate, channels, None))
                except Exception as e:  # one bad file doesn't end the run
                    rows.append((path, False, None, None, None, None, None, str(e) or type(e).__name__))
            yield pd.DataFrame(rows, columns=["rel_path", "ok", "mos", "mos_0_100", "duration_s", "input_sr", "channels", "error"]).astype({"input_sr": "Int32", "channels": "Int32"})

    return files.select("rel_path", "content").mapInPandas(run, "rel_path string, ok boolean, mos double, mos_0_100 double, duration_s double, input_sr int, channels int, error string")
