"""Writers: JSON lines in one file or in parts of bounded size, appended, cleared or swapped in; upserts, logs and reports."""

from __future__ import annotations

import html
import os
import shutil
import tempfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import records as R
from ..operators import scores as S
from . import jsonl

#: Bytes after which a part is closed; a larger record still gets a part of its own.
PART_BYTES = 60 * 1024 * 1024


def encoded(df: DataFrame) -> DataFrame:
    """(line): each row as a JSON object, keys in column order, nulls written."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("line"))


def prefix_of(folder: str | Path) -> str:
    """The prefix of the parts that are there, else the name of the folder."""
    there = jsonl.parts(folder)
    return there[0].name.rsplit("part_", 1)[0] if there else f"{Path(folder).name}_"


def _roll(folder: Path, prefix: str, lines: Iterable[str], first: int, used: int) -> int:
    """Writes ``lines`` from part ``first``, of which ``used`` bytes are full; returns how many lines it wrote."""
    n, handle, number = 0, None, first
    try:
        for line in lines:
            data = (line + "\n").encode("utf-8")
            if used and used + len(data) > PART_BYTES:
                if handle:
                    handle.close()
                handle, number, used = None, number + 1, 0
            if handle is None:
                handle = open(folder / f"{prefix}part_{number:02d}.jsonl", "ab")
            handle.write(data)
            used += len(data)
            n += 1
    finally:
        if handle:
            handle.close()
    return n


def clear(path: str | Path) -> None:
    """An empty file, or a folder without parts; other files of the folder stay."""
    path = Path(path)
    if jsonl.is_single_file(path):
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"")
        return
    path.mkdir(parents=True, exist_ok=True)
    for p in jsonl.parts(path):
        p.unlink()


def write(df: DataFrame, path: str | Path, *order: str) -> int:
    """Overwrites ``path`` with the rows of ``df``, in ``order`` if given; rows are streamed through the driver one partition at a time.

    This is the export to files that other programs read. Within the engine tables are written with ``df.write``.
    """
    prefix = None if jsonl.is_single_file(path) else prefix_of(path)
    clear(path)
    return _add(df, Path(path), prefix, order)


def append(df: DataFrame, path: str | Path, *order: str) -> int:
    """Fills the last part up, then goes on with the next."""
    path = Path(path)
    (path.parent if jsonl.is_single_file(path) else path).mkdir(parents=True, exist_ok=True)
    return _add(df, path, None if jsonl.is_single_file(path) else prefix_of(path), order)


def _add(df: DataFrame, path: Path, prefix: str | None, order: tuple[str, ...]) -> int:
    rows = encoded(df.orderBy(*order) if order else df).toLocalIterator()
    lines = (r.line for r in rows)
    if prefix is None:
        n = 0
        with path.open("a", encoding="utf-8", newline="\n") as out:
            for line in lines:
                out.write(line + "\n")
                n += 1
        return n
    there = jsonl.parts(path)
    return _roll(path, prefix, lines, max(0, len(there) - 1), there[-1].stat().st_size if there else 0)


def swap_in(staged: str | Path, path: str | Path) -> None:
    """Puts a staged file or folder in the place of ``path``; both must be of one kind."""
    staged, path = Path(staged), Path(path)
    if path.exists() and path.is_dir() != staged.is_dir():
        raise ValueError(f"{staged} and {path} are of different kinds")
    if staged.is_dir():
        old = path.with_name(f"{path.name}.old")
        shutil.rmtree(old, ignore_errors=True)
        if path.exists():
            os.replace(path, old)
        os.replace(staged, path)
        shutil.rmtree(old, ignore_errors=True)
    else:
        os.replace(staged, path)


def rewrite(df: DataFrame, path: str | Path, *order: str) -> int:
    """Writes beside ``path`` and swaps in, so that ``df`` may read from ``path``."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    with tempfile.TemporaryDirectory(dir=path.parent) as tmp:
        staged = Path(tmp, path.name)
        n = write(df, staged, *order)
        swap_in(staged, path)
    return n


def upsert(new: DataFrame, existing: DataFrame, path: str | Path, *order: str) -> int:
    return rewrite(R.upserted(existing, new), path, *order)


def write_log(failures: DataFrame, path: str | Path) -> bool:
    """Writes a log only if anything failed; returns whether it did. Absent details aren't written."""
    if failures.isEmpty():
        return False
    rows = failures.select(F.to_json(F.struct("*")).alias("line")).toLocalIterator()
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with Path(path).open("a", encoding="utf-8") as out:
        out.writelines(r.line + "\n" for r in rows)
    return True


def per_file(outputs: dict[str, DataFrame], folder: str | Path) -> dict[str, int]:
    """One file of JSON lines for each input file."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    return {name: write(df, Path(folder, name)) for name, df in outputs.items()}


def _table(rows: list, heads: list[str], mark: bool) -> str:
    cells = [["" if v is None else f"{v:.6g}" if isinstance(v, float) else str(v) for v in r] for r in rows]
    if mark:
        return "\n".join("| " + " | ".join(r) + " |" for r in [heads, ["-"] * len(heads), *cells]) + "\n"
    body = "".join("<tr>" + "".join(f"<td>{html.escape(v)}</td>" for v in r) + "</tr>" for r in cells)
    return "<table><tr>" + "".join(f"<th>{html.escape(h)}</th>" for h in heads) + f"</tr>{body}</table>"


def score_report(scores: DataFrame, folder: str | Path) -> None:
    """scores.csv with all rows; summary.md and report.html with totals, quartiles, histogram, and best and worst files."""
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    scores.write.mode("overwrite").csv(str(folder / "scores.csv"), header=True)
    total = S.summary(scores)
    tables = {
        "Overall": (list(zip(total.columns, total.first())), ["metric", "value"]),
        "Distribution": ([tuple(S.described(scores).first())], S.described(scores).columns),
        "Histogram": ([tuple(r) for r in S.histogram(scores).orderBy("bin").collect()], ["bin", "low", "high", "n"]),
        "Best": ([tuple(r) for r in S.extremes(scores).collect()], ["rel_path", "mos", "mos_0_100", "duration_s"]),
        "Worst": ([tuple(r) for r in S.extremes(scores, best=False).collect()], ["rel_path", "mos", "mos_0_100", "duration_s"]),
    }
    (folder / "summary.md").write_text("\n".join(f"## {k}\n\n{_table(rows, heads, True)}" for k, (rows, heads) in tables.items()), encoding="utf-8")
    body = "".join(f"<h2>{k}</h2>{_table(rows, heads, False)}" for k, (rows, heads) in tables.items())
    (folder / "report.html").write_text(f"<!doctype html><meta charset='utf-8'><title>Scores</title>{body}", encoding="utf-8")
