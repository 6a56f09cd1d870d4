"""The README lists every problem that has no query."""

import re
from pathlib import Path

import __spark_entry__ as driver


def test_each_problem_is_registered_or_listed():
    text = (Path(__file__).resolve().parents[2] / "README.md").read_text()
    listed = set(re.findall(r"^- (p\d+_found):", text.partition("## Missing")[2], re.M))
    assert listed == {f"p{n}_found" for n in range(1, 11)} - set(driver.queries())
