"""Unified diffs: no built-in exists, so an Arrow-batched function."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def unified(a: str | None, b: str | None, name: str | None) -> str:
    """Diff of two texts with three context lines; null counts as ''."""
    name = name or "code.py"
    return "".join(
        difflib.unified_diff(
            (a or "").splitlines(keepends=True), (b or "").splitlines(keepends=True), fromfile=f"a/{name}", tofile=f"b/{name}"
        )
    )


def unified_diff(a, b, name) -> Column:
    """Column of diffs of two text columns; made when it is used, as workers import this module too."""

    def run(x: pd.Series, y: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([unified(*t) for t in zip(x, y, n, strict=True)], dtype=object)

    run.__annotations__ = {"x": pd.Series, "y": pd.Series, "n": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")(a, b, name)


_HUNK = re.compile(r"@@ -(\d+)(?:,(\d+))? \+\d+(?:,(\d+))? @@\n")


def applied(a: str | None, diff: str | None) -> str:
    """The text that a unified diff makes of a; an empty diff changes nothing. Lines that do not fit raise ValueError."""
    old, out, at = (a or "").splitlines(keepends=True), [], 0
    lines = (diff or "").splitlines(keepends=True)
    i = 2
    while i < len(lines):
        m = _HUNK.fullmatch(lines[i])
        if not m:
            raise ValueError(f"no hunk: {lines[i]!r}")
        begin = int(m[1]) - (m[2] != "0")
        out += old[at:begin]
        at, i = begin, i + 1
        left, right = int(m[2] or 1), int(m[3] or 1)
        while left or right:
            mark, line = lines[i][:1], lines[i][1:]
            if mark in " -" and old[at] != line:
                raise ValueError(f"line {at + 1} is {old[at]!r}, not {line!r}")
            out += [line] if mark in " +" else []
            at, left, right, i = at + (mark in " -"), left - (mark in " -"), right - (mark in " +"), i + 1
    return "".join(out + old[at:])


def patched(a, diff) -> Column:
    """Column of what diffs make of texts."""

    def run(x: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([applied(*t) for t in zip(x, d, strict=True)], dtype=object)

    run.__annotations__ = {"x": pd.Series, "d": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")(a, diff)
