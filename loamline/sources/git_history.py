"""Changes of local git repositories: one task and one git process per repository; each commit against its first parent."""

from __future__ import annotations

import re
import subprocess
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame

SCHEMA = "repo string, commit string, parent string, ord int, author string, date string, message string, a_path string, b_path string, change_type string, diff string"
_RAW = re.compile(r":\d+ \d+ \S+ \S+ (?P<kind>[A-Z])\d*\0(?P<one>[^\0]*)\0")
_HEADER = re.compile(r"(?:diff --git|old mode|new mode|deleted file|new file|similarity|dissimilarity|rename|copy|index|---|\+\+\+)")


def _log(path: str, count: int, mark: str) -> str:
    form = f"{mark}%H%x1f%P%x1f%an%x1f%ct%x1f%B{mark}"
    command = ["git", "-c", "safe.directory=*", "-C", path, "log", f"-n{count}", "-M", "--diff-merges=first-parent", "--raw", "--no-abbrev", "-p", "-z", "--no-color", "--no-ext-diff", f"--format={form}"]
    try:
        out = subprocess.run(command, capture_output=True, timeout=3600, check=False)
    except (subprocess.TimeoutExpired, OSError):
        return ""
    return out.stdout.decode("utf-8", "ignore") if out.returncode == 0 else ""


def _changes(text: str) -> list[tuple[str | None, str | None, str, str]]:
    """(old path, new path, kind, diff without its header) of what follows a commit's message."""
    at, found = text.find(":"), []
    begin = text.find("diff --git ")
    if at < 0 or 0 <= begin < at:
        return []
    while m := _RAW.match(text, at):
        at, old, new = m.end(), m["one"], m["one"]
        if m["kind"] in "RC":
            stop = text.index("\0", at)
            new, at = text[at:stop], stop + 1
        found.append((None if m["kind"] == "A" else old, None if m["kind"] == "D" else new, m["kind"]))
    patches = []
    for part in re.split(r"(?m)^(?=diff --git )", text[at:].lstrip("\0\n")):
        if not part.startswith("diff --git "):
            continue
        lines = part.split("\n")
        k = 0
        while k < len(lines) and _HEADER.match(lines[k]):
            k += 1
        patches.append("\n".join(lines[k:]).rstrip("\0"))
    out, k = [], 0
    for old, new, kind in found:
        n = 2 if kind == "T" else 1  # a change of type is shown as a removal and an addition
        out.append((old, new, kind, "".join(patches[k : k + n])))
        k += n
    return out


def changes_of(repo: str, path: str, max_commits: int = 200) -> list[tuple]:
    """Rows of SCHEMA for the last commits: message whole, date as naive UTC, paths as they are. A root commit has one row without parent."""
    rows, mark = [], uuid.uuid4().hex
    parts = _log(path, int(max_commits), mark).split(mark)[1:]
    for n, (head, body) in enumerate(zip(parts[::2], parts[1::2], strict=False)):
        sha, parents, author, date, message = head.split("\x1f", 4)
        when = datetime.fromtimestamp(int(date), timezone.utc).replace(tzinfo=None).isoformat()
        parent = parents.split(" ")[0] or None
        common = (repo, sha, parent, n, author, when, message.strip())
        if parent is None:
            rows.append((*common, None, None, None, None))
        else:
            rows += [(*common, *x) for x in _changes(body)]
    return rows


def read(repos: DataFrame, max_commits: int = 200) -> DataFrame:
    """Rows for operators.mining of (repo, path) rows. A folder that is no repository gives none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for p in batches:
            for repo, path in zip(p.repo, p.path, strict=True):
                yield pd.DataFrame(changes_of(repo, path, max_commits), columns=names)

    return repos.select("repo", "path").mapInPandas(run, SCHEMA)
