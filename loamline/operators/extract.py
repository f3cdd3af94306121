"""Functions from source files."""

from __future__ import annotations

import ast
import warnings
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The endings that are listed per language.
ENDINGS = {"python": (".py",), "javascript": (".js", ".jsx", ".ts", ".tsx")}


def list_sources(files: DataFrame, languages: tuple[str, ...], path: str = "file_path") -> DataFrame:
    """Files whose ending, case aside, belongs to one of the languages."""
    ends = [e for x in languages for e in ENDINGS.get(x, ())]
    if not ends:
        return files.where(F.lit(False))
    low = F.lower(F.col(path))
    cond = F.lit(False)
    for e in ends:
        cond = cond | low.endswith(e)
    return files.where(F.coalesce(cond, F.lit(False)))


def functions_of(code: str, min_loc: int = 0, max_loc: int = 10**9) -> list[tuple[int, int, str, str | None]]:
    """(first line, last line, text, docstring) of all functions, breadth first; [] for what does not parse.

    Lines are parted at line feeds only, as the parser counts them; decorators are left out.
    """
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            tree = ast.parse(code)
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return []
    lines = code.split("\n")
    out = []
    for node in ast.walk(tree):
        if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)):
            last = node.end_lineno or node.lineno
            if min_loc <= last - node.lineno + 1 <= max_loc:
                out.append((node.lineno, last, "\n".join(lines[node.lineno - 1 : last]), ast.get_docstring(node)))
    return out


def extract_functions(files: DataFrame, min_loc: int = 5, max_loc: int = 400) -> DataFrame:
    """(repo_full_name, file_path, start_line, end_line, loc, code, docstring) of Python files (repo_full_name, file_path, code).

    Null, empty and unparsable files give no rows; other languages are listed but have no extractor.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            rows = [
                (repo, path, a, b, b - a + 1, text, doc)
                for repo, path, code in zip(p.repo_full_name, p.file_path, p.code, strict=True)
                if isinstance(code, str)
                for a, b, text, doc in functions_of(code, min_loc, max_loc)
            ]
            yield pd.DataFrame(rows, columns=["repo_full_name", "file_path", "start_line", "end_line", "loc", "code", "docstring"])

    py = list_sources(files, ("python",)).select("repo_full_name", "file_path", "code")
    return py.mapInPandas(run, "repo_full_name string, file_path string, start_line int, end_line int, loc int, code string, docstring string")


def loc_between(lo: int, hi: int, c: str = "loc") -> Column:
    return F.col(c).between(lo, hi)


def attach_provenance(units: DataFrame, repos: DataFrame) -> DataFrame:
    """Adds the 13-field provenance struct of each unit's repository (one row per repository); null where it is unknown."""
    r = repos.select(
        F.col("repo_full_name").alias("__r"), *[F.col(c).alias(f"__{c}") for c in ("source", "clone_url", "default_branch", "commit_sha", "commit_date", "license_spdx", "license_text", "scan_tool_versions", "scan_timestamp", "semantic_score")], F.lit(True).alias("__known")
    )
    j = units.join(r, F.col("repo_full_name") == F.col("__r"), "left")
    fields = ["repo_full_name"] + [F.col(f"__{c}").alias(c) for c in ("source", "clone_url", "default_branch", "commit_sha", "commit_date")] + ["file_path"]
    fields += [F.array(F.col("start_line"), F.col("end_line")).alias("lines")] + [F.col(f"__{c}").alias(c) for c in ("license_spdx", "license_text", "scan_tool_versions", "scan_timestamp", "semantic_score")]
    return j.withColumn("provenance", F.when(F.col("__known"), F.struct(*fields))).select(*units.columns, "provenance")


def file_hashes(files: DataFrame) -> DataFrame:
    """(repo_full_name, file_path, sha256), one row per distinct path and content; unreadable (null) contents are skipped."""
    return files.where(F.col("code").isNotNull()).select("repo_full_name", "file_path", F.sha2("code", 256).alias("sha256")).distinct()


#: Files in one map of hashes.
FILES_PER_MAP = 100_000


def hash_maps(hashes: DataFrame, most: int = FILES_PER_MAP) -> DataFrame:
    """(repo_full_name, part, file_hashes map) for repository records. A repository of more than about `most` files has several
    parts, dealt by hash of the path, so no row grows with it. The last hash of a path in order wins."""
    one = hashes.groupBy("repo_full_name", "file_path").agg(F.max("sha256").alias("sha256"))
    parts = one.groupBy("repo_full_name").agg(F.ceil(F.count("*") / most).cast("int").alias("__n")).withColumnRenamed("repo_full_name", "__r")
    dealt = one.join(parts, F.col("repo_full_name").eqNullSafe(F.col("__r"))).withColumn("part", F.pmod(F.xxhash64("file_path"), F.col("__n")).cast("int"))
    return dealt.groupBy("repo_full_name", "part").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("file_path", "sha256")))).alias("file_hashes"))
