"""Records for the four tasks, made from code units.

Input: kept units (repo_full_name, file_path, start_line, language, code, docstring, code_norm, provenance). Ids are made
from content. A null provenance gives null license and default commit fields; null code gives no completion records.
"""

from __future__ import annotations

import importlib.util

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions import text as T
from loamline.functions.diff import unified_diff

TASKS = ("completion", "documentation", "refactor", "debugging")



def _keys(task: str, *more: Column) -> Column:
    return T.record_id(F.lit(task), F.col("repo_full_name"), F.col("file_path"), F.col("start_line"), F.col("record_id"), *more)


def _language() -> Column:
    return F.coalesce(F.col("language"), T.language_of_path(F.col("file_path")))


def completion(units: DataFrame, sizes: tuple[int, ...] = (1, 3, 10)) -> DataFrame:
    """Prefix and last n lines, for each n of sizes that is less than the number of lines."""
    # what the records need of the provenance is taken before the rows multiply, so that a scan can prune the rest
    u = units.withColumn("__license", F.col("provenance.license_spdx")).withColumn("__lines", T.lines("code_norm")).withColumn("n_lines", F.explode(F.array(*[F.lit(n) for n in sizes]))).where(F.size("__lines") > F.col("n_lines"))
    cut = F.size("__lines") - F.col("n_lines")
    joined = lambda a: F.concat(F.array_join(a, "\n"), F.lit("\n"))
    return u.select(
        _keys("completion", F.col("n_lines")).alias("id"),
        F.lit("completion").alias("task"),
        _language().alias("language"),
        F.col("__license").alias("license"),
        "provenance",
        F.struct(joined(F.slice("__lines", F.lit(1), cut)).alias("prefix")).alias("input"),
        F.struct(joined(F.slice("__lines", cut + 1, F.col("n_lines"))).alias("completion")).alias("output"),
        F.create_map().cast("map<string,string>").alias("metrics"),
        F.lit(False).alias("synthetic"),
        "record_id",
        "n_lines",
    )


def documentation(units: DataFrame) -> DataFrame:
    """Code with its docstring, or with a description made from its first line."""
    has = ~T.is_blank(F.col("docstring"))
    made = F.concat(F.lit("Function: "), F.substring(F.substring_index(F.col("code_norm"), "\n", 1), 1, 200))
    return units.select(
        _keys("documentation").alias("id"),
        F.lit("documentation").alias("task"),
        _language().alias("language"),
        F.col("provenance.license_spdx").alias("license"),
        "provenance",
        F.col("code_norm").alias("code"),
        F.when(has, F.col("docstring")).otherwise(made).alias("docstring"),
        F.when(has, "docstring").otherwise("heuristic").alias("source"),
        (~has).alias("synthetic"),
        "record_id",
    )


def _formatted(code: Column, formatter: str) -> Column:
    """struct(post, kind): by Black where it is at hand and takes the code ('auto'), else by the minimal formatter."""
    minimal = F.struct(T.format_minimal(code).alias("post"), F.lit("formatting_minimal").alias("kind"))
    if formatter == "minimal" or importlib.util.find_spec("black") is None:
        return minimal

    def run(s: pd.Series) -> pd.DataFrame:
        import black

        out = []
        for c in s:
            try:
                post = black.format_str(c, mode=black.FileMode())
                out.append((post, "formatting_black" if post != c else "formatting_black_noop"))
            except Exception:  # noqa: BLE001  (whatever the formatter does not take)
                out.append((None, None))
        return pd.DataFrame(out, columns=["post", "kind"])

    run.__annotations__ = {"s": pd.Series, "return": pd.DataFrame}
    by = F.pandas_udf(run, "post string, kind string")(code)
    return F.when(by["kind"].isNotNull(), by).otherwise(minimal)


def refactor(units: DataFrame, diffs: bool = True, formatter: str = "auto") -> DataFrame:
    """Before and after formatting ('auto': Black if it can be imported; 'minimal'), with the diff between them."""
    u = units.withColumn("__f", _formatted(F.col("code_norm"), formatter)).withColumn("__post", F.col("__f.post"))
    return u.select(
        _keys("refactor").alias("id"),
        F.lit("refactor").alias("task"),
        _language().alias("language"),
        "provenance",
        F.col("code_norm").alias("pre"),
        F.col("__post").alias("post"),
        *([unified_diff("code_norm", "__post", T.basename(F.col("file_path"))).alias("diff")] if diffs else []),
        F.col("__f.kind").alias("refactor_type"),
        F.lit(False).alias("verified"),
        F.lit(True).alias("synthetic"),
        "record_id",
    )


def debugging(units: DataFrame, diffs: bool = True) -> DataFrame:
    """A mutated unit as the state before and the unit as the state after a fix."""
    sha = T.or_default(F.col("provenance.commit_sha"), "synthetic")
    u = units.withColumn("__buggy", T.inject_bug(F.col("code_norm")))
    none = F.array().cast("array<string>")
    return u.select(
        _keys("debugging").alias("id"),
        F.lit("debugging").alias("task"),
        _language().alias("language"),
        F.col("provenance.license_spdx").alias("license"),
        F.struct(sha.alias("pre_commit"), sha.alias("post_commit"), T.or_default(F.col("provenance.repo_full_name"), "unknown").alias("repo_full_name")).alias("provenance"),
        F.col("__buggy").alias("pre_snippet"),
        F.col("code_norm").alias("post_snippet"),
        *([unified_diff("__buggy", "code_norm", T.basename(F.col("file_path"))).alias("diff")] if diffs else []),
        none.alias("failing_tests"),
        none.alias("stack_trace"),
        F.lit(True).alias("synthetic"),
        "record_id",
    )
