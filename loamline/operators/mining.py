"""Pairs of states from the history of repositories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def mine_commits(commits: DataFrame, max_commits: int = 200, endings: tuple[str, ...] = (".py",)) -> DataFrame:
    """Of (repo, commit, parent, ord, a_path, b_path, ...) rows the changes of files with one of the endings (case aside).

    The first max_commits commits of each repository count, in the order of ord; root commits (no parent) are skipped; a
    deleted file has its old path. Null paths match no ending.
    """
    firsts = commits.groupBy("repo", "commit").agg(F.min("ord").alias("__o"))
    taken = firsts.withColumn("__rn", F.row_number().over(W.partitionBy("repo").orderBy("__o", "commit"))).where(F.col("__rn") <= max_commits).select("repo", "commit")
    path = F.coalesce("b_path", "a_path")
    wanted = F.lit(False)
    for e in endings:
        wanted = wanted | F.lower(path).endswith(e)
    kept = commits.join(taken, ["repo", "commit"], "left_semi").where(F.col("parent").isNotNull() & (F.col("parent") != "") & F.coalesce(wanted, F.lit(False)))
    return kept.select("repo", "commit", "parent", "author", "date", "message", path.alias("file_path"), "change_type", "diff")


def with_parent(commits: DataFrame, parents: DataFrame) -> DataFrame:
    """Commits joined with the row of their first parent: (commit columns, parent_date, parent_message)."""
    p = parents.select(F.col("repo").alias("__r"), F.col("commit").alias("__c"), F.col("date").alias("parent_date"), F.col("message").alias("parent_message"))
    return commits.join(p, (F.col("repo") == F.col("__r")) & (F.col("parent") == F.col("__c")), "left").drop("__r", "__c")
