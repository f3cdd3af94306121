"""Searches over saved listings of repositories, with the conditions of the hosting sites' searches applied in Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loamline.functions import text as T
from loamline.schemas import REPO

LISTING = REPO + ", languages array<string>, license struct<spdx_id: string, key: string, name: string>"


def listing(spark: SparkSession, path: str) -> DataFrame:
    """Rows of LISTING and `ord`, the reading order, from JSON lines; lines that cannot be read are left out."""
    raw = spark.read.text(path).select("value", F.struct(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i")).alias("ord"))
    good = raw.where(F.try_parse_json("value").isNotNull()).select("ord", F.from_json("value", LISTING).alias("r"))
    return good.select("ord", "r.*").where("repo_full_name is not null")


def has_words(query: str | None, *texts: Column) -> Column:
    """Every word of the query stands in one of the texts, case aside; no words: no condition."""
    hay = F.lower(F.concat_ws(" ", *texts))
    out = F.lit(True)
    for w in (query or "").lower().split():
        out = out & F.contains(hay, F.lit(w))
    return out


def _texts() -> tuple[Column, ...]:
    return F.col("repo_full_name"), F.col("description"), F.array_join("topics", " "), F.col("readme_head")


def _filled(items: DataFrame) -> DataFrame:
    return items.withColumns(
        {
            "default_branch": T.or_default(F.col("default_branch"), "main"),
            "stars": F.coalesce("stars", F.lit(0)),
            "description": F.coalesce("description", F.lit("")),
            "topics": F.coalesce("topics", F.array().cast("array<string>")),
        }
    )


def license_of(license_: Column) -> Column:
    """The first of a licence's spdx_id, key and name that is not empty."""
    full = lambda f: F.nullif(license_[f], F.lit(""))
    return F.coalesce(full("spdx_id"), full("key"), full("name"))


def _firsts(items: DataFrame, order: Column, most: int) -> DataFrame:
    """The first `most` repositories in the order, each name once; `ord` becomes their number."""
    cols = [c for c in items.columns if c not in ("repo_full_name", "ord")]
    one = items.withColumn("ord", order).groupBy("repo_full_name").agg(F.min_by(F.struct("ord", *cols), "ord").alias("r"))
    top = one.select("repo_full_name", "r.*").orderBy("ord").limit(most)
    return top.withColumn("ord", F.row_number().over(W.orderBy("ord")).cast("bigint"))  # over `most` rows


def github(items: DataFrame, keywords: str | None = None, languages: tuple[str, ...] = (), min_stars: int = 0, most: int = 100) -> DataFrame:
    """One search per language, each by stars; a repository counts with the first language that has it; `most` over all of them.

    items: rows of LISTING (license may be absent) with `ord`, which decides ties; null stars count as 0.
    """
    items = _filled(items.where(has_words(keywords, *_texts())))
    wanted = F.array(*[F.lit(x.lower()) for x in languages]).cast("array<string>")
    own = F.transform(F.coalesce("languages", F.array().cast("array<string>")), lambda x: F.lower(x))
    number = F.array_position(F.transform(wanted, lambda w: F.array_contains(own, w)), F.lit(True)) if languages else F.lit(1)
    items = items.withColumn("__n", F.coalesce(number, F.lit(0)).cast("int")).where((F.col("__n") > 0) & (F.col("stars") >= min_stars))
    return _firsts(items, F.struct(F.col("__n").alias("n"), (-F.col("stars")).alias("s"), F.col("ord").alias("o")), most).drop("__n", "languages", "license")


def gitlab(items: DataFrame, keywords: str | None = None, languages: tuple[str, ...] = (), min_stars: int = 0, most: int = 100) -> DataFrame:
    """The listing's order, stars and languages checked one by one; where a project's languages are not known, its description and
    topics are looked at. The licence is the first of spdx_id, key and name where the listing has a licence record."""
    items = _filled(items.where(has_words(keywords, *_texts())))
    ok = F.lit(True)
    if languages:
        wanted = F.array(*[F.lit(x.lower()) for x in languages])
        hay = F.lower(F.concat_ws(" ", "description", F.array_join("topics", " ")))
        known = F.arrays_overlap(F.transform("languages", lambda x: F.lower(x)), wanted)
        ok = F.when(F.col("languages").isNotNull(), F.coalesce(known, F.lit(False))).otherwise(F.exists(wanted, lambda w: F.contains(hay, w)))
    if "license" in items.columns:
        items = items.withColumn("license_hint", F.coalesce(license_of(F.col("license")), "license_hint"))
    return _firsts(items.where(ok & (F.col("stars") >= min_stars)), F.struct("ord"), most).drop("languages", "license")
