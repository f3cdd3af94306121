"""Readers: manifests, records as JSON lines, raw files, scanner reports, provenance folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline import schemas
from loamline.functions import text as T
from loamline.functions.store import qualified


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Repositories from JSON arrays or JSON lines; absent fields are null, topics and readme_head default to empty. A manifest is a
    list of chosen repositories, so each of its files is read as one text."""
    text = spark.read.text(path, wholetext=True)
    lines = F.concat(F.lit("["), F.array_join(F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != ""), ","), F.lit("]"))
    whole = F.when(F.ltrim("value").startswith("["), F.col("value")).otherwise(lines)
    df = text.select(F.explode(F.from_json(whole, f"array<struct<{schemas.REPO.replace(' string', ': string').replace(' int', ': int').replace(' array', ': array').replace(' double', ': double')}>>")).alias("r")).select("r.*")
    return df.withColumn("topics", F.coalesce("topics", F.array().cast("array<string>"))).withColumn("readme_head", F.coalesce("readme_head", F.lit("")))


def json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, corrupt lines) of JSON-line files; a glob reads them all. Blank lines count for neither."""
    raw = spark.read.text(path).where(F.trim("value") != "").withColumn("ok", F.try_parse_json("value").isNotNull())
    good = raw.where("ok").select(F.from_json("value", schema).alias("r")).select("r.*")
    return good, raw.where("not ok").select("value")


def functions(spark: SparkSession, path: str) -> DataFrame:
    return json_lines(spark, path, schemas.FUNCTION)[0]


def raw_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """(file_path below root, content, code): every file, recursively, or those whose names fit the glob pattern, which are then the
    only ones read; bytes that are no UTF-8 are dropped from the text. Empty files have no row, as Spark reads none."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    df = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(root)
    below = len(qualified(spark, root).rstrip("/")) + 2
    return df.select(F.expr(f"substring(path, {below})").alias("file_path"), "content", T.decode_utf8(F.col("content")).alias("code"))


def repositories(spark: SparkSession, root: str, pattern: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(provenance, source files) of a folder with <name>/provenance.json and the files below <name>/repo/."""
    provenance = provenance_folders(spark, root)
    folder = F.element_at(F.split("path", "/"), -2)
    named = provenance.select(folder.alias("__folder"), "repo_full_name")
    files = raw_files(spark, root, pattern).where(F.col("file_path").rlike("^[^/]+/repo/"))
    files = files.withColumn("__folder", F.substring_index("file_path", "/", 1)).withColumn("file_path", F.regexp_replace("file_path", "^[^/]+/repo/", ""))
    return provenance, files.join(named, "__folder").select("repo_full_name", "file_path", "code")


def _report_of(suffix: str):
    """The repository that a report is of: <repo>_<suffix>.json, else the folder."""
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return F.when(name.endswith(f"_{suffix}.json"), F.expr(f"left(element_at(split(input_file_name(), '/'), -1), length(element_at(split(input_file_name(), '/'), -1)) - {len(suffix) + 6})")).otherwise(F.element_at(F.split(F.input_file_name(), "/"), -2))


def secret_reports(spark: SparkSession, path: str) -> DataFrame:
    """(repo, rule, file) of secret scanner reports, JSON arrays of findings <repo>_gitleaks.json; what is no array has no findings."""
    text = spark.read.text(path, wholetext=True).select(_report_of("gitleaks").alias("repo"), "value")
    found = F.from_json("value", "array<struct<RuleID: string, File: string>>")
    rows = text.where(F.ltrim("value").startswith("[")).select("repo", F.explode(found).alias("f"))
    return rows.select("repo", F.col("f.RuleID").alias("rule"), F.col("f.File").alias("file"))


def license_reports(spark: SparkSession, path: str) -> DataFrame:
    """(repo, files) of licence scanner reports, <repo>_scancode.json or <repo>/licenses.json."""
    df = spark.read.schema(schemas.LICENSE_REPORT).option("multiLine", True).json(path)
    return df.select(_report_of("scancode").alias("repo"), F.coalesce("files", F.array().cast("array<struct<path:string,licenses:array<struct<spdx_license_key:string,key:string,matched_text:string>>>>")).alias("files"))


def rebuild_manifest(provenance: DataFrame, order: str = "path") -> DataFrame:
    """Manifest rows from repositories' provenance: those with repo_full_name, clone_url and source, in order of the path.

    default_branch defaults to 'main'; what provenance doesn't hold is null or empty.
    """
    full = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    null = lambda t: F.lit(None).cast(t)
    return (
        provenance.where(full("repo_full_name") & full("clone_url") & full("source"))
        .select(
            "source", "repo_full_name", "clone_url", T.or_default(F.col("default_branch"), "main").alias("default_branch"), null("int").alias("stars"),
            F.col("license_spdx").alias("license_hint"), null("string").alias("url"), null("string").alias("description"),
            F.array().cast("array<string>").alias("topics"), F.lit("").alias("readme_head"), "semantic_score", null("string").alias("fetch_timestamp"), order,
        )
        .orderBy(order)
    )


def provenance_folders(spark: SparkSession, root: str) -> DataFrame:
    """One row per readable <root>/*/provenance.json, with its path; unparsable files are skipped."""
    df = spark.read.schema(schemas.REPO_PROVENANCE + ", _corrupt string").option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(f"{root.rstrip('/')}/*/provenance.json")
    return df.withColumn("path", F.input_file_name()).where("_corrupt is null").drop("_corrupt")
