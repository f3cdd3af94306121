"""The whole flow as one plan: search or manifest -> gate -> units -> normalized -> exact -> near -> four tasks -> manifest."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline import config
from loamline.functions import text as T
from loamline.functions.store import shared_dir, written
from loamline.operators import dedup, discovery, extract, gate, tasks, validate
from loamline.sources import files, search, sinks


def gated(repos: DataFrame, findings: DataFrame | None, secrets: DataFrame, cfg: config.Config) -> DataFrame:
    """Repositories (repo_full_name, license_hint, ...) with license, matched_text and status. No findings table (None) means that no
    scanner was at hand: the hint decides."""
    if cfg.skip_security:
        return repos.withColumns({"license": F.col("license_hint"), "matched_text": F.lit(None).cast("string"), "status": F.lit("ok")})
    j = repos.withColumn("repo", F.col("repo_full_name")).withColumn("hint", F.col("license_hint"))
    if findings is None:
        j = j.withColumns({"detected": F.lit(None).cast("string"), "matched_text": F.lit(None).cast("string"), "has_secrets": F.lit(False), "scanned": F.lit(False)})
    else:
        vote = gate.license_vote(findings).select("repo", F.col("license").alias("detected"), "matched_text")
        found = secrets.groupBy("repo").agg(F.lit(True).alias("has_secrets"))
        j = j.join(vote, "repo", "left").join(found, "repo", "left").withColumn("scanned", F.lit(True))
    return gate.gate(j, cfg.allowed_licenses).drop("repo", "hint", "detected", "has_secrets", "scanned")


def kept_units(units: DataFrame, cfg: config.Config, path: str) -> DataFrame:
    """Normalized units without exact and near duplicates. Units with fewer tokens than a shingle have no near duplicates."""
    norm = F.when(F.col("language") == "python", T.normalize_code(F.col("code"))).otherwise(F.col("code"))
    order = ("repo_full_name", "file_path", "start_line", "code")
    u = units.where(extract.loc_between(cfg.min_loc, cfg.max_loc)).withColumn("code_norm", norm).withColumn("record_id", F.xxhash64(*order))
    exact = written(dedup.exact_dedup(u, (*order, "record_id")), f"{path}/exact")
    texts = exact.select(F.col("record_id").alias("id"), F.col("code_norm").alias("text"))
    keep = dedup.greedy_keep(texts, dedup.near_pairs(texts, cfg.shingle_size, cfg.lsh_threshold, cfg.num_perm))
    return written(exact.join(keep.withColumnRenamed("id", "record_id"), "record_id", "left_semi"), f"{path}/kept")


def datasets(kept: DataFrame, cfg: config.Config) -> dict[str, DataFrame]:
    made = {"completion": tasks.completion(kept, cfg.completion_lines), "documentation": tasks.documentation(kept), "refactor": tasks.refactor(kept), "debugging": tasks.debugging(kept)}
    return {k: v.drop("record_id", "n_lines") for k, v in made.items()}


def chosen(repos: DataFrame, cfg: config.Config) -> DataFrame:
    """The first max_repos of a manifest, in its order (`ord`, else as it is read)."""
    return (repos.orderBy("ord") if "ord" in repos.columns else repos).limit(cfg.max_repos)


def run(spark: SparkSession, repos: DataFrame, provenance: DataFrame, sources: DataFrame, findings: DataFrame | None, secrets: DataFrame, out: str, cfg: config.Config, stamp: str | None = None) -> DataFrame:
    """Writes the four datasets, quarantined and blocked repositories, the updated provenance and the manifest below `out`; gives the manifest row.

    provenance: a row per repository, those with a status other than 'ok' (a failed ingest) left out. stamp: the time of the run.
    """
    path = shared_dir(spark)
    stamp = stamp or datetime.now(timezone.utc).replace(tzinfo=None).isoformat(timespec="seconds")
    if "status" in provenance.columns:
        provenance = gate.ingested(provenance).drop("status")
    repos = chosen(repos, cfg).join(provenance.select("repo_full_name"), "repo_full_name", "left_semi")
    decided = written(gated(repos, findings, secrets, cfg), f"{path}/gated")
    parts = gate.split_by_status(decided)
    sinks.quarantine({k: v for k, v in parts.items() if k != "ok"}, f"{out}/gate")
    updated = gate.update_provenance(provenance, decided.select(F.col("repo_full_name").alias("repo"), "license", "matched_text"), stamp, cfg.skip_security)
    updated = written(updated, f"{path}/provenance")
    sinks.json_lines(updated, f"{out}/provenance")
    ok = parts["ok"].select("repo_full_name")
    units = extract.extract_functions(extract.list_sources(sources, cfg.languages).join(ok, "repo_full_name", "left_semi"), cfg.min_loc, cfg.max_loc).withColumn("language", F.lit("python"))
    units = written(extract.attach_provenance(units, updated), f"{path}/units")
    kept = kept_units(units, cfg, path)
    made = datasets(kept, cfg)
    for name, df in made.items():
        sinks.json_lines(df, f"{out}/{name}")
    stats = dedup.stats(units.withColumn("code_norm", F.col("code")), kept)
    rows = reduce(DataFrame.unionByName, [df.select("task", (F.col("license") if "license" in df.columns else F.lit(None).cast("string")).alias("license"), "language", F.col("provenance").isNotNull().alias("ok")) for df in made.values()])
    result = written(validate.manifest(rows, stats, F.col("ok")), f"{path}/manifest")
    sinks.single_json(result, f"{out}/manifest")
    return result


def search_listings(spark: SparkSession, github: str | None, gitlab: str | None, cfg: config.Config, readmes: DataFrame | None = None, encoder=None) -> DataFrame:
    """The search over saved listings of the two sites."""
    of = {site: search.listing(spark, p) for site, p in (("github", github), ("gitlab", gitlab)) if p}
    return discovery.discover(of, cfg.keyword_query, cfg.languages, cfg.min_stars, cfg.topk, cfg.threshold, cfg.max_repos, readmes, encoder, cfg.semantic_query)


def _table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path) if path.endswith((".json", ".jsonl")) else spark.read.parquet(path)


def main(argv: list[str] | None = None) -> None:
    """Offline run over saved inputs.

    Repositories: a manifest (--repos, JSON or Parquet) or saved search listings (--github-listing, --gitlab-listing). Files and
    provenance: a folder with <name>/provenance.json and <name>/repo/ (--raw-dir), or tables (--sources, --provenance). Findings:
    folders of scanner reports (--reports: <name>_scancode.json, <name>_gitleaks.json), or tables (--findings, --secrets); with
    neither the licence hints decide, as without scanners.
    """
    p = argparse.ArgumentParser()
    p.add_argument("--out", required=True)
    for name in ("repos", "github-listing", "gitlab-listing", "raw-dir", "provenance", "sources", "reports", "findings", "secrets", "config"):
        p.add_argument(f"--{name}")
    kinds = {
        "allowed-licenses": str, "languages": str, "min-stars": int, "max-repos": int, "semantic-query": str, "semantic-topk": int, "semantic-threshold": float, "keyword-query": str,
        "min-function-loc": int, "max-function-loc": int, "dedup-shingle-size": int, "minhash-perms": int, "lsh-threshold": float,
    }
    for name, kind in kinds.items():
        p.add_argument(f"--{name}", type=kind)
    p.add_argument("--skip-security", action="store_true", default=None)
    a = vars(p.parse_args(argv))
    names = {"semantic_topk": "topk", "semantic_threshold": "threshold", "min_function_loc": "min_loc", "max_function_loc": "max_loc", "dedup_shingle_size": "shingle_size", "minhash_perms": "num_perm"}
    options = {k.replace("-", "_") for k in kinds} | {"skip_security"}
    cfg = config.load(a["config"], **{names.get(k, k): a[k] for k in options})
    spark = SparkSession.builder.getOrCreate()
    if a["raw_dir"]:
        provenance, sources = files.repositories(spark, a["raw_dir"])
        provenance = provenance.drop("path")
    elif a["provenance"] and a["sources"]:
        provenance, sources = _table(spark, a["provenance"]), _table(spark, a["sources"])
    else:
        p.error("--raw-dir, or --provenance and --sources")
    if a["repos"]:
        repos = files.manifest(spark, a["repos"]) if a["repos"].endswith((".json", ".jsonl")) else spark.read.parquet(a["repos"])
    elif a["github_listing"] or a["gitlab_listing"]:
        repos = search_listings(spark, a["github_listing"], a["gitlab_listing"], cfg, sources.select("repo_full_name", "file_path", "code"))
    else:
        p.error("--repos, --github-listing or --gitlab-listing")
    findings = gate.findings_of_reports(files.license_reports(spark, f"{a['reports']}/*_scancode.json")) if a["reports"] else _table(spark, a["findings"]) if a["findings"] else None
    secrets = files.secret_reports(spark, f"{a['reports']}/*_gitleaks.json") if a["reports"] else _table(spark, a["secrets"]) if a["secrets"] else spark.createDataFrame([], "repo string, rule string")
    if a["reports"]:  # reports are named after folders, in which slashes are underscores
        name = provenance.select(F.replace("repo_full_name", F.lit("/"), F.lit("_")).alias("repo"), F.col("repo_full_name").alias("__full"))
        full = lambda df: df.join(name, "repo").withColumn("repo", F.col("__full")).drop("__full")
        findings, secrets = full(findings), full(secrets)
    run(spark, repos, provenance, sources, findings, secrets, a["out"], cfg)


def rebuild(argv: list[str] | None = None) -> int:
    """Writes a manifest of what lies below a folder of ingested repositories; gives the number of entries."""
    p = argparse.ArgumentParser()
    p.add_argument("--raw-dir", default="data/raw")
    p.add_argument("--out", default="manifests/from_raw_manifest.json")
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    stamp = datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
    m = files.rebuild_manifest(files.provenance_folders(spark, a.raw_dir)).drop("path").withColumn("fetch_timestamp", F.lit(stamp))
    rows = [r[0] for r in m.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect()]  # one per folder
    Path(a.out).parent.mkdir(parents=True, exist_ok=True)
    Path(a.out).write_text("[\n" + ",\n".join(rows) + "\n]\n", encoding="utf-8")
    return len(rows)


if __name__ == "__main__":
    main()
