"""Licence vote, secret findings and the gate that decides over repositories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions import text as T


def findings_of_reports(reports: DataFrame) -> DataFrame:
    """Nested scanner reports (repo, files[].licenses[]) as rows (repo, ord, spdx, matched_text); ord is the reading order."""
    files = reports.select("repo", F.posexplode("files").alias("i", "file"))
    return files.select("repo", "i", F.posexplode("file.licenses").alias("j", "l")).select(
        "repo",
        (F.col("i").cast("bigint") * 1_000_000 + F.col("j")).alias("ord"),
        T.or_default(F.col("l.spdx_license_key"), None).alias("k1"),
        F.col("l.key").alias("k2"),
        F.col("l.matched_text").alias("matched_text"),
    ).select("repo", "ord", F.coalesce("k1", F.nullif(F.col("k2"), F.lit(""))).alias("spdx"), "matched_text")


# Rules of secret scanners, in the syntax that Java and RE2 share.
SECRET_RULES = (
    ("private-key", r"-----BEGIN [A-Z ]*PRIVATE KEY( BLOCK)?-----"),
    ("aws-access-key", r"(^|[^A-Za-z0-9])(AKIA|ASIA)[0-9A-Z]{16}([^A-Za-z0-9]|$)"),
    ("github-token", r"(^|[^A-Za-z0-9])(gh[pousr]_[A-Za-z0-9]{30,}|github_pat_[A-Za-z0-9_]{30,})"),
    ("slack-token", r"(^|[^A-Za-z0-9])xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    ("signed-token", r"(^|[^A-Za-z0-9])eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{16,}"),
    ("password-in-url", r"[a-z][a-z0-9+.-]*://[^ :/@'\"]*:[^ @/'\"${}<>]{4,}@[A-Za-z0-9]"),
    ("assigned-secret", r"(?i)(password|passwd|secret|token|api_?key)[\"']?[ ]*[:=][ ]*[\"'][A-Za-z0-9+/=_!#$%&*?~-]{16,}[\"']"),
)


def secret_findings(files: DataFrame, text: str, *keep: str, rules: tuple = SECRET_RULES) -> DataFrame:
    """(keep, rule) for each rule that a text breaks: where no scanner's reports are at hand. One pass, in the JVM."""
    broken = F.array_compact(F.array(*[F.when(F.col(text).rlike(p), name) for name, p in rules]))
    return files.where(F.col(text).isNotNull()).select(*keep, F.explode(broken).alias("rule"))


def license_vote(findings: DataFrame) -> DataFrame:
    """(repo, license, votes, matched_text): the licence found most often, ties to the one found first; the first text that is not empty.

    Findings without a licence don't count. Partial aggregation per (repo, licence), so hot repositories combine early.
    """
    f = findings.where(F.col("spdx").isNotNull() & (F.col("spdx") != ""))
    by = f.groupBy("repo", "spdx").agg(
        F.count("*").alias("n"),
        F.min("ord").alias("first"),
        F.min(F.when(F.col("matched_text") != "", F.struct("ord", "matched_text"))).alias("text"),
    )
    return by.groupBy("repo").agg(
        F.max_by("spdx", F.struct(F.col("n"), -F.col("first"))).alias("license"), F.max("n").alias("votes"), F.min("text").alias("text")
    ).select("repo", "license", "votes", F.col("text.matched_text").alias("matched_text"))


def is_allowed(c: Column, allowed: tuple[str, ...]) -> Column:
    """Never null: an unknown licence is not allowed."""
    return F.coalesce(c.isin(*allowed), F.lit(False))


def gate(repos: DataFrame, allowed: tuple[str, ...]) -> DataFrame:
    """Adds license (effective) and status to (repo, hint, detected, has_secrets, scanned).

    scanned false: the hint decides and secrets are not looked at. Secrets quarantine whatever the licence.
    """
    detected = F.nullif(F.col("detected"), F.lit(""))
    hint = F.nullif(F.col("hint"), F.lit(""))
    effective = F.when(F.col("scanned"), F.coalesce(detected, hint)).otherwise(hint)
    ok = is_allowed(effective, allowed)
    status = (
        F.when(~F.col("scanned"), F.when(ok, "ok").otherwise("blocked_license_scanner_unavailable"))
        .when(F.coalesce("has_secrets", F.lit(False)), "quarantined_secrets")
        .when(ok, "ok")
        .otherwise("blocked_license")
    )
    return repos.withColumn("license", effective).withColumn("status", status)


# What a scan leaves in the provenance record.
SCANNERS = {"scancode": "latest", "semgrep": "latest", "bandit": "latest", "gitleaks": "latest"}


def update_provenance(provenance: DataFrame, gated: DataFrame, stamp: str, skipped: bool = False) -> DataFrame:
    """Provenance (one row per repository) with what the gate found out: license_spdx, license_text, scan_tool_versions, scan_timestamp.

    gated: (repo, license, matched_text); repositories without a row keep their fields. With a skipped scan only the time is set, and the
    versions where there are none. stamp: the time of the run.
    """
    if skipped:
        versions = F.coalesce("scan_tool_versions", F.create_map(F.lit("security"), F.lit("skipped")))
        return provenance.withColumn("scan_tool_versions", versions).withColumn("scan_timestamp", F.lit(stamp))
    g = gated.select(F.col("repo").alias("__repo"), F.col("license").alias("__license"), F.col("matched_text").alias("__text"))
    known = F.col("__repo").isNotNull()
    now = F.create_map(*[F.lit(x) for kv in SCANNERS.items() for x in kv])
    new = {"license_spdx": F.col("__license"), "license_text": F.col("__text"), "scan_tool_versions": now, "scan_timestamp": F.lit(stamp)}
    out = provenance.join(g, F.col("repo_full_name") == F.col("__repo"), "left")
    return out.withColumns({c: F.when(known, v).otherwise(F.col(c)) for c, v in new.items()}).drop("__repo", "__license", "__text")


def ingested(snapshots: DataFrame) -> DataFrame:
    """Snapshots whose ingest went well; a missing status is none that did."""
    return snapshots.where(F.col("status") == "ok")


def with_reports(repos: DataFrame, findings: DataFrame, key: str = "repo") -> DataFrame:
    """Every repository with the numbers of its findings by rule: n_findings and a map with a key per rule; 0 and an empty map where a
    scanner made no report."""
    by = findings.groupBy(key, "rule").agg(F.count("*").alias("n"))
    got = by.groupBy(key).agg(F.sum("n").alias("n_findings"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("rule", "n")))).alias("findings"))
    empty = F.create_map().cast("map<string,bigint>")
    return repos.join(got, key, "left").withColumns({"n_findings": F.coalesce("n_findings", F.lit(0)).cast("bigint"), "findings": F.coalesce("findings", empty)})


def split_by_status(gated: DataFrame) -> dict[str, DataFrame]:
    """'ok', 'quarantined' and 'blocked' parts."""
    s = F.col("status")
    return {"ok": gated.where(s == "ok"), "quarantined": gated.where(s == "quarantined_secrets"), "blocked": gated.where(s.startswith("blocked"))}
