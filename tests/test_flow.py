import glob
import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from loamline import config
from loamline.operators import validate
from loamline.plans import catalogue, pipeline
from loamline.sources import files
from loamline.streaming import incremental


def _value(v):
    return round(v, 6) if isinstance(v, float) else round(float(v), 6) if hasattr(v, "is_finite") else v


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, small, name):
    con = duckdb.connect()
    for f in glob.glob(f"{small}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = catalogue.queries()[name](spark, small)
    cols = sorted(df.columns)
    r = con.execute(catalogue.oracle_sql()[name])
    names = [c[0] for c in r.description]
    assert sorted(names) == cols
    want = sorted((tuple(_value(row[names.index(c)]) for c in cols) for row in r.fetchall()), key=repr)
    got = sorted((tuple(_value(row[c]) for c in cols) for row in df.collect()), key=repr)
    assert got == want


PY = "def area(width, height):\n    \"\"\"Area of a rectangle.\"\"\"\n    total = width * height\n    if total == 0:\n        return None\n    return total\n"


def saved(tmp_path):
    """Listings, ingested folders and scanner reports as they lie on a disk."""
    raw, reports = tmp_path / "raw", tmp_path / "reports"
    reports.mkdir()
    listing = []
    for i, (name, licence, leaks) in enumerate((("o/good", "MIT", []), ("o/leaky", "MIT", [{"RuleID": "key", "File": "a.py"}]), ("o/closed", "GPL-3.0-only", []), ("o/js", "MIT", []), ("p/small", "MIT", []))):
        folder = name.replace("/", "_")
        (raw / folder / "repo" / "d").mkdir(parents=True)
        (raw / folder / "repo" / "d" / "a.py").write_bytes(PY.replace("area", f"area{i}").encode() + f"\n\nx{i} = '\xff'\n".encode("latin-1"))
        (raw / folder / "repo" / "README.md").write_text(f"# {name}\nGraph tools.\n")
        (raw / folder / "provenance.json").write_text(json.dumps({"repo_full_name": name, "source": "github", "clone_url": "u", "default_branch": "main", "commit_sha": "c" * 40, "commit_date": "2024-01-01T00:00:00", "license_spdx": "MIT", "license_text": None, "scan_tool_versions": {}, "scan_timestamp": None, "semantic_score": None, "snapshot_tar": "t", "file_hashes": {"d/a.py": "h"}}))
        (reports / f"{folder}_gitleaks.json").write_text(json.dumps(leaks))
        (reports / f"{folder}_scancode.json").write_text(json.dumps({"files": [{"path": "LICENSE", "licenses": [{"spdx_license_key": licence, "matched_text": "text"}]}]}))
        listing.append({"source": "github", "repo_full_name": name, "clone_url": "u", "stars": 50 if name == "p/small" else 500 - i, "license_hint": "MIT", "description": "graph algorithm tools", "topics": ["python"], "languages": ["JavaScript" if name == "o/js" else "Python"]})
    (tmp_path / "gh.jsonl").write_text("\n".join(map(json.dumps, listing)) + "\nbroken\n")
    return raw, reports, tmp_path / "gh.jsonl"


def test_flow_from_saved_inputs(spark, tmp_path):
    raw, reports, listing = saved(tmp_path)
    out = tmp_path / "out"
    pipeline.main(["--github-listing", str(listing), "--raw-dir", str(raw), "--reports", str(reports), "--out", str(out), "--max-repos", "4"])
    m = spark.read.json(str(out / "manifest")).first()
    assert m.counts.asDict() == {"completion": 2, "debugging": 1, "documentation": 1, "refactor": 1} and m.provenance_complete and m.duplication_rate_hint == 0.0
    assert {r.repo_full_name: r.status for part in ("quarantined", "blocked") for r in spark.read.parquet(str(out / "gate" / part)).collect()} == {"o/leaky": "quarantined_secrets", "o/closed": "blocked_license"}
    lines = spark.read.text(str(out / "documentation"))
    assert validate.violations(lines, "documentation").where("size(violations) > 0").count() == 0
    doc = json.loads(lines.first().value)
    assert doc["docstring"] == "Area of a rectangle." and doc["provenance"]["repo_full_name"] == "o/good" and doc["provenance"]["file_path"] == "d/a.py" and doc["provenance"]["scan_tool_versions"]["gitleaks"] == "latest"
    prov = {json.loads(r.value)["repo_full_name"]: json.loads(r.value) for r in spark.read.text(str(out / "provenance")).collect()}
    assert prov["o/closed"]["license_spdx"] == "GPL-3.0-only" and prov["o/closed"]["license_text"] == "text" and prov["p/small"]["scan_timestamp"] is None
    # without scanners the hints decide; the options of the search and of the selection have their effect
    pipeline.main(["--github-listing", str(listing), "--raw-dir", str(raw), "--out", str(out), "--min-stars", "10", "--languages", "python,javascript", "--max-repos", "9", "--allowed-licenses", "MIT"])
    again = spark.read.json(str(out / "manifest")).first()
    assert again.counts["documentation"] == 5 - round(again.duplication_rate_hint * 5) and spark.read.parquet(str(out / "gate" / "blocked")).count() == 0
    with pytest.raises(SystemExit):
        pipeline.main(["--out", str(out)])
    assert pipeline.rebuild(["--raw-dir", str(raw), "--out", str(tmp_path / "m" / "made.json")]) == 5
    rebuilt = files.manifest(spark, str(tmp_path / "m" / "made.json"))
    assert rebuilt.count() == 5 and rebuilt.where("license_hint = 'MIT' and size(topics) = 0 and default_branch = 'main'").count() == 5


def test_whole_flow(spark, small, tmp_path):
    t = lambda n: spark.read.parquet(f"{small}/{n}.parquet")
    repos = t("repos").groupBy("repo_full_name").agg(F.min("license_hint").alias("license_hint"))
    prov = catalogue._repo_provenance(spark, small)
    row = pipeline.run(spark, repos, prov, t("source_files"), catalogue._findings(spark, small), catalogue._secret_rows(spark, small), str(tmp_path), config.Config(skip_security=True, max_repos=100)).first()
    lines = {k: spark.read.text(str(tmp_path / k)).count() for k in ("completion", "documentation", "refactor", "debugging")}
    assert {k: v for k, v in lines.items() if v} == dict(row.counts) and row.provenance_complete
    strict = pipeline.gated(repos, catalogue._findings(spark, small), catalogue._secret_rows(spark, small), config.Config())
    assert set(r.status for r in strict.collect()) <= {"ok", "blocked_license", "quarantined_secrets"}


def test_streams(spark, small, tmp_path):
    df = spark.read.parquet(f"{small}/kept_records.parquet").select("record_id", "code", "language", "accepted_ts")
    src = str(tmp_path / "in")
    df.union(df).coalesce(1).write.parquet(src)
    stream = incremental.landing(spark, src, df.schema).withColumn("ts", F.col("accepted_ts").cast("timestamp"))
    q = incremental.first_of_content(stream, "ts", "3650 days").writeStream.format("memory").queryName("firsts").start()
    q.processAllAvailable()
    q.stop()
    distinct = spark.table("firsts").select("content_hash").distinct().count()
    assert spark.table("firsts").count() == distinct > 0
    q = incremental.counts(stream, "ts").writeStream.outputMode("complete").format("memory").queryName("counted").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("counted").agg(F.sum("n")).first()[0] == 2 * df.count()
