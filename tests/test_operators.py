import subprocess

from pyspark.sql import functions as F

from loamline import config
from loamline.functions.vectors import cosine
from loamline.operators import discovery, extract, gate, mining, tasks, validate
from loamline.sources import files, git_history, sinks
from loamline.sources import search

PROV = "repo_full_name string, source string, clone_url string, default_branch string, commit_sha string, commit_date string, file_path string, lines array<int>, license_spdx string, license_text string, scan_tool_versions map<string,string>, scan_timestamp string, semantic_score double"


def units(spark, codes, docs=None, sha="abc"):
    prov = ("o/r", "github", "u", "main", sha, "d", "f.py", [1, 2], "MIT", None, {}, None, 0.5)
    rows = [("o/r", f"f{i}.py", i, i, "python", c, (docs or [None] * len(codes))[i], prov) for i, c in enumerate(codes)]
    return spark.createDataFrame(rows, f"repo_full_name string, file_path string, start_line int, record_id bigint, language string, code_norm string, docstring string, provenance struct<{PROV.replace(' ', ': ').replace(',: ', ', ')}>")


def test_completion_reassembles(spark):
    codes = ["\n".join(f"l{k}" for k in range(n)) + "\n" for n in (1, 2, 3, 4, 10, 11)] + [None, ""]
    out = tasks.completion(units(spark, codes)).select("record_id", "n_lines", "input.prefix", "output.completion", "license").collect()
    assert sorted((r.record_id, r.n_lines) for r in out) == [(1, 1), (2, 1), (3, 1), (3, 3), (4, 1), (4, 3), (5, 1), (5, 3), (5, 10)]
    for r in out:
        assert r.prefix + r.completion == codes[r.record_id] and r.license == "MIT"


def test_documentation_and_debugging(spark):
    u = units(spark, ["def f():\n  return a == b\n", "x" * 300 + "\n"], ["Doc.", " \t"], sha=None)
    d = {r.record_id: r for r in tasks.documentation(u).collect()}
    assert d[0].source == "docstring" and not d[0].synthetic
    assert d[1].docstring == "Function: " + "x" * 200 and d[1].synthetic
    b = {r.record_id: r for r in tasks.debugging(u).collect()}
    assert "a != b" in b[0].pre_snippet and "-  return a != b" in b[0].diff and b[0].provenance.pre_commit == "synthetic"
    r = {r.record_id: r for r in tasks.refactor(u).collect()}
    assert r[0].post == "def f():\n  return a == b" and r[0].refactor_type == "formatting_minimal"
    assert tasks.refactor(u.where("false")).count() == 0


def test_null_provenance(spark):
    u = units(spark, ["a\nb\n"]).withColumn("provenance", F.lit(None).cast(units(spark, []).schema["provenance"].dataType))
    assert tasks.completion(u).first().license is None
    assert tasks.debugging(u, diffs=False).first().provenance.repo_full_name == "unknown"


def test_license_vote_ties_to_the_first(spark):
    rows = [("r", 1, "GPL", ""), ("r", 2, "MIT", "text b"), ("r", 3, "MIT", "text c"), ("r", 4, "GPL", None), ("q", 1, "", "x"), ("q", 2, None, "y"), ("s", 5, "ISC", None)]
    out = {r.repo: tuple(r)[1:] for r in gate.license_vote(spark.createDataFrame(rows, "repo string, ord bigint, spdx string, matched_text string")).collect()}
    assert out == {"r": ("GPL", 2, "text b"), "s": ("ISC", 1, None)}


def test_gate_table(spark):
    rows = [("a", "MIT", None, True, False), ("b", "GPL", None, False, False), ("c", None, None, False, False), ("d", "GPL", "MIT", False, True), ("e", "MIT", "GPL", False, True), ("f", "MIT", None, False, True), ("g", None, "", None, True), ("h", "MIT", "MIT", True, True)]
    df = spark.createDataFrame(rows, "repo string, hint string, detected string, has_secrets boolean, scanned boolean")
    got = {r.repo: r.status for r in gate.gate(df, ("MIT",)).collect()}
    assert got == {"a": "ok", "b": "blocked_license_scanner_unavailable", "c": "blocked_license_scanner_unavailable", "d": "ok", "e": "blocked_license", "f": "ok", "g": "blocked_license", "h": "quarantined_secrets"}
    parts = gate.split_by_status(gate.gate(df, ("MIT",)))
    assert sum(p.count() for p in parts.values()) == len(rows)


def test_reports_of_scanners(spark):
    files_ = [("p", [("MIT", None, "t1"), (None, "ISC", "")]), ("q", None)]
    df = spark.createDataFrame([("r", files_), ("s", None)], "repo string, files array<struct<path: string, licenses: array<struct<spdx_license_key: string, key: string, matched_text: string>>>>")
    assert [(r.repo, r.spdx) for r in gate.findings_of_reports(df).orderBy("ord").collect()] == [("r", "MIT"), ("r", "ISC")]


def repos(spark, rows):
    return spark.createDataFrame(rows, "ord bigint, source string, repo_full_name string, stars int, semantic_score double, extra string")


def test_ranking(spark):
    r = repos(spark, [(1, "github", "a", 5, 0.70, "x"), (2, "gitlab", "a", 9, 0.9, "y"), (3, "github", "a", 1, 0.99, "z"), (4, "github", "b", None, None, "w"), (5, "github", "c", 9, 0.9, "v")])
    d = discovery.key_distinct(r)
    assert sorted((x.source, x.repo_full_name, x.extra) for x in d.collect()) == [("github", "a", "x"), ("github", "b", "w"), ("github", "c", "v"), ("gitlab", "a", "y")]
    assert [x.ord for x in discovery.rank(d, 0.7, 10).collect()] == [2, 5, 1]
    none = d.withColumn("semantic_score", F.lit(None).cast("double"))
    assert [x.ord for x in discovery.rank(none, 0.7, 3).collect()] == [2, 5, 1]
    assert d.where(discovery.min_stars(F.col("stars"), 5)).count() == 3 and d.where(discovery.min_stars(F.col("stars"), 0)).count() == 4
    assert sorted(x.ord for x in discovery.per_source_limit(d, 1).collect()) == [1, 2]
    assert sorted(x.extra for x in discovery.merge_sources(r.where("source = 'github'"), r).collect()) == ["v", "w", "x", "y"]
    assert discovery.rank(d.where("false"), 0.7, 3).count() == 0


def test_language_and_corpus(spark):
    df = spark.createDataFrame([(["Py", "PYTHON"], None, "a"), ([], "tools for Python", "b"), (None, None, "c")], "topics array<string>, description string, n string")
    got = df.where(discovery.names_language(("python",), F.col("topics"), F.col("description"))).select("n").collect()
    assert sorted(r.n for r in got) == ["a", "b"]
    c = df.select(discovery.corpus_text(F.col("n"), F.col("description"), F.col("topics"), F.lit("r" * 3000)).alias("c")).collect()
    assert c[2].c == "c\n\n\n" + "r" * 2000


def test_calibration(spark):
    v = spark.createDataFrame([(i, [1.0, x]) for i, x in enumerate((0.0, 0.1, 1.0, 5.0))], "id bigint, vec array<double>")
    q = spark.createDataFrame([(0, [1.0, 0.0])], "q_id bigint, q_vec array<double>")
    row = discovery.calibrate(discovery.nearest(v, q)).first()
    assert (row.threshold, row.p10) == (0.5, 0.3)
    away = spark.createDataFrame([(0, [-1.0, 0.0])], "q_id bigint, q_vec array<double>")
    assert tuple(discovery.calibrate(discovery.nearest(v, away)).first()) == (0.7, 0.0)
    assert tuple(discovery.calibrate(discovery.nearest(v.where("false"), q)).first()) == (0.7, 0.0)
    assert spark.range(1).select(cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0))).alias("c")).first().c == 0


def test_embedding_cache(spark):
    items = spark.createDataFrame([("k1",), ("k2",), (None,)], "key string")
    cache = spark.createDataFrame([("k1", 1), ("k1", 1)], "key string, value int")
    assert discovery.cache_hits(items, cache, "key").count() == 1
    assert {r.key for r in discovery.cache_misses(items, cache, "key").collect()} == {"k2", None}
    texts = spark.createDataFrame([("ab",), (None,)], "t string")
    assert [r.v for r in discovery.embed(texts, "t", "v", lambda: lambda xs: [[len(x)] for x in xs]).collect()] == [[2.0], [0.0]]
    assert discovery.embed(texts, "t", "v", None).first().v is None


def test_extraction(spark):
    code = 'import x\n\n@d\ndef f(a):\n    """Doc\n\n    more"""\n    def g():\n        return 1\n    return g\n\nclass C:\n    async def m(self):\n        return 2\n'
    df = spark.createDataFrame([("r", "a.PY", code), ("r", "b.js", code), ("r", "c.py", "def broken(:\n"), ("r", "d.py", None), ("r", "e.py", "")], "repo_full_name string, file_path string, code string")
    got = extract.extract_functions(df, 2, 400).orderBy("start_line").collect()
    assert [(x.start_line, x.end_line, x.loc, x.docstring) for x in got] == [(4, 10, 7, "Doc\n\nmore"), (8, 9, 2, None), (13, 14, 2, None)]
    assert got[0].code.startswith("def f(a):")
    assert extract.list_sources(df, ("javascript",)).count() == 1 and extract.list_sources(df, ()).count() == 0
    assert dict(extract.hash_maps(extract.file_hashes(df)).first().file_hashes).keys() == {"a.PY", "b.js", "c.py", "e.py"}
    parts = extract.hash_maps(extract.file_hashes(df), 2).collect()
    assert len(parts) <= 2 and sorted(k for r in parts for k in r.file_hashes) == ["a.PY", "b.js", "c.py", "e.py"]
    found = gate.with_reports(spark.createDataFrame([("r",), ("s",)], "repo string"), spark.createDataFrame([("r", "a"), ("r", "b"), ("r", "a"), ("t", "a")], "repo string, rule string"))
    assert {r.repo: (r.n_findings, r.findings) for r in found.collect()} == {"r": (3, {"a": 2, "b": 1}), "s": (0, {})}


def test_provenance_attach_keeps_clashing_columns(spark):
    u = spark.createDataFrame([("r", "f", 1, 3, "mine"), ("zz", "f", 1, 3, "mine")], "repo_full_name string, file_path string, start_line int, end_line int, source string")
    p = spark.createDataFrame([("r", "github", "u", "m", "s", "d", "MIT", None, {"a": "b"}, None, None)], "repo_full_name string, source string, clone_url string, default_branch string, commit_sha string, commit_date string, license_spdx string, license_text string, scan_tool_versions map<string,string>, scan_timestamp string, semantic_score double")
    out = {r.repo_full_name: r for r in extract.attach_provenance(u, p).collect()}
    assert out["r"].source == "mine" and out["r"].provenance.source == "github" and out["r"].provenance.lines == [1, 3]
    assert out["zz"].provenance is None


GOOD = '{"id":"1","task":"documentation","language":"python","license":null,"provenance":{"repo_full_name":"r","source":"github","clone_url":"u","default_branch":"m","commit_sha":"s","commit_date":"d","file_path":"f","lines":[1,2],"license_spdx":null,"license_text":null,"scan_tool_versions":{},"scan_timestamp":"t"},"code":"c","docstring":"d","source":"docstring","synthetic":false,"more":1}'


def test_violations(spark):
    bad = [GOOD, GOOD.replace('"id":"1"', '"id":5'), GOOD.replace('"id":"1",', ""), GOOD.replace('"license":null,', ""), GOOD.replace("[1,2]", "[1]"), GOOD.replace('"github"', '"other"'), GOOD.replace('"task":"documentation"', '"task":"x"'), GOOD.replace('"code":"c"', '"code":null'), "{broken", None, "5"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(bad)], "i int, value string")
    got = [r.violations for r in validate.violations(df, "documentation").orderBy("i").collect()]
    assert got[:8] == [[], ["id: type"], ["id: missing"], ["license: missing"], ["provenance.lines: length"], ["provenance.source: value"], ["task: value"], ["code: null"]]
    assert got[8] == got[9] == ["unparsable"] and "id: missing" in got[10]
    good = validate.require_valid(validate.violations(df.where("i = 0"), "documentation"))
    assert good.count() == 1
    try:
        validate.require_valid(validate.violations(df.where("i = 1"), "documentation")).collect()
        raise AssertionError
    except Exception as e:
        assert "id: type" in str(e)


def test_json_keeps_nulls_and_flow_records_are_valid(spark):
    u = units(spark, ["a\nb\nc\nd\n"], ["Doc"])
    u = u.withColumn("provenance", F.col("provenance").withField("scan_timestamp", F.lit("2025-01-31T12:00:00")))
    made = {"completion": tasks.completion(u), "documentation": tasks.documentation(u), "refactor": tasks.refactor(u), "debugging": tasks.debugging(u)}
    for name, df in made.items():
        lines = validate.as_json(df.drop("record_id", "n_lines"))
        assert validate.violations(lines, name).where("size(violations) > 0").count() == 0, name


def test_manifest(spark):
    df = spark.createDataFrame([("completion", "MIT", "python", True), ("refactor", None, "python", True), ("completion", "", "js", False)], "task string, license string, language string, ok boolean")
    rate = spark.createDataFrame([(0.25,)], "duplication_rate double")
    m = validate.manifest(df, rate, F.col("ok")).first()
    assert m.counts == {"completion": 2, "refactor": 1} and m.licenses == {"MIT": 1} and m.languages == {"js": 1, "python": 2} and not m.provenance_complete
    e = validate.manifest(df.where("false"), rate, F.col("ok")).first()
    assert e.counts == {} and e.provenance_complete


def test_mining(spark, tmp_path):
    rows = [("r", "c1", None, 3, None, "a.py"), ("r", "c2", "c1", 2, "a.py", "b.PY"), ("r", "c3", "c2", 1, "b.PY", None), ("r", "c4", "c3", 0, None, "x.js"), ("r", "c5", "", 9, None, "y.py")]
    df = spark.createDataFrame([(a, b, c, d, "me", "t", "m", e, f, "M", "diff") for a, b, c, d, e, f in rows], git_history.SCHEMA)
    out = {r.commit: r.file_path for r in mining.mine_commits(df).collect()}
    assert out == {"c2": "b.PY", "c3": "b.PY"}
    assert mining.mine_commits(df, 2).count() == 1
    git = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=t", "-c", "user.email=t@t", *a], check=True, capture_output=True)
    git("init", "-q")
    for text in ("a = 1\n", "a = 2\n"):
        (tmp_path / "m.py").write_text(text)
        git("add", ".")
        git("commit", "-qm", "change\n\nfor a reason")
    git("checkout", "-qb", "side", "HEAD~1")
    (tmp_path / "Größe \"x\".py").write_text("b = 1\n")
    git("add", ".")
    git("commit", "-qm", "more", "--date", "2001-01-01T00:00:00+0200")
    git("checkout", "-q", "-")
    git("merge", "-q", "--no-ff", "-m", "both", "side")
    git("mv", "m.py", "n.py")
    (tmp_path / "n.py").write_text("a = 2\n")
    git("rm", "-q", "Größe \"x\".py")
    git("commit", "-qm", "away")
    rows = git_history.read(spark.createDataFrame([("r", str(tmp_path)), ("none", "/nowhere")], "repo string, path string"))
    got = mining.mine_commits(rows).collect()
    seen = sorted((r.message, r.change_type, r.file_path) for r in got)
    odd = "Größe \"x\".py"
    assert seen == [("away", "D", odd), ("away", "R", "n.py"), ("both", "A", odd), ("change\n\nfor a reason", "M", "m.py"), ("more", "A", odd)]
    change = next(r for r in got if r.message.startswith("change"))
    assert change.diff == "@@ -1 +1 @@\n-a = 1\n+a = 2\n" and len(change.date) == 19 and change.author == "t"
    assert rows.where("parent is null").count() == 1


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "listing.jsonl").write_text('{"source":"github","repo_full_name":"a","stars":5,"languages":["Python"]}\n{"source":"github","repo_full_name":"a","stars":5,"languages":["Python"]}\n{"source":"github","repo_full_name":"b","stars":1,"languages":["Python","JavaScript"]}\n{"source":"gitlab","repo_full_name":"c","stars":9,"languages":["JavaScript"]}\nbroken\n{"source":"x"}\n')
    df = search.github(search.listing(spark, str(tmp_path / "listing.jsonl")), None, ("python", "javascript"), 2)
    assert [r.repo_full_name for r in df.orderBy("ord").collect()] == ["a", "c"]
    good, bad = files.json_lines(spark, str(tmp_path / "listing.jsonl"), "repo_full_name string")
    assert good.count() == 5 and [r.value for r in bad.collect()] == ["broken"]
    (tmp_path / "src" / "d").mkdir(parents=True)
    odd = ["a\xff", "\xe2\x82A\xac", "\xf0\x9f\xe2\x82\xac", "\xc0\xaf\xed\xa0\x80z", "\xef\xbf\xbd ok \xe4\xb8\xad", "\xf4\x90\x80\x80", ""]
    for i, x in enumerate(odd):
        (tmp_path / "src" / "d" / f"x({i}).py").write_bytes(x.encode("latin-1"))
    (tmp_path / "src" / "d" / "x.txt").write_bytes(b"a")
    got = {r.file_path: r.code for r in files.raw_files(spark, str(tmp_path / "src"), "*.py").collect()}
    assert got == {f"d/x({i}).py": x.encode("latin-1").decode("utf-8", "ignore") for i, x in enumerate(odd) if x}
    assert files.raw_files(spark, str(tmp_path / "src")).count() == len(odd)
    for name, text in (("r1", '{"repo_full_name":"o/a","clone_url":"u","source":"github"}'), ("r2", "{"), ("r3", '{"repo_full_name":"","clone_url":"u","source":"github"}')):
        (tmp_path / "raw" / name).mkdir(parents=True)
        (tmp_path / "raw" / name / "provenance.json").write_text(text)
    m = files.rebuild_manifest(files.provenance_folders(spark, str(tmp_path / "raw"))).collect()
    assert [(r.repo_full_name, r.default_branch) for r in m] == [("o/a", "main")]
    out = spark.createDataFrame([("x", None)], "a string, license string")
    sinks.json_lines(out, str(tmp_path / "out"))
    assert '"license":null' in spark.read.text(str(tmp_path / "out")).first().value


def test_readme_and_runs(spark):
    from loamline.functions import text as T

    repos_ = spark.createDataFrame([("a", "old"), ("b", None), (None, None)], "repo_full_name string, readme_head string")
    f = spark.createDataFrame([("a", "Readme.md", "third"), ("a", "README.md", ""), ("a", "docs/README.md", "no"), ("a", "README.rst", "x" * 3000), ("b", "README.md", None)], "repo_full_name string, file_path string, code string")
    got = {r.repo_full_name: r.readme_head for r in discovery.readme_preview(repos_, f).collect()}
    assert got == {"a": "x" * 2000, "b": "", None: ""}
    runs = spark.createDataFrame([(0, False, True), (1, None, None), (None, True, True), (None, False, True), (5, False, False)], "rc int, late boolean, tests boolean")
    assert [r.s for r in runs.select(T.run_status(F.col("rc"), F.col("late"), F.col("tests")).alias("s")).collect()] == ["ok", "fail", "timeout", "error", "skipped"]
    row = spark.range(1).select(T.iso_utc(F.lit(1738324800)).alias("t"), T.tail(F.lit("abcdef"), 3).alias("e")).first()
    assert tuple(row) == ("2025-01-31T12:00:00", "def")


def test_config(tmp_path):
    (tmp_path / "c.json").write_text('{"license": {"allowed_licenses": ["MIT", "BSD-2-Clause"]}, "dedup": {"lsh_threshold": 0.9}, "nothing": 1}')
    c = config.load(tmp_path / "c.json", allowed_licenses="MIT, ,ISC", max_loc=None)
    assert c.allowed_licenses == ("MIT", "ISC") and c.lsh_threshold == 0.9 and c.max_loc == 400
    (tmp_path / ".env").write_text("# x\nLOAMLINE_T='v'\n")
    assert config.load_env(tmp_path / ".env") == {"LOAMLINE_T": "v"} and config.load_env(tmp_path / "none") == {}


def test_searches(spark):
    rows = [
        (1, "github", "a/x", 10, "graph algorithm tools", ["Python"], None), (2, "github", "a/y", 90, "Graph ALGORITHM in python", ["Go", "Python"], None), (3, "github", "a/y", 5, "graph algorithm", ["Python"], None),
        (4, "github", "a/z", 95, "graph algorithm", ["Go"], None), (5, "github", "a/w", None, "graph algorithm", ["Python"], None), (6, "github", "a/v", 70, "web", ["Python"], None), (7, "github", "a/u", 80, "algorithm of a graph", None, None),
    ]
    t = spark.createDataFrame([(*r[:5], [], *r[5:]) for r in rows], "ord bigint, source string, repo_full_name string, stars int, description string, topics array<string>, languages array<string>, license struct<spdx_id: string, key: string, name: string>")
    t = t.withColumns({"default_branch": F.lit(None).cast("string"), "readme_head": F.lit(None).cast("string"), "license_hint": F.lit("hint")})
    names = lambda df: [r.repo_full_name for r in df.orderBy("ord").collect()]
    assert names(search.github(t, "graph algorithm", ("python", "go"), 0, 10)) == ["a/y", "a/x", "a/w", "a/z"]
    assert names(search.github(t, "graph algorithm", ("go", "python"), 6, 3)) == ["a/z", "a/y", "a/x"]
    assert names(search.github(t, "", (), 0, 10)) == ["a/z", "a/y", "a/u", "a/v", "a/x", "a/w"] and search.github(t, None, (), 0, 10).where("default_branch = 'main'").count() == 6
    lab = t.withColumn("languages", F.when(F.col("repo_full_name") == "a/y", None).otherwise(F.col("languages"))).withColumn("license", F.when(F.col("ord") == 1, F.struct(F.lit("").alias("spdx_id"), F.lit("mit").alias("key"), F.lit("MIT License").alias("name"))))
    got = search.gitlab(lab, "graph", ("python",), 6, 10)
    assert names(got) == ["a/x", "a/y"] and [r.license_hint for r in got.orderBy("ord").collect()] == ["mit", "hint"]
    assert names(search.gitlab(t, "", ("python",), 0, 2)) == ["a/x", "a/y"] and search.gitlab(t.where("false"), "", (), 0, 2).count() == 0


def test_discovery_with_an_encoder(spark):
    t = spark.createDataFrame([(1, "github", "a/x", 1, "graphs", [], ["Python"]), (2, "github", "a/y", 9, "web", [], ["Python"])], "ord bigint, source string, repo_full_name string, stars int, description string, topics array<string>, languages array<string>")
    t = t.withColumns({c: F.lit(None).cast("string") for c in ("default_branch", "readme_head", "license_hint")})
    encoder = lambda: lambda texts: [[float("graph" in x), float("web" in x)] for x in texts]
    found = discovery.discover({"github": t}, "", ("python",), 0, 10, 0.7, 5, None, encoder, "graph algorithms")
    assert [(r.repo_full_name, round(r.semantic_score, 3)) for r in found.collect()] == [("a/x", 1.0)]
    assert [r.repo_full_name for r in discovery.discover({"github": t}, "", ("python",), 0, 10, 0.7, 5).collect()] == ["a/y", "a/x"]


def test_nearest_equals_brute_force(spark, monkeypatch):
    import numpy as np

    r = np.random.default_rng(3)
    m = r.integers(-2, 3, (400, 3)).astype(float)  # many ties, some zero vectors
    v = spark.createDataFrame([(int(i), m[i].tolist()) for i in range(400)] + [(999, None)], "id bigint, vec array<double>").repartition(5)
    q = v.where("id % 20 = 0").select(F.col("id").alias("q_id"), F.col("vec").alias("q_vec"))
    unit = m / (np.linalg.norm(m, axis=1, keepdims=True) + 1e-8)
    sims = np.round(unit @ unit.T, 12)
    want = {(i, int(j)) for i in range(0, 400, 20) for j in sorted(range(400), key=lambda j: (-sims[i, j], j))[:7]}
    for few in (32 << 20, 0):
        monkeypatch.setattr(discovery, "FEW_BYTES", few)
        monkeypatch.setattr(discovery, "BLOCK", 6)
        assert {(x.q_id, x.id) for x in discovery.nearest(v, q, 7).collect()} == want
        assert {x.q_id: x.n for x in discovery.count_near(v, q, 0.5).collect()} == {i: n for i in range(0, 400, 20) if (n := int((sims[i] >= 0.5).sum() - (sims[i, i] >= 0.5)))}


def test_schemas(spark, tmp_path):
    line = '{"id":"1","task":"debugging","language":"x","license":null,"provenance":{"pre_commit":"a","post_commit":"b","repo_full_name":"r"},"pre_snippet":"","post_snippet":"","diff":"","failing_tests":["a",5],"stack_trace":[],"synthetic":true}'
    df = spark.createDataFrame([(line,), (line.replace(",5", ""),), (GOOD.replace('"scan_timestamp":"t"', '"scan_timestamp":null').replace("[1,2]", '[1,"2",3]'),)], "value string")
    got = [r.violations for r in validate.violations(df, "debugging").collect()]
    assert got[0] == ["failing_tests: items"] and got[1] == []
    assert validate.violations(df, "documentation").collect()[2].violations == ["provenance.lines: length", "provenance.scan_timestamp: null"]
    (tmp_path / "thing.schema.json").write_text('{"type":"object","required":["a","p"],"properties":{"a":{"type":["integer","null"]},"b":{"enum":["x"]},"p":{"$ref":"part.schema.json"}}}')
    (tmp_path / "part.schema.json").write_text('{"type":"object","required":["n"],"properties":{"n":{"type":"number"}}}')
    known = validate.load_schemas(tmp_path)
    lines = spark.createDataFrame([('{"a":null,"b":"x","p":{"n":1.5}}',), ('{"a":"1","b":"y","p":{}}',), ('{"p":null}',)], "value string")
    assert [r.violations for r in validate.violations(lines, "thing", known=known).collect()] == [[], ["a: type", "b: value", "p.n: missing"], ["a: missing", "p: null", "p.n: missing"]]


def test_shared_folder(spark):
    from loamline.functions import store

    class Cluster:
        class conf:
            get = staticmethod(lambda k, d=None: d)

        class sparkContext:
            master = "spark://somewhere:7077"

    try:
        store.shared_dir(Cluster)
        raise AssertionError
    except RuntimeError as e:
        assert "spark.checkpoint.dir" in str(e)
    path = store.shared_dir(spark)
    store.written(spark.range(3), path + "/x")
    assert store.release(spark) > 0 and not store._made
    try:
        spark.read.parquet(path + "/x")
        raise AssertionError
    except Exception as e:
        assert "PATH_NOT_FOUND" in str(e)


def test_provenance_update(spark):
    p = spark.createDataFrame([("r", "MIT", None, {"a": "b"}, None), ("s", None, None, None, None)], "repo_full_name string, license_spdx string, license_text string, scan_tool_versions map<string,string>, scan_timestamp string")
    g = spark.createDataFrame([("r", "ISC", "text")], "repo string, license string, matched_text string")
    got = {r.repo_full_name: r for r in gate.update_provenance(p, g, "now").collect()}
    assert (got["r"].license_spdx, got["r"].license_text, got["r"].scan_timestamp, got["r"].scan_tool_versions["bandit"]) == ("ISC", "text", "now", "latest") and got["s"].scan_timestamp is None
    got = {r.repo_full_name: r for r in gate.update_provenance(p, g, "now", True).collect()}
    assert got["r"].scan_tool_versions == {"a": "b"} and got["s"].scan_tool_versions == {"security": "skipped"} and got["s"].scan_timestamp == "now"
    assert gate.ingested(spark.createDataFrame([("a", "ok"), ("b", "error"), ("c", None)], "r string, status string")).count() == 1


def test_large_repositories_are_spread_over_files(spark, tmp_path):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("r"), F.col("id") % 4)).alias("repo_full_name"), "id")
    sinks.by_repository(df, str(tmp_path / "out"), rows_per_file=500)
    n = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "out").iterdir() if p.is_dir()}
    assert 3 <= n["repo_full_name=big"] <= 5 and all(k <= 3 for r, k in n.items() if "big" not in r) and spark.read.parquet(str(tmp_path / "out")).count() == 4000
