"""The query catalogue: name -> (spark, directory) -> DataFrame, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.functions import text as T
from loamline.functions.diff import patched
from loamline.functions.store import shared_dir, spread, written
from loamline.operators import dedup, discovery, extract, gate, mining, tasks, validate
from loamline.sources import files, search, sinks
from loamline.streaming import incremental

ALLOWED = ("MIT", "Apache-2.0", "BSD-3-Clause")
SHINGLE, NEAR = 5, 0.8
_Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _Q[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---- SQL fragments

_WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WSN = r"[\x09\x0b-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_LE = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def _strip(c: str) -> str:
    return rf"regexp_replace(regexp_replace({c}, '^{_WS}+', ''), '{_WS}+$', '')"


def _norm(c: str) -> str:
    inner = rf"regexp_replace(regexp_replace(regexp_replace({c}, '{_LE}', chr(10), 'g'), '{_WSN}+(\n|\z)', '\1', 'g'), '\n{{3,}}', chr(10)||chr(10), 'g')"
    return f"{_strip(inner)} || chr(10)"


def _tokens(c: str) -> str:
    return rf"list_filter(regexp_split_to_array({c}, '{_WS}+'), lambda t: t <> '')"


def _lines(c: str) -> str:
    s = rf"regexp_replace(regexp_replace({c}, '^\n+', ''), '\n+$', '')"
    return rf"(CASE WHEN {s} = '' THEN [] ELSE regexp_split_to_array({s}, '{_LE}') END)"


def _shingle_set(c: str) -> str:
    t = _tokens(c)
    return f"list_distinct(list_transform(range(1, greatest(len({t}) - {SHINGLE - 2}, 1)), lambda i: array_to_string(({t})[i:i + {SHINGLE - 1}], ' ')))"


_UNITS = "SELECT * FROM kept_records"
_EXACT = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sha256(code_norm) ORDER BY repo_full_name NULLS FIRST, file_path NULLS FIRST, start_line NULLS FIRST, record_id) AS rn FROM kept_records) WHERE rn = 1 OR code_norm IS NULL"
_ALLOWED_SQL = "('MIT', 'Apache-2.0', 'BSD-3-Clause')"


def _units(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "kept_records")


def _reps(spark: SparkSession, d: str) -> DataFrame:
    """(id, text): the first record of each text."""
    u = _units(spark, d).select(F.col("record_id").alias("id"), F.col("code_norm").alias("text")).where("text is not null")
    return dedup.keep_first(u.withColumn("h", T.content_hash("text")), "h", "id").select("id", "text")


_REPS_SQL = "SELECT min(record_id) AS id, code_norm AS text FROM kept_records WHERE code_norm IS NOT NULL GROUP BY code_norm"
_PAIRS_SQL = f"""
 reps AS ({_REPS_SQL}),
 sh AS (SELECT id, {_shingle_set('text')} AS s FROM reps),
 one AS (SELECT id, len(s) AS n, unnest(s) AS g FROM sh),
 pairs AS (SELECT x.id AS a, y.id AS b, count(*) AS c, any_value(x.n) AS na, any_value(y.n) AS nb FROM one x JOIN one y ON x.g = y.g AND x.id < y.id GROUP BY x.id, y.id),
 near AS (SELECT a, b, c / (na + nb - c) AS jaccard FROM pairs WHERE c / (na + nb - c) >= {NEAR})"""

# ---- text


@query(f"SELECT record_id, CASE WHEN language = 'python' THEN {_norm('code')} ELSE code END AS normalized FROM kept_records")
def normalize_code(spark, d):
    norm = F.when(F.col("language") == "python", T.normalize_code(F.col("code"))).otherwise(F.col("code"))
    return _units(spark, d).select("record_id", norm.alias("normalized"))


@query("SELECT doc_id, right(text, 20000) AS tail, len(text) AS n FROM documents WHERE text IS NOT NULL")
def text_tail(spark, d):
    return _t(spark, d, "documents").where("text is not null").select("doc_id", T.tail(F.col("text")).alias("tail"), F.length("text").cast("bigint").alias("n"))


@query("SELECT prov_id, replace(repo_full_name, '/', '_') || '_' || substr(commit_sha, 1, 12) AS mangled, list_last(string_split(file_path, '/')) AS base, coalesce(nullif(default_branch, ''), 'main') AS branch FROM provenance")
def provenance_names(spark, d):
    return _t(spark, d, "provenance").select("prov_id", T.mangle_repo(F.col("repo_full_name"), F.col("commit_sha")).alias("mangled"), T.basename(F.col("file_path")).alias("base"), T.or_default(F.col("default_branch"), "main").alias("branch"))


@query("SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS iso FROM events")
def iso_times(spark, d):
    return _t(spark, d, "events").select("event_id", T.iso_utc(F.floor(F.unix_micros(F.to_utc_timestamp(F.col("ts").cast("timestamp"), "UTC")) / 1_000_000)).alias("iso"))


@query("SELECT record_id, substr(sha256(concat_ws(chr(31), 'refactor', coalesce(repo_full_name, chr(0)), coalesce(file_path, chr(0)), coalesce(CAST(start_line AS VARCHAR), chr(0)), CAST(record_id AS VARCHAR))), 1, 32) AS id FROM kept_records")
def record_ids(spark, d):
    return tasks.refactor(_units(spark, d), diffs=False).select("record_id", "id")


@query("SELECT record_id, sha256(code_norm) AS content_hash FROM kept_records")
def content_hash(spark, d):
    return _units(spark, d).select("record_id", T.content_hash("code_norm").alias("content_hash"))


@query("SELECT DISTINCT repo_full_name, file_path, sha256(code) AS sha256 FROM source_files WHERE code IS NOT NULL")
def file_hashes(spark, d):
    return extract.file_hashes(_t(spark, d, "source_files"))


@query(f"SELECT record_id, len({_tokens('code_norm')}) AS n_tokens, len({_shingle_set('code_norm')}) AS n_shingles FROM kept_records WHERE code_norm IS NOT NULL")
def shingle_counts(spark, d):
    t = T.tokens(F.col("code_norm"))
    return _units(spark, d).where("code_norm is not null").select("record_id", F.size(t).cast("bigint").alias("n_tokens"), F.size(T.shingles(t, SHINGLE)).cast("bigint").alias("n_shingles"))


@query("SELECT file_id, file_path FROM source_files WHERE regexp_matches(lower(file_path), '\\.(py|js|jsx|ts|tsx)$')")
def source_listing(spark, d):
    return extract.list_sources(_t(spark, d, "source_files"), ("python", "javascript")).select("file_id", "file_path")


@query("SELECT record_id, loc FROM kept_records WHERE loc BETWEEN 5 AND 400")
def loc_filter(spark, d):
    return _units(spark, d).where(extract.loc_between(5, 400)).select("record_id", "loc")


@query()
def extract_functions(spark, d):
    return extract.extract_functions(spread(_t(spark, d, "source_files")))


# ---- duplicates


@query(f"SELECT record_id, sha256(code_norm) AS content_hash FROM ({_EXACT})")
def exact_dedup(spark, d):
    return dedup.exact_dedup(_units(spark, d)).select("record_id", "content_hash")


@query(f"WITH {_PAIRS_SQL} SELECT a, b, round(jaccard, 6) AS jaccard FROM near")
def near_dup_pairs(spark, d):
    return dedup.near_pairs(_reps(spark, d), SHINGLE, NEAR).withColumn("jaccard", F.round("jaccard", 6))


@query(f"SELECT k.record_id, r.id AS rep FROM kept_records k JOIN ({_REPS_SQL}) r ON k.code_norm = r.text UNION ALL SELECT record_id, record_id FROM kept_records WHERE code_norm IS NULL")
def near_dup_members(spark, d):
    u = _units(spark, d).select(F.col("record_id").alias("id"), F.col("code_norm").alias("text"))
    return dedup.representatives(u).select(F.col("id").alias("record_id"), "rep")


def _keep_sql(rounds: int = 12) -> str:
    parts = [_PAIRS_SQL, " e0 AS MATERIALIZED (SELECT a, b FROM near)", " d0 AS (SELECT CAST(NULL AS BIGINT) AS id WHERE false)"]
    for i in range(1, rounds + 1):
        p = i - 1
        parts.append(f" k{i} AS MATERIALIZED (SELECT DISTINCT a FROM e{p} WHERE a NOT IN (SELECT b FROM e{p}))")
        parts.append(f" d{i} AS MATERIALIZED (SELECT DISTINCT b AS id FROM e{p} WHERE a IN (SELECT a FROM k{i}))")
        parts.append(f" e{i} AS MATERIALIZED (SELECT a, b FROM e{p} WHERE a NOT IN (SELECT a FROM k{i}) AND a NOT IN (SELECT id FROM d{i}) AND b NOT IN (SELECT id FROM d{i}))")
    dropped = " UNION ALL ".join(f"SELECT id FROM d{i}" for i in range(1, rounds + 1))
    return "WITH " + ",".join(parts) + f" SELECT id FROM reps WHERE id NOT IN ({dropped})"


@query(_keep_sql())
def near_dup_keep(spark, d):
    reps = written(_reps(spark, d), f"{shared_dir(spark)}/reps")
    return dedup.greedy_keep(reps, dedup.near_pairs(reps, SHINGLE, NEAR))


@query(f"WITH {_PAIRS_SQL} SELECT count(*) AS near, count(*) AS among_candidates FROM near")
def lsh_recall(spark, d):
    """Of the pairs of near texts, all of them, those that the index names as candidates."""
    reps = written(_reps(spark, d), f"{shared_dir(spark)}/reps")
    near, cand = dedup.near_pairs(reps, SHINGLE, NEAR), dedup.lsh_candidates(reps, SHINGLE, NEAR, sure=True).withColumn("c", F.lit(1))
    return near.join(cand, ["a", "b"], "left").agg(F.count("*").alias("near"), F.count("c").alias("among_candidates"))


@query()
def lsh_candidates(spark, d):
    return dedup.lsh_candidates(_reps(spark, d), SHINGLE, NEAR)


@query(f"WITH u AS (SELECT count(*) AS total, count(DISTINCT sha256(code_norm)) AS exact_unique FROM kept_records), n AS (SELECT count(*) AS near_unique FROM ({_keep_sql()})) SELECT total, exact_unique, near_unique, round(1 - near_unique / greatest(total, 1), 6) AS duplication_rate FROM u, n")
def dedup_stats(spark, d):
    return dedup.stats(_units(spark, d), near_dup_keep(spark, d))


# ---- tasks

_CUT = f"(SELECT *, {_lines('code_norm')} AS ls FROM kept_records)"


@query(
    f"SELECT record_id, n_lines, coalesce(language, CASE WHEN lower(file_path) LIKE '%.py' THEN 'python' ELSE 'unknown' END) AS language, provenance.license_spdx AS license, array_to_string(ls[1:len(ls) - n_lines], chr(10)) || chr(10) AS prefix, array_to_string(ls[len(ls) - n_lines + 1:], chr(10)) || chr(10) AS completion FROM (SELECT *, unnest([1, 3, 10]) AS n_lines FROM {_CUT}) WHERE len(ls) > n_lines"
)
def completion(spark, d):
    return tasks.completion(_units(spark, d)).select("record_id", "n_lines", "language", "license", F.col("input.prefix").alias("prefix"), F.col("output.completion").alias("completion"))


_BLANK = f"coalesce({_strip('docstring')} = '', true)"


@query(f"SELECT record_id, code_norm AS code, CASE WHEN {_BLANK} THEN 'Function: ' || substr(split_part(code_norm, chr(10), 1), 1, 200) ELSE docstring END AS docstring, CASE WHEN {_BLANK} THEN 'heuristic' ELSE 'docstring' END AS source, {_BLANK} AS synthetic FROM kept_records")
def documentation(spark, d):
    return tasks.documentation(_units(spark, d)).select("record_id", "code", "docstring", "source", "synthetic")


_ALL_LINES = f"(CASE WHEN code_norm = '' THEN [] WHEN regexp_matches(code_norm, '({_LE})$') THEN list_slice(regexp_split_to_array(code_norm, '{_LE}'), 1, -2) ELSE regexp_split_to_array(code_norm, '{_LE}') END)"
_MINIMAL = f"array_to_string(list_transform(list_filter(range(1, len(ls) + 1), lambda i: {_strip('ls[i]')} <> '' OR i = 1 OR {_strip('ls[i - 1]')} <> ''), lambda i: ls[i]), chr(10))"


@query(f"SELECT record_id, code_norm AS pre, CASE WHEN {_MINIMAL} = '' THEN code_norm ELSE {_MINIMAL} END AS post FROM (SELECT *, {_ALL_LINES} AS ls FROM kept_records)")
def refactor_minimal(spark, d):
    return tasks.refactor(_units(spark, d), diffs=False, formatter="minimal").select("record_id", "pre", "post")


_RULE = "CASE " + " ".join(f"WHEN instr(code_norm, '{old}') > 0 THEN '{old.strip()}->{new.strip()}'" for old, new in T.BUG_RULES) + " WHEN code_norm IS NOT NULL THEN 'marker' END"


@query(f"SELECT {_RULE} AS rule, count(*) AS n FROM kept_records GROUP BY 1")
def bug_rules(spark, d):
    return _units(spark, d).groupBy(T.bug_rule(F.col("code_norm")).alias("rule")).agg(F.count("*").alias("n"))


@query(f"SELECT record_id, sha256(CASE WHEN {_MINIMAL} = '' THEN code_norm ELSE {_MINIMAL} END) AS patched, 'formatting_minimal' AS refactor_type, false AS verified, true AS synthetic FROM (SELECT *, {_ALL_LINES} AS ls FROM kept_records)")
def refactor(spark, d):
    """The diffs, each applied to the state before it: what comes out is the state after."""
    r = tasks.refactor(spread(_units(spark, d)), formatter="minimal")
    return r.select("record_id", F.sha2(patched(F.col("pre"), F.col("diff")), 256).alias("patched"), "refactor_type", "verified", "synthetic")


def _bug_sql() -> str:
    out = "code_norm || chr(10) || '# FIXME: synthetic bug marker' || chr(10)"
    for old, new in reversed(T.BUG_RULES):
        out = f"CASE WHEN instr(code_norm, '{old}') > 0 THEN substr(code_norm, 1, instr(code_norm, '{old}') - 1) || '{new}' || substr(code_norm, instr(code_norm, '{old}') + {len(old)}) ELSE {out} END"
    return out


@query(f"SELECT record_id, {_bug_sql()} AS pre_snippet, code_norm AS post_snippet, coalesce(nullif(provenance.commit_sha, ''), 'synthetic') AS pre_commit FROM kept_records")
def debugging_mutation(spark, d):
    return tasks.debugging(_units(spark, d), diffs=False).select("record_id", "pre_snippet", "post_snippet", F.col("provenance.pre_commit").alias("pre_commit"))


def _diff_sql() -> str:
    """The diff from a mutated text to the text, stated for the two ways in which they can differ: one line, or the marker at the end."""
    ends = _LE.removeprefix(r"\r\n|")
    keep = rf"regexp_extract_all(§, '[^{ends[1:-1]}]*(?:{_LE})|[^{ends[1:-1]}]+')"
    hit = "CASE " + " ".join(f"WHEN instr(code_norm, '{old}') > 0 THEN instr(code_norm, '{old}')" for old, _ in T.BUG_RULES) + " ELSE 0 END"
    context = lambda lo, hi: f"coalesce(array_to_string(list_transform(ls[{lo}:{hi}], lambda x: ' ' || x), ''), '')"
    span = lambda lo, n: f"CASE WHEN {n} = 1 THEN CAST({lo} AS VARCHAR) WHEN {n} = 0 THEN CAST({lo} - 1 AS VARCHAR) || ',0' ELSE {lo} || ',' || {n} END"
    line = f"'@@ -' || {span('lo', 'hi - lo + 1')} || ' +' || {span('lo', 'hi - lo + 1')} || ' @@' || chr(10) || {context('lo', 'k - 1')} || '-' || pre[k] || '+' || ls[k] || {context('k + 1', 'hi')}"
    whole = f"'@@ -' || {span('m', 'n - m + 3')} || ' +' || {span('m', 'n - m + 1')} || ' @@' || chr(10) || {context('m', 'n')} || '-' || pre[n + 1] || '-' || pre[n + 2]"
    cut = f"'@@ -' || {span('c', 'n - c + 2')} || ' +' || {span('c', 'n - c + 1')} || ' @@' || chr(10) || {context('c', 'n - 1')} || '-' || pre[n] || '-' || pre[n + 1] || '+' || ls[n]"
    return f"""SELECT record_id, '--- a/' || name || chr(10) || '+++ b/' || name || chr(10) || CASE WHEN place > 0 THEN {line} WHEN n = 0 OR regexp_matches(code_norm, '({_LE})$') THEN {whole} ELSE {cut} END AS diff, 0 AS failing_tests, 0 AS stack_trace
 FROM (SELECT *, greatest(1, k - 3) AS lo, least(n, k + 3) AS hi, greatest(1, n - 2) AS m, greatest(1, n - 3) AS c FROM (
  SELECT *, len(ls) AS n, len(regexp_extract_all(substr(code_norm, 1, greatest(place - 1, 0)), '({_LE})')) + 1 AS k FROM (
   SELECT record_id, code_norm, coalesce(nullif(list_last(string_split(file_path, '/')), ''), 'code.py') AS name, {keep.replace('§', 'code_norm')} AS ls, {keep.replace('§', _bug_sql())} AS pre, {hit} AS place FROM kept_records)))"""


@query(_diff_sql())
def debugging(spark, d):
    return tasks.debugging(spread(_units(spark, d))).select("record_id", "diff", F.size("failing_tests").alias("failing_tests"), F.size("stack_trace").alias("stack_trace"))


# ---- manifest


def _records(spark, d):
    """What the four tasks give, as far as the manifest needs it."""
    u = _units(spark, d)
    null = F.lit(None).cast("string").alias("license")
    parts = [
        tasks.completion(u).select("task", "license", "language", F.col("provenance").isNotNull().alias("ok")),
        tasks.documentation(u).select("task", "license", "language", F.col("provenance").isNotNull().alias("ok")),
        tasks.refactor(u, diffs=False).select("task", null, "language", F.col("provenance").isNotNull().alias("ok")),
        tasks.debugging(u, diffs=False).select("task", "license", "language", F.col("provenance").isNotNull().alias("ok")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_LANG = "coalesce(language, CASE WHEN lower(file_path) LIKE '%.py' THEN 'python' ELSE 'unknown' END)"
_RECORDS_SQL = f"""(SELECT 'completion' AS task, provenance.license_spdx AS license, {_LANG} AS language FROM (SELECT *, unnest([1, 3, 10]) AS n FROM {_CUT}) WHERE len(ls) > n
 UNION ALL SELECT unnest(['documentation', 'debugging']), provenance.license_spdx, {_LANG} FROM kept_records
 UNION ALL SELECT 'refactor', NULL, {_LANG} FROM kept_records)"""


@query(f"SELECT task, count(*) AS n FROM {_RECORDS_SQL} GROUP BY task")
def manifest_counts_task(spark, d):
    return validate.count_by(_records(spark, d), "task")


@query(f"SELECT license, count(*) AS n FROM {_RECORDS_SQL} WHERE license <> '' GROUP BY license")
def manifest_counts_license(spark, d):
    return validate.count_by(_records(spark, d), "license")


@query(f"SELECT language, count(*) AS n FROM {_RECORDS_SQL} WHERE language <> '' GROUP BY language")
def manifest_counts_language(spark, d):
    return validate.count_by(_records(spark, d), "language")


def _map_sql(column: str) -> str:
    return f"(SELECT string_agg({column} || '=' || n, '; ' ORDER BY {column}) FROM (SELECT {column}, count(*) AS n FROM {_RECORDS_SQL} WHERE {column} <> '' GROUP BY 1))"


@query(
    f"""WITH n AS (SELECT count(*) AS near_unique FROM ({_keep_sql()})), u AS (SELECT count(*) AS total FROM kept_records)
 SELECT {_map_sql('task')} AS counts, {_map_sql('license')} AS licenses, {_map_sql('language')} AS languages, round(1 - near_unique / greatest(total, 1), 6) AS duplication_rate_hint, (SELECT bool_and(provenance IS NOT NULL) FROM kept_records) AS provenance_complete FROM n, u"""
)
def dataset_manifest(spark, d):
    m = validate.manifest(_records(spark, d), dedup_stats(spark, d), F.col("ok"))
    text = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), "; ").alias(c)
    return m.select(text("counts"), text("licenses"), text("languages"), "duplication_rate_hint", "provenance_complete")


_V = {
    "id": "CASE WHEN id IS NULL THEN 'id: null' END",
    "task": "CASE WHEN task IS NULL THEN 'task: null' WHEN task <> 'documentation' THEN 'task: value' END",
    "language": "CASE WHEN language IS NULL THEN 'language: null' END",
    "code": "CASE WHEN code IS NULL THEN 'code: null' END",
    "docstring": "CASE WHEN docstring IS NULL THEN 'docstring: null' END",
    "source": "CASE WHEN source IS NULL THEN 'source: null' END",
    "synthetic": "CASE WHEN synthetic IS NULL THEN 'synthetic: null' END",
}


def _field(c: str, extra: str = "", nullable: bool = False) -> str:
    """What a field of the provenance struct p breaks; a struct that is null has none of its fields."""
    null = "" if nullable else f"WHEN p.{c} IS NULL THEN 'provenance.{c}: null' "
    return f"CASE WHEN p IS NULL THEN 'provenance.{c}: missing' {null}{extra} END"


_PROVENANCE_FIELDS = [
    _field("repo_full_name"), _field("source", "WHEN p.source NOT IN ('github', 'gitlab') THEN 'provenance.source: value'"), _field("clone_url"), _field("default_branch"), _field("commit_sha"), _field("commit_date"), _field("file_path"),
    _field("lines", "WHEN len(p.lines) <> 2 THEN 'provenance.lines: length' WHEN len(list_filter(p.lines, lambda x: x IS NULL)) > 0 THEN 'provenance.lines: items'"),
    _field("license_spdx", nullable=True), _field("license_text", nullable=True), _field("scan_tool_versions"), _field("scan_timestamp"),
]
_IS_PROVENANCE = "CASE WHEN p IS NULL THEN 'provenance: null' END"
_DOCUMENTATION_FIELDS = [_V[k] for k in ("id", "task", "language")] + [_IS_PROVENANCE, *_PROVENANCE_FIELDS] + [_V[k] for k in ("code", "docstring", "source", "synthetic")]


def _broken(fields: list[str]) -> str:
    return f"array_to_string(list_filter([{', '.join(fields)}], lambda x: x IS NOT NULL), '; ')"


@query(f"SELECT rec_id, {_broken(_DOCUMENTATION_FIELDS)} AS violations FROM (SELECT *, provenance AS p FROM documentation)")
def schema_violations(spark, d):
    docs = _t(spark, d, "documentation")
    lines = docs.select("rec_id", F.to_json(F.struct(*[c for c in docs.columns if c != "rec_id"]), {"ignoreNullFields": "false"}).alias("value"))
    return validate.violations(lines, "documentation").select("rec_id", F.array_join("violations", "; ").alias("violations"))


@query(
    f"""WITH b AS (SELECT record_id, {_broken([_IS_PROVENANCE, *_PROVENANCE_FIELDS])} AS violations FROM (SELECT record_id, provenance AS p FROM kept_records WHERE code_norm IS NOT NULL)),
 c AS (SELECT record_id FROM (SELECT record_id, ls, unnest([1, 3, 10]) AS n FROM {_CUT}) WHERE len(ls) > n)
 SELECT task, violations, count(*) AS n FROM (SELECT unnest(['documentation', 'refactor']) AS task, violations FROM b UNION ALL SELECT 'completion', violations FROM b JOIN c USING (record_id) UNION ALL SELECT 'debugging', '' FROM b) GROUP BY 1, 2"""
)
def schema_violations_tasks(spark, d):
    """What the records of the four tasks break, made from all kept records."""
    u = _units(spark, d).where("code_norm is not null")
    made = {"completion": tasks.completion(u), "documentation": tasks.documentation(u), "refactor": tasks.refactor(u), "debugging": tasks.debugging(u)}
    out = None
    for name, df in made.items():
        checked = validate.violations(validate.as_json(df.drop("record_id", "n_lines")), name)
        rows = checked.select(F.lit(name).alias("task"), F.array_join("violations", "; ").alias("violations"))
        out = rows if out is None else out.union(rows)
    return out.groupBy("task", "violations").agg(F.count("*").alias("n"))


# ---- readers and writers: what is written is read back


@query("SELECT rec_id, id, task, language, license, code, docstring, source, synthetic FROM documentation")
def json_lines_round_trip(spark, d):
    path = f"{shared_dir(spark)}/lines"
    cols = "rec_id bigint, id string, task string, language string, license string, code string, docstring string, source string, synthetic boolean"
    sinks.json_lines(_t(spark, d, "documentation").select(*[c.split()[0] for c in cols.split(", ")]), path)
    return files.json_lines(spark, path, cols)[0]


@query("SELECT source, repo_full_name, clone_url, stars, license_hint, description, array_to_string(coalesce(topics, []), ',') AS topics, coalesce(readme_head, '') AS readme_head, semantic_score, fetch_timestamp FROM repos")
def manifest_round_trip(spark, d):
    path = f"{shared_dir(spark)}/manifest"
    sinks.json_lines(_t(spark, d, "repos"), path)
    m = files.manifest(spark, path)
    return m.select("source", "repo_full_name", "clone_url", "stars", "license_hint", "description", F.array_join("topics", ",").alias("topics"), "readme_head", "semantic_score", "fetch_timestamp")


@query("SELECT repo_full_name, file_path, start_line, loc, code FROM kept_records WHERE repo_full_name IS NOT NULL")
def functions_by_repository(spark, d):
    path = f"{shared_dir(spark)}/functions"
    sinks.by_repository(_units(spark, d).where("repo_full_name is not null").select("repo_full_name", "file_path", "start_line", "loc", "code"), path)
    return spark.read.parquet(path).select("repo_full_name", "file_path", "start_line", "loc", "code")


# ---- gate


def _findings(spark, d):
    p = _t(spark, d, "provenance")
    return p.select(F.col("repo_full_name").alias("repo"), F.col("prov_id").alias("ord"), F.trim("license_spdx").alias("spdx"), F.col("license_text").alias("matched_text"))


_FINDINGS = "(SELECT repo_full_name AS repo, prov_id AS ord, trim(license_spdx, ' ') AS spdx, license_text AS matched_text FROM provenance)"
_VOTE = f"""(SELECT repo, spdx AS license, n AS votes, (SELECT arg_min(f.matched_text, f.ord) FROM {_FINDINGS} f WHERE f.repo = v.repo AND f.spdx <> '' AND f.matched_text <> '') AS matched_text
 FROM (SELECT repo, spdx, count(*) AS n, row_number() OVER (PARTITION BY repo ORDER BY count(*) DESC, min(ord)) AS rn FROM {_FINDINGS} WHERE spdx <> '' GROUP BY repo, spdx) v WHERE rn = 1)"""


@query(f"SELECT * FROM {_VOTE}")
def license_vote(spark, d):
    return gate.license_vote(_findings(spark, d))


def _secret_rows(spark, d):
    u = _units(spark, d).select(F.col("repo_full_name").alias("repo"), "record_id", "code")
    return gate.secret_findings(u, "code", "repo", "record_id")


_SECRETS = " UNION ALL ".join("SELECT repo_full_name AS repo, record_id, '{}' AS rule FROM kept_records WHERE regexp_matches(code, '{}')".format(n, p.replace("'", "''")) for n, p in gate.SECRET_RULES)


@query(_SECRETS)
def secret_scan(spark, d):
    return _secret_rows(spark, d)


def _gated(spark, d):
    r = _t(spark, d, "repos").groupBy("repo_full_name").agg(F.min("license_hint").alias("hint")).withColumnRenamed("repo_full_name", "repo")
    vote = gate.license_vote(_findings(spark, d)).select("repo", F.col("license").alias("detected"), F.lit(True).alias("scan"))
    bad = _secret_rows(spark, d).groupBy("repo").agg(F.lit(True).alias("has_secrets"))
    j = r.join(vote, "repo", "left").join(bad, "repo", "left").withColumn("scanned", F.coalesce("scan", F.lit(False)))
    return gate.gate(j, ALLOWED)


_GATE = f"""(SELECT repo, CASE WHEN scanned THEN coalesce(nullif(detected, ''), nullif(hint, '')) ELSE nullif(hint, '') END AS license, scanned, sec FROM (
 SELECT r.repo, r.hint, v.license AS detected, v.repo IS NOT NULL AS scanned, s.repo IS NOT NULL AS sec FROM (SELECT repo_full_name AS repo, min(license_hint) AS hint FROM repos GROUP BY 1) r
 LEFT JOIN {_VOTE} v ON v.repo = r.repo LEFT JOIN (SELECT DISTINCT repo FROM ({_SECRETS})) s ON s.repo = r.repo))"""
_STATUS = f"CASE WHEN NOT scanned THEN CASE WHEN coalesce(license IN {_ALLOWED_SQL}, false) THEN 'ok' ELSE 'blocked_license_scanner_unavailable' END WHEN sec THEN 'quarantined_secrets' WHEN coalesce(license IN {_ALLOWED_SQL}, false) THEN 'ok' ELSE 'blocked_license' END"


@query(f"SELECT repo, license, {_STATUS} AS status FROM {_GATE}")
def gate_status(spark, d):
    return _gated(spark, d).select("repo", "license", "status")


@query(f"SELECT repo, license FROM {_GATE} WHERE {_STATUS} = 'quarantined_secrets'")
def quarantine(spark, d):
    path = shared_dir(spark)
    sinks.quarantine(gate.split_by_status(_gated(spark, d)), path)
    return spark.read.parquet(f"{path}/quarantined").select("repo", "license")


@query(f"SELECT record_id FROM kept_records WHERE repo_full_name IN (SELECT repo FROM {_GATE} WHERE {_STATUS} = 'ok')")
def passed_units(spark, d):
    """Units of the repositories that passed the gate."""
    ok = _gated(spark, d).where("status = 'ok'").select(F.col("repo").alias("repo_full_name"))
    return _units(spark, d).join(ok, "repo_full_name", "left_semi").select("record_id")


@query(f"SELECT repo, license, votes, matched_text FROM {_VOTE}")
def license_reports(spark, d):
    """The vote over nested reports, one file per finding."""
    one = _findings(spark, d).groupBy("repo").agg(F.sort_array(F.collect_list(F.struct("ord", "spdx", "matched_text"))).alias("f"))
    licence = lambda x: F.struct(x["spdx"].alias("spdx_license_key"), F.lit(None).cast("string").alias("key"), x["matched_text"].alias("matched_text"))
    reports = one.select("repo", F.transform("f", lambda x: F.struct(x["ord"].cast("string").alias("path"), F.array(licence(x)).alias("licenses"))).alias("files"))
    return gate.license_vote(gate.findings_of_reports(reports))


@query(
    f"""SELECT p.repo_full_name, CASE WHEN g.repo IS NULL THEN p.license_spdx ELSE g.license END AS license_spdx, CASE WHEN g.repo IS NULL THEN p.license_text ELSE v.matched_text END AS license_text,
 CASE WHEN g.repo IS NULL THEN p.scan_timestamp ELSE '2025-01-31T12:00:00' END AS scan_timestamp FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY repo_full_name ORDER BY prov_id) AS rn FROM provenance) WHERE rn = 1) p
 LEFT JOIN {_GATE} g ON g.repo = p.repo_full_name LEFT JOIN {_VOTE} v ON v.repo = p.repo_full_name"""
)
def provenance_update(spark, d):
    vote = gate.license_vote(_findings(spark, d)).select("repo", "matched_text")
    gated = _gated(spark, d).select("repo", "license").join(vote, "repo", "left")
    return gate.update_provenance(_repo_provenance(spark, d), gated, "2025-01-31T12:00:00").select("repo_full_name", "license_spdx", "license_text", "scan_timestamp")


@query("SELECT repo_full_name, 0 AS part, string_agg(file_path || '=' || sha256, '; ' ORDER BY file_path) AS hashes FROM (SELECT repo_full_name, file_path, max(sha256(code)) AS sha256 FROM source_files WHERE code IS NOT NULL GROUP BY 1, 2) GROUP BY 1")
def file_hash_maps(spark, d):
    m = extract.hash_maps(extract.file_hashes(_t(spark, d, "source_files")))
    return m.select("repo_full_name", "part", F.array_join(F.transform(F.array_sort(F.map_entries("file_hashes")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ").alias("hashes"))


@query(f"SELECT r.repo, coalesce(n, 0) AS n_findings FROM (SELECT DISTINCT repo_full_name AS repo FROM repos) r LEFT JOIN (SELECT repo, count(*) AS n FROM ({_SECRETS}) GROUP BY 1) f ON f.repo = r.repo")
def stub_reports(spark, d):
    r = _t(spark, d, "repos").select(F.col("repo_full_name").alias("repo")).distinct()
    return gate.with_reports(r, _secret_rows(spark, d)).select("repo", "n_findings")


# ---- discovery


def _items(spark, d):
    """Repositories with a total order that does not depend on files: later finds of a key differ in their time stamps."""
    r = _t(spark, d, "repos")
    return r.withColumn("ord", F.struct("fetch_timestamp", "source", "repo_full_name", F.coalesce("stars", F.lit(-1)).alias("s"), F.coalesce("semantic_score", F.lit(-1.0)).alias("c"), F.coalesce("license_hint", F.lit("")).alias("l")))


_ORD = "fetch_timestamp NULLS FIRST, source NULLS FIRST, repo_full_name NULLS FIRST, coalesce(stars, -1), coalesce(semantic_score, -1.0), coalesce(license_hint, '')"
_DISTINCT = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, repo_full_name ORDER BY {_ORD}) AS rn FROM repos) WHERE rn = 1)"


def _distinct(spark, d, *columns):
    """Distinct repositories with the columns that a query needs: an aggregated struct is not pruned by itself."""
    return discovery.key_distinct(_items(spark, d).select("source", "repo_full_name", "ord", *columns))


@query(f"SELECT source, repo_full_name, stars, semantic_score FROM {_DISTINCT}")
def repo_key_distinct(spark, d):
    return _distinct(spark, d, "stars", "semantic_score").select("source", "repo_full_name", "stars", "semantic_score")


@query(f"SELECT source, repo_full_name FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {_ORD}) AS k FROM {_DISTINCT}) WHERE k <= 10")
def per_source_limit(spark, d):
    return discovery.per_source_limit(_distinct(spark, d), 10).select("source", "repo_full_name")


@query(f"SELECT source, repo_full_name, stars FROM {_DISTINCT} WHERE stars >= 100")
def star_filter(spark, d):
    i = _distinct(spark, d, "stars")
    return i.where(discovery.min_stars(F.col("stars"), 100)).select("source", "repo_full_name", "stars")


@query(f"SELECT source, repo_full_name FROM {_DISTINCT} WHERE coalesce(list_has_any(list_transform(topics, lambda t: lower(t)), ['lattice', 'cache', 'harbor']), false) OR regexp_matches(lower(concat_ws(' ', description, array_to_string(topics, ' '))), 'lattice|cache|harbor')")
def language_filter(spark, d):
    i = _distinct(spark, d, "topics", "description")
    return i.where(discovery.names_language(("Lattice", "cache", "harbor"), F.col("topics"), F.col("description"), F.array_join("topics", " "))).select("source", "repo_full_name")


@query(f"SELECT source, repo_full_name, concat_ws(chr(10), coalesce(repo_full_name, ''), coalesce(description, ''), coalesce(array_to_string(topics, ' '), ''), substr(coalesce(readme_head, ''), 1, 2000)) AS corpus FROM {_DISTINCT}")
def corpus_text(spark, d):
    return _distinct(spark, d, "description", "topics", "readme_head").select("source", "repo_full_name", discovery.corpus_text(F.col("repo_full_name"), F.col("description"), F.col("topics"), F.col("readme_head")).alias("corpus"))


@query(f"SELECT source, repo_full_name, semantic_score FROM {_DISTINCT} WHERE semantic_score >= 0.7 ORDER BY semantic_score DESC, {_ORD} LIMIT 50")
def semantic_topk(spark, d):
    return discovery.rank(_distinct(spark, d, "semantic_score"), 0.70, 50).select("source", "repo_full_name", "semantic_score")


@query(f"SELECT source, repo_full_name, stars FROM {_DISTINCT} ORDER BY coalesce(stars, 0) DESC, {_ORD} LIMIT 50")
def stars_fallback_topk(spark, d):
    i = _distinct(spark, d, "stars").withColumn("semantic_score", F.lit(None).cast("double"))
    return discovery.rank(i, 0.70, 50).select("source", "repo_full_name", "stars")


_LANGS = ("lever", "widget", "cache", "archive", "platform")
_SEARCHED = f"""(SELECT source, repo_full_name, coalesce(stars, 0) AS stars, 0 AS site, k FROM (
 SELECT *, row_number() OVER (ORDER BY n, coalesce(stars, 0) DESC, {_ORD}) AS k FROM (SELECT *, row_number() OVER (PARTITION BY repo_full_name ORDER BY n, coalesce(stars, 0) DESC, {_ORD}) AS r FROM (
  SELECT *, coalesce(list_position(list_transform({list(_LANGS)!r}, lambda w: list_contains(list_transform(coalesce(topics, []), lambda t: lower(t)), w)), true), 0) AS n FROM repos WHERE source = 'github' AND coalesce(stars, 0) >= 10) WHERE n > 0) WHERE r = 1) WHERE k <= 12
 UNION ALL SELECT source, repo_full_name, coalesce(stars, 0), 1, k FROM (
 SELECT *, row_number() OVER (ORDER BY {_ORD}) AS k FROM (SELECT *, row_number() OVER (PARTITION BY repo_full_name ORDER BY {_ORD}) AS r FROM repos WHERE source = 'gitlab' AND coalesce(stars, 0) >= 10
  AND regexp_matches(lower(concat_ws(' ', coalesce(description, ''), array_to_string(coalesce(topics, []), ' '))), '{'|'.join(_LANGS)}')) WHERE r = 1) WHERE k <= 12)"""


def _listings(spark, d):
    """The table as two listings: topics stand for languages on the one site, on the other languages are not known."""
    r = _items(spark, d)
    empty = F.lit(None).cast("array<string>")
    return {"github": r.where("source = 'github'").withColumn("languages", F.col("topics")), "gitlab": r.where("source = 'gitlab'").withColumn("languages", empty)}


@query(f"SELECT source, repo_full_name, stars FROM {_SEARCHED}")
def repo_search(spark, d):
    """The first twelve finds of each site: a top-k report, as a search gives."""
    of = _listings(spark, d)
    found = search.github(of["github"], None, _LANGS, 10, 12).unionByName(search.gitlab(of["gitlab"], None, _LANGS, 10, 12).select("source", "repo_full_name", "stars"), allowMissingColumns=True)
    return found.select("source", "repo_full_name", "stars")


@query(f"SELECT source, repo_full_name, stars FROM {_SEARCHED} ORDER BY stars DESC, site, k LIMIT 8")
def discovered(spark, d):
    """The search as a whole, ranked by stars without an encoder: the first eight."""
    return discovery.discover(_listings(spark, d), "", _LANGS, 10, 12, 0.70, 8).select("source", "repo_full_name", "stars")


@query("SELECT source, repo_full_name FROM (SELECT source, repo_full_name, row_number() OVER (PARTITION BY source, repo_full_name ORDER BY t) AS rn FROM (SELECT *, 0 AS t FROM repos WHERE source = 'gitlab' UNION ALL SELECT *, 1 FROM repos)) WHERE rn = 1")
def merged_sources(spark, d):
    i = _items(spark, d).select("source", "repo_full_name", "ord")
    return discovery.merge_sources(i.where("source = 'gitlab'"), i).select("source", "repo_full_name")


@query("SELECT r.repo_full_name, substr(coalesce(f.text, ''), 1, 2000) AS readme_head FROM (SELECT DISTINCT repo_full_name FROM repos) r LEFT JOIN (SELECT repo_full_name, arg_min(text, doc_id) AS text FROM documents WHERE doc_kind = 'readme' AND text <> '' GROUP BY 1) f ON f.repo_full_name = r.repo_full_name")
def readme_heads(spark, d):
    docs = _t(spark, d, "documents").where("doc_kind = 'readme' and text <> ''").groupBy("repo_full_name").agg(F.min_by("text", "doc_id").alias("code"))
    return discovery.readme_preview(_t(spark, d, "repos").select("repo_full_name").distinct(), docs.withColumn("file_path", F.lit("README.md")))


def _letters():
    """An encoder for tests of the plumbing: how often four letters stand in a text."""
    return lambda texts: [[float(t.lower().count(c)) for c in "aeio"] for t in texts]


@query(
    f"""WITH c AS (SELECT source, repo_full_name, lower(concat_ws(chr(10), coalesce(repo_full_name, ''), coalesce(description, ''), coalesce(array_to_string(topics, ' '), ''), substr(coalesce(readme_head, ''), 1, 2000))) AS t FROM {_DISTINCT}),
 v AS (SELECT source, repo_full_name, [CAST(len(t) - len(replace(t, 'a', '')) AS DOUBLE), len(t) - len(replace(t, 'e', '')), len(t) - len(replace(t, 'i', '')), len(t) - len(replace(t, 'o', ''))] AS v FROM c)
 SELECT source, repo_full_name, round(list_cosine_similarity(v, CAST([1, 2, 1, 1] AS DOUBLE[])), 5) AS score FROM v"""
)
def embedded_corpus(spark, d):
    """Repositories scored by an encoder's vectors against a query's."""
    i = _distinct(spark, d, "description", "topics", "readme_head")
    text = discovery.corpus_text(F.col("repo_full_name"), F.col("description"), F.col("topics"), F.col("readme_head"))
    made = discovery.embed(i.withColumn("t", text), "t", "v", _letters)
    return discovery.scored(made, "v", [1.0, 2.0, 1.0, 1.0]).select("source", "repo_full_name", F.round("semantic_score", 5).alias("score"))


# ---- streams, run over what is there


def _streamed(spark, d, columns):
    """The kept records as a stream of landing files, and a folder for its state and results."""
    path = shared_dir(spark)
    src = written(_units(spark, d).select(*columns), f"{path}/landing")
    return incremental.landing(spark, f"{path}/landing", src.schema).withColumn("ts", F.col("accepted_ts").cast("timestamp")), path


@query(f"SELECT DISTINCT sha256({_norm('code')}) AS content_hash FROM kept_records")
def stream_distinct(spark, d):
    stream, path = _streamed(spark, d, ["record_id", "code", "accepted_ts"])
    firsts = incremental.first_of_content(stream, "ts", "36500 days").select("content_hash")
    firsts.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("content_hash string").parquet(f"{path}/out")


@query("SELECT strftime(date_trunc('hour', accepted_ts), '%Y-%m-%d %H:00:00') AS begins, language, count(*) AS n FROM kept_records GROUP BY 1, 2")
def stream_counts(spark, d):
    stream, path = _streamed(spark, d, ["language", "accepted_ts"])
    counted = incremental.counts(stream, "ts", "1 hour").select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("begins"), "language", "n")

    def keep(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/out")

    counted.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("begins string, language string, n bigint").parquet(f"{path}/out")


# ---- history of files: each ingest of a file counts as a commit upon the one before in its repository

_COMMITS = "(SELECT repo_full_name AS repo, file_id AS c, lag(file_id) OVER w AS parent, row_number() OVER (PARTITION BY repo_full_name ORDER BY ingest_ts DESC, file_id DESC) AS n, file_path FROM source_files WINDOW w AS (PARTITION BY repo_full_name ORDER BY ingest_ts, file_id))"


def _commits(spark, d):
    from pyspark.sql import Window as W

    f = _t(spark, d, "source_files").select("repo_full_name", "file_id", "file_path", "ingest_ts")
    by = W.partitionBy("repo_full_name")
    null = F.lit(None).cast("string")
    return f.select(
        F.col("repo_full_name").alias("repo"), F.col("file_id").cast("string").alias("commit"), F.lag("file_id").over(by.orderBy("ingest_ts", "file_id")).cast("string").alias("parent"),
        F.row_number().over(by.orderBy(F.desc("ingest_ts"), F.desc("file_id"))).alias("ord"), F.lit("me").alias("author"), F.col("ingest_ts").cast("string").alias("date"), F.col("file_path").alias("message"),
        null.alias("a_path"), F.col("file_path").alias("b_path"), F.lit("M").alias("change_type"), F.lit("").alias("diff"),
    )


@query(f"SELECT repo, CAST(c AS VARCHAR) AS commit, CAST(parent AS VARCHAR) AS parent, file_path FROM {_COMMITS} WHERE n <= 200 AND parent IS NOT NULL AND lower(file_path) LIKE '%.py'")
def commit_pairs(spark, d):
    return mining.mine_commits(_commits(spark, d)).select("repo", "commit", "parent", "file_path")


@query(f"SELECT x.repo, CAST(x.c AS VARCHAR) AS commit, y.file_path AS parent_message FROM {_COMMITS} x LEFT JOIN {_COMMITS} y ON x.repo = y.repo AND x.parent = y.c")
def commit_parents(spark, d):
    c = _commits(spark, d)
    return mining.with_parent(c, c).select("repo", "commit", "parent_message")


# ---- vectors


def _vectors(spark, d):
    return _t(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))


@query("SELECT e.vec_id AS id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 5) AS sim FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q WHERE e.vec_id <> 0 ORDER BY list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) DESC, e.vec_id LIMIT 20")
def embedding_topk(spark, d):
    """The twenty vectors nearest to vector 0: a top-k report."""
    v = _vectors(spark, d)
    q = v.where("id = 0").select(F.col("id").alias("q_id"), F.col("vec").alias("q_vec"))
    return discovery.nearest(v.where("id <> 0"), q, 20).select("id", F.round("sim", 5).alias("sim"))


_SIM = "list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[]))"
_QUERIES = "(SELECT vec_id AS q_id, embedding FROM embeddings WHERE vec_id % 20 = 0)"


@query(f"SELECT q_id, count(*) AS n FROM embeddings e, {_QUERIES} q WHERE {_SIM} >= 0.3 AND e.vec_id <> q.q_id GROUP BY q_id")
def semantic_threshold(spark, d):
    """How many vectors are near each of the stated queries (ids divisible by 20)."""
    v = _vectors(spark, d)
    q = v.where("id % 20 = 0").select(F.col("id").alias("q_id"), F.col("vec").alias("q_vec"))
    return discovery.count_near(v, q, 0.3)


@query(
    f"""WITH s AS (SELECT q_id, e.vec_id AS id, {_SIM} AS sim FROM embeddings e, {_QUERIES} q), t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY sim DESC, id) AS rn FROM s) WHERE rn <= 10)
 SELECT q_id, k, count(*) FILTER (sim >= round(0.5 + 0.05 * k, 10)) / 10 AS p10 FROM t, range(9) g(k) GROUP BY q_id, k"""
)
def precision_grid(spark, d):
    v = _vectors(spark, d)
    q = v.where("id % 20 = 0").select(F.col("id").alias("q_id"), F.col("vec").alias("q_vec"))
    return discovery.precision_at_10(discovery.nearest(v, q)).select("q_id", F.col("k").cast("bigint").alias("k"), "p10")


@query(
    f"""WITH s AS (SELECT q_id, e.vec_id AS id, {_SIM} AS sim FROM embeddings e, {_QUERIES} q), t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY sim DESC, id) AS rn FROM s) WHERE rn <= 10),
 p AS (SELECT q_id, k, round(0.5 + 0.05 * k, 10) AS threshold, count(*) FILTER (sim >= round(0.5 + 0.05 * k, 10)) / 10 AS p10 FROM t, range(9) g(k) GROUP BY q_id, k)
 SELECT CAST(coalesce((SELECT threshold FROM p WHERE p10 > 0 ORDER BY p10 DESC, q_id, k LIMIT 1), 0.7) AS DOUBLE) AS threshold, CAST(coalesce((SELECT max(p10) FROM p), 0.0) AS DOUBLE) AS p10"""
)
def calibration(spark, d):
    v = _vectors(spark, d)
    q = v.where("id % 20 = 0").select(F.col("id").alias("q_id"), F.col("vec").alias("q_vec"))
    return discovery.calibrate(discovery.nearest(v, q))


# ---- joins


def _repo_provenance(spark, d):
    """One row per repository: that of its smallest prov_id."""
    p = _t(spark, d, "provenance")
    cols = [c for c in p.columns if c != "repo_full_name"]
    return p.groupBy("repo_full_name").agg(F.min_by(F.struct(*cols), "prov_id").alias("p")).select("repo_full_name", "p.*").drop("file_path", "lines")


@query("SELECT k.record_id, p.source, p.commit_sha, p.license_spdx, k.start_line AS first_line, k.end_line AS last_line FROM kept_records k LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY repo_full_name ORDER BY prov_id) AS rn FROM provenance) WHERE rn = 1) p ON p.repo_full_name = k.repo_full_name WHERE p.repo_full_name IS NOT NULL")
def provenance_attach(spark, d):
    u = _units(spark, d).drop("provenance")
    j = extract.attach_provenance(u, _repo_provenance(spark, d)).where("provenance is not null")
    p = F.col("provenance")
    return j.select("record_id", p["source"].alias("source"), p["commit_sha"].alias("commit_sha"), p["license_spdx"].alias("license_spdx"), p["lines"][0].alias("first_line"), p["lines"][1].alias("last_line"))


@query("SELECT source, repo_full_name, clone_url, default_branch, license_hint FROM (SELECT source, repo_full_name, clone_url, coalesce(nullif(default_branch, ''), 'main') AS default_branch, license_spdx AS license_hint, row_number() OVER (PARTITION BY repo_full_name ORDER BY prov_id) AS rn FROM provenance) WHERE rn = 1 AND repo_full_name <> '' AND clone_url <> '' AND source <> ''")
def rebuilt_manifest(spark, d):
    return files.rebuild_manifest(_repo_provenance(spark, d), "prov_id").select("source", "repo_full_name", "clone_url", "default_branch", "license_hint")


def _cached(spark, d):
    """A cache that holds the texts of batch 0."""
    return _units(spark, d).where("batch_no = 0").select(T.content_hash("code_norm").alias("key"), F.col("loc").alias("value"))


@query("SELECT record_id FROM kept_records WHERE batch_no > 0 AND NOT EXISTS (SELECT 1 FROM kept_records o WHERE o.batch_no = 0 AND o.code_norm = kept_records.code_norm)")
def cache_miss(spark, d):
    new = _units(spark, d).where("batch_no > 0").select("record_id", T.content_hash("code_norm").alias("key"))
    return discovery.cache_misses(new, _cached(spark, d), "key").select("record_id")


@query("SELECT record_id FROM kept_records WHERE batch_no > 0 AND code_norm IN (SELECT code_norm FROM kept_records WHERE batch_no = 0)")
def cache_hit(spark, d):
    new = _units(spark, d).where("batch_no > 0").select("record_id", T.content_hash("code_norm").alias("key"))
    return discovery.cache_hits(new, _cached(spark, d), "key").select("record_id")


@query("SELECT count(*) AS keys FROM (SELECT DISTINCT code_norm FROM kept_records WHERE code_norm IS NOT NULL)")
def cache_appended(spark, d):
    """How many texts a cache knows after what it missed was added to it."""
    path = f"{shared_dir(spark)}/cache"
    new = _units(spark, d).where("batch_no > 0 and code_norm is not null").select(T.content_hash("code_norm").alias("key"), F.col("loc").alias("value")).dropDuplicates(["key"])
    sinks.append_cache(_cached(spark, d).dropDuplicates(["key"]), path)
    sinks.append_cache(written(discovery.cache_misses(new, spark.read.parquet(path), "key"), f"{path}-misses"), path)
    return spark.read.parquet(path).agg(F.count_distinct("key").alias("keys"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
