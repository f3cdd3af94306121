"""Schemas of the record types, as DDL."""

PROVENANCE_STRUCT = (
    "struct<repo_full_name: string, source: string, clone_url: string, default_branch: string, commit_sha: string, commit_date: string, "
    "file_path: string, lines: array<int>, license_spdx: string, license_text: string, scan_tool_versions: map<string,string>, "
    "scan_timestamp: string, semantic_score: double>"
)
REPO = (
    "source string, repo_full_name string, clone_url string, default_branch string, stars int, license_hint string, url string, "
    "description string, topics array<string>, readme_head string, semantic_score double, fetch_timestamp string"
)
REPO_PROVENANCE = (
    "repo_full_name string, source string, clone_url string, default_branch string, commit_sha string, commit_date string, "
    "license_spdx string, license_text string, scan_tool_versions map<string,string>, scan_timestamp string, semantic_score double, "
    "snapshot_tar string, file_hashes map<string,string>"
)
FUNCTION = (
    f"language string, file_path string, start_line int, end_line int, loc int, code string, docstring string, provenance {PROVENANCE_STRUCT}"
)
COMMIT = (
    "repo string, commit string, parent string, author string, date string, message string, a_path string, b_path string, change_type string, diff string"
)
LICENSE_REPORT = "files array<struct<path: string, licenses: array<struct<spdx_license_key: string, key: string, matched_text: string>>>>"

# The record formats as JSON Schema (draft 7), as far as validation goes.
_STRING, _TEXT_OR_NULL = {"type": "string"}, {"type": ["string", "null"]}
_STRINGS = {"type": "array", "items": _STRING}
_BOOLEAN, _OBJECT = {"type": "boolean"}, {"type": "object"}


def _record(properties: dict, optional: tuple[str, ...] = ()) -> dict:
    return {"type": "object", "properties": properties, "required": [k for k in properties if k not in optional]}


def _task(name: str, **properties) -> dict:
    return _record({"id": _STRING, "task": _STRING | {"const": name}, "language": _STRING, **properties, "synthetic": _BOOLEAN}, ("metrics",))


PROVENANCE_RECORD = _record(
    {
        "repo_full_name": _STRING,
        "source": _STRING | {"enum": ["github", "gitlab"]},
        **dict.fromkeys(("clone_url", "default_branch", "commit_sha", "commit_date", "file_path"), _STRING),
        "lines": {"type": "array", "items": {"type": "integer"}, "minItems": 2, "maxItems": 2},
        **dict.fromkeys(("license_spdx", "license_text"), _TEXT_OR_NULL),
        "scan_tool_versions": _OBJECT,
        "scan_timestamp": _STRING,
        "semantic_score": {"type": ["number", "null"]},
    },
    ("semantic_score",),
)
_FROM = {"$ref": "provenance.schema.json"}
_COMMITS = _record(dict.fromkeys(("pre_commit", "post_commit", "repo_full_name"), _STRING))
#: Schemas by the names under which they refer to one another.
RECORDS = {
    "provenance": PROVENANCE_RECORD,
    "completion": _task("completion", license=_TEXT_OR_NULL, provenance=_FROM, input=_record({"prefix": _STRING}), output=_record({"completion": _STRING}), metrics=_OBJECT),
    "documentation": _task("documentation", license=_TEXT_OR_NULL, provenance=_FROM, code=_STRING, docstring=_STRING, source=_STRING),
    "refactor": _task("refactor", provenance=_FROM, pre=_STRING, post=_STRING, diff=_STRING, refactor_type=_STRING, verified=_BOOLEAN),
    "debugging": _task("debugging", license=_TEXT_OR_NULL, provenance=_COMMITS, pre_snippet=_STRING, post_snippet=_STRING, diff=_STRING, failing_tests=_STRINGS, stack_trace=_STRINGS),
}
