"""Schema checks of the final records, and the dataset manifest."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline import schemas


@dataclass(frozen=True)
class Rule:
    """A field of a record: its JSON types, whether it must be there, the values allowed, the type of its items, their number."""

    path: str
    kinds: tuple[str, ...]
    required: bool = True
    values: tuple[str, ...] = ()
    items: str | None = None
    least: int | None = None
    most: int | None = None


def load_schemas(folder: str | Path) -> dict[str, dict]:
    """Schemas of a folder of <name>.schema.json files, by name."""
    return {p.name.removesuffix(".schema.json"): json.loads(p.read_text(encoding="utf-8")) for p in sorted(Path(folder).glob("*.schema.json"))}


def rules(name: str, known: dict[str, dict] | None = None) -> tuple[Rule, ...]:
    """The rules of a schema, nested objects and references to other schemas unfolded. What is not said here is not checked:
    type, required, properties, const, enum, items.type, minItems, maxItems, $ref."""
    known = known or schemas.RECORDS
    out: list[Rule] = []

    def walk(schema: dict, path: str) -> None:
        for key, s in schema.get("properties", {}).items():
            s = known[s["$ref"].split("#")[0].removesuffix(".schema.json")] | {k: v for k, v in s.items() if k != "$ref"} if "$ref" in s else s
            at = f"{path}{key}"
            kinds = s.get("type", ())
            values = s.get("enum", (s["const"],) if "const" in s else ())
            out.append(Rule(at, tuple([kinds] if isinstance(kinds, str) else kinds), key in schema.get("required", ()), tuple(values), s.get("items", {}).get("type"), s.get("minItems"), s.get("maxItems")))
            walk(s, f"{at}.")

    walk(known[name], "")
    return tuple(out)


_KINDS = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL"), "boolean": ("BOOLEAN",), "object": ("OBJECT",), "array": ("ARRAY",), "null": ("VOID",)}


def _is(kind: Column, names: tuple[str, ...]) -> Column:
    fits = F.lit(False)
    for k in names:
        for x in _KINDS[k]:
            fits = fits | kind.startswith(x)
    return fits


def _violation(v: Column, rule: Rule) -> Column:
    """A text that names the rule broken, or null. JSON null and an absent field are told apart: VOID against no value.

    A field of what is not there itself is only reported through that.
    """
    at = F.try_variant_get(v, f"$.{rule.path}", "variant")
    kind = F.schema_of_variant(at)
    out = F.when(at.isNull(), f"{rule.path}: missing" if rule.required else None)
    if rule.kinds:
        if "null" not in rule.kinds:
            out = out.when(kind == "VOID", f"{rule.path}: null")
        out = out.when(~_is(kind, rule.kinds), f"{rule.path}: type")
    if rule.values:
        out = out.when((kind != "VOID") & ~F.try_variant_get(v, f"$.{rule.path}", "string").isin(*rule.values), f"{rule.path}: value")
    items = F.try_variant_get(v, f"$.{rule.path}", "array<variant>")
    if rule.least is not None:
        out = out.when(F.size(items) < rule.least, f"{rule.path}: length")
    if rule.most is not None:
        out = out.when(F.size(items) > rule.most, f"{rule.path}: length")
    if rule.items:
        out = out.when(F.exists(items, lambda x: ~_is(F.schema_of_variant(x), (rule.items,))), f"{rule.path}: items")
    return out


def violations(lines: DataFrame, task: str, column: str = "value", known: dict[str, dict] | None = None) -> DataFrame:
    """Adds `violations`, an array of texts: empty for valid records, ['unparsable'] for lines that are no JSON (null too).

    Extra fields are allowed. One pass, no join: each rule of the task's schema (of `known`, or the built-in ones) is an
    expression over the parsed line. A record without its provenance reports that and each field that it should have.
    """
    v = F.col("__v")
    found = F.array_compact(F.array(*[_violation(v, r) for r in rules(task, known)]))
    return lines.withColumn("__v", F.try_parse_json(F.col(column))).withColumn("violations", F.when(v.isNull(), F.array(F.lit("unparsable"))).otherwise(found)).drop("__v")


def require_valid(checked: DataFrame) -> DataFrame:
    """Fails the job at the first invalid record, like a strict validator."""
    bad = F.size("violations") > 0
    return checked.withColumn("violations", F.when(bad, F.raise_error(F.concat(F.lit("invalid record: "), F.array_join("violations", "; "))).cast("array<string>")).otherwise(F.col("violations")))


def as_json(records: DataFrame) -> DataFrame:
    """One JSON text per record, null fields included: the formats require some that may be null."""
    return records.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def count_by(records: DataFrame, column: str) -> DataFrame:
    """(column, n), values that are null or '' left out."""
    return records.where(F.col(column).isNotNull() & (F.col(column) != "")).groupBy(column).agg(F.count("*").alias("n"))


def manifest(records: DataFrame, rate: DataFrame, complete: Column) -> DataFrame:
    """One row with counts, licenses and languages as maps, the duplication rate and whether every record has its provenance.

    The maps have a key per task, licence and language, not per record.
    """
    parts = records.groupBy("task", "license", "language").agg(F.count("*").alias("n"), F.bool_and(complete).alias("ok"))

    def of(c: str, name: str) -> DataFrame:
        by = parts.where(F.col(c).isNotNull() & (F.col(c) != "")).groupBy(c).agg(F.sum("n").alias("n"))
        return by.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(c).alias("k"), "n")))).alias(name))

    ok = parts.agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("provenance_complete"))
    return of("task", "counts").join(of("license", "licenses")).join(of("language", "languages")).join(rate.select(F.col("duplication_rate").alias("duplication_rate_hint"))).join(ok)
