"""Queries of the problems p1 to p10. Each reads whole tables and runs with the operators' production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm import bpe, docpairs, handwritten, history, languages, licenses, mixing, nearcopies, secrets, syntax
from loamline.llm.common import shared_dir, spread, table, written


#: Similarity from which kept_records count as copies of one another.
SAME = 0.70


def _records(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "kept_records").select(F.col("record_id").alias("id"), F.col("code_norm").alias("text")))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return nearcopies.record_pairs(*nearcopies.class_pairs(_records(spark, d), SAME, shared_dir(spark)))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    path = shared_dir(spark)
    pairs, members = nearcopies.class_pairs(_records(spark, d), SAME, path)
    return nearcopies.groups(pairs, members, path)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return licenses.resolve(table(spark, d, "provenance"), table(spark, d, "licenses"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    records = spread(table(spark, d, "kept_records").select(F.col("record_id").alias("id"), F.col("batch_no").alias("batch"), F.col("code_norm").alias("text")))
    return history.duplicates(records, SAME, shared_dir(spark))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return docpairs.extract(spread(table(spark, d, "documentation"))).select("rec_id", "func_name")


def p4_pairs(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documentation")
    return docpairs.with_code(docs, docpairs.extract(spread(docs)))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    files = spread(table(spark, d, "source_files"))
    weights, cut, _, libs = handwritten.train(files, table(spark, d, "known_libs"))
    return handwritten.scored(files, weights, cut, libs)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).where(~F.col("hand_written")).select("file_id")


def p5_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("file_id", F.round("score", 6).alias("score"), "hand_written")


def p5_validation(spark: SparkSession, d: str) -> DataFrame:
    _, cut, figures, _ = handwritten.train(spread(table(spark, d, "source_files")), table(spark, d, "known_libs"))
    return spark.createDataFrame([(k, float(v)) for k, v in {**figures, "threshold": cut}.items()], "figure string, value double")


def _code(spark: SparkSession, d: str) -> DataFrame:
    return spread(secrets.both_tables(table(spark, d, "documentation"), table(spark, d, "kept_records")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return secrets.lines(_code(spark, d))


def p6_redacted(spark: SparkSession, d: str) -> DataFrame:
    return secrets.redacted(_code(spark, d))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return syntax.flagged(spread(table(spark, d, "source_files")))


def p7_repairs(spark: SparkSession, d: str) -> DataFrame:
    return syntax.checked(spread(table(spark, d, "source_files")))


def p7_rates(spark: SparkSession, d: str) -> DataFrame:
    return syntax.rates(syntax.checked(spread(table(spark, d, "source_files"))))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    return bpe.encode_column(docs, "text").select("doc_id", "ids")


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    """Token counts of all documents, written once, as three steps read them."""
    docs = spread(table(spark, d, "documents").select("doc_id", "source", "text"))
    counted = bpe.count_column(docs, "text").select("doc_id", "source", "n_tokens")
    return written(counted, f"{shared_dir(spark)}/sizes").where("n_tokens > 0")  # a filter before would count twice


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    sizes = _sizes(spark, d)
    rate = mixing.rates(sizes, table(spark, d, "mix_targets"))
    return mixing.sample(mixing.ranked(sizes), rate)


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    sizes = _sizes(spark, d)
    ranks, parts = mixing.ranked(sizes), []
    for keep in ("size", "shares"):
        rate = mixing.rates(sizes, table(spark, d, "mix_targets"), keep)
        parts.append(mixing.shares(mixing.sample(ranks, rate), rate).withColumn("keep", F.lit(keep)))
    return parts[0].unionByName(parts[1])


def _segments(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(table(spark, d, "documents").select("doc_id", "lang", "text"))
    return languages.segments(docs, languages.train(docs))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return languages.found(_segments(spark, d))


def p10_segments(spark: SparkSession, d: str) -> DataFrame:
    return _segments(spark, d).select("doc_id", "seg_no", "lang", "confidence", "n_words")


def p10_documents(spark: SparkSession, d: str) -> DataFrame:
    return languages.of_documents(_segments(spark, d))


def queries() -> dict:
    return {k: f for k, f in globals().items() if k[0] == "p" and k[1:2].isdigit() and callable(f)}


_WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_PAIRS = f"""t AS (SELECT record_id, unnest(list_filter(regexp_split_to_array(code_norm, '{_WS}+'), lambda x: x <> '')) AS w FROM kept_records),
 o AS (SELECT record_id, w, row_number() OVER (PARTITION BY record_id, w) AS k FROM t),
 n AS (SELECT record_id, count(*) AS n FROM t GROUP BY record_id),
 c AS (SELECT a.record_id AS x, b.record_id AS y, count(*) AS c FROM o a JOIN o b ON a.w = b.w AND a.k = b.k AND a.record_id < b.record_id GROUP BY 1, 2),
 p AS (SELECT x AS record_a, y AS record_b FROM c JOIN n na ON na.record_id = x JOIN n nb ON nb.record_id = y WHERE c / (na.n + nb.n - c) >= 0.7)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"WITH {_PAIRS} SELECT record_a, record_b FROM p",
        "p3_found": f"""WITH {_PAIRS}, d AS (SELECT record_a AS a, record_b AS b FROM p UNION ALL SELECT record_b, record_a FROM p)
 SELECT k.record_id, CASE WHEN bool_or(h.code_norm = k.code_norm) THEN 'exact' ELSE 'near' END AS kind FROM d JOIN kept_records k ON k.record_id = d.a JOIN kept_records h ON h.record_id = d.b AND h.batch_no < k.batch_no GROUP BY k.record_id""",
    }
