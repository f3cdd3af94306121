"""Ranking of candidate repositories, and the calibration of its threshold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loamline.functions import text as T
from loamline.functions.vectors import EPS, cosine

#: Fixed value: what calibration gives when nothing lies above any threshold.
FALLBACK = 0.7


def key_distinct(items: DataFrame, ord_col: str = "ord") -> DataFrame:
    """First item per (source, repo_full_name) in the order of ord_col; null keys count as keys."""
    cols = [c for c in items.columns if c not in ("source", "repo_full_name")]
    return items.groupBy("source", "repo_full_name").agg(F.min_by(F.struct(*cols), ord_col).alias("__i")).select("source", "repo_full_name", "__i.*")


def merge_sources(*tables: DataFrame) -> DataFrame:
    """Union of several searches, earlier tables first, distinct by key."""
    out = None
    for i, t in enumerate(tables):
        t = t.withColumn("ord", F.struct(F.lit(i).alias("t"), F.col("ord").alias("o")))
        out = t if out is None else out.unionByName(t)
    return key_distinct(out)


def min_stars(c: Column, n: int) -> Column:
    """c >= n; no condition for n = 0, so that null stars pass."""
    return F.lit(True) if not n else F.coalesce(c >= n, F.lit(False))


def names_language(languages: tuple[str, ...], keys: Column, *texts: Column) -> Column:
    """A language is among the keys (case aside), or one of the texts contains its name."""
    wanted = F.array(*[F.lit(x.lower()) for x in languages])
    hay = F.lower(F.concat_ws(" ", *texts))
    return F.coalesce(F.arrays_overlap(F.transform(keys, lambda k: F.lower(k)), wanted), F.lit(False)) | F.exists(wanted, lambda w: F.contains(hay, w))


def corpus_text(name: Column, description: Column, topics: Column, readme: Column) -> Column:
    """name, description, topics and the first 2,000 characters of the readme, a line each; nulls count as ''."""
    e = F.lit("")
    return F.concat_ws("\n", F.coalesce(name, e), F.coalesce(description, e), F.coalesce(F.array_join(topics, " "), e), F.substring(F.coalesce(readme, e), 1, 2000))


# Names under which a readme is looked for, in this order.
README_NAMES = ("README.md", "README.rst", "README", "readme.md", "Readme.md")


def readme_preview(repos: DataFrame, files: DataFrame, names: tuple[str, ...] = README_NAMES) -> DataFrame:
    """Adds readme_head to repositories: the first 2,000 characters of the first of the names that has a file that is not empty; '' if none has."""
    rank = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("file_path"))
    found = files.where(F.col("file_path").isin(*names) & (F.col("code") != "")).groupBy("repo_full_name").agg(F.min_by(F.substring("code", 1, 2000), rank).alias("readme_head"))
    return repos.drop("readme_head").join(found, "repo_full_name", "left").withColumn("readme_head", F.coalesce("readme_head", F.lit("")))


def per_source_limit(items: DataFrame, n: int, ord_col: str = "ord") -> DataFrame:
    """The first n of each source. Spark pushes the limit below the window's shuffle (WindowGroupLimit)."""
    return items.withColumn("__rn", F.row_number().over(W.partitionBy("source").orderBy(ord_col))).where(F.col("__rn") <= n).drop("__rn")


def rank(items: DataFrame, threshold: float, limit: int, ord_col: str = "ord") -> DataFrame:
    """By score, if any item has one: those of at least the threshold, best first. Else by stars. Ties in the order of ord_col."""
    scored = not items.where(F.col("semantic_score").isNotNull()).limit(1).isEmpty()
    if scored:
        return items.where(F.col("semantic_score") >= threshold).orderBy(F.desc("semantic_score"), ord_col).limit(limit)
    return items.orderBy(F.desc(F.coalesce("stars", F.lit(0))), ord_col).limit(limit)


#: Queries in a block, and bytes of all queries' vectors up to which they are broadcast; beyond that blocks meet by a join on their numbers.
BLOCK, FEW_BYTES = 1024, 32 << 20


def _blocks(vectors: DataFrame, queries: DataFrame, run, schema: str) -> DataFrame:
    """run(ids, matrix, query ids, query matrix) -> columns of schema, for packs of vectors (id, vec) and blocks of queries (q_id, q_vec).

    Rows with null vectors are left out. The queries are a stated set; every vector meets every query once, by matrix products.
    """
    queries = queries.where("q_id is not null and q_vec is not null")
    count, size = queries.agg(F.count("*"), F.coalesce(F.sum(F.size("q_vec") * 8), F.lit(0))).first()
    n = max(1, -(-count // BLOCK))
    q = queries.select(F.pmod(F.xxhash64("q_id"), F.lit(n)).cast("int").alias("block"), "q_id", F.col("q_vec").cast("array<double>").alias("q_vec"))
    q = q.groupBy("block").agg(F.collect_list(F.struct("q_id", "q_vec")).alias("q"))  # BLOCK queries or so

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            p = p[p.vec.notna()]
            if len(p):
                yield pd.DataFrame({"ids": [p.id.to_numpy(np.int64).tobytes()], "vecs": [np.stack(p.vec.to_list()).astype(np.float64).tobytes()]})

    packed = vectors.select("id", F.col("vec").cast("array<double>").alias("vec")).mapInPandas(pack, "ids binary, vecs binary")
    pairs = packed.join(F.broadcast(q)) if size <= FEW_BYTES else packed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).join(q, "block")

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in schema.split(", ")]
        for p in batches:
            for ids, vecs, qs in zip(p.ids, p.vecs, p.q, strict=True):
                i = np.frombuffer(ids, np.int64)
                a, b = np.frombuffer(vecs).reshape(len(i), -1), np.stack([x["q_vec"] for x in qs])
                unit = lambda m: m / (np.linalg.norm(m, axis=1, keepdims=True) + EPS)
                # rounded far below any difference that counts, so that equal vectors tie
                sims = np.round(unit(b) @ unit(a).T, 12)
                yield pd.DataFrame(dict(zip(names, run(i, sims, np.array([x["q_id"] for x in qs], np.int64)), strict=True)))

    return pairs.select("ids", "vecs", "q").mapInPandas(meet, schema)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(q_id, id, sim): the k vectors with the highest cosine for each query, ties to the smaller id. Each task keeps k of its own, so
    no more than that is shuffled, whatever the number of vectors."""

    def best(ids: np.ndarray, sims: np.ndarray, q: np.ndarray):
        take = min(k, len(ids))
        cut = np.partition(sims, len(ids) - take, axis=1)[:, len(ids) - take]
        rows = []
        for i in range(len(q)):
            near = np.flatnonzero(sims[i] >= cut[i])
            rows.append(near[np.lexsort((ids[near], -sims[i, near]))[:take]])
        at = np.concatenate(rows)
        of = np.repeat(np.arange(len(q)), take)
        return q[of], ids[at], sims[of, at]

    top = _blocks(vectors, queries, best, "q_id bigint, id bigint, sim double")
    return top.withColumn("__rn", F.row_number().over(W.partitionBy("q_id").orderBy(F.desc("sim"), "id"))).where(F.col("__rn") <= k).drop("__rn")


def count_near(vectors: DataFrame, queries: DataFrame, threshold: float) -> DataFrame:
    """(q_id, n): how many vectors besides the query itself have a cosine of the threshold or more; queries without any are left out."""

    def near(ids: np.ndarray, sims: np.ndarray, q: np.ndarray):
        return q, ((sims >= threshold) & (ids[None, :] != q[:, None])).sum(axis=1)

    return _blocks(vectors, queries, near, "q_id bigint, n bigint").groupBy("q_id").agg(F.sum("n").alias("n")).where("n > 0")


def scored(items: DataFrame, vector: str, query: list[float] | None) -> DataFrame:
    """items with semantic_score, the cosine of their vector with the query's; null without a query."""
    score = F.lit(None).cast("double") if query is None else cosine(F.col(vector), F.array(*[F.lit(float(x)) for x in query]))
    return items.withColumn("semantic_score", score)


def precision_at_10(top: DataFrame, lo: float = 0.5, hi: float = 0.9, steps: int = 9) -> DataFrame:
    """Of the ten nearest of each query (`nearest`) (q_id, k, threshold, p10): the share of ten that lies above the threshold."""
    grid = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.lit(round(lo + (hi - lo) * i / (steps - 1), 10)).alias("threshold")) for i in range(steps)]))
    return (
        top.withColumn("g", grid)
        .groupBy("q_id", F.col("g.k").alias("k"), F.col("g.threshold").alias("threshold"))
        .agg((F.count_if(F.col("sim") >= F.col("g.threshold")) / 10).alias("p10"))
    )


def calibrate(top: DataFrame) -> DataFrame:
    """One row (threshold, p10): the best over queries and thresholds, ties to the earliest; (FALLBACK, 0) if none is above 0."""
    best = precision_at_10(top).where("p10 > 0").agg(F.max_by(F.struct("threshold", "p10"), F.struct("p10", -F.col("q_id"), -F.col("k"))).alias("b"))
    return best.select(F.coalesce("b.threshold", F.lit(FALLBACK)).alias("threshold"), F.coalesce("b.p10", F.lit(0.0)).alias("p10"))


def cache_misses(items: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Items whose content hash is not in the cache."""
    return items.join(cache.select(key).distinct(), key, "left_anti")


def cache_hits(items: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    return items.join(cache.groupBy(key).agg(F.first("value").alias("value")), key)


def embed(texts: DataFrame, column: str, out: str, encoder) -> DataFrame:
    """Adds vectors by an encoder (a callable list[str] -> array), made once per Python worker from a factory; None gives nulls."""
    if encoder is None:
        return texts.withColumn(out, F.lit(None).cast("array<float>"))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        f = encoder()
        for s in batches:
            yield pd.Series([[float(x) for x in v] for v in f([t or "" for t in s])])

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return texts.withColumn(out, F.pandas_udf(run, "array<float>")(F.col(column)))


def discover(listings: dict[str, DataFrame], keywords: str, languages: tuple[str, ...], min_stars: int, topk: int, threshold: float, limit: int, readmes: DataFrame | None = None, encoder=None, query: str = "") -> DataFrame:
    """The search as a whole: at most topk repositories of each site ('github', 'gitlab': rows of sources.search.LISTING with ord), merged,
    with their readmes' heads (files: repo_full_name, file_path, code), ranked by an encoder's vectors against the query, or by
    stars where there is no encoder, and the first `limit` of them."""
    from loamline.sources import search

    found = [getattr(search, site)(listings[site], keywords, languages, min_stars, topk) for site in ("github", "gitlab") if site in listings]
    items = merge_sources(*found)
    if readmes is not None:
        items = readme_preview(items, readmes)
    made = encoder() if encoder is not None and query else None
    wanted = [float(x) for x in made([query])[0]] if made else None
    text = corpus_text(F.col("repo_full_name"), F.col("description"), F.col("topics"), F.col("readme_head"))
    items = embed(items.withColumn("__text", text), "__text", "__vec", encoder if made else None)
    return rank(scored(items, "__vec", wanted), threshold, limit).drop("__text", "__vec")
