"""Exact and near duplicates of code units.

Records with blank or null text are never duplicates of anything here and are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loamline.functions import text as T
from loamline.functions.store import remove, shared_dir, written

ORDER = ("repo_full_name", "file_path", "start_line", "record_id")


def keep_first(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key, the first in the given total order (nulls first). Rows with a null key are all kept.

    The first is found by an aggregation, which combines on the map side, not by a window that would gather a hot key.
    """
    best = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*order)).alias("__first"))
    firsts = best.select(*[F.col(f"__first.{c}").alias(c) for c in order])
    cond = [df[c].eqNullSafe(firsts[c]) for c in order]
    on = cond[0]
    for c in cond[1:]:
        on = on & c
    return df.join(firsts, on, "left_semi").union(df.where(F.col(key).isNull()))


def exact_dedup(units: DataFrame, order: tuple[str, ...] = ORDER) -> DataFrame:
    """First of each normalized text; adds content_hash (SHA-256 hex)."""
    return keep_first(units.withColumn("content_hash", T.content_hash("code_norm")), "content_hash", *order)


def stats(units: DataFrame, near_unique: DataFrame) -> DataFrame:
    """total, exact_unique, near_unique and the duplication rate, one row (also for an empty input)."""
    u = units.agg(F.count("*").alias("total"), F.count_distinct(T.content_hash("code_norm")).alias("exact_unique"))
    return u.join(near_unique.agg(F.count("*").alias("near_unique"))).withColumn(
        "duplication_rate", F.round(1 - F.col("near_unique") / F.greatest("total", F.lit(1)), 6)
    )


def banding(threshold: float, perms: int) -> tuple[int, int]:
    """(bands, rows) that minimize the area of false positives plus false negatives of the S-curve 1-(1-s^r)^b."""
    s = np.linspace(0, 1, 1001)
    best = (math.inf, 1, perms)
    for b in range(1, perms + 1):
        r = perms // b
        p = 1 - (1 - s**r) ** b
        cost = float(p[s < threshold].sum() + (1 - p[s >= threshold]).sum())
        best = min(best, (round(cost, 9), b, r))
    return best[1], best[2]


def sure_banding(threshold: float, perms: int, miss: float = 1e-4, n: int = 0) -> tuple[int, int]:
    """(bands, rows): the most rows for which a pair at the threshold is missed with at most the given probability.

    For n texts beyond a million a row more for each power of ten, and as many bands as that takes: so the texts that share a
    band by chance do not grow in number with the collection.
    """
    r = next((r for r in range(perms, 0, -1) if (1 - threshold**r) ** (perms // r) <= miss), 1)
    r += max(0, math.ceil(math.log10(max(n, 1))) - 6)
    return max(perms // r, math.ceil(math.log(miss) / math.log(1 - threshold**r))) if threshold < 1 else perms // r, r


#: Minima of which one bit each goes into the sketch, and the standard deviations that its bound allows.
SKETCH, SIGMAS = 128, 4.5


def sketch_bound(threshold: float) -> int:
    """Most bits in which the sketches of two texts at the threshold differ (b-bit minwise hashing with b = 1)."""
    p = (1 - threshold) / 2
    return math.ceil(SKETCH * p + SIGMAS * math.sqrt(SKETCH * p * (1 - p)))


def _minima(x: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """functions x texts: the minima of the functions' values over the elements x of texts that begin at starts."""
    out = np.empty((len(a), len(starts)), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(len(a)):
            out[j] = np.minimum.reduceat((x * a[j] + b[j]) >> np.uint64(16), starts)
    return out


def _keys(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """texts x bands: hashes of `rows` minima each."""
    out = np.empty((minima.shape[1], bands), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(bands):
            h = np.full(minima.shape[1], k + 1, np.uint64)
            for m in minima[k * rows : (k + 1) * rows]:
                h = (h ^ m) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            out[:, k] = h
    return out


def minhash_bands(shingled: DataFrame, perms: int, bands: int, rows: int, collapse_short: bool = False) -> DataFrame:
    """Of (id, shingles array<bigint>) rows (id, band_key, n, s0, s1): the number of shingles and the sketch. Empty shingle sets give
    none, or, with collapse_short, all the same."""
    functions = max(SKETCH, bands * rows, perms)
    rng = np.random.default_rng(1)
    a = rng.integers(1, 2**63, functions, dtype=np.uint64) | np.uint64(1)
    b = rng.integers(0, 2**63, functions, dtype=np.uint64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            n = np.fromiter(map(len, p.shingles), np.int64, len(p))
            some = np.flatnonzero(n)
            ids = p.id.to_numpy()
            if len(some):
                x = np.concatenate([np.asarray(p.shingles.iloc[i], np.int64) for i in some]).view(np.uint64)
                m = _minima(x, np.cumsum(n[some]) - n[some], a, b)
                bits = ((m[:SKETCH] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(63)).astype(np.uint8)
                s = np.repeat(np.packbits(np.ascontiguousarray(bits.T), axis=1).view("<i8"), bands, axis=0)
                yield pd.DataFrame({"id": np.repeat(ids[some], bands), "band_key": _keys(m, bands, rows).ravel().view(np.int64), "n": np.repeat(n[some], bands), "s0": s[:, 0], "s1": s[:, 1]})
            if collapse_short and len(some) < len(p):
                none = np.flatnonzero(n == 0)
                yield pd.DataFrame({"id": np.repeat(ids[none], bands), "band_key": np.tile(np.arange(bands), len(none)), "n": 0, "s0": 0, "s1": 0})

    return shingled.select("id", "shingles").mapInPandas(run, "id bigint, band_key bigint, n bigint, s0 bigint, s1 bigint")


def shingled(units: DataFrame, k: int) -> DataFrame:
    """(id, shingles) with 64-bit hashes of the distinct k-token shingles."""
    return units.select("id", T.shingle_hashes(T.tokens("text"), k).alias("shingles"))


def _sharing(bands: DataFrame, *more) -> DataFrame:
    """Distinct pairs (a < b) of rows of minhash_bands that share a band and meet the further conditions on x and y."""
    x, y = bands.alias("x"), bands.alias("y")
    cond = (F.col("x.band_key") == F.col("y.band_key")) & (F.col("x.id") < F.col("y.id"))
    for c in more:
        cond = cond & c
    return x.join(y, cond).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def lsh_candidates(units: DataFrame, k: int, threshold: float, perms: int = 128, sure: bool = False, collapse_short: bool = False) -> DataFrame:
    """Pairs (a < b) of (id, text) rows that share a whole band, unverified."""
    b, r = sure_banding(threshold, perms) if sure else banding(threshold, perms)
    return _sharing(minhash_bands(shingled(units, k), perms, b, r, collapse_short))


def near_pairs(units: DataFrame, k: int = 5, threshold: float = 0.8, perms: int = 128) -> DataFrame:
    """Pairs (a < b, jaccard) of distinct texts whose shingle sets have a Jaccard of the threshold or more (LSH, then exact).

    Within the join on a band, sizes (exact: a Jaccard of t needs a ratio of t) and sketches tell most chance pairs apart, so few
    shingle sets travel.
    """
    sh = written(shingled(units, k).where(F.size("shingles") > 0), f"{shared_dir(units.sparkSession)}/shingles")
    b, r = sure_banding(threshold, perms, n=sh.count())
    apart = sum(F.bit_count(F.col(f"x.{s}").bitwiseXOR(F.col(f"y.{s}"))) for s in ("s0", "s1"))
    size = (F.col("x.n") >= F.col("y.n") * threshold) & (F.col("y.n") >= F.col("x.n") * threshold)
    cand = _sharing(minhash_bands(sh, perms, b, r), size, apart <= sketch_bound(threshold))
    sides = cand.join(sh.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a").join(sh.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return sides.select("a", "b", (common / (F.size("sa") + F.size("sb") - common)).alias("jaccard")).where(F.col("jaccard") >= threshold)


def representatives(units: DataFrame) -> DataFrame:
    """(id, rep): the smallest id with the same text; null texts represent themselves."""
    h = units.select("id", T.content_hash("text").alias("h"))
    rep = h.where("h is not null").groupBy("h").agg(F.min("id").alias("rep"))
    return h.where("h is not null").join(rep, "h").select("id", "rep").union(h.where("h is null").select("id", F.col("id").alias("rep")))


def greedy_keep(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id) kept by the sequential scan in ascending order that drops the neighbours of what it keeps.

    That is the lexicographically first maximal independent set. Per round: what has no undecided smaller neighbour is
    kept, its neighbours are dropped. Each round decides some node, so it ends; rounds follow the longest ascending chain of
    undecided nodes; each is written.
    """
    spark = nodes.sparkSession
    path = shared_dir(spark)
    edges = written(pairs.select("a", "b").where("a < b").distinct(), f"{path}/e0")
    dropped = None
    for i in count(1):
        if edges.isEmpty():
            break
        later = edges.select(F.col("b").alias("a")).distinct()
        keep = edges.select("a").distinct().join(later, "a", "left_anti")
        drop = written(edges.join(keep, "a", "left_semi").select(F.col("b").alias("id")).distinct(), f"{path}/d{i}")
        dropped = drop if dropped is None else dropped.union(drop)
        gone = drop.withColumnRenamed("id", "x")
        rest = edges.join(keep, "a", "left_anti").join(gone, F.col("a") == F.col("x"), "left_anti").join(gone, F.col("b") == F.col("x"), "left_anti")
        edges = written(rest, f"{path}/e{i}")
        remove(spark, f"{path}/e{i - 1}")
    return nodes.select("id") if dropped is None else nodes.select("id").join(dropped, "id", "left_anti")
