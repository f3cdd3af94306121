"""What the operators of this subpackage share: table access, the shared folder, salted joins, connected classes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.functions import store
from loamline.functions.store import remove, shared_dir, spread  # noqa: F401  (used by the other modules)

#: Rows per Arrow batch for functions that read texts, so that one batch stays small in a Python worker.
ARROW_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """Writes the rows below path and reads them back: cuts the lineage and survives the loss of executors."""
    if not partition_by:
        return store.written(df, path)
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def flat_tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """White-space tokens of a batch of texts as (text number, token hash, occurrence of that token in its text).

    Hashes are 64 bits (XXH3) of the token's UTF-8 form. Null texts have no tokens.
    """
    import xxhash

    lists = [t.split() if t else [] for t in texts]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    codes, names = pd.factorize(np.array([w for x in lists for w in x], dtype=object))
    own = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in names), np.uint64, len(names))
    doc = np.repeat(np.arange(len(lists)), counts)
    hashes = own[codes] if len(codes) else np.empty(0, np.uint64)
    if not len(codes):
        return doc, hashes, np.empty(0, np.int64)
    key = doc * (len(names) + 1) + codes
    order = np.argsort(key, kind="stable")
    s = key[order]
    first = np.r_[True, s[1:] != s[:-1]]
    start = np.maximum.accumulate(np.where(first, np.arange(len(s)), 0))
    occ = np.empty(len(s), np.int64)
    occ[order] = np.arange(len(s)) - start
    return doc, hashes, occ


def text_keys(texts: list[str]) -> list[bytes]:
    """128-bit keys of the token sequences."""
    import xxhash

    return [xxhash.xxh3_128_digest(" ".join(t.split()).encode("utf-8", "surrogatepass")) for t in texts]


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finalizer."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def element_hashes(hashes: np.ndarray, occ: np.ndarray) -> np.ndarray:
    """Elements (token, occurrence): the Jaccard of such sets is that of the token multisets."""
    with np.errstate(over="ignore"):
        return mix64(hashes + occ.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def multiset_jaccard(a: str, b: str) -> float:
    """Tokens in common, with multiplicity, over those of both together less those in common; 0 if neither has tokens."""
    from collections import Counter

    x, y = Counter(a.split()), Counter(b.split())
    common = sum((x & y).values())
    either = sum(x.values()) + sum(y.values()) - common
    return common / either if either else 0.0


def shared_elements(x: str, y: str):
    """Jaccard of two columns of distinct elements (arrays): all in the JVM."""
    common = F.size(F.array_intersect(x, y))
    return common / F.greatest(F.size(x) + F.size(y) - common, F.lit(1))


def elements(texts: DataFrame) -> DataFrame:
    """(id, elements): the distinct 64-bit hashes of (token, occurrence) of each text (id, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            doc, h, occ = flat_tokens(p.text.tolist())
            n = np.bincount(doc, minlength=len(p))
            yield pd.DataFrame({"id": p.id.to_numpy(np.int64), "elements": np.split(element_hashes(h, occ).view(np.int64), np.cumsum(n)[:-1])})

    return texts.select("id", "text").mapInPandas(run, "id bigint, elements array<bigint>")


def verified_pairs(pairs: DataFrame, hashed: DataFrame, threshold: float) -> DataFrame:
    """Of pairs (a, b) of distinct ids those whose elements (id, elements) have a Jaccard of the threshold or more.

    Hashes travel, not texts: eight bytes a token, and what is compared are the pairs that survived the sketches.
    """
    x = hashed.select(F.col("id").alias("a"), F.col("elements").alias("x"))
    y = hashed.select(F.col("id").alias("b"), F.col("elements").alias("y"))
    joined = pairs.join(x, "a").join(y, "b")
    return joined.select("a", "b", shared_elements("x", "y").alias("similarity")).where(F.col("similarity") >= threshold)


def salted_members(members: DataFrame, key: str, row: str, block: int = 2000) -> tuple[DataFrame, DataFrame]:
    """Two forms of (key, row) for an equi-join of a class with itself or another: left once, right repeated per salt.

    A class of more than `block` rows is cut on the left into blocks, and the right side repeated once per block,
    so no task gets more than a block times the class at once, whatever the class's size.
    """
    sizes = members.groupBy(key).agg(F.count("*").alias("n_members"))
    big = sizes.where(F.col("n_members") > 1)
    salts = F.greatest(F.lit(1), F.ceil(F.col("n_members") / block)).cast("int")
    m = members.join(big, key).withColumn("n_salts", salts)
    left = m.select(key, row, F.pmod(F.xxhash64(row), F.col("n_salts")).cast("int").alias("salt"))
    right = m.select(key, row, F.explode(F.sequence(F.lit(0), F.col("n_salts") - 1)).alias("salt"))
    return left, right


def components(edges: DataFrame, path: str) -> DataFrame:
    """Connected components of (a, b): rows (id, class_id), class_id the smallest id reached.

    Large-star and small-star rounds (Kiveris et al., 2014), each written to the shared folder. A round moves every
    edge at least one step towards its root, so the rounds are about the logarithm of the longest chain; they go on until
    nothing moves.
    """
    spark = edges.sparkSession
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{path}/e0")
    for i in count(1):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        root = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(root, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lo = large.where("u <> v").distinct()
        sroot = lo.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            lo.join(sroot, "u")
            .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.*")
            .where("u <> v")
            .distinct()
        )
        new = written(small, f"{path}/e{i}")
        a, b = [d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() for d in (e, new)]
        if tuple(a) == tuple(b):
            break
        remove(spark, f"{path}/e{i - 1}")
        e = new
    pairs = new.select(F.col("u").alias("id"), F.col("v").alias("class_id"))
    return pairs.union(pairs.select(F.col("class_id").alias("id"), "class_id").distinct())
