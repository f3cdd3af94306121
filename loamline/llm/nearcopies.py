"""Problem 1: near-duplicate records by odd sketches.

Similarity is the Jaccard of the records' white-space token multisets. Steps:

1. Records with the same token sequence form a class; only classes are compared (`signatures`).
2. Every class has SAMPLES MinHash values of its elements (token, occurrence). Bands of them are the candidate keys;
   all of them are folded into an odd sketch (Mitzenmacher, Pagh and Pham, 2014): value i flips bit hash(i, value) of
   a bitmap of BITS bits. The bits in which two sketches differ, a XOR and a population count, estimate how many
   samples differ, the more precisely the higher the similarity.
3. Classes that share a band are joined on it; the join condition bounds their sizes' ratio (exact: a Jaccard of t needs
   a ratio of t) and the sketches' distance, so only likely pairs leave the join (`candidates`).
4. Those are checked exactly on the hashed elements of their texts (`verified_pairs`).
5. Pairs of classes are expanded to pairs of records where a query asks for it; classes of many members are salted.

How likely a pair at the threshold is lost: (1 - t^rows)^bands <= MISS by the bands, and 0.0005 by the sketch bound of
3.3 standard deviations; both fall fast above the threshold. The rows per band grow with the logarithm of the number
of classes, which keeps the chance candidates per class bounded (`banding`).

Cases: null, empty and white-space-only texts are in no pair; identical texts have similarity 1; texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.common import components, element_hashes, elements, flat_tokens, mix64, salted_members, text_keys, verified_pairs, written

BITS, WORDS, SAMPLES, MISS, SIGMAS = 320, 5, 160, 0.002, 3.3


def banding(threshold: float, n: int) -> tuple[int, int]:
    """(rows per band, bands) for n classes: a row more for each power of ten above a million."""
    rows = 4 + max(0, math.ceil(math.log10(max(n, 1))) - 6)
    return rows, math.ceil(math.log(MISS) / math.log(1 - threshold**rows))


def sketch_bound(threshold: float) -> int:
    """Most bits in which the sketches of a pair at the threshold differ, SIGMAS standard deviations included."""
    flips = 2 * SAMPLES * (1 - threshold)
    mean = BITS / 2 * (1 - math.exp(-2 * flips / BITS))
    slope = math.exp(-2 * flips / BITS)
    of_samples = 2 * math.sqrt(SAMPLES * threshold * (1 - threshold)) * slope
    of_bits = math.sqrt(BITS) / 2 * math.sqrt(max(1e-9, 1 - slope**2))
    return math.ceil(mean + SIGMAS * math.hypot(of_samples, of_bits))


def minhashes(elements: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """count x texts: the minima of count hash functions over each text's elements (starts: where each begins)."""
    seeds = mix64(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.empty((count, len(starts)), np.uint64)
    with np.errstate(over="ignore"):
        for i, s in enumerate(seeds):
            x = elements ^ s
            x *= s | np.uint64(1)
            x ^= x >> np.uint64(32)
            out[i] = np.minimum.reduceat(x, starts)
    return out


def odd_sketch(mins: np.ndarray) -> np.ndarray:
    """texts x WORDS (int64): parity of the number of samples that fall on each bit."""
    k, n = mins.shape
    with np.errstate(over="ignore"):
        bit = (mix64(mins + np.arange(k, dtype=np.uint64)[:, None] * np.uint64(0xD1B54A32D192ED03)) % np.uint64(BITS)).astype(np.int64)
    flat = (bit + np.arange(n) * BITS).ravel()
    parity = (np.bincount(flat, minlength=n * BITS) & 1).astype(np.uint8).reshape(n, BITS)
    return np.packbits(parity, axis=1).view(">i8").astype(np.int64)


def band_keys(mins: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """texts x bands (int64) of hashes of `rows` consecutive samples."""
    out = np.empty((mins.shape[1], bands), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            x = np.full(mins.shape[1], b + 1, np.uint64)
            for r in range(rows):
                x = mix64(x * np.uint64(0x9E3779B97F4A7C15) + mins[b * rows + r])
            out[:, b] = x
    return out.view(np.int64)


def signatures(records: DataFrame, rows: int, bands: int) -> DataFrame:
    """Of rows (id, text) with tokens: id, key (of the token sequence), n (tokens), sketch, bands."""
    most = max(SAMPLES, rows * bands)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            p = p[[isinstance(t, str) and not (t == "" or t.isspace()) for t in p.text]]
            if not len(p):
                continue
            texts = p.text.tolist()
            doc, h, occ = flat_tokens(texts)
            n = np.bincount(doc, minlength=len(texts))
            starts = np.cumsum(n) - n
            mins = minhashes(element_hashes(h, occ), starts, most)
            yield pd.DataFrame(
                {
                    "id": p.id.to_numpy(),
                    "key": text_keys(texts),
                    "n": n.astype(np.int32),
                    "sketch": list(odd_sketch(mins[:SAMPLES])),
                    "bands": list(band_keys(mins, rows, bands)),
                }
            )

    return records.select("id", "text").mapInPandas(sign, "id bigint, key binary, n int, sketch array<bigint>, bands array<bigint>")


def keys(records: DataFrame) -> DataFrame:
    """(id, key of the token sequence) of the records with tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            p = p[[isinstance(t, str) and not (t == "" or t.isspace()) for t in p.text]]
            yield pd.DataFrame({"id": p.id, "key": text_keys(p.text.tolist())})

    return records.select("id", "text").mapInPandas(run, "id bigint, key binary")


def classes(records: DataFrame, rows: int, bands: int, path: str) -> tuple[DataFrame, DataFrame]:
    """(classes: rep, n, sketch, bands; members: rep, id). A class's rep is its smallest id. Both are written."""
    signed = signatures(records, rows, bands)
    reps = signed.groupBy("key").agg(F.min_by(F.struct("id", "n", "sketch", "bands"), "id").alias("r"), F.count("*").alias("n_members"))
    reps = written(reps.select("key", F.col("r.id").alias("rep"), F.col("r.n").alias("n"), F.col("r.sketch").alias("sketch"), F.col("r.bands").alias("bands"), "n_members"), f"{path}/classes")
    multiple = reps.where("n_members > 1").select("key", "rep")
    # members of classes of one need no join: the class is the record
    copies = keys(records).join(multiple, "key").select("rep", "id")
    members = written(copies, f"{path}/copies").union(reps.where("n_members = 1").select("rep", F.col("rep").alias("id")))
    return reps.select("rep", "n", "sketch", "bands"), members


def candidates(reps: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs (a < b) of reps that share a band and whose sketches are near enough."""
    one = reps.select(
        F.posexplode("bands").alias("band", "hash"), F.col("rep"), F.col("n"), *[F.col("sketch")[i].alias(f"s{i}") for i in range(WORDS)]
    ).select((F.col("hash").bitwiseXOR(F.col("band").cast("bigint"))).alias("k"), "rep", "n", *[f"s{i}" for i in range(WORDS)])
    x, y = one.alias("x"), one.alias("y")
    apart = sum((F.bit_count(F.col(f"x.s{i}").bitwiseXOR(F.col(f"y.s{i}"))) for i in range(1, WORDS)), F.bit_count(F.col("x.s0").bitwiseXOR(F.col("y.s0"))))
    near = (
        (F.col("x.k") == F.col("y.k"))
        & (F.col("x.rep") < F.col("y.rep"))
        & (F.col("x.n") >= F.col("y.n") * threshold)
        & (F.col("y.n") >= F.col("x.n") * threshold)
        & (apart <= sketch_bound(threshold))
    )
    return x.join(y, near).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()


def class_pairs(records: DataFrame, threshold: float, path: str) -> tuple[DataFrame, DataFrame]:
    """(pairs of reps a < b with their similarity, members rep, id) of rows (id, text); id must be unique."""
    rows, bands = banding(threshold, records.count())
    reps, members = classes(records, rows, bands, path)
    cand = written(candidates(reps, threshold), f"{path}/candidates")
    named = cand.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    hashed = written(elements(records.join(named, "id", "left_semi")), f"{path}/elements")
    return written(verified_pairs(cand, hashed, threshold), f"{path}/pairs"), members


def record_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """All pairs (record_a < record_b): of records of one class, and of records of two similar classes."""
    left, right = salted_members(members, "rep", "id")
    within = left.withColumnRenamed("id", "i").join(right.withColumnRenamed("id", "j"), ["rep", "salt"]).where("i < j").select("i", "j")
    block = 2000
    sizes = members.groupBy("rep").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / block)).cast("int").alias("n_salts"))
    named = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    m = members.join(named, "rep", "left_semi").join(sizes, "rep").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("n_salts")).cast("int"))
    from_a = pairs.join(m.select(F.col("rep").alias("a"), F.col("id").alias("i")), "a")
    salts = sizes.select(F.col("rep").alias("b"), "n_salts")
    across = (
        from_a.join(salts, "b")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("n_salts") - 1)))
        .join(m.select(F.col("rep").alias("b"), F.col("id").alias("j"), "salt"), ["b", "salt"])
        .select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"))
    )
    return within.union(across).select(F.col("i").alias("record_a"), F.col("j").alias("record_b"))


def groups(pairs: DataFrame, members: DataFrame, path: str) -> DataFrame:
    """One row per record with tokens: record_id, class_id (smallest id linked to it over any chain), n_links (its partners)."""
    comp = written(components(pairs, f"{path}/cc"), f"{path}/components")
    size = members.groupBy("rep").agg(F.count("*").alias("size"))
    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = both.join(size.withColumnRenamed("rep", "b"), "b").groupBy("a").agg(F.sum("size").alias("others"))
    per_class = (
        size.join(links.withColumnRenamed("a", "rep"), "rep", "left")
        .join(comp.withColumnRenamed("id", "rep"), "rep", "left")
        .select("rep", F.coalesce("class_id", "rep").alias("class_id"), (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    )
    return members.join(per_class, "rep").select(F.col("id").alias("record_id"), "class_id", "n_links")
