"""Problem 9: mixtures of sources by target shares.

Systematic sampling. Within a source, every document of a mix has the same expected number of copies,

    rate = min(max_repeats, target tokens of the source / tokens the source has),  target = share * size_ratio * all tokens.

The expected copies are summed up along the source's documents, one random offset per (mix, source) is added, and a
document comes out once per integer that the running sum passes on it: floor(rate) or ceil(rate) times, never more
than max_repeats. The documents are walked by size class, up and down again, so the tokens reached differ from the target by about one document.

Running sums come without a window over a whole source: documents fall into blocks (source, size class, hash bucket)
of bounded size, the blocks' counts are summed up, and ranks are counted within blocks.

Cases: texts that are null or empty have no tokens and are in no mix; a source without documents, an unknown source or
a null share reaches 0 tokens and is reported. A source that is too small even at max_repeats cannot give its share of the
size asked for, so one of two things gives way, by the parameter `keep`: with 'size' (the default) the source is used in full
max_repeats times, falls short and is reported (`capped`), and the others give what is asked of them; with 'shares' the whole
mix shrinks to what the scarcest source can give, so the shares hold among the sources that have documents. Either way the
distance from the shares asked for is reported. Repeated rows are documents of their own. The sample depends on the seed, on doc_id and the sizes only, not on partitions or order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

ROWS_PER_BLOCK = 50_000


def ranked(sizes: DataFrame) -> DataFrame:
    """Of rows (doc_id, source, n_tokens > 0) each one's rank (from 1) within its source, in order of size class."""
    total = sizes.count()
    buckets = max(1, -(-total // ROWS_PER_BLOCK))
    d = sizes.withColumn("size_class", F.floor(F.log2(F.col("n_tokens").cast("double")) * 4).cast("int")).withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int")
    )
    # even classes from small to large, then odd ones from large to small: the walk begins and ends at small documents, where
    # what the offset cuts off weighs little, and what it picks too large on the way up it picks too small on the way down
    d = d.withColumn("place", F.when(F.pmod("size_class", F.lit(2)) == 0, F.col("size_class")).otherwise(F.lit(2000) - F.col("size_class")))
    block = ["source", "place", "bucket"]
    before = W.partitionBy("source").orderBy("place", "bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = d.groupBy(*block).agg(F.count("*").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    turn = F.col("n_tokens") * (1 - 2 * F.pmod("size_class", F.lit(2)))
    local = F.row_number().over(W.partitionBy(*block).orderBy(turn, F.xxhash64("doc_id"), "doc_id"))
    return (
        d.withColumn("local", local)
        .join(counts.drop("n"), block)
        .select("doc_id", "source", "n_tokens", (F.col("local") + F.col("offset")).alias("rank"))
    )


def rates(sizes: DataFrame, targets: DataFrame, keep: str = "size") -> DataFrame:
    """Per (mix_name, source): target and available tokens, the rate and whether the repeat limit binds."""
    if keep not in ("size", "shares"):
        raise ValueError(f"keep: {keep}")
    have = sizes.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"), F.count("*").alias("available_docs"))
    everything = have.agg(F.sum("available_tokens").alias("all_tokens"))
    t = targets.select("mix_name", "source", "target_share", "max_repeats", "size_ratio").distinct()
    goal = F.coalesce(F.col("target_share") * F.col("size_ratio") * F.col("all_tokens"), F.lit(0.0))
    r = (
        t.join(have, "source", "left")
        .join(everything)  # one row
        .withColumn("target_tokens", goal)
        .withColumn("available_tokens", F.coalesce("available_tokens", F.lit(0)))
        .withColumn("available_docs", F.coalesce("available_docs", F.lit(0)))
        .withColumn("wanted", F.when(F.col("available_tokens") > 0, F.col("target_tokens") / F.col("available_tokens")).otherwise(F.lit(0.0)))
        .withColumn("most", F.coalesce(F.col("max_repeats"), F.lit(1)).cast("double"))
        .withColumn("capped", (F.col("wanted") > F.col("most")) | ((F.col("available_tokens") == 0) & (F.col("target_tokens") > 0)))
    )
    if keep == "shares":  # by how much the mix shrinks, from the source that falls shortest
        shrink = F.min(F.when(F.col("wanted") > F.col("most"), F.col("most") / F.col("wanted"))).over(W.partitionBy("mix_name"))
        r = r.withColumn("wanted", F.col("wanted") * F.coalesce(shrink, F.lit(1.0)))
    return r.withColumn("rate", F.least("wanted", "most")).drop("all_tokens", "wanted", "most")


def sample(ranks: DataFrame, rate: DataFrame, seed: int = 17) -> DataFrame:
    """One row (mix_name, source, doc_id, copy_no, n_tokens) per copy."""
    r = rate.where("rate > 0").select("mix_name", "source", "rate")
    u = (F.pmod(F.xxhash64(F.lit(seed), "mix_name", "source"), F.lit(1 << 30)) + 0.5) / F.lit(float(1 << 30))
    d = ranks.join(r, "source").withColumn("u", u)
    passed = F.floor(F.col("rank") * F.col("rate") + F.col("u")) - F.floor((F.col("rank") - 1) * F.col("rate") + F.col("u"))
    return (
        d.withColumn("copies", passed.cast("int"))
        .where("copies > 0")
        .select("mix_name", "source", "doc_id", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no"), "n_tokens")
    )


def shares(picked: DataFrame, rate: DataFrame) -> DataFrame:
    """Target against reached tokens and shares per (mix_name, source); every source of a mix has a row.

    off: the distance of the mix from its shares, half the sum of the sources' differences (0: met, 1: nothing in common).
    """
    got = picked.groupBy("mix_name", "source").agg(
        F.sum("n_tokens").alias("tokens"), F.count("*").alias("copies"), F.count_distinct("doc_id").alias("documents"), F.max("copy_no").alias("most_copies")
    )
    all_of_mix = W.partitionBy("mix_name")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return (
        rate.join(got, ["mix_name", "source"], "left")
        .select("mix_name", "source", "target_share", "max_repeats", F.round("target_tokens", 3).alias("target_tokens"), "available_tokens", "capped", zero("tokens"), zero("copies"), zero("documents"), zero("most_copies"))
        .withColumn("mix_tokens", F.sum("tokens").over(all_of_mix))
        .withColumn("actual_share", F.when(F.col("mix_tokens") > 0, F.round(F.col("tokens") / F.col("mix_tokens"), 6)).otherwise(F.lit(0.0)))
        .withColumn("off", F.round(F.sum(F.abs(F.col("actual_share") - F.coalesce("target_share", F.lit(0.0)))).over(all_of_mix) / 2, 6))
    )
