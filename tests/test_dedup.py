import random

import pytest
from pyspark.sql import functions as F

from loamline.operators import dedup


def shingle_set(t, k):
    w = t.split()
    return {" ".join(w[i : i + k]) for i in range(len(w) - k + 1)}


def make(n=60):
    r = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [[r.choice(words) for _ in range(40)] for _ in range(12)]
    rows = []
    for i in range(n):
        w = list(r.choice(base))
        for _ in range(r.choice((0, 0, 1, 2, 6))):
            w[r.randrange(len(w))] = r.choice(words)
        rows.append((i, " ".join(w)))
    return rows + [(n, ""), (n + 1, "short text"), (n + 2, "short text")]


@pytest.mark.parametrize("t", [0.5, 0.8])
def test_near_pairs_match_brute_force(spark, t):
    rows = make()
    got = {(r.a, r.b): r.jaccard for r in dedup.near_pairs(spark.createDataFrame(rows, "id bigint, text string"), 5, t).collect()}
    want = {}
    for i, x in rows:
        for j, y in rows:
            a, b = shingle_set(x, 5), shingle_set(y, 5)
            if i < j and a and b and len(a & b) / len(a | b) >= t:
                want[i, j] = len(a & b) / len(a | b)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


def greedy(ids, edges):
    near = {i: set() for i in ids}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    dropped, kept = set(), []
    for i in sorted(ids):
        if i not in dropped:
            kept.append(i)
            dropped |= {j for j in near[i] if j > i}
    return kept


def test_greedy_keep_equals_the_scan(spark):
    r = random.Random(2)
    for n, m in ((5, 0), (12, 18), (30, 50)):
        edges = {tuple(sorted(r.sample(range(n), 2))) for _ in range(m)}
        nodes = spark.range(n)
        pairs = spark.createDataFrame(list(edges) or [(0, 0)], "a bigint, b bigint")
        assert sorted(x.id for x in dedup.greedy_keep(nodes, pairs).collect()) == greedy(range(n), edges)


def test_greedy_chain_keeps_both_ends(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 3)], "a bigint, b bigint")
    assert sorted(r.id for r in dedup.greedy_keep(spark.range(1, 4), pairs).collect()) == [1, 3]


def test_exact_dedup_order_ties_and_nulls(spark):
    rows = [("b", "f", 1, 1, "x", 0), ("a", "g", 1, 2, "x", 0), ("a", "g", 1, 3, "x", 0), (None, None, None, 4, "y", 0), ("z", "z", 1, 5, None, 0), ("z", "z", 1, 6, None, 0)]
    df = spark.createDataFrame(rows, "repo_full_name string, file_path string, start_line int, record_id bigint, code_norm string, extra int")
    out = dedup.exact_dedup(df)
    assert sorted(r.record_id for r in out.collect()) == [2, 4, 5, 6]
    assert "extra" in out.columns
    assert dedup.exact_dedup(df.where("false")).count() == 0


def test_representatives(spark):
    df = spark.createDataFrame([(3, "x"), (1, "x"), (2, None), (4, None)], "id bigint, text string")
    assert sorted(map(tuple, dedup.representatives(df).collect())) == [(1, 1), (2, 2), (3, 1), (4, 4)]


def test_short_units_collapse_only_if_asked(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "d e f g h i j k")], "id bigint, text string")
    assert dedup.lsh_candidates(df, 7, 0.85).count() == 0
    assert [tuple(r) for r in dedup.lsh_candidates(df, 7, 0.85, collapse_short=True).collect()] == [(1, 2)]


def test_bandings():
    assert dedup.banding(0.85, 128) == (8, 16)
    b, r = dedup.sure_banding(0.8, 128)
    assert (1 - 0.8**r) ** b <= 1e-4 and b * r <= 128
    more = dedup.sure_banding(0.8, 128, n=10**9)
    assert more[1] == r + 3 and (1 - 0.8 ** more[1]) ** more[0] <= 1e-4


def test_stats_of_nothing(spark):
    df = spark.createDataFrame([], "code_norm string")
    assert tuple(dedup.stats(df, df).first()) == (0, 0, 0, 1.0)
