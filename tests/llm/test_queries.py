"""The operators in Spark: whole small tables against brute force, and defined results for nulls, empties, ties, clashes."""

import glob
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from loamline.llm import bpe, docpairs, handwritten, history, languages, licenses, mixing, nearcopies, queries, secrets, syntax
from loamline.llm.common import components, multiset_jaccard, salted_members, shared_dir


def brute(rows, t=0.7):
    return {(i, j) for i, a in rows for j, b in rows if i < j and a and b and multiset_jaccard(a, b) >= t}


def records(n=120, seed=1):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    base = [[r.choice(words) for _ in range(r.choice((5, 14, 30, 60)))] for _ in range(18)]
    rows = []
    for i in range(n):
        w = list(r.choice(base))
        for _ in range(r.choice((0, 0, 0, 1, 2, 5))):
            k = r.randrange(len(w))
            w[k : k + r.choice((0, 1))] = [r.choice(words)]
        rows.append((i, r.choice((" ", "  ", "\n")).join(w)))
    return [*rows, (n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "x y z"), (n + 4, "x  y\tz"), (n + 5, "long " * 4000), (n + 6, "long " * 4100)]


def test_p1_pairs_equal_brute_force(spark):
    rows = records()
    df = spark.createDataFrame(rows, "id bigint, text string")
    pairs, members = nearcopies.class_pairs(df, 0.7, shared_dir(spark))
    got = [tuple(r) for r in nearcopies.record_pairs(pairs, members).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    groups = nearcopies.groups(pairs, members, shared_dir(spark)).collect()
    links = {}
    for a, b in brute(rows):
        links[a], links[b] = links.get(a, 0) + 1, links.get(b, 0) + 1
    assert {r.record_id: r.n_links for r in groups} == {i: links.get(i, 0) for i, t in rows if t and t.strip()}
    cls = {r.record_id: r.class_id for r in groups}
    assert all(cls[a] == cls[b] for a, b in brute(rows)) and all(v <= k for k, v in cls.items())


def test_p1_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "id bigint, text string")
    for d in (df, df.where("false")):
        assert nearcopies.record_pairs(*nearcopies.class_pairs(d, 0.7, shared_dir(spark))).count() == 0


def test_salted_classes_lose_no_pair(spark):
    m = spark.range(500).select((F.col("id") % 3 == 0).cast("bigint").alias("rep"), "id")
    left, right = salted_members(m, "rep", "id", block=20)
    n = left.withColumnRenamed("id", "i").join(right.withColumnRenamed("id", "j"), ["rep", "salt"]).where("i < j").select("i", "j").distinct().count()
    assert n == 167 * 166 // 2 + 333 * 332 // 2


def test_components(spark):
    r = random.Random(6)
    edges = [(i, i + 1) for i in range(60)] + [(r.randrange(100, 160), r.randrange(100, 160)) for _ in range(45)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    want = {x: root(x) for a, b in edges if a != b for x in (a, b)}
    got = {r.id: r.class_id for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), shared_dir(spark)).collect()}
    assert got == want


def test_p3_equals_brute_force_over_batches(spark):
    r = random.Random(5)
    rows = [(i, r.choice((0, 0, 1, 2, 2, 5)), t) for i, t in records(150, 9)] + [(900, None, "x y z"), (901, 0, "x y z")]
    df = spark.createDataFrame(rows, "id bigint, batch int, text string")
    got = {x.record_id: x.kind for x in history.duplicates(df, 0.7, shared_dir(spark)).collect()}
    want = {}
    for i, b, t in rows:
        for j, c, u in rows:
            if t and u and (c if c is not None else 99) < (b if b is not None else 99) and multiset_jaccard(t, u) >= 0.7:
                want[i] = "exact" if t == u or want.get(i) == "exact" else "near"
    assert got == want
    assert history.duplicates(df.where("false"), 0.7, shared_dir(spark)).count() == 0


def test_p3_finds_pairs_without_long_runs(spark):
    base = [f"t{i}" for i in range(60)]
    spaced = [f"x{i}" if i % 6 == 5 else w for i, w in enumerate(base)]  # 50 / 70, longest common run 5
    entries = [f"k{i}: v{i}" for i in range(40)]
    rows = [(1, 0, " ".join(base)), (2, 0, " ".join(entries)), (3, 0, " ".join(f"o{i}" for i in range(60))), (4, 1, " ".join(spaced)), (5, 1, " ".join(entries[::-1]))]
    df = spark.createDataFrame(rows, "id bigint, batch int, text string")
    assert sorted(tuple(x) for x in history.duplicates(df, 0.7, shared_dir(spark)).collect()) == [(4, "near"), (5, "near")]


def test_p3_finds_variants_of_a_large_family(spark):
    base = [f"t{i}" for i in range(60)]
    variant = lambda k: " ".join(f"v{k}.{i}" if i % 8 == 7 else w for i, w in enumerate(base))  # noqa: E731  (53 / 67, runs of 7)
    for family in (20, 300):  # the verdict on a pair must not depend on the size of the history
        rows = [(k, 0, variant(k)) for k in range(family)] + [(1000, 1, variant(1000))]
        df = spark.createDataFrame(rows, "id bigint, batch int, text string")
        assert [tuple(x) for x in history.duplicates(df, 0.7, shared_dir(spark)).collect()] == [(1000, "near")]


def test_p3_common_starts_hide_nothing(spark, monkeypatch):
    rows = [(i, r, t) for (i, t), r in zip(records(150, 11), random.Random(2).choices((0, 1, 2), k=200), strict=False)]
    df = spark.createDataFrame(rows, "id bigint, batch int, text string")
    want = {i for i, b, t in rows for j, c, u in rows if t and u and c < b and multiset_jaccard(t, u) >= 0.7}
    plain = history.History._hits
    monkeypatch.setattr(history.History, "_hits", lambda self, mine, most: plain(self, mine, most and 1))  # every start is common
    assert {x.record_id for x in history.duplicates(df, 0.7, shared_dir(spark)).collect()} == want


def test_p3_goes_on_where_it_stopped(spark):
    rows = records(160, 21)
    batch = lambda k: spark.createDataFrame([x for x in rows if x[0] % 10 == k], "id bigint, text string")
    path = shared_dir(spark)
    h = history.History.create(spark, path)
    for k in range(9):
        h.accept(batch(k), str(k))
        assert len(h.state["segments"]) <= 4
    h.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(f"loamline_{h.tag}")]
    again = history.History.open(spark, path)
    assert again.state == h.state
    found = again.accept(batch(9), "9")
    got = {x.record_id: x.kind for x in found.collect()}
    old = [t for i, t in rows if i % 10 < 9 and t and t.strip()]
    want = {i: "exact" if t in old else "near" for i, t in rows if i % 10 == 9 and t and t.strip() and any(multiset_jaccard(t, u) >= 0.7 for u in old)}
    assert got == want and want
    # nothing of the old batches is read but hashes, segments and the elements of candidates: the texts are not even there
    assert not [f for f in found.inputFiles() if "batches/0/marked" in f]
    again.close()
    with pytest.raises(FileNotFoundError):
        history.History.open(spark, shared_dir(spark))


def test_p3_deals_common_starts_over_parts(spark):
    base = [f"t{i}" for i in range(40)]
    rows = [(k, k // 500, " ".join([*base, *(f"v{k}.{i}" for i in range(12))])) for k in range(1000)]  # 40 / 64: none is a case
    rows += [(5000, 2, " ".join([*base, *(f"v7.{i}" for i in range(11)), "x"]))]
    df = spark.createDataFrame(rows, "id bigint, batch int, text string")
    assert [tuple(x) for x in history.duplicates(df, 0.7, shared_dir(spark)).collect()] == [(5000, "near")]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, small, name):
    con = duckdb.connect()
    for f in glob.glob(f"{small}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = queries.queries()[name](spark, small)
    want = con.execute(f"select {', '.join(df.columns)} from ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_found_queries_have_the_given_columns(spark, small):
    want = {
        "p1_found": "record_a bigint, record_b bigint", "p2_found": "repo_full_name string, file_path string, license string, flag string", "p3_found": "record_id bigint, kind string", "p4_found": "rec_id bigint, func_name string",
        "p5_found": "file_id bigint", "p6_found": "tab string, rec_id bigint, line_no int", "p7_found": "file_id bigint", "p8_ids": "doc_id bigint, ids array<int>", "p10_found": "doc_id bigint, seg_no int, lang string",
    }
    for name, schema in want.items():
        df = queries.queries()[name](spark, small)
        assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == schema, name
        assert df.count() > 0 and df.count() == df.distinct().count() or name == "p4_found"


PROV = "repo_full_name string, file_path string, license_text string, license_spdx string, extra int"
LICENSES = [("MIT", "MIT License"), ("Apache-2.0", "Apache License 2.0"), ("GPL-3.0-or-later", "GNU General Public License v3.0 or later"), ("ISC", "ISC License")]


def test_p2_cases(spark):
    rows = [
        ("a", "LICENSE", "SPDX-License-Identifier: MIT", "mit"), ("a", "s/x.py", None, "MIT"), ("a", "s/y.py", "License: ISC", None), ("a", "s/z.py", None, "Apache-2.0"), ("a", "s/x.py", None, "MIT"),
        ("b", "COPYING", "under GPLv3+", None), ("b", "LICENSE", "MIT OR Apache-2.0", "other"), ("b", "s/x.py", "nothing here", "NOASSERTION"),
        ("c", "s/x.py", None, None), ("c", None, "License: ISC", None), (None, "q.py", "License: ISC", "isc"), ("d", "LICENSE", "no words", "Apache-2.0 OR MIT"), ("e", "s/t.py", "License: WTFPL", ""),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], PROV)
    lic = spark.createDataFrame(LICENSES, "spdx_id string, title string")
    got = {(r.repo_full_name, r.file_path): (r.license, r.flag) for r in licenses.resolve(df, lic).collect()}
    both = "Apache-2.0 OR MIT AND GPL-3.0-or-later"
    assert got == {
        ("a", "LICENSE"): ("MIT", "ok"), ("a", "s/x.py"): ("MIT", "ok"), ("a", "s/y.py"): ("ISC", "conflict"), ("a", "s/z.py"): ("MIT", "conflict"), ("a", ""): ("MIT", "ok"),
        ("b", "COPYING"): ("GPL-3.0-or-later", "conflict"), ("b", "LICENSE"): ("Apache-2.0 OR MIT", "conflict"), ("b", "s/x.py"): (both, "ok"), ("b", ""): (both, "ok"),
        ("c", "s/x.py"): ("unknown", "unknown"), ("c", None): ("ISC", "ok"), ("c", ""): ("unknown", "unknown"), (None, "q.py"): ("ISC", "ok"), (None, ""): ("ISC", "ok"),
        ("d", "LICENSE"): ("Apache-2.0 OR MIT", "ok"), ("d", ""): ("Apache-2.0 OR MIT", "ok"), ("e", "s/t.py"): ("unknown", "unknown"), ("e", ""): ("unknown", "unknown"),
    }
    assert licenses.resolve(df.where("false"), lic).count() == 0


def test_p2_bodies_without_names(spark):
    text = {s: list(parts) for s, *parts in licenses.BODIES}
    mit = 'Copyright (c) 2020 Someone\n\n' + ".\n\n".join(text["MIT"]) + '.\n\nTHE SOFTWARE IS PROVIDED "AS IS".\n'
    bsd = text["BSD-3-Clause"]
    two = "# Copyright 2019, x\n#\n# " + bsd[0].replace("binary forms", "binary\n# forms") + ":\n# 1. " + bsd[1] + ".\n# 2. " + bsd[2] + ".\n"
    three = two + "# 3. " + bsd[3].replace("the copyright holder", "Example Corp.\n#    and friends") + ".\n"
    apache = "/*\n * " + next(p[1] for p in licenses.BODIES if p[0] == "Apache-2.0").replace("; you", ";\n * you") + ".\n */"
    isc = text["ISC"][0] + "."
    rows = [("r", "a/mit", mit), ("r", "a/two", two), ("r", "a/three", three), ("r", "a/apache", apache), ("r", "a/isc", isc), ("r", "a/part", ".\n\n".join(text["MIT"][1:])), ("r", "a/none", "Permission is not granted.")]
    df = spark.createDataFrame([(*r, None, 1) for r in rows], PROV)
    lic = spark.createDataFrame([*LICENSES, ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License")], "spdx_id string, title string")
    got = {r.file_path: r.license for r in licenses.resolve(df, lic).collect()}
    assert got == {"a/mit": "MIT", "a/two": "BSD-2-Clause", "a/three": "BSD-3-Clause", "a/apache": "Apache-2.0", "a/isc": "ISC", "a/part": "unknown", "a/none": "unknown", "": "unknown"}


def test_flags_are_the_files_with_repairs(spark):
    rows = [(i, "r", path, label, code) for i, (path, label, code) in enumerate((("a.py", None, "x = = 1\n" * 20), ("a.js", None, "x = a b c d e f g h i j k;\n"), ("a.ts", "python", "x = 1\n"), (None, None, "("), ("a.json", None, ""), ("a.py", "json", None)))]
    f = spark.createDataFrame(rows, "file_id bigint, repo_full_name string, file_path string, language string, code string")
    out = {r.file_id: r.edits for r in syntax.checked(f).collect()}
    assert out == {0: 20, 1: 5, 2: 0, 3: 0, 4: 1, 5: 0}
    assert sorted(r.file_id for r in syntax.flagged(f).collect()) == [0, 1, 4] and syntax.flagged(f.where("false")).count() == 0


def test_row_functions_take_nulls_empties_and_extra_columns(spark):
    d = spark.createDataFrame([(1, None, None, None, None, "x"), (2, "python", "", "", "", "x"), (3, "python", "def f():\n  pass\n", "Counts the open items.", "docstring", "x")], "rec_id bigint, language string, code string, docstring string, source string, func_name string")
    assert [tuple(r) for r in docpairs.extract(d).select("rec_id", "func_name", "origin").collect()] == [(3, "f", "record")]
    assert docpairs.with_code(d, docpairs.extract(d)).first().function_code == "def f():\n  pass"
    s = spark.createDataFrame([("t", 1, None, None, 5), ("t", 2, "python", "", 5), ("t", 3, None, "a = 1\nmy_token = 'Ab3dEf6hIj9k'\n", 5)], "tab string, rec_id bigint, language string, code string, line_no int")
    assert [tuple(r) for r in secrets.lines(s).collect()] == [("t", 3, 2)]
    assert [r.n_redacted for r in secrets.redacted(s).orderBy("rec_id").collect()] == [0, 0, 1] and secrets.redacted(s).where("code is null").count() == 1
    f = spark.createDataFrame([(1, None, None, None, None, 0), (2, "r", "a.json", None, "", 0), (3, "r", "a.py", "Python ", "def f(:\n", 0), (4, "r", "a.py", None, "x = 1\n", 0)], "file_id bigint, repo_full_name string, file_path string, language string, code string, edits int")
    out = syntax.checked(f)
    assert {r.file_id for r in out.where("edits > 0").collect()} == {2, 3}
    assert {(r.repo_full_name, r.language): (r.files, r.invalid) for r in syntax.rates(out).collect()} == {(None, None): (1, 0), ("r", "json"): (1, 1), ("r", "python"): (2, 1)}
    for op in (docpairs.extract, secrets.lines, syntax.checked):
        src = {docpairs.extract: d, secrets.lines: s, syntax.checked: f}[op]
        assert op(src.where("false")).count() == 0


def test_p5_learns_and_classifies_everything(spark, small):
    files = spark.read.parquet(f"{small}/source_files.parquet")
    libs = spark.read.parquet(f"{small}/known_libs.parquet")
    w, cut, figures, names = handwritten.train(files.unionByName(spark.createDataFrame([(-1, None, None, None, None, None, None), (-2, None, "a", None, "", None, None)], files.schema)), libs)
    out = handwritten.scored(files, w, cut, names)
    assert out.count() == files.count() and 0 < out.where("not hand_written").count() < files.count() / 2
    odd = handwritten.scored(spark.createDataFrame([(-1, None, None), (-2, "a", "")], "file_id bigint, file_path string, code string"), w, cut, names)
    assert all(r.hand_written for r in odd.collect())
    assert handwritten.train(files.where("false"), libs)[2]["rows"] == 0


def test_p8_in_spark(spark):
    df = spark.createDataFrame([(1, None, 7), (2, "", 7), (3, "Hello <|endoftext|> world", 7)], "doc_id bigint, text string, ids int")
    got = {r.doc_id: r.out for r in bpe.encode_column(df, "text", "out").collect()}
    assert got[1] == got[2] == [] and 50256 not in got[3]
    assert [r.n_tokens for r in bpe.count_column(df, "text").orderBy("doc_id").collect()] == [0, 0, len(got[3])]


def test_p9_meets_shares_within_limits(spark):
    r = random.Random(4)
    rows = [(i, r.choice("aaaaab"), r.randrange(1, 200)) for i in range(3000)]
    sizes = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("m", "a", 0.3, 2, 1.0), ("m", "b", 0.6, 2, 1.0), ("m", "none", 0.1, 3, 1.0), ("n", "b", 1.0, 5, 0.3), ("n", None, None, None, None)], "mix_name string, source string, target_share double, max_repeats int, size_ratio double")
    ranks = mixing.ranked(sizes)
    n = {}
    for x in ranks.collect():
        n.setdefault(x.source, []).append(x["rank"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in n.values())
    rate = mixing.rates(sizes, targets)
    picked = mixing.sample(ranks, rate)
    out = {(x.mix_name, x.source): x for x in mixing.shares(picked, rate).collect()}
    total = sum(x[2] for x in rows)
    of_b = sum(x[2] for x in rows if x[1] == "b")
    assert abs(out["m", "a"].tokens - 0.3 * total) <= 400 and not out["m", "a"].capped
    assert out["m", "b"].capped and out["m", "b"].tokens == 2 * of_b and out["m", "b"].most_copies == 2
    assert out["m", "none"].tokens == 0 and out["m", "none"].capped
    assert abs(out["n", "b"].tokens - 0.3 * total) <= 400 and out["n", "b"].most_copies <= 5
    even = mixing.rates(sizes, targets, "shares")
    kept = {(x.mix_name, x.source): x for x in mixing.shares(mixing.sample(ranks, even), even).collect()}
    assert abs(kept["m", "a"].tokens / kept["m", "b"].tokens - 0.5) < 0.01 and abs(kept["m", "b"].tokens - 2 * of_b) <= 400
    assert kept["m", "a"].off < out["m", "a"].off and kept["n", "b"].tokens == out["n", "b"].tokens
    a, b = (sorted(map(tuple, mixing.sample(mixing.ranked(sizes.repartition(k)), rate).collect())) for k in (1, 7))
    assert a == b
    assert mixing.shares(mixing.sample(mixing.ranked(sizes.where("false")), mixing.rates(sizes.where("false"), targets)), mixing.rates(sizes.where("false"), targets)).count() == 5


def test_p10_in_spark(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    counts = languages.train(docs)
    assert counts.sum() > 0
    odd = spark.createDataFrame([(-1, None, None), (-2, "en", ""), (-3, "en", " \n "), (-4, "de", "+1"), (-5, "xx", "The whole thing is slower without the export job, though it still works.")], "doc_id bigint, lang string, text string")
    segs = languages.segments(odd, counts)
    assert [(r.doc_id, r.lang) for r in segs.collect()] == [(-5, "en")]
    assert [tuple(r) for r in languages.found(segs).collect()] == [(-5, 0, "en")]
    assert languages.of_documents(segs).first().label == "missing"
    assert languages.segments(odd.where("false"), languages.train(odd.where("false"))).count() == 0
