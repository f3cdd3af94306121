import pytest
import random
import re

from pyspark.sql import functions as F

from loamline.functions import text as T
from loamline.functions.diff import unified

ALPHABET = ["a", "b", " ", "  ", "\t", "\n", "\n\n", "\r\n", "\x0b", "\x0c", "\x1c", "\x85", "\u2028", "\xa0", "\u3000", "=", "==", "é", " True", ">="]


def texts(n=1500):
    r = random.Random(3)
    return ["", " ", "\n"] + ["".join(r.choice(ALPHABET) for _ in range(r.randrange(14))) for _ in range(n)]


def run(spark, column, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[1] for r in sorted(df.select("i", column.alias("o")).collect())]


def normalize(code):
    out, blank = [], False
    for line in (x.rstrip() for x in code.splitlines()):
        if line or not blank:
            out.append(line)
        blank = not line
    return "\n".join(out).strip() + "\n"


def test_normalize_matches_plain_statement(spark):
    v = texts()
    assert run(spark, T.normalize_code(F.col("t")), v) == [normalize(x) for x in v]
    assert run(spark, T.normalize_code(F.col("t")), [None]) == [None]


def test_normalize_is_idempotent(spark):
    v = texts(400)
    once = T.normalize_code(F.col("t"))
    assert run(spark, T.normalize_code(once), v) == run(spark, once, v)


def test_tokens_and_shingles(spark):
    v = texts(600)
    assert run(spark, T.tokens(F.col("t")), v) == [x.split() for x in v]
    got = run(spark, T.shingles(T.tokens(F.col("t")), 3), v)
    for g, x in zip(got, v, strict=True):
        w = x.split()
        assert g == list(dict.fromkeys(" ".join(w[i : i + 3]) for i in range(len(w) - 2)))
    assert run(spark, T.shingles(T.tokens(F.col("t")), 3), [None]) == [None]


def test_inject_bug_first_rule_first_occurrence(spark):
    cases = ["a == b == c", "a >= b == c", "x != y", "x >= 1 >= 2", "x <= 1", "return True", "f(x, False)", "plain", ""]
    want = ["a != b == c", "a >= b != c", "x == y", "x > 1 >= 2", "x < 1", "return False", "f(x, True)", "plain" + T.BUG_MARKER, T.BUG_MARKER]
    assert run(spark, T.inject_bug(F.col("t")), cases) == want


def test_format_minimal(spark):
    assert run(spark, T.format_minimal(F.col("t")), ["a  \n\n\n\nb\n", "  ", "", None]) == ["a  \n\nb", "  ", "", None]
    texts = ["\n \n\t\nx\r\n\r\n \r\ny", "a\n \n\n", "\n\n", " \n \nb\u2028\u2028\u2028c\n", "x\n\n\n\n\ny\n\n"]

    def plain(code):
        out, blank = [], 0
        for ln in code.splitlines():
            blank = blank + 1 if not ln.strip() else 0
            out += [ln] if blank <= 1 else []
        return "\n".join(out) or code

    assert run(spark, T.format_minimal(F.col("t")), texts) == [plain(t) for t in texts]


def test_blank_language_and_defaults(spark):
    assert run(spark, T.is_blank(F.col("t")), [None, "", "\u2003 ", "x"]) == [True, True, True, False]
    assert run(spark, T.language_of_path(F.col("t")), ["a/b.PY", "c.js", None]) == ["python", "unknown", "unknown"]
    assert run(spark, T.or_default(F.col("t"), "main"), ["", None, "dev"]) == ["main", "main", "dev"]
    assert run(spark, T.mangle_repo(F.col("t"), F.lit("0123456789abcdef")), ["a/b"]) == ["a_b_0123456789ab"]
    assert run(spark, T.basename(F.col("t")), ["a/b/c.py", "c.py"]) == ["c.py", "c.py"]


def test_record_ids_tell_null_from_empty(spark):
    df = spark.createDataFrame([(None, "b"), ("", "b"), ("b", None), ("b", "")], "x string, y string")
    assert df.select(T.record_id(F.col("x"), F.col("y")).alias("i")).distinct().count() == 4


def test_unified_diff():
    d = unified("a\nb\n", "a\nc\n", "f.py")
    assert d.startswith("--- a/f.py") and "-b" in d and "+c" in d
    assert unified(None, "", None) == ""
    assert re.search("a/code.py", unified("x", "y", None))


def test_diffs_can_be_applied():
    import random

    from loamline.functions.diff import applied, unified

    r = random.Random(8)
    for _ in range(300):
        a = [f"l{r.randrange(6)}\n" for _ in range(r.randrange(30))]
        b = [x for x in a if r.random() > 0.15]
        for _ in range(r.randrange(4)):
            b.insert(r.randrange(len(b) + 1), f"n{r.randrange(6)}\n")
        x, y = "".join(a), "".join(b)
        assert applied(x, unified(x, y, "f")) == y
        assert applied(x, unified(x, y + "end", "f")) == y + "end"
    assert applied("a\n", "") == "a\n" and applied(None, None) == ""
    with pytest.raises(ValueError):
        applied("b\n", unified("a\n", "c\n", "f"))
