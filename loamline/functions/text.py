"""Text expressions; all stay in the JVM.

Null in gives null out everywhere, unless a docstring says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that Python's str.isspace accepts, as a Java regex class,
# and the line ends of str.splitlines.
WS = r"\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS_NO_LF = r"\x09\x0b-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LINE_END = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85\x{2028}\x{2029}]"

# The mutation rules, first match wins, first occurrence is replaced.
BUG_RULES = (("==", "!="), ("!=", "=="), (">=", ">"), ("<=", "<"), (" True", " False"), (" False", " True"))
BUG_MARKER = "\n# FIXME: synthetic bug marker\n"


def strip(c: Column) -> Column:
    """Python's str.strip()."""
    return F.regexp_replace(F.regexp_replace(c, rf"\A[{WS}]+", ""), rf"[{WS}]+\z", "")


def is_blank(c: Column) -> Column:
    """True for null, empty and white-space-only texts."""
    return F.coalesce(strip(c) == "", F.lit(True))


def normalize_code(c: Column) -> Column:
    """Canonical form of a code unit.

    Line ends become ``\\n``, trailing blanks of lines go, runs of blank lines shrink to one, the whole is
    stripped (the first line's indentation too) and ends with one line break. '' gives a single line break.
    """
    c = F.regexp_replace(c, LINE_END, "\n")
    c = F.regexp_replace(c, rf"[{WS_NO_LF}]+(?=\n|\z)", "")
    c = F.regexp_replace(c, r"\n{3,}", "\n\n")
    return F.concat(strip(c), F.lit("\n"))


def format_minimal(c: Column) -> Column:
    """Formatter used where no real one is at hand: of each run of blank lines the first stays, lines are parted by line feeds
    and the last has none; other white space stays. A text of which nothing is left stays as it is."""

    c_ = F.regexp_replace(F.regexp_replace(c, LINE_END, "\n"), r"\n\z", "")
    out = F.regexp_replace(c_, rf"(\A[{WS_NO_LF}]*|\n[{WS_NO_LF}]*)(?:\n[{WS_NO_LF}]*)+(?=\n|\z)", "$1")
    return F.when(out == "", c).otherwise(out)


# The byte sequences that are well-formed UTF-8, and any other byte from 0x80 on, in Latin-1 characters.
_UTF8 = (
    r"([\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|"
    r"\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})|[\x80-\xff]"
)


def decode_utf8(c: Column) -> Column:
    """Bytes as text; those that are no part of well-formed UTF-8 are dropped."""
    sound = F.regexp_replace(F.decode(c, "ISO-8859-1"), _UTF8, "$1")
    return F.when(F.is_valid_utf8(c.cast("string")), c.cast("string")).otherwise(F.encode(sound, "ISO-8859-1").cast("string"))


def tokens(c: Column) -> Column:
    """White-space tokens, as str.split() gives them; '' gives an empty array."""
    return F.filter(F.split(c, rf"[{WS}]+"), lambda t: t != "")


def lines(c: Column) -> Column:
    """Lines as str.splitlines() gives them after stripping line breaks at both ends; '' gives an empty array."""
    c = F.regexp_replace(F.regexp_replace(c, r"\A\n+", ""), r"\n+\z", "")
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, LINE_END))


def shingles(toks: Column, k: int) -> Column:
    """Distinct k-token shingles; fewer than k tokens give an empty array (the guard sits inside the expression).

    The tokens are bound to a lambda variable, so they are made once per row and not once per shingle.
    """
    none = F.array().cast("array<string>")

    def of(t: Column) -> Column:
        n = F.size(t)
        cut = F.transform(F.sequence(F.lit(1), F.greatest(n - (k - 1), F.lit(1))), lambda i: F.array_join(F.slice(t, i, F.lit(k)), " "))
        return F.when(n >= k, F.array_distinct(cut)).when(n.isNotNull(), none)

    return F.transform(F.array(toks), of)[0]


def shingle_hashes(toks: Column, k: int) -> Column:
    """64-bit hashes of the distinct k-token shingles, made from the tokens as they stand, without texts of shingles."""
    none = F.array().cast("array<bigint>")

    def of(t: Column) -> Column:
        n = F.size(t)
        cut = F.transform(F.sequence(F.lit(1), F.greatest(n - (k - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(t, i, F.lit(k))))
        return F.when(n >= k, F.array_distinct(cut)).when(n.isNotNull(), none)

    return F.transform(F.array(toks), of)[0]


def content_hash(c: Column) -> Column:
    """SHA-256 hex of the UTF-8 text or of bytes."""
    return F.sha2(c, 256)


def inject_bug(c: Column) -> Column:
    """Applies the first rule of BUG_RULES whose pattern occurs to its first occurrence, else appends BUG_MARKER."""
    out = F.concat(c, F.lit(BUG_MARKER))
    for old, new in reversed(BUG_RULES):
        out = F.when(
            F.instr(c, old) > 0,
            F.overlay(c, F.lit(new), F.greatest(F.instr(c, old), F.lit(1)), F.lit(len(old))),
        ).otherwise(out)
    return out


def bug_rule(c: Column) -> Column:
    """The label of the rule that inject_bug applies."""
    out = F.lit("marker")
    for old, new in reversed(BUG_RULES):
        out = F.when(F.instr(c, old) > 0, F.lit(f"{old.strip()}->{new.strip()}")).otherwise(out)
    return F.when(c.isNotNull(), out)


def basename(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def language_of_path(path: Column) -> Column:
    """'python' for .py files, else 'unknown' (null paths too)."""
    return F.when(F.lower(path).endswith(".py"), "python").otherwise("unknown")


def or_default(c: Column, default) -> Column:
    """Replaces null and '' (what is falsy) by the default."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def mangle_repo(name: Column, sha: Column) -> Column:
    """File-name form of a repository at a commit: slashes to underscores, 12 hex digits."""
    return F.concat(F.replace(name, F.lit("/"), F.lit("_")), F.lit("_"), F.substring(sha, 1, 12))


def record_id(*parts: Column) -> Column:
    """Stable id made from content, so that a retried task gives the same ids."""
    return F.substring(F.sha2(F.concat_ws("\u001f", *[F.coalesce(p.cast("string"), F.lit("\u0000")) for p in parts]), 256), 1, 32)


def iso_utc(seconds: Column) -> Column:
    """Epoch seconds as naive UTC text, 2025-01-31T12:00:00."""
    return F.date_format(F.to_utc_timestamp(F.timestamp_seconds(seconds), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss")


def tail(c: Column, n: int = 20_000) -> Column:
    """The last n characters."""
    return F.right(c, F.lit(n))


def run_status(returncode: Column, timed_out: Column, has_tests: Column) -> Column:
    """What a recorded test run means: skipped, timeout, error (no return code), ok or fail."""
    return F.when(~F.coalesce(has_tests, F.lit(True)), "skipped").when(F.coalesce(timed_out, F.lit(False)), "timeout").when(returncode.isNull(), "error").when(returncode == 0, "ok").otherwise("fail")
