"""Problem 6: credentials in source code.

Code is cut lexically into comments and literals (with their delimiters, prefixes and escapes). A literal is a credential
if it is assigned, passed, or given as default to a credential-named identifier and is no placeholder, or if its own
form says so (private keys, signed tokens, key ids, user info in addresses, connection strings, authorization headers,
options of command lines). Comments and documentation are searched for the same forms and for noted logins. Redaction
replaces only the secret characters inside the delimiters, so the code around stays as it was.

Cases: null and empty texts have none; texts are read whole; line ends are \\n, a \\r before one belongs to its line;
placeholders, look-ups elsewhere, digests, object ids, public keys and mere mentions are left alone.
"""

from __future__ import annotations

import base64
import binascii
import re
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REDACTED = "REDACTED"

_STRING = r"""(?P<q>(?:[rRbBuUfF]{1,2})?(?:\"\"\"(?:\\.|[^\\])*?(?:\"\"\"|\Z)|'''(?:\\.|[^\\])*?(?:'''|\Z)|"(?:\\.|[^"\\\n])*(?:"|(?=\n)|\Z)|'(?:\\.|[^'\\\n])*(?:'|(?=\n)|\Z)))"""
_PYTHON = re.compile(rf"(?P<c>\#[^\n]*)|{_STRING}", re.S)
_SCRIPT = re.compile(
    rf"(?P<c>//[^\n]*|/\*.*?(?:\*/|\Z))|{_STRING}|(?P<t>`(?:\\.|[^`\\])*(?:`|\Z))|(?P<r>(?:(?<=[=(,:;!&|?{{}}\[])|(?<=return))\s*/(?![*/])(?:\\.|\[(?:\\.|[^\]\\\n])*\]|[^/\\\n\[])+/[a-z]*)",
    re.S,
)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

# Words of identifiers that hold credentials, and words that show that an identifier holds something else.
NAMED = frozenset("password passwd pwd pass passphrase passcode secret token apikey credential credentials creds".split())
KEYS = frozenset("api access private secret auth signing encryption master account storage shared".split())
HASHES = frozenset("sha sha1 sha256 sha512 md5 hash checksum integrity commit revision rev uuid guid pub public pinned".split())
OTHER = frozenset(
    "digest field label placeholder hint path file icon image type length len regex pattern url uri endpoint header name column env var title message msg error prompt text".split()
)
# What stands where a secret should be.
PLACEHOLDER = re.compile(
    r"(?i)(?:change|replace)[-_ ]?(?:me|this|it)|your[-_ ]?\w*|<[^>]*>|\$\{|\{\{|%\(|%s|^\{.*\}$|placeholder|example|dummy|sample|redacted|insert|todo|fixme|"
    r"^(?:x+|\*+|\.+|-+|_+|0+|none|null|undefined|n/?a|test(?:ing)?|secret|pass(?:word|wd)?|pwd|pw|token|key|user(?:name)?|admin|root|foo|bar|abc123?|12345\d*)$"
)
_PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----(?P<s>(?:\\[nr]|[\s\"'+,A-Za-z0-9/=:\-.\\])*?)(?=-----END|\Z|[`)\];])")
_JWT = re.compile(r"\beyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]{16,}")
_PREFIXED = re.compile(
    r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\b(?:sk|rk)[-_](?:[a-z]+[-_])*[A-Za-z0-9]{20,}\b|\b[a-z]{2,6}_live_[A-Za-z0-9]{16,}\b|\bgh[pousr]_[A-Za-z0-9]{30,}\b|"
    r"\bgithub_pat_\w{30,}|\bglpat-[\w-]{16,}|\bxox[abeoprs]-[\w-]{10,}|\bAIza[\w-]{30,}|\b(?:npm|hf|pypi|dop_v1|shpat|figd)[_-][A-Za-z0-9_]{20,}\b|\bSG\.[\w-]{16,}\.[\w-]{16,}|\bya29\.[\w-]{20,}"
)
_AFTER_ID = re.compile(r"^[A-Za-z0-9/+]{40}$")
_BEARER = re.compile(r"(?i)\bbearer\s+(?P<s>[\w\-.=+/~]{16,})")
_BASIC = re.compile(r"(?i)\bbasic\s+(?P<s>[A-Za-z0-9+/]{8,}={0,2})")
_USERINFO = re.compile(r"\b[a-z][a-z0-9+.\-]*://[^\s:/@'\"`]*:(?P<s>[^\s@/'\"`]+)@[\w\[]")
_DSN = re.compile(r"(?i)(?:^|;)\s*(?:pwd|password)\s*=\s*(?P<s>[^;'\"`]+)")
_OPTION = re.compile(r"(?i)(?:^|\s)--?(?:[a-z]+-)*(?:password|passwd|pwd|pass|token|secret|api-?key|auth)(?:=|\s+)(?P<s>[^\s'\"`]+)")
_SHORT_OPTION = re.compile(r"(?:^|\s)-[pP]\s*(?P<s>[^\s'\"`]{8,})")
_NOTE = re.compile(
    r"(?i)\b(?:pass(?:word|wd|phrase)?|pwd|pw|logins?|log-?in|credentials?|creds|secret|token|api[ _-]?key|account|user(?:name)?|remove|delete|old|staging|temporary|temp|todo)\b[^\n:=]{0,40}[:=]\s*(?P<s>[^\s,;\"'`]+(?:\s*/\s*[^\s,;\"'`]+)?)"
)
# What stands before a literal is matched from the literal backwards, so it may be as long as it likes.
_CONTEXT = regex.compile(r"(?r)(?P<n>[A-Za-z_$][\w$]*)[\"'\]]*\s*(?::\s*[\w\[\]<>|., ]+?\s*=|:=|===?|!==?|=>|[:=])\s*(?:[\w.$]*\(?\s*)?")
_DEFAULT = regex.compile(
    r"(?r)(?:(?P<n>[A-Za-z_$][\w$]*)[\"'\]]*\s*(?::\s*[\w\[\]<>|., ]+?\s*=|[:=])\s*[^\n=;]*(?:getenv|environ(?:\.get)?|\.get|env(?:\.get)?|setdefault|config)\s*\(\s*[\"'`]?[\w.\-/]+[\"'`]?\s*,\s*|"
    r"(?P<m>[A-Za-z_$][\w$]*)[\"'\]]*\s*(?::\s*[\w\[\]<>|., ]+?\s*=|[:=])\s*[^\n=;]*(?:\|\||\?\?|\bor)\s*)"
)
_KEY_ID = regex.compile(r"(?r)(?:AKIA|ASIA)[0-9A-Z]{16}[\"'`],\s*")
_ARGUMENTS = re.compile(r"\s*(?:[\w.$@\-]+\s*,\s*)*")
_NEXT = re.compile(r"\s*,\s*(?:[\w.$@\-]+\s*,\s*)*")
_SIMPLE = re.compile(r"[\w.$\"'@\-]+")


def _called(between: str) -> str:
    """The function whose open argument list, of plain arguments, ends the text; '' if none."""
    at = between.rfind("(")
    if at < 0 or not _ARGUMENTS.fullmatch(between, at + 1):
        return ""
    end = len(between[:at].rstrip())
    begin = end
    while begin and (between[begin - 1].isalnum() or between[begin - 1] in "_$"):
        begin -= 1
    return between[begin:end].lstrip("0123456789")


def _kinds(s: str) -> tuple[bool, bool, bool, bool]:
    return any(c.islower() for c in s), any(c.isupper() for c in s), any(c.isdigit() for c in s), any(not c.isalnum() and c not in "_-./ " for c in s)


def _irregular(s: str) -> bool:
    """Letters that change case as chance has it, not as words do."""
    letters = [c for c in s if c.isalpha()]
    changes = sum(a.isupper() != b.isupper() for a, b in zip(letters, letters[1:], strict=False))
    return len(letters) >= 8 and changes >= len(letters) / 3


def is_placeholder(s: str) -> bool:
    return not s or bool(PLACEHOLDER.search(s)) or len(set(s)) <= 2


def usable(s: str, least: int = 6) -> bool:
    """Whether a literal can be a secret: no placeholder, no words, no look-up."""
    if len(s) < least or is_placeholder(s) or any(c.isspace() for c in s) or re.match(r"(?:sha(?:1|256|384|512)|md5)[-:]|data:|https?://", s):
        return False
    lower, upper, digit, mark = _kinds(s)
    if re.fullmatch(r"[a-z]+(?:[._/\-][a-z]+)*\d{0,2}|[A-Z]+(?:[_/\-][A-Z]+)*\d{0,2}|[\d.,:\-]+", s):
        return False
    return (digit and (lower or upper)) or (mark and (lower or upper) and len(s) >= 8) or (lower and upper and _irregular(s))


def strong(s: str) -> bool:
    """Stricter, for places that don't name a credential: a mixture that no word, path or number has."""
    lower, upper, digit, mark = _kinds(s)
    return usable(s, 8) and digit and (lower or upper) and ((mark and re.search(r"[!#$%&?*^~]", s) is not None) or (lower and upper and len(s) >= 12 and _irregular(s)))


def _random(s: str, least: int = 16) -> bool:
    """A long mixture of small and capital letters and digits."""
    lower, upper, digit, _ = _kinds(s)
    return usable(s, least) and ((lower and upper and digit) or _irregular(s))


def _of_name(name: str) -> str:
    """'named' for identifiers of credentials, 'soft' for those whose last words may say what else it is about one, 'key' for
    those that only end in key, else ''."""
    words = [w.lower() for w in _WORDS.findall(name)]
    if any(w in HASHES for w in words):
        return ""
    at = [i for i, w in enumerate(words) if w in NAMED] + [i + 1 for i, (a, b) in enumerate(zip(words, words[1:], strict=False)) if a in KEYS and b in ("key", "keys")]
    if at:
        return "soft" if any(w in OTHER for w in words[max(at) + 1 :]) else "named"
    return "key" if words and words[-1] in ("key", "auth", "access") else ""


def _forms(text: str, at: int, note: bool) -> Iterator[tuple[int, int]]:
    """Spans of credentials that show by their form within a literal's content or a comment that begins at `at`."""
    for m in _PEM.finditer(text):
        if len(re.sub(r"\\[nr]|[^A-Za-z0-9+/=]", "", m["s"])) >= 32:
            yield at + m.start(), at + m.end("s")
    for pattern in (_JWT, _PREFIXED):
        for m in pattern.finditer(text):
            if not PLACEHOLDER.search(m.group()) and (m.group()[:4] in ("AKIA", "ASIA") or any(c.isdigit() for c in m.group())):
                yield at + m.start(), at + m.end()
    for m in _BEARER.finditer(text):
        if usable(m["s"], 16):
            yield at + m.start("s"), at + m.end("s")
    for m in _BASIC.finditer(text):
        try:
            user, colon, word = base64.b64decode(m["s"], validate=True).decode("utf-8").partition(":")
        except (binascii.Error, ValueError):
            continue
        if colon and word.isprintable() and not is_placeholder(word) and usable(word, 4):
            yield at + m.start("s"), at + m.end("s")
    for m in _USERINFO.finditer(text):
        s = m["s"]
        if not is_placeholder(s) and "{" not in s and not s.startswith(("$", "%", "<", "*")) and (usable(s, 4) or len(s) >= 8):
            yield at + m.start("s"), at + m.end("s")
    if ";" in text:
        for m in _DSN.finditer(text):
            if not is_placeholder(m["s"].strip()) and "{" not in m["s"]:
                yield at + m.start("s"), at + m.end("s")
    for m in _OPTION.finditer(text):
        if usable(m["s"], 8) and "{" not in m["s"]:
            yield at + m.start("s"), at + m.end("s")
    for m in _SHORT_OPTION.finditer(text):
        if strong(m["s"]):
            yield at + m.start("s"), at + m.end("s")
    if note:
        for m in _NOTE.finditer(text):
            word = m["s"].split("/")[-1].strip() if re.search(r"\s/\s", m["s"]) else m["s"]
            if strong(word):
                yield at + m.end("s") - len(word), at + m.end("s")
        for m in re.finditer(r"\w+ / (?P<s>\S{8,})", text):
            if strong(m["s"]):
                yield at + m.start("s"), at + m.end("s")


def find(code: str | None, language: str | None) -> list[tuple[int, int]]:
    """Disjoint (start, end) of the secret characters, in order."""
    if not code:
        return []
    python = (language or "").strip().lower() in ("python", "py", "") and not re.match(r"\s*(?:const|let|function|export|import \{|async function)\b", code)
    return _find(code, _PYTHON if python else _SCRIPT, 0)


def _find(code: str, lexer: re.Pattern, depth: int) -> list[tuple[int, int]]:
    spans: list[tuple[int, int]] = []
    last = (-1, False)  # end of the last literal and whether it was a credential: 'a' + 'b' is one
    call, plain, line, seen = "", False, 0, 0  # whose argument the last literal was; where the line begins of what is before `seen`
    for m in lexer.finditer(code):
        start, body = m.start(), m.group()
        if m["c"] is not None:
            spans += _forms(body, start, True)
            mark = len(re.match(r"[#/*]+", body).group())
            if depth == 0 and re.search(r"[\"'`]", body):
                spans += [(a + start + mark, b + start + mark) for a, b in _find(body[mark:], lexer, 1)]
            continue
        if "r" in m.groupdict() and m["r"] is not None:
            continue
        prefix = len(re.match(r"[rRbBuUfF]*", body).group()) if body[0] not in "`" else 0
        quote = 3 if body[prefix : prefix + 3] in ('"""', "'''") else 1
        begin = start + prefix + quote
        stop = m.end() - (quote if body.endswith(body[prefix : prefix + quote]) and len(body) >= prefix + 2 * quote else 0)
        s = code[begin:stop]
        found = list(_forms(s, begin, "\n" in s or " " in s))
        between = code[max(0, last[0]) : start]
        call = call if plain and _NEXT.fullmatch(between) else _called(between)
        plain = _SIMPLE.fullmatch(body) is not None
        full = max(0, last[0]) + len(between.rstrip()) if between.strip() else max(0, last[0])  # the end of what is not blank before
        if (nl := code.rfind("\n", seen, full)) >= 0:
            line = nl + 1
        seen = full
        joined = last[1] and re.fullmatch(r"\s*(?:\+\s*|\\?\n\s*|\s)?", code[last[0] : start]) is not None
        interpolated = ("f" in body[:prefix].lower() and "{" in s) or (body[0] == "`" and "${" in s)
        if not found and not interpolated:
            hit = False
            if joined:
                hit = len(s) >= 4
            elif usable(s, 6):
                c = _DEFAULT.match(code, line, start) or _CONTEXT.match(code, line, start)
                if c:
                    name = c["n"] or (c.groupdict().get("m") or "")
                    kind = _of_name(name)
                    if kind == "named":
                        hit = code[full - 1 : full] != "(" or re.search(r"\d", s) is not None
                    elif kind == "soft":
                        hit = strong(s) or _random(s) or re.fullmatch(r"[0-9a-f]{32,}", s) is not None
                    elif kind == "key":
                        hit = _random(s)
                elif call and _of_name(call) == "named":
                    hit = strong(s)
                if not hit and _AFTER_ID.match(s) and spans and _KEY_ID.match(code, line, start):
                    hit = True
            if hit:
                found = [(begin, stop)]
        spans += found
        last = (m.end(), bool(found))
    spans.sort()
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        elif b > a:
            out.append((a, b))
    return out


def begin_lines(code: str, spans: list[tuple[int, int]]) -> list[int]:
    """Lines (from 1) on which a credential begins; parts of one joined literal count at the first."""
    return sorted({code.count("\n", 0, a) + 1 for a, _ in spans})


def redact(code: str, spans: list[tuple[int, int]]) -> str:
    out, at = [], 0
    for a, b in spans:
        out += [code[at:a], REDACTED]
        at = b
    return "".join(out) + code[at:]


def lines(rows: DataFrame) -> DataFrame:
    """Of rows (tab, rec_id, language, code) one row (tab, rec_id, line_no) per line on which a credential begins."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            out = []
            for tab, rec, language, code in p[["tab", "rec_id", "language", "code"]].itertuples(index=False):
                if spans := find(code, language):
                    out += [(tab, rec, n) for n in begin_lines(code, spans)]
            yield pd.DataFrame(out, columns=["tab", "rec_id", "line_no"])

    return rows.select("tab", "rec_id", "language", "code").mapInPandas(scan, "tab string, rec_id bigint, line_no int")


def redacted(rows: DataFrame) -> DataFrame:
    """The same rows with the secret characters of `code` replaced and their number of places: (tab, rec_id, code, n_redacted)."""

    def clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            spans = [find(c, lang) for c, lang in zip(p.code, p.language, strict=True)]
            yield pd.DataFrame(
                {
                    "tab": p.tab,
                    "rec_id": p.rec_id,
                    "code": [redact(c, s) if s else c for c, s in zip(p.code, spans, strict=True)],
                    "n_redacted": pd.array([len(s) for s in spans], dtype="int32"),
                }
            )

    return rows.select("tab", "rec_id", "language", "code").mapInPandas(clean, "tab string, rec_id bigint, code string, n_redacted int")


def both_tables(documentation: DataFrame, kept: DataFrame) -> DataFrame:
    return documentation.select(F.lit("documentation").alias("tab"), "rec_id", "language", "code").union(
        kept.select(F.lit("kept_records").alias("tab"), F.col("record_id").alias("rec_id"), "language", F.col("code_norm").alias("code"))
    )
