"""Problem 5: generated, minified, vendored and data files among source files.

A linear support-vector classifier over hashed character n-grams (of the text and of its shape, in which letters and
digits become classes), path components and a few flags. There are no labels, so seeds give them: files whose header,
name, place or make-up gives them away count as positive, all others as negative. Giveaway headers and the names of
known libraries are masked in the texts, and for half of the training rows the flags are hidden too, so that the weights
of n-grams and paths are learnt for files that have no giveaway. Repositories (by hash) are split in three: the weights are
fitted on three fifths, the threshold is set on one fifth, and one fifth gives the figures of `p5_validation`: as files are
scored, and with the flags hidden from the classifier as their notices are from the n-grams (`_masked`), which is what it has
learnt beyond the seeds.

The training sample is bounded by TRAIN_ROWS, dealt by hash; its features are made where the files are, and only they (at most DIM
numbers a file) go to the task that fits. The classifier is applied to every file, to whole texts.

Cases: null and empty texts, and null paths, are classified by what is there (an empty file is hand-written); repeated
files get the same verdict; ties in the score count as hand-written.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm import secrets

#: Documented bound of the training sample (seed-labelled rows).
TRAIN_ROWS = 8_000
DIM = 1 << 16
FLAGS = ("notice", "copy_notice", "known_library", "machine_name", "vendor_place", "dense_lines", "numbers", "blob", "records", "lock")
#: The known libraries are a fixed small table.
MOST_LIBRARIES = 100_000

# Notices that programs leave in what they write, in several languages.
NOTICE = re.compile(
    r"(?i)\bcode generated by\b|@generated\b|<auto-?generated|\bauto-?generated\b|\bautogen(?:erated)?\b|\b(?:this file|file) (?:is|was|has been) (?:created|generated|made|written|produced|built) (?:automatically|by)|"
    r"\bgenerated (?:by|from|with|using|automatically)\b|\bproduced (?:with|by) [\w.\-]+,? (?:rerun|do not|don't)|\brerun it instead\b|\bchanges will be (?:lost|overwritten)|\bdo not (?:edit|modify|change)\b|\bmachine[- ](?:generated|written|made)\b|"
    r"\bautomatisch (?:erzeugt|erstellt|generiert)|\bnicht von hand\b|\bproduit par\b.*\bne pas\b|\bne pas (?:modifier|éditer)\b|\bgénéré (?:par|automatiquement)|\bgenerado (?:por|automáticamente)|\bno (?:editar|modificar)\b|"
    r"\bgenerato (?:da|automaticamente)|\bnon modificare\b|\bgerado (?:por|automaticamente)|\bnão (?:editar|edite|modificar)\b|\bgegenereerd door\b|\bniet (?:bewerken|wijzigen)\b|сгенерирован|не редактир|自动生成|自動生成|请勿(?:修改|编辑)|編集しないで"
)
# Notices of copies of other projects.
COPY_NOTICE = re.compile(
    r"(?i)\bvendored (?:from|copy)\b|\bbundled copy of\b|\bcopied (?:from|verbatim)\b|\bimported from upstream\b|\btaken from upstream\b|\breport problems to its own project\b|\(c\) the \w+ project\b|\bpart of the \w+ (?:distribution|project)\b|"
    r"^\W*[\w.\-]+ (?:v|version |- version |release )\d+(?:\.\d+)+\W*$|^\W*this is \w+ \(release \d|@license\b.*\bv?\d+\.\d+\.\d+|\b[\w\-]+@\d+\.\d+\.\d+\b"
)
# Names that tools give to what they write, and places of other projects' code.
MACHINE_NAME = re.compile(r"(?i)_pb2(?:_grpc)?\.|_client\.|\.pb\.|_stubs?\.|_parsetab\.|_lextab\.|\.generated\.|\.g\.\w+$|\.gen\.|\.min\.|\.bundle\.|\.[0-9a-f]{8,}\.\w+$|~[\w.\-]+\.js$|\.designer\.|\.lock\.json$|(?:^|/)(?:package-lock|npm-shrinkwrap|composer\.lock|yarn\.lock)")
VENDOR_PLACE = re.compile(r"(?i)(?:^|/)_?(?:vendor(?:ed)?|third[_-]?party|3rd[_-]?party|externals?|extern|deps|node_modules|bower_components|site-packages|jspm_packages|contrib/import)(?:/|$)")
_LOCK = re.compile(r'"(?:lockfileVersion|integrity|resolved|_resolved)"\s*:')
_NUMBER = re.compile(r"(?<![\w.])-?\d+(?:\.\d+)?(?![\w.])")
_NO_NUMBERS = dict.fromkeys(map(ord, "0123456789.-"))
_BLOB = re.compile(r"[A-Za-z0-9+/=\\]{40,}")
_RECORD = re.compile(r"\{[^{}]{0,400}\}")


# Notices that only forbid changes; deep in a file, hand-written comments say so too.
_FORBIDS = re.compile(r"(?i)do not|changes will|rerun|nicht|ne pas|no |non |não|niet|не редактир|请勿|編集")
_SUBJECT = re.compile(r"(?i)(?:this |the |dieser? |ce |este |questo |dit )?(?:file|code|module|datei|fichier|archivo|fichero|código|arquivo|bestand)\b")
#: An array of records that is assigned, exported or the whole text, wherever it begins.
_ARRAY = re.compile(r"(?:\A|=|\bdefault\b|\breturn\b)\s*\[\s*(?:\{[^{}]{0,400}\}[\s,]*+){8,}")


def stems(pattern: str) -> list[list[frozenset[str]]]:
    """For each alternative of the pattern sets of texts: whatever it matches has one text of each set. Read off the parse tree."""
    from re import _parser as parse

    def sets(items) -> list[frozenset[str]]:
        out, run = [], ""
        for op, arg in [*items, (None, None)]:
            if op is parse.LITERAL:
                run += chr(arg)
                continue
            if run:
                out.append(frozenset((_folded(run),)))
            run = ""
            if op is parse.SUBPATTERN:
                out += sets(arg[3])
            elif op is parse.BRANCH:
                each = [max(sets(x), key=lambda y: min(map(len, y)), default=frozenset()) for x in arg[1]]
                out += [frozenset().union(*each)] if all(each) else []
        return out

    items = list(parse.parse(pattern))
    while len(items) == 1 and items[0][0] is parse.SUBPATTERN:
        items = list(items[0][1][3])
    branches = items[0][1][1] if len(items) == 1 and items[0][0] is parse.BRANCH else [items]
    return [[x for x in sets(b) if min(map(len, x)) > 1] for b in branches]


def _folded(text: str) -> str:
    """Like regular expressions that ignore case see it."""
    return text.lower() if text.isascii() else text.casefold().replace("i\u0307", "i").replace("\u0131", "i")


_NOTICE_STEMS, _COPY_STEMS = stems(NOTICE.pattern), stems(COPY_NOTICE.pattern)
#: What stands in the forms of copy notices that have no stems.
_VERSION, _POINT = re.compile(r"(?i)(?:v|version |release |@)\d+\.\d"), re.compile(r"\d\.\d")
_TEXTS = sorted({x for branch in (*_NOTICE_STEMS, *_COPY_STEMS) for texts in branch for x in texts})
_FINDER: list = []


def _stems_in(low: str) -> set[str]:
    """The stems that stand in a text: all are looked for in one pass (Aho and Corasick)."""
    if not _FINDER:
        import ahocorasick

        finder = ahocorasick.Automaton()
        for x in _TEXTS:
            finder.add_word(x, x)
        finder.make_automaton()
        _FINDER.append(finder)
    return {x for _, x in _FINDER[0].iter(low)}


_NOTICE_ALL, _COPY_ALL = re.compile(NOTICE.pattern, re.M), re.compile(COPY_NOTICE.pattern, re.M)


def _lines_with(code: str, there: set[str], needed: list[list[frozenset[str]]], over_all: re.Pattern, pattern: re.Pattern, lines: list[str]) -> set[int]:
    """Numbers of the lines that the pattern matches. Most texts have none of the stems; in the others matches over the whole
    text name the lines to look at, as a match within a line is one of the text, or overlaps one."""
    version = None
    for sets in needed:
        if not sets and version is None:
            version = _POINT.search(code) is not None and _VERSION.search(code) is not None
        if all(not texts.isdisjoint(there) for texts in sets) if sets else version:
            break
    else:
        return set()
    near: set[int] = set()
    for m in over_all.finditer(code):
        a = code.count("\n", 0, m.start())
        near.update(range(a, a + m.group().count("\n") + 1))
    return {k for k in near if pattern.search(lines[k])}


def _comments(path: str, code: str) -> list[tuple[int, int]]:
    """(start, end) of the comments, those in literals left out."""
    lexer = secrets._PYTHON if path.lower().endswith((".py", ".pyi")) or (not path and re.search(r"(?m)^\s*#", code)) else secrets._SCRIPT
    return [m.span() for m in lexer.finditer(code) if m["c"] is not None]


@functools.lru_cache(maxsize=8)
def notices(path: str, code: str) -> tuple[set[int], set[int]]:
    """Numbers of the lines (from 0) with a program's notice and with a notice of a copy.

    In the first lines and in the comments before all code any form counts; in the comments after that, down to the last
    line, a form that says what the file is: it begins the comment's line, or the file is its subject.
    """
    lines, there = code.split("\n"), _stems_in(_folded(code))
    all_made = _lines_with(code, there, _NOTICE_STEMS, _NOTICE_ALL, NOTICE, lines)
    all_copied = _lines_with(code, there, _COPY_STEMS, _COPY_ALL, COPY_NOTICE, lines)
    made, copied = {k for k in all_made if k < 12}, {k for k in all_copied if k < 8}
    some = sorted(k for k in all_made | all_copied if k >= 8)
    if not some:
        return made, copied
    starts = np.cumsum([0, *(len(x) + 1 for x in lines)])
    spans, at, lead = _comments(path, code), 0, 0
    for a, b in spans:  # where the code begins
        if code[at:a].strip():
            break
        at = lead = b
    for k in some:
        for a, b in spans:
            lo, hi = max(a, int(starts[k])), min(b, int(starts[k]) + len(lines[k]))
            if lo >= hi:
                continue
            text = code[lo:hi].lstrip(" \t#/*-;!\"'")
            m = NOTICE.match(text)
            if NOTICE.search(text) and (hi <= lead or (m and not _FORBIDS.match(m.group())) or _SUBJECT.match(text)):
                made.add(k)
            if COPY_NOTICE.search(text) and (hi <= lead or COPY_NOTICE.match(text)):
                copied.add(k)
    return made, copied


#: How every such array begins.
_OPENS = re.compile(r"\[\s*\{")


def _data_array(path: str, code: str) -> bool:
    """Whether arrays of records are most of the text besides comments."""
    if not _OPENS.search(code):
        return False
    size = sum(m.end() - m.start() for m in _ARRAY.finditer(code))
    return size > 0 and 2 * size > len(code) - sum(b - a for a, b in _comments(path, code))


def flags_of(path: str, code: str, libraries: frozenset[str]) -> np.ndarray:
    """FLAGS as 0/1."""
    low = path.lower()
    made, copied = notices(path, code)
    parts = re.split(r"[/._~\-]+", low)
    n = max(1, len(code))
    lines = code.split("\n")
    longest = max(map(len, lines))
    blanks = (len(code) - len("".join(code.split()))) / n
    # numbers have no other characters than these, so a text with few of them has few numbers
    some = not code.isascii() or 5 * (len(code) - len(code.translate(_NO_NUMBERS))) > n
    digits = len("".join(_NUMBER.findall(code))) / n if some else 0.0
    blob = sum(len(m) for m in _BLOB.findall(code))
    records = _RECORD.findall(code) if code.lstrip()[:1] == "[" or "= [{" in code[:200] else []
    rows = [x for x in lines if x.count(",") >= 3]
    return np.array(
        [
            bool(made),
            bool(copied),
            any(p in libraries for p in parts),
            bool(MACHINE_NAME.search(low)),
            bool(VENDOR_PLACE.search(low)),
            (longest > 400 and blanks < 0.11) or (n > 300 and blanks < 0.06 and longest > 200),
            digits > 0.2,
            blob > 0.5 * n and blob >= 200,
            len(records) >= 8 or _data_array(path, code) or (n > 400 and len(rows) > 0.9 * len(lines) and len({x.count(",") for x in rows}) == 1),
            len(_LOCK.findall(code)) >= 3,
        ],
        np.float32,
    )


def seed(flags: np.ndarray) -> int:
    """1 where a giveaway makes a file positive, else 0. A place alone is no proof; a place with a library or notice is."""
    f = dict(zip(FLAGS, flags.tolist(), strict=True))
    return int(bool(f["notice"] or f["copy_notice"] or f["known_library"] or f["machine_name"] or f["dense_lines"] or f["numbers"] or f["blob"] or f["records"] or f["lock"]))


_NAME = re.compile(r"[A-Za-z]{5,}")


def masked(code: str, libraries: frozenset[str], path: str = "") -> str:
    """The text without the lines of its giveaway notices and names of known libraries."""
    made, copied = notices(path, code)
    lines = code.split("\n")
    text = "\n".join(x for k, x in enumerate(lines) if not (k in made or k in copied or (8 <= k < 12 and COPY_NOTICE.search(x))))
    if libraries.isdisjoint(x.lower() for x in set(_NAME.findall(text))):
        return text
    return _NAME.sub(lambda m: "\x01lib" if m.group().lower() in libraries else m.group(), text)


_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a") : ord("z") + 1] = ord("a")
_SHAPE[ord("A") : ord("Z") + 1] = ord("A")
_SHAPE[ord("0") : ord("9") + 1] = ord("0")


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """Places among DIM - 256 of packed n-grams."""
    with np.errstate(over="ignore"):
        h = (h + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(40)).astype(np.int64) % (DIM - 256)


def _packed(b: np.ndarray) -> np.ndarray:
    """The 3-grams of bytes, each as a number."""
    w = b.astype(np.uint64)
    return (w[:-2] << np.uint64(16)) | (w[1:-1] << np.uint64(8)) | w[2:]


def _grams(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of a text's 3-grams, and of the 4-grams and 6-grams of its shape."""
    none = np.empty(0, np.int64)
    if len(b) < 3:
        return none, none
    shape = _SHAPE[b]
    three = _packed(shape)
    four = _mixed((three[:-1] << np.uint64(8)) | shape[3:], 1 << 33) if len(b) > 3 else none
    six = _mixed((three[:-3] << np.uint64(24)) | three[3:], 1 << 50) if len(b) > 5 else none
    return _mixed(_packed(b), 3), np.concatenate([four, six])


def features(path: str, code: str, flags: np.ndarray, libraries: frozenset[str], hide: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values): three blocks of length 1 (text n-grams, shape n-grams, path components) and the flags."""
    b = np.frombuffer(masked(code, libraries, path).encode("utf-8", "surrogatepass"), np.uint8)
    idx, val = [], []
    for grams in _grams(b):
        if len(grams):
            i, c = np.unique(grams, return_counts=True)
            v = np.log1p(c).astype(np.float32)
            idx.append(i)
            val.append(v / np.sqrt((v * v).sum()))
    import zlib

    low = path.lower()
    parts = [("\x01lib" if p in libraries else p) for p in re.split(r"[/._~\-]+", low) if p]
    names = {f"d:{x}" for x in low.split("/")[:-1]} | {f"p:{x}" for x in parts[-4:]} | {"e:" + low.rsplit("/", 1)[-1].partition(".")[2]}
    i = np.unique(np.array([zlib.crc32(x.encode()) % (DIM - 256) for x in sorted(names)], np.int64))
    idx.append(i)
    val.append(np.full(len(i), 1 / np.sqrt(max(1, len(i))), np.float32))
    f = np.zeros_like(flags) if hide else flags
    on = np.flatnonzero(f)
    idx.append(DIM - 256 + on)
    val.append(f[on] * 1.0)
    idx.append(np.array([DIM - 1]))
    val.append(np.array([1.0], np.float32))
    return np.concatenate(idx), np.concatenate(val).astype(np.float32)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 6, strength: float = 3e-5, seed_: int = 5) -> np.ndarray:
    """Weights of the support-vector classifier: averaged stochastic subgradients of the hinge loss, classes weighted alike."""
    rng = np.random.default_rng(seed_)
    y = np.array([r[2] for r in rows])
    pos = max(1, int(y.sum()))
    weight = {1: len(y) / (2 * pos), 0: len(y) / (2 * max(1, len(y) - pos))}
    w, total, scale, t = np.zeros(DIM), np.zeros(DIM), 1.0, 0
    for e in range(epochs):
        for k in rng.permutation(len(rows)):
            t += 1
            i, v, label = rows[k]
            s = 1 if label else -1
            step = 1 / (strength * (t + 20_000))
            margin = s * scale * float(w[i] @ v)
            scale *= 1 - strength * step
            if margin < 1:
                np.add.at(w, i, s * step * min(3.0, weight[label]) * v / scale)
            if scale < 1e-3:
                w *= scale
                scale = 1.0
        if e >= epochs // 2:
            total += w * scale
    return total / (epochs - epochs // 2)


def train(files: DataFrame, libraries: DataFrame) -> tuple[np.ndarray, float, dict, frozenset[str]]:
    """(weights, threshold, validation figures, library names). Fitting runs as one task on the features of the bounded sample."""
    names = [r[0] for r in libraries.select(F.lower("lib_name")).distinct().limit(MOST_LIBRARIES + 1).collect() if r[0]]
    if len(names) > MOST_LIBRARIES:
        raise ValueError("the table of known libraries is too large to send to every task")
    libs = frozenset(names)
    step = max(1, -(-files.count() // TRAIN_ROWS))
    part = F.when(F.pmod(F.xxhash64("repo_full_name"), F.lit(10)) < 2, "tune").when(F.pmod(F.xxhash64("repo_full_name"), F.lit(10)) < 4, "report").otherwise("fit")
    sample = files.where(F.pmod(F.xxhash64("file_id", F.lit("train")), F.lit(step)) == 0).select(
        "file_path", "code", part.alias("part"), F.pmod(F.xxhash64("file_id"), F.lit(2)).cast("boolean").alias("hide")
    )

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            out = []
            for path, code, part, hide in p[["file_path", "code", "part", "hide"]].itertuples(index=False):
                path, code = path if isinstance(path, str) else "", code if isinstance(code, str) else ""
                f = flags_of(path, code, libs)
                for hidden in [bool(hide)] if part == "fit" else [False] if part == "tune" else [False, True]:
                    i, v = features(path, code, f, libs, hidden)
                    out.append((part, hidden, seed(f), i.astype(np.int32).tobytes(), v.tobytes()))
            yield pd.DataFrame(out, columns=["part", "hidden", "label", "at", "value"])

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["at", "value", "hidden"])  # the order of rows, and so the fit, does not depend on the partitions
        row = lambda x: (np.frombuffer(x.at_, np.int32), np.frombuffer(x.value, np.float32), x.label)
        p = p.rename(columns={"at": "at_"})
        of = lambda part, hidden=None: [row(x) for x in p[(p.part == part) & ((p.hidden == hidden) if hidden is not None else True)].itertuples()]
        rows = of("fit")
        w = fit(rows) if rows else np.zeros(DIM)

        def score(held: list) -> tuple[np.ndarray, np.ndarray]:
            return np.array([w[i] @ v for i, v, _ in held]), np.array([r[2] for r in held], bool)

        def right(s: np.ndarray, y: np.ndarray, cut: float) -> tuple[float, float]:
            tp = int(((s > cut) & y).sum())
            return tp / max(1, int((s > cut).sum())), tp / max(1, int(y.sum()))

        s, y = score(of("tune"))
        f1 = {float(t): round(2 * int(((s > t) & y).sum()) / max(1, int((s > t).sum()) + int(y.sum())), 9) for t in np.linspace(-0.5, 0.5, 41)}
        cut = min(f1, key=lambda t: (-f1[t], abs(t), t)) if len(s) else 0.0
        plain, hidden = score(of("report", False)), score(of("report", True))
        values = {"rows": len(rows), "tuned_on": len(s), "reported_on": len(plain[1]), "reported_positive": int(plain[1].sum())}
        values |= dict(zip(("precision", "recall"), right(*plain, cut), strict=True)) | dict(zip(("precision_masked", "recall_masked"), right(*hidden, cut), strict=True))
        return pd.DataFrame({"w": [w.astype(np.float32).tobytes()], "cut": [cut], "figures": [list(values.values())], "names": [list(values)]})

    made = sample.mapInPandas(vectors, "part string, hidden boolean, label int, at binary, value binary")
    got = made.groupBy(F.lit(1).alias("one")).applyInPandas(run, "w binary, cut double, figures array<double>, names array<string>").collect()  # one group: the sample is bounded
    if not got:
        return np.zeros(DIM, np.float32), 0.0, {"rows": 0}, libs
    r = got[0]
    return np.frombuffer(r["w"], np.float32), r["cut"], dict(zip(r["names"], r["figures"], strict=True)), libs


def scored(files: DataFrame, weights: np.ndarray, cut: float, libs: frozenset[str]) -> DataFrame:
    """(file_id, score, hand_written): every file; the score is the distance from the threshold."""
    shared = files.sparkSession.sparkContext.broadcast((weights, libs))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, names = shared.value
        for p in batches:
            out = []
            for path, code in zip(p.file_path, p.code, strict=True):
                path, code = path if isinstance(path, str) else "", code if isinstance(code, str) else ""
                if not code.strip():
                    out.append(-1.0)
                    continue
                i, v = features(path, code, flags_of(path, code, names), names)
                out.append(float(w[i] @ v) - cut)
            s = np.array(out, np.float64)
            yield pd.DataFrame({"file_id": p.file_id, "score": s, "hand_written": s <= 0})

    return files.select("file_id", "file_path", "code").mapInPandas(run, "file_id bigint, score double, hand_written boolean")
