"""Problem 10: the languages of documents and of their segments.

Character n-gram models of the languages are counted from labelled documents: a sample of at most TRAIN_DOCS documents,
dealt by a hash of doc_id, whose labels are usable. Labels are partly wrong, so paragraphs of the sample are relabelled
by the first models and counted once more. The models are one table of fixed size (BUCKETS hashed n-grams per language).

A document is a mixture of languages: expectation-maximisation over its words estimates the proportions, and languages
enter the set one by one as long as the likelihood gains more than PENALTY and a logarithm of the length. Within that
set the best sequence of languages over the paragraphs is found, where each change costs SWITCH (Viterbi), so a short
heading goes with its surroundings. Paragraphs are parted by blank lines; code, addresses, identifiers and numbers are
no evidence; paragraphs without any are in no segment and part none.

Cases: null, empty and white-space texts and those without natural language have no segments; the label is compared
after its notation (case, region, three letters, English name) is reduced to a two-letter code; others are unusable.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The languages told apart, with the other notations of their labels.
NOTATIONS = {
    "en": ("eng", "english"),
    "de": ("deu", "ger", "german", "deutsch"),
    "fr": ("fra", "fre", "french", "français", "francais"),
    "es": ("spa", "spanish", "español", "espanol", "castilian"),
    "pt": ("por", "portuguese", "português", "portugues"),
    "it": ("ita", "italian", "italiano"),
    "nl": ("nld", "dut", "dutch", "nederlands", "flemish"),
    "ru": ("rus", "russian", "русский"),
    "zh": ("zho", "chi", "cmn", "chinese", "中文"),
    "ja": ("jpn", "japanese", "日本語"),
}
LANGUAGES = tuple(NOTATIONS)
_CODE = {n: k for k, v in NOTATIONS.items() for n in (k, *v)}
#: Documented bound of the labelled sample; everything else covers all documents.
TRAIN_DOCS = 20_000
BUCKETS, PENALTY, SWITCH, NEED = 1 << 16, 8.0, 6.0, 3

_FENCE = re.compile(r"^[ \t]*(```|~~~).*?(?:^[ \t]*\1[^\n]*$|\Z)", re.M | re.S)
_DROP = re.compile(r"`[^`\n]*`|\b[a-z][a-z0-9+.\-]*://\S+|\bwww\.\S+|\S+@\S+\.\S+|</?[a-zA-Z][^>\n]*>")
_TITLE = re.compile(r"^[ \t]*#+[ \t]*[\w.\-/]+[ \t]*$", re.M)
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_CJK = re.compile(r"[぀-ヿ㐀-鿿ｦ-ﾟ]")
_TITLE_CJK = re.compile(r"[^\x00-\x7f]")


def code_of(label: str | None) -> str | None:
    """The two-letter code that a label means, None if it means none of the languages."""
    if not label:
        return None
    s = label.strip().lower()
    return _CODE.get(s) or _CODE.get(re.split(r"[-_ (]", s, maxsplit=1)[0])


def words_of_token(token: str) -> list[str]:
    """The words of what stands between white space that tell of a language, in lower case."""
    core = token.strip(".,;:!?()[]\"'«»„“”‘’。、，！？：；（）「」*-–—>#|")
    if not core:
        return []
    if not _CJK.search(core) and (re.search(r"[\d_/\\=@{}<>$%]|\w\.\w|\w\(\)", core) or re.search(r"[a-z][A-Z]", core) or len(core) > 28):
        return []
    return [w.lower() for w in _WORD.findall(core)]


def _tokens(paragraph: str) -> list[str]:
    p = paragraph
    if "#" in p:
        p = _TITLE.sub(lambda m: m.group() if _TITLE_CJK.search(m.group()) else " ", p)
    if "`" in p or "@" in p or "<" in p or "://" in p or "www." in p:  # without one of these nothing is dropped
        p = _DROP.sub(" ", p)
    return p.split()


def words_of(paragraph: str) -> list[str]:
    """Words that tell of a language, in lower case. Runs of Chinese or Japanese characters count as words."""
    return [w for t in _tokens(paragraph) for w in words_of_token(t)]


def _paragraphs(text: str) -> list[str]:
    t = text.replace("\r\n", "\n").replace("\r", "\n")
    if not t.isascii():
        t = re.sub(r"[​‌‍﻿­]", "", unicodedata.normalize("NFC", t))
    if "```" in t or "~~~" in t:
        t = _FENCE.sub("\n\n", t)
    return re.split(r"\n[^\S\n]*\n", t)


def paragraphs_of(text: str) -> list[list[str]]:
    """The words of each paragraph outside code blocks."""
    return [words_of(p) for p in _paragraphs(text)]


def has_language(words: list[str]) -> bool:
    """Enough letters: NEED at least, or two characters of Chinese or Japanese."""
    s = "".join(words)
    return len(s) >= NEED or len(_CJK.findall(s)) >= 2


def grams(word: str) -> list[int]:
    """Buckets of a word's 1- to 4-grams; the word's ends are marked."""
    import zlib

    w = f" {word} "
    n = len(w)
    return [zlib.crc32(w[i : i + k].encode("utf-8", "surrogatepass")) % BUCKETS for k in (1, 2, 3, 4) for i in range(n - k + 1) if k > 1 or w[i] != " "]


class Words:
    """Numbers for words, so that texts become arrays; what is known of a token or a word is worked out once."""

    #: Words and tokens kept before a worker starts afresh; between batches only.
    KEEP = 500_000

    def __init__(self):
        self.tokens: dict[str, tuple[int, ...]] = {}
        self.number: dict[str, int] = {}
        self.names: list[str] = []
        self.letters: list[int] = []
        self.cjk: list[int] = []

    def fresh(self) -> None:
        if len(self.tokens) > self.KEEP:
            Words.__init__(self)

    def word(self, w: str) -> int:
        k = self.number.get(w)
        if k is None:
            k = self.number[w] = len(self.names)
            self.names.append(w)
            self.letters.append(len(w))
            self.cjk.append(len(_CJK.findall(w)))
        return k

    def flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word numbers, words of each paragraph, text of each paragraph) of the paragraphs with natural language."""
        known = self.tokens
        ids: list[int] = []
        sizes, docs = [], []
        for d, text in enumerate(texts):
            if not isinstance(text, str) or not text or text.isspace():
                continue
            for p in _paragraphs(text):
                begin = len(ids)
                for t in _tokens(p):
                    v = known.get(t)
                    if v is None:
                        v = known[t] = tuple(map(self.word, words_of_token(t)))
                    ids += v
                if len(ids) > begin:
                    sizes.append(len(ids) - begin)
                    docs.append(d)
        ids_, sizes_, docs_ = np.array(ids, np.int64), np.array(sizes, np.int64), np.array(docs, np.int64)
        if not len(sizes_):
            return ids_, sizes_, docs_
        starts = np.cumsum(sizes_) - sizes_
        enough = (np.add.reduceat(np.array(self.letters)[ids_], starts) >= NEED) | (np.add.reduceat(np.array(self.cjk)[ids_], starts) >= 2)
        return ids_[np.repeat(enough, sizes_)], sizes_[enough], docs_[enough]


def flat_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all words one after the other, where each word's begin)."""
    each = [grams(w) for w in words]
    n = np.fromiter(map(len, each), np.int64, len(each))
    return np.fromiter((g for x in each for g in x), np.int64, int(n.sum())), np.cumsum(n) - n


class Models(Words):
    """log p(bucket | language), languages x BUCKETS, and the log-likelihoods of the words met so far."""

    def __init__(self, counts: np.ndarray):
        super().__init__()
        smooth = counts + 0.05
        self.logp = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)
        self.table = np.empty((0, len(counts)))

    def fresh(self) -> None:
        if len(self.tokens) > self.KEEP:
            Words.__init__(self)
            self.table = self.table[:0]

    def like(self, ids: np.ndarray) -> np.ndarray:
        """Words x languages; n-grams overlap, so each counts for a third."""
        if len(self.table) < len(self.names):
            b, starts = flat_grams(self.names[len(self.table) :])
            self.table = np.concatenate([self.table, np.add.reduceat(self.logp[:, b].T.astype(np.float64), starts, axis=0) / 3])
        return self.table[ids]

    def matrix(self, words: list[str]) -> np.ndarray:
        return self.like(np.array([self.word(w) for w in words]))


def proportions(like: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, float]:
    """(proportions, log-likelihood) of the mixture over words (words x languages) by expectation-maximisation."""
    top = like.max(axis=1, keepdims=True)
    p = np.exp(like - top)
    pi = np.full(like.shape[1], 1 / like.shape[1])
    for _ in range(rounds):
        r = p * pi
        pi = (r / r.sum(axis=1, keepdims=True)).mean(axis=0)
    return pi, float((np.log((p * pi).sum(axis=1)) + top[:, 0]).sum())


def language_sets(like: np.ndarray, sizes: np.ndarray, rounds: int = 12) -> list[tuple[list[int], np.ndarray]]:
    """For each document (sizes: its words, rows of like) the languages whose mixture has the best penalised likelihood.

    Sets grow one by one. Expectation-maximisation between the mixture so far and each further language, for all documents and
    languages at once, names the best further language; with three or more its proportions are then estimated anew.
    """
    starts = np.cumsum(sizes) - sizes
    total = np.add.reduceat(like, starts, axis=0)
    chosen = [[int(k)] for k in total.argmax(axis=1)]
    pi = [np.ones(1) for _ in chosen]
    best = total.max(axis=1)
    least = best + PENALTY + np.log(sizes)
    mix = like[np.arange(len(like)), np.repeat(total.argmax(axis=1), sizes)]  # log-likelihoods of the words by the mixtures so far
    top = mix.copy()  # by the likeliest of the languages chosen
    open_ = np.arange(len(sizes))
    while len(open_):
        rows = np.concatenate([np.arange(starts[d], starts[d] + sizes[d]) for d in open_]) if len(open_) < len(sizes) else np.arange(len(like))
        n = sizes[open_]
        at = np.cumsum(n) - n
        most = np.add.reduceat(np.maximum(like[rows], top[rows, None]), at, axis=0)  # no mixture with a further language is likelier
        able = most > least[open_, None]
        for i, d in enumerate(open_.tolist()):
            able[i, chosen[d]] = False
        some = able.any(axis=1)
        keep = np.repeat(some, n)
        open_, able, rows, n = open_[some], able[some], rows[keep], n[some]
        if not len(open_):
            break
        at = np.cumsum(n) - n
        ratio = np.exp(np.minimum(like[rows] - mix[rows, None], 300.0))
        share = np.full(able.shape, 0.5)
        for _ in range(rounds):
            x = np.repeat(share, n, axis=0)
            x *= ratio
            x /= x + 1 - np.repeat(share, n, axis=0)
            share = np.add.reduceat(x, at, axis=0) / n[:, None]
        x = np.repeat(share, n, axis=0)
        gain = np.add.reduceat(np.log(1 - x + x * ratio), at, axis=0)
        gain[~able] = -np.inf
        more = gain.argmax(axis=1)
        again = []
        for i, d in enumerate(open_.tolist()):
            k, r = int(more[i]), slice(starts[d], starts[d] + sizes[d])
            if len(chosen[d]) == 1:
                q, ll = np.array([1 - share[i, k], share[i, k]]), best[d] + gain[i, k]
            else:
                q, ll = proportions(like[r][:, [*chosen[d], k]], rounds)
            if ll > least[d]:
                chosen[d], pi[d], best[d], least[d] = [*chosen[d], k], q, ll, ll + PENALTY + np.log(sizes[d])
                own = like[r][:, chosen[d]]
                top[r] = own.max(axis=1)
                mix[r] = np.log((np.exp(own - top[r][:, None]) * q).sum(axis=1)) + top[r]
                again.append(d)
        open_ = np.array(again, np.int64)
    return list(zip(chosen, pi, strict=True))


def language_set(like: np.ndarray) -> tuple[list[int], np.ndarray]:
    return language_sets(like, np.array([len(like)]))[0]


def _path(like: np.ndarray, chosen: list[int], pi: np.ndarray) -> np.ndarray:
    """The best sequence of the chosen languages over the paragraphs (Viterbi)."""
    score = like[:, chosen] + np.log(np.maximum(pi, 1e-4))
    path = np.empty(len(like), np.int64)
    back = np.zeros(score.shape, np.int64)
    now = score[0].copy()
    for i in range(1, len(like)):
        stay, change = now, now.max() - SWITCH
        back[i] = np.where(stay >= change, np.arange(len(chosen)), int(now.argmax()))
        now = np.maximum(stay, change) + score[i]
    path[-1] = int(now.argmax())
    for i in range(len(like) - 1, 0, -1):
        path[i - 1] = back[i][path[i]]
    return np.array(chosen)[path]


def segments_of_all(texts: list[str | None], models: Models) -> tuple[np.ndarray, ...]:
    """(text, seg_no, language, confidence, words) of the segments of all texts."""
    ids, sizes, docs = models.flat(texts)
    if not len(ids):
        z = np.empty(0, np.int64)
        return z, z, z, np.empty(0), z
    like = models.like(ids)
    first = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])  # each text's first paragraph
    paras = np.diff(np.r_[first, len(docs)])
    para = np.add.reduceat(like, np.cumsum(sizes) - sizes, axis=0)
    sets = language_sets(like, np.add.reduceat(sizes, first))
    lang = np.repeat(np.array([c[0] for c, _ in sets]), paras)
    for (chosen, pi), a, k in zip(sets, first.tolist(), paras.tolist(), strict=True):
        if len(chosen) > 1:
            lang[a : a + k] = _path(para[a : a + k], chosen, pi)
    head = np.flatnonzero(np.r_[True, (docs[1:] != docs[:-1]) | (lang[1:] != lang[:-1])])
    total, n, doc, lang = np.add.reduceat(para, head, axis=0), np.add.reduceat(sizes, head), docs[head], lang[head]
    odds = np.exp((total - total.max(axis=1, keepdims=True)) / np.maximum(1.0, n**0.5)[:, None])  # words of a text are not independent
    number = np.arange(len(head)) - np.searchsorted(doc, doc, "left")
    return doc, number, lang, odds[np.arange(len(head)), lang] / odds.sum(axis=1), n


def segments_of(text: str | None, models: Models) -> list[tuple[int, str, float, int]]:
    """(seg_no, language, confidence, words) of a text."""
    _, number, lang, confidence, n = segments_of_all([text], models)
    return [(int(i), LANGUAGES[k], float(c), int(m)) for i, k, c, m in zip(number, lang, confidence, n, strict=True)]


def _count(rows: DataFrame, shared) -> np.ndarray:
    """Counts of hashed n-grams per language, languages x BUCKETS: a table of fixed size, whatever the input's."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Models(shared.value) if shared is not None else Words()
        total = np.zeros((len(LANGUAGES), BUCKETS), np.int64)

        def add(by: np.ndarray) -> None:
            """Counts of words (languages x words) become counts of their n-grams."""
            some = np.flatnonzero(by.any(axis=0))
            b, starts = flat_grams([words.names[i] for i in some])
            n = np.diff(np.r_[starts, len(b)])
            for k in range(len(LANGUAGES)):
                total[k] += np.bincount(b, np.repeat(by[k, some], n), minlength=BUCKETS).astype(np.int64)

        held = np.zeros((len(LANGUAGES), 0), np.int64)
        for p in batches:
            given = [code_of(x) for x in p.lang]
            ids, sizes, docs = words.flat([t if g else None for g, t in zip(given, p.text, strict=True)])
            if not len(ids):
                continue
            if shared is None:
                label = np.array([LANGUAGES.index(g) if g else 0 for g in given])[docs]
            else:
                label = np.add.reduceat(words.like(ids), np.cumsum(sizes) - sizes, axis=0).argmax(axis=1)
            size = len(words.names)
            by = np.bincount(np.repeat(label, sizes) * size + ids, minlength=len(LANGUAGES) * size).reshape(len(LANGUAGES), size)
            by[:, : held.shape[1]] += held
            held = by
            if len(words.tokens) > words.KEEP:
                add(held)
                words.fresh()
                held = held[:, :0]
        if held.size:
            add(held)
        k, b = np.nonzero(total)
        yield pd.DataFrame({"k": k.astype(np.int32), "b": b.astype(np.int32), "n": total[k, b]})

    got = rows.select("lang", "text").mapInPandas(count, "k int, b int, n bigint").groupBy("k", "b").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros((len(LANGUAGES), BUCKETS), np.float64)
    out[got.k.to_numpy(), got.b.to_numpy()] = got.n.to_numpy()
    return out


def train(documents: DataFrame, bound: int = TRAIN_DOCS) -> np.ndarray:
    """Counts for Models, from at most about `bound` labelled documents, relabelled once."""
    labelled = documents.where(F.col("lang").isNotNull() & (F.trim("lang") != "")).select("doc_id", "lang", "text")
    step = max(1, -(-labelled.count() // bound))
    some = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0)
    first = _count(some, None)
    return _count(some, documents.sparkSession.sparkContext.broadcast(first.astype(np.float32)))


def segments(documents: DataFrame, counts: np.ndarray) -> DataFrame:
    """(doc_id, seg_no, lang, confidence, n_words, label_code, n_langs) of all documents with natural language."""
    shared = documents.sparkSession.sparkContext.broadcast(counts.astype(np.float32))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = Models(shared.value)
        names = np.array(LANGUAGES, object)
        for p in batches:
            doc, number, lang, confidence, n = segments_of_all([t if isinstance(t, str) else None for t in p.text], models)
            label = np.array([code_of(x) for x in p.lang], object)
            several = np.bincount(np.unique(doc * len(LANGUAGES) + lang) // len(LANGUAGES), minlength=len(p)) if len(doc) else np.zeros(len(p), np.int64)
            yield pd.DataFrame(
                {
                    "doc_id": p.doc_id.to_numpy()[doc], "seg_no": number.astype(np.int32), "lang": names[lang], "confidence": np.round(confidence, 6),
                    "n_words": n.astype(np.int32), "label_code": label[doc], "n_langs": several[doc].astype(np.int32),
                }
            )
            models.fresh()

    schema = "doc_id bigint, seg_no int, lang string, confidence double, n_words int, label_code string, n_langs int"
    return documents.select("doc_id", "lang", "text").mapInPandas(split, schema)


def found(segs: DataFrame) -> DataFrame:
    """Segments of the documents whose label is missing, unusable or wrong, or that have several languages."""
    return segs.where(F.col("label_code").isNull() | (F.col("n_langs") > 1) | (F.col("label_code") != F.col("lang"))).select("doc_id", "seg_no", "lang")


def of_documents(segs: DataFrame) -> DataFrame:
    """One row per document with natural language: the language of most words, its confidence and share, and what the label is."""
    by = segs.groupBy("doc_id", "label_code", "lang").agg(F.sum("n_words").alias("n"), F.sum(F.col("confidence") * F.col("n_words")).alias("c"))
    best = by.groupBy("doc_id", "label_code").agg(
        F.max_by("lang", F.struct("n", "lang")).alias("main_lang"), F.max_by(F.col("c") / F.col("n"), F.struct("n", "lang")).alias("confidence"), F.max("n").alias("m"), F.sum("n").alias("t"), F.count("*").alias("n_langs")
    )
    verdict = F.when(F.col("label_code").isNull(), "missing").when(F.col("n_langs") > 1, "mixed").when(F.col("label_code") != F.col("main_lang"), "wrong").otherwise("ok")
    return best.select("doc_id", "main_lang", F.round("confidence", 6).alias("confidence"), F.round(F.col("m") / F.col("t"), 6).alias("share"), "n_langs", verdict.alias("label"))
