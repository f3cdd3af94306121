"""Problem 8: the whole corpus as ids of a public byte-level BPE vocabulary.

Two tiers. A minimal perfect hash over the vocabulary's byte strings resolves pre-tokens that are whole entries;
the others are merged with a heap over a linked list of bytes, O(n log n) for a pre-token of n bytes. A pre-token
is looked up once per Arrow batch, however often it occurs there.

Cases: null and empty texts give []; special tokens' strings are ordinary text; texts are never cut; lone
surrogates cannot occur in Spark strings.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm.common import mix64

#: Fixed value: the pre-token pattern of the byte_bpe_50k vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def _hashes(keys: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))


@dataclass(frozen=True)
class PerfectHash:
    """Hash and displace: a key's bucket names a seed under which all keys of the bucket have slots of their own.

    n keys take n slots. `find` compares the stored key, so strangers give -1.
    """

    seeds: np.ndarray
    keys: list[bytes]
    ids: np.ndarray

    @staticmethod
    def build(entries: dict[bytes, int], per_bucket: int = 3) -> "PerfectHash":
        names = list(entries)
        n, h = len(names), _hashes(names)
        buckets = max(1, n // per_bucket)
        where = (h % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(where, kind="stable")
        parts = np.split(order, np.cumsum(np.bincount(where, minlength=buckets))[:-1])
        seeds, taken = np.zeros(buckets, np.uint64), np.zeros(n, bool)
        slot_of = np.empty(n, np.int64)
        tries = np.arange(1, 257, dtype=np.uint64)
        for b in sorted(range(buckets), key=lambda b: -len(parts[b])):
            own = h[parts[b]]
            if not len(own):
                continue
            base = np.uint64(0)
            while True:
                s = base + tries
                slots = PerfectHash._slot(own[None, :], s[:, None], n)
                free = ~taken[slots].any(axis=1)
                if len(own) > 1:
                    ordered = np.sort(slots, axis=1)
                    free &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if free.any():
                    i = int(np.argmax(free))
                    seeds[b], slot_of[parts[b]] = s[i], slots[i]
                    taken[slots[i]] = True
                    break
                base += np.uint64(256)
        keys: list[bytes] = [b""] * n
        ids = np.empty(n, np.int32)
        for i, name in enumerate(names):
            keys[slot_of[i]] = name
            ids[slot_of[i]] = entries[name]
        return PerfectHash(seeds, keys, ids)

    @staticmethod
    def _slot(h: np.ndarray, seed: np.ndarray, n: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix64(h ^ (seed * np.uint64(0x9E3779B97F4A7C15))) % np.uint64(n)).astype(np.int64)

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Ids of the keys, -1 where a key is none of the vocabulary."""
        if not keys:
            return np.empty(0, np.int32)
        h = _hashes(keys)
        slots = self._slot(h, self.seeds[(h % np.uint64(len(self.seeds))).astype(np.int64)], len(self.keys))
        own = self.keys
        same = np.fromiter((own[s] == k for s, k in zip(slots.tolist(), keys, strict=True)), bool, len(keys))
        return np.where(same, self.ids[slots], -1).astype(np.int32)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte pair merges in order of rank, leftmost first; the parts form a linked list, the merges a heap."""
    n = len(word)
    end = list(range(1, n + 1))  # end[i]: where the part that starts at i ends; 0 once it is swallowed
    prev = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        mid = end[i]
        if not mid or mid >= n or end[mid] != stop:
            continue
        end[i], end[mid] = stop, 0
        if stop < n:
            prev[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := prev[i]) >= 0 and (r := ranks.get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Made once per Python worker from the vocabulary, which is of fixed size (some 50,000 entries)."""

    def __init__(self, ranks: dict[bytes, int], table: PerfectHash | None = None):
        import regex

        self.ranks, self.table, self.pattern = ranks, table or PerfectHash.build(ranks), regex.compile(PATTERN)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Each text's ids."""
        words = [self.pattern.findall(t) if t else [] for t in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        codes, names = pd.factorize(np.array([w for x in words for w in x], dtype=object))
        keys = [w.encode("utf-8") for w in names]
        whole = self.table.find(keys)
        parts: list[np.ndarray] = [np.array([i], np.int32) for i in whole]
        for k in np.flatnonzero(whole < 0):
            parts[k] = np.array(merge_bytes(keys[k], self.ranks), np.int32)
        ends = np.cumsum(counts)
        if not len(codes):
            return [np.empty(0, np.int32) for _ in words]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = np.concatenate(parts)
        starts = np.cumsum(sizes) - sizes
        n = sizes[codes]
        to = np.cumsum(n)
        picks = np.repeat(starts[codes] - (to - n), n) + np.arange(int(to[-1]))
        ids = flat[picks]
        cuts = np.r_[0, to][ends]
        return np.split(ids, cuts[:-1]) if len(cuts) > 1 else [ids]


_made: dict[str, Encoder] = {}


def _encoder(key: str, shared) -> Encoder:
    """One encoder per worker process; a new broadcast (another session) makes another."""
    if key not in _made:
        _made.clear()
        ranks, table = shared.value
        _made[key] = Encoder(ranks, table)
    return _made[key]


def _shared(spark: SparkSession, path: str):
    """Broadcasts the vocabulary with its perfect hash: fixed by the file, not by the data (about 2 MB)."""
    ranks = load_ranks(path)
    if len(ranks) > 500_000:
        raise ValueError(f"{path}: a vocabulary of {len(ranks)} entries is too large to broadcast")
    return spark.sparkContext.broadcast((ranks, PerfectHash.build(ranks)))


def encode_column(df: DataFrame, text: str, out: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """All columns of df and `out`, the ids of column `text` (array<int>)."""
    shared = _shared(df.sparkSession, vocabulary)

    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoder(vocabulary, shared)
        for s in batches:
            yield pd.Series(enc.encode([t if isinstance(t, str) else None for t in s]), dtype=object)

    encode.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn(out, F.pandas_udf(encode, "array<int>")(F.col(text)))


def count_column(df: DataFrame, text: str, out: str = "n_tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """As encode_column, but only the number of ids (bigint) comes back; 0 for null and empty texts."""
    shared = _shared(df.sparkSession, vocabulary)

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoder(vocabulary, shared)
        for s in batches:
            yield pd.Series([len(x) for x in enc.encode([t if isinstance(t, str) else None for t in s])], dtype="int64")

    count.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn(out, F.pandas_udf(count, "bigint")(F.col(text)))
