"""Problem 3: new batches against all history, by suffix arrays that are never rebuilt.

Each accepted batch leaves an immutable segment: the suffixes of its records' token streams in lexicographic order, cut
into chunks of neighbouring suffixes. The suffixes of a new batch are looked up in the older segments by binary search;
the lengths of the matches add up to a coverage per (new record, old record), pairs whose coverage allows the threshold
are checked exactly. Segments of about the same size are merged (two sorted runs into one), so there are logarithmically
many and every suffix is rewritten logarithmically often.

The token stream. Similarity is that of token multisets, so order in the text does not count: a record's stream is its
elements (token, occurrence) in one fixed order, rare ones first. Edits spread over the text and parts that stand in another
order then leave long common runs, and the search is exact: of two records of similarity t or more with n and m
elements, the first n - ceil(t n) + 1 and m - ceil(t m) + 1 elements of the streams share one at least. So suffixes begin
at those positions only. The order is counted on the first load and stays; whatever it is, no pair is lost.

An entry is a suffix: its first W elements (32 bits each), the one before, the record, the record's size, the position, and
an odd sketch of the record: the parity of its elements on 128 bits. Two sketches differ in no more bits than the records
differ in elements, so most chance matches end within the search, without loss (`search`).

Common starts. Where an element begins more than PROBE suffixes of a chunk, the PROBE nearest in suffix order are taken, those
with the longest matches. A record that is found in this way needs nothing else, however large its family; what is not found
is searched once more without the limit. So the result does not depend on PROBE, on sizes or on chunks.

Layout: suffixes fall into cells, ranges of their first element; a cell that holds much of a batch is dealt over SUBS parts by
record, so that no task gets all suffixes of an element that a third of all rows share. Segments are tables bucketed by
(cell, sub), so a search shuffles the new batch only. `History.open` goes on where another session has stopped: the
manifest below the folder names what belongs to it, and it is written last.

Records with the same token sequence are one class; a class is searched and indexed once, when it first appears.

Cases: null, empty and blank texts are never duplicates and are not indexed; null batch numbers come after all others;
repeated rows within one batch are no history to one another; batches are processed by number, late rows included.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm.common import element_hashes, flat_tokens, remove, shared_elements, text_keys, written

#: Elements of a suffix that an entry holds; longer matches go on in the entries that follow.
W = 4
PROBE, CHUNK, SUBS = 64, 4096, 64
#: Share of an Arrow batch's suffixes from which a cell is dealt over SUBS parts.
MUCH = 0.02
ENTRY = np.dtype([("e", ">u4", W), ("prev", "<u4"), ("rec", "<i8"), ("n", "<u4"), ("at", "<u4"), ("sketch", "<u8", 2)])
CHUNKS = "cell int, sub int, lo binary, first bigint, last bigint, entries binary"
MARKED = "id bigint, key binary, exact binary, n int, elements array<bigint>"
#: Counters of elements that give the order of streams; elements that fall on one counter are ordered by their hashes.
COUNTERS = 1 << 18
#: What rounding may add to a product of a threshold and a number of tokens.
ROUNDING = 1e-6
#: Ids of which records' elements are fetched by a broadcast (8 MB); beyond that by a shuffle.
FEW = 1_000_000


def common_needed(n, m, threshold: float):
    """Least number of common elements of two records of n and m elements with the threshold's similarity."""
    return np.ceil(threshold / (1 + threshold) * (n + m) - ROUNDING)


def starts_of(n, threshold: float):
    """How many elements of a stream of n suffixes begin at."""
    return n - np.ceil(threshold * n - ROUNDING).astype(np.int64) + 1


# ---- streams


def element_counts(records: DataFrame) -> DataFrame:
    """(k, n): in how many of the rows (id, text) elements of counter k stand; at most COUNTERS rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(COUNTERS, np.int64)
        for p in batches:
            _, h, occ = flat_tokens(p.text.tolist())
            total += np.bincount((element_hashes(h, occ) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"k": at.astype(np.int32), "n": total[at]})

    return records.select("id", "text").mapInPandas(count, "k int, n bigint").groupBy("k").agg(F.sum("n").alias("n"))


def streams(records: DataFrame, shared, *extra: str) -> DataFrame:
    """Of rows (id, text, extra columns) with tokens: MARKED (key: of the token sequence, exact: of the text) and the extra columns."""

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        counts = shared.value
        for p in batches:
            p = p[[isinstance(t, str) and not (t == "" or t.isspace()) for t in p.text]]
            if not len(p):
                continue
            texts = p.text.tolist()
            doc, h, occ = flat_tokens(texts)
            e = element_hashes(h, occ)
            e = e[np.lexsort((e, counts[(e % np.uint64(COUNTERS)).astype(np.int64)], doc))].view(np.int64)
            n = np.bincount(doc, minlength=len(texts))
            yield pd.DataFrame(
                {
                    "id": p.id.to_numpy(np.int64),
                    "key": text_keys(texts),
                    "exact": [xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in texts],
                    "n": n.astype(np.int32),
                    "elements": np.split(e, np.cumsum(n)[:-1]),
                    **{c: p[c].to_numpy() for c in extra},
                }
            )

    r = records.select("id", "text", *extra)
    return r.mapInPandas(mark, ", ".join([MARKED, *(f"{c} {r.schema[c].dataType.simpleString()}" for c in extra)]))


def sketches(elements: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """docs x 2 (uint64): the parity of each record's elements on 128 bits."""
    bits = np.bincount(doc * 128 + (elements & np.uint64(127)).astype(np.int64), minlength=docs * 128) & 1
    return np.packbits(bits.astype(np.uint8).reshape(docs, 128), axis=1).view("<u8")


def entries_of(ids: np.ndarray, streams_: list[np.ndarray], threshold: float) -> np.ndarray:
    """Unsorted entries of the suffixes of the streams (int64 elements in order)."""
    n = np.fromiter(map(len, streams_), np.int64, len(streams_))
    flat = np.concatenate(streams_).view(np.uint64) if len(streams_) else np.empty(0, np.uint64)
    doc = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
    keep = np.flatnonzero(at < np.repeat(starts_of(n, threshold), n))
    short = np.concatenate([(flat >> np.uint64(32)).astype(np.uint32), np.zeros(W, np.uint32)])
    left = np.repeat(n, n) - at
    out = np.zeros(len(keep), ENTRY)
    for k in range(W):
        out["e"][:, k] = np.where(left[keep] > k, short[keep + k], 0)
    out["prev"] = np.where(at[keep] > 0, short[keep - 1], 0)
    out["rec"], out["n"], out["at"] = ids[doc[keep]], n[doc[keep]], at[keep]
    if len(keep):
        out["sketch"] = sketches(flat, doc, len(n))[doc[keep]]
    return out


# ---- suffix arrays


def keys_of(e: np.ndarray) -> np.ndarray:
    """The entries' elements as texts of bytes, whose order is the suffixes' order."""
    return np.ascontiguousarray(e["e"]).view(f"S{4 * W}").ravel()


def in_order(e: np.ndarray) -> np.ndarray:
    x = e["e"].astype(np.uint64)
    return e[np.lexsort(((x[:, 2] << np.uint64(32)) | x[:, 3], (x[:, 0] << np.uint64(32)) | x[:, 1]))]


def joined(parts: list[np.ndarray]) -> np.ndarray:
    """Like np.concatenate, which would turn the elements' bytes round."""
    return np.concatenate([np.ascontiguousarray(x).view(np.dtype((np.void, ENTRY.itemsize))) for x in parts]).view(ENTRY)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One sorted run of two."""
    place = np.searchsorted(keys_of(a), keys_of(b), "right") + np.arange(len(b))
    out = np.empty(len(a) + len(b), ENTRY)
    from_b = np.zeros(len(out), bool)
    from_b[place] = True
    out[from_b], out[~from_b] = b, a
    return out


def suffixes(classes: DataFrame, cells: int, threshold: float) -> DataFrame:
    """Of rows (id, elements) rows (cell, sub, entries), blobs of unsorted ENTRY."""
    shift = 32 - (cells.bit_length() - 1)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            e = entries_of(p.id.to_numpy(np.int64), [np.asarray(x, np.int64) for x in p.elements], threshold)
            cell = (e["e"][:, 0].astype(np.uint64) >> np.uint64(shift)).astype(np.int64)
            many = np.bincount(cell, minlength=cells) > max(MUCH * len(e), 256)
            sub = np.where(many[cell], (e["rec"] * 0x9E3779B1 >> 13) % SUBS, 0)
            order = np.lexsort((sub, cell))
            e, cell, sub = e[order], cell[order], sub[order]
            group = cell * SUBS + sub
            cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(e) else np.empty(0, np.int64)
            yield pd.DataFrame({"cell": cell[cuts].astype(np.int32), "sub": sub[cuts].astype(np.int32), "entries": [x.tobytes() for x in np.split(e, cuts[1:])] if len(cuts) else []})

    return classes.select("id", "elements").mapInPandas(cut, "cell int, sub int, entries binary")


def _rows(cell: int, sub: int, e: np.ndarray) -> pd.DataFrame:
    """Chunk rows of a sorted run."""
    parts = [e[i : i + CHUNK] for i in range(0, len(e), CHUNK)]
    return pd.DataFrame(
        {
            "cell": np.full(len(parts), cell, np.int32),
            "sub": np.full(len(parts), sub, np.int32),
            "lo": [x[0]["e"].tobytes() for x in parts],
            "first": np.array([int(x[0]["e"][0]) for x in parts], np.int64),
            "last": np.array([int(x[-1]["e"][0]) for x in parts], np.int64),
            "entries": [x.tobytes() for x in parts],
        }
    )


def _sorted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows ordered by (cell, sub) -> chunks of one sorted run for each."""
    now, held = None, []
    for p in batches:
        for cell, sub, blob in zip(p.cell.tolist(), p["sub"].tolist(), p.entries, strict=True):
            if (cell, sub) != now:
                if held:
                    yield _rows(*now, in_order(joined(held)))
                now, held = (cell, sub), []
            held.append(np.frombuffer(blob, ENTRY))
    if held:
        yield _rows(*now, in_order(joined(held)))


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks of two runs, ordered by (cell, sub, lo) -> chunks of the merged run.

    What lies before the chunk that comes next is final, so about two chunks are held at once.
    """
    now, open_, done = None, np.empty(0, ENTRY), []

    def full(all_of_it: bool) -> Iterator[pd.DataFrame]:
        nonlocal done
        size = sum(map(len, done))
        if size and (all_of_it or size >= CHUNK):
            e = joined(done)
            stop = size if all_of_it else size - size % CHUNK
            done = [e[stop:]] if stop < size else []
            yield _rows(*now, e[:stop])

    for p in batches:
        for cell, sub, lo, blob in zip(p.cell.tolist(), p["sub"].tolist(), p.lo, p.entries, strict=True):
            x = np.frombuffer(blob, ENTRY)
            if (cell, sub) != now:
                done.append(open_)
                yield from full(True)
                now, open_ = (cell, sub), x
                continue
            final = int(np.searchsorted(keys_of(open_), np.array(bytes(lo), f"S{4 * W}"), "left"))
            done.append(open_[:final])
            yield from full(False)
            open_ = merge(open_[final:], x)
    done.append(open_)
    yield from full(True)


def search(new: np.ndarray, old: np.ndarray, threshold: float, most: int | None = PROBE, block: int = 500_000) -> Iterator[tuple[np.ndarray, ...]]:
    """Matches of the suffixes of one sorted chunk in another: (new record, old record, its sizes, matched elements), added up per pair.

    Rows (record, -1, 0, 0, 0) name the new records of which not all matches were taken. Left out are pairs that cannot reach
    the threshold: by their sizes, by what stands before and behind the match, by the bits in which their sketches differ.
    A match counts from where it begins, or from the last position divisible by W, up to the next such position, so the
    parts of a long match that several entries give add up to its length.
    """
    first_new, first_old = new["e"][:, 0].astype(np.uint32), old["e"][:, 0].astype(np.uint32)
    lo, hi = np.searchsorted(first_old, first_new, "left"), np.searchsorted(first_old, first_new, "right")
    if most is not None and len(hot := np.flatnonzero(hi - lo > most)):
        at = np.searchsorted(keys_of(old), keys_of(new[hot]))
        lo[hot] = np.clip(at - most // 2, lo[hot], hi[hot] - most)
        hi[hot] = lo[hot] + most
        rec = np.unique(new["rec"][hot])
        zero = np.zeros(len(rec), np.int64)
        yield rec, zero - 1, zero, zero, zero
    n = hi - lo
    ends = np.cumsum(n)
    begin = 0
    while begin < len(new) and ends[-1] > (ends[begin - 1] if begin else 0):
        before = int(ends[begin - 1]) if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, before + block, "right")))
        k = n[begin:stop]
        q = np.repeat(np.arange(begin, stop), k)
        o = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k) + np.repeat(lo[begin:stop], k)
        begin = stop
        na, nb = new["n"][q].astype(np.int64), old["n"][o].astype(np.int64)
        need = common_needed(na, nb, threshold)
        ok = need <= np.minimum(na, nb)
        i, j = new["at"][q].astype(np.int64), old["at"][o].astype(np.int64)
        ok &= np.minimum(i, j) + np.minimum(na - i, nb - j) >= need
        ok[ok] = np.bitwise_count(new["sketch"][q[ok]] ^ old["sketch"][o[ok]]).sum(axis=1) <= (na + nb - 2 * need)[ok]
        q, o, i, na, nb = q[ok], o[ok], i[ok], na[ok], nb[ok]
        counts = (i % W == 0) | (new["prev"][q] != old["prev"][o])
        q, o, i, na, nb = q[counts], o[counts], i[counts], na[counts], nb[counts]
        if not len(q):
            continue
        same = np.logical_and.accumulate(new["e"][q] == old["e"][o], axis=1).sum(axis=1)
        length = np.minimum(same, W - i % W)
        a, b = new["rec"][q], old["rec"][o]
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        head = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        yield a[head], b[head], na[order][head], nb[order][head], np.add.reduceat(length[order], head)


# ---- history


class History:
    """The batches accepted so far, below one folder. Make it with `create`, go on with `open`."""

    def __init__(self, spark: SparkSession, path: str, state: dict):
        self.spark, self.path, self.state = spark, path, state
        self.tag = uuid.uuid4().hex[:12]
        self.names: dict[str, str] = {}
        self._order = None

    @classmethod
    def create(cls, spark: SparkSession, path: str, threshold: float = 0.70) -> History:
        return cls(spark, path, {"threshold": threshold, "cells": 0, "made": 0, "batches": [], "segments": []})

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> History:
        """The history that `path` holds; what an interrupted `accept` left besides is not part of it."""
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        last = max((s.getPath().getName() for s in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest-*.json"))), default=None)
        if last is None:
            raise FileNotFoundError(f"no history below {path}")
        return cls(spark, path, json.loads("".join(r[0] for r in spark.read.text(f"{path}/{last}").collect())))

    def _save(self) -> None:
        """A manifest appears whole: it is written under another name and renamed."""
        jvm = self.spark._jvm
        to = jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest-{len(self.state['batches']):08d}.json")
        draft = jvm.org.apache.hadoop.fs.Path(f"{self.path}/draft-{self.tag}.json")
        fs = to.getFileSystem(self.spark._jsc.hadoopConfiguration())
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(self.state).encode()))
        out.close()
        fs.delete(to, False)
        fs.rename(draft, to)

    @property
    def threshold(self) -> float:
        return self.state["threshold"]

    def order(self, records: DataFrame | None = None):
        """The broadcast counts that order all streams, taken from `records` where there are none yet: a table of fixed size."""
        if self._order is None:
            if records is not None and not self.state["batches"]:
                written(element_counts(records), f"{self.path}/order")
            got = self.spark.read.schema("k int, n bigint").parquet(f"{self.path}/order").toPandas()
            counts = np.zeros(COUNTERS, np.int64)
            counts[got.k.to_numpy()] = got.n.to_numpy()
            self._order = self.spark.sparkContext.broadcast(counts)
        return self._order

    # -- segments

    def _table(self, segment: dict) -> DataFrame:
        """The segment as a table that Spark knows to be bucketed; registered in this session when it is first used."""
        name = self.names.get(segment["path"])
        if name is None:
            name = self.names[segment["path"]] = f"loamline_{self.tag}_{segment['path'][-6:]}"
            self.spark.sql(f"CREATE TABLE {name} ({CHUNKS}) USING parquet CLUSTERED BY (cell, sub) INTO {segment['buckets']} BUCKETS LOCATION '{self.path}/{segment['path']}'")
        return self.spark.table(name)

    def _store(self, rows: DataFrame, size: int, by: tuple[str, ...], make) -> dict:
        """Writes rows (cell, sub, ...) as a segment: a task for each bucket, rows in the given order through `make`."""
        self.state["made"] += 1
        path = f"segments/{self.state['made']:06d}"
        buckets = max(1, min(-(-size // 50_000), max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-size // 4_000_000))))
        name = self.names[path] = f"loamline_{self.tag}_{path[-6:]}"
        remove(self.spark, f"{self.path}/{path}")
        chunks = rows.repartition(buckets, "cell", "sub").sortWithinPartitions(*by).mapInPandas(make, CHUNKS)
        chunks.write.bucketBy(buckets, "cell", "sub").option("path", f"{self.path}/{path}").option("compression", "none").saveAsTable(name)
        dealt = not self.spark.table(name).where("sub > 0").isEmpty()
        return {"size": size, "path": path, "buckets": buckets, "dealt": dealt}

    def _drop(self, segment: dict) -> None:
        if name := self.names.pop(segment["path"], None):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, f"{self.path}/{segment['path']}")

    def _merge(self) -> list[dict]:
        """While the last segment is not less than half as large as the one before, the two become one. Gives those replaced."""
        s, gone = self.state["segments"], []
        while len(s) > 1 and 2 * s[-1]["size"] >= s[-2]["size"]:
            b, a = s.pop(), s.pop()
            s.append(self._store(self._table(a).union(self._table(b)), a["size"] + b["size"], ("cell", "sub", "lo"), _merged))
            gone += [a, b]
        return gone

    # -- tables of batches

    def _read(self, what: str, schema: str, batches: list[str] | None = None) -> DataFrame | None:
        names = self.state["batches"] if batches is None else batches
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/batches/{b}/{what}" for b in names]) if names else None

    def accept(self, batch: DataFrame, name: str) -> DataFrame:
        """Finds what of a batch (id, text) repeats an earlier one, (record_id, kind 'exact' or 'near'), and takes the batch in.

        Reads of the history: the hashes of its texts, the segments, and the elements of the records that are compared.
        """
        marked = written(streams(batch, self.order(batch)), f"{self.path}/batches/{name}/marked")
        self.accept_streams(marked, name)
        return self.found([name], marked.withColumn("batch", F.lit(name)))

    def accept_streams(self, marked: DataFrame, name: str) -> None:
        """Takes in rows of MARKED; `found` then tells what they repeat."""
        here = f"{self.path}/batches/{name}"
        texts = marked.groupBy("exact", "key").agg(F.min("id").alias("id"))
        seen = self._read("texts", TEXTS)
        if seen is None:
            texts = texts.withColumns({"old_text": F.lit(False), "old_class": F.lit(False)})
        else:
            yes = F.lit(True)
            seen = seen.where("not old_text").select("exact", "key")
            texts = texts.join(seen.select("exact", yes.alias("t")), "exact", "left").join(seen.select("key").distinct().withColumn("c", yes), "key", "left")
            no = F.lit(False)
            texts = texts.withColumns({"old_text": F.coalesce("t", no), "old_class": F.coalesce("c", no)})
        texts = written(texts.select(F.lit(name).alias("batch"), "exact", "key", "id", "old_text", "old_class"), f"{here}/texts")
        reps = texts.where("not old_class").groupBy("key").agg(F.min("id").alias("id"))
        classes = written(marked.join(reps.select("id"), "id", "left_semi").select("id", "key", "n", "elements"), f"{here}/classes")
        starts = (F.col("n") - F.ceil(F.col("n") * self.threshold - ROUNDING) + 1).cast("bigint")
        size = classes.agg(F.sum(starts)).first()[0] or 0
        if not self.state["cells"]:
            self.state["cells"] = 1 << min(20, max(6, (size // 4096).bit_length()))
        gone = []
        if size:
            mine = self._store(suffixes(classes, self.state["cells"], self.threshold), size, ("cell", "sub"), _sorted)
            if self.state["segments"]:
                self._search(mine, classes, here)
            self.state["segments"].append(mine)
            gone = self._merge()
        self.state["batches"].append(name)
        self._save()
        for s in gone:
            self._drop(s)

    def _search(self, mine: dict, classes: DataFrame, here: str) -> None:
        """Writes below near-1 and near-2 the (id, key) of the new classes that have a near one in the history."""
        hits = written(self._hits(self._table(mine), PROBE), f"{here}/hits")
        pairs, hidden = hits.agg(F.count("*"), F.count_if(F.col("old") == -1)).first()
        near = written(self._verified(hits, classes, pairs, bool(hidden)), f"{here}/near-1")
        if not hidden:
            return
        # common starts hid matches of these: all matches of what has not been found
        rest = classes.join(hits.where("old = -1").select(F.col("new").alias("id")), "id", "left_semi").join(near.select("id"), "id", "left_anti")
        rest = written(rest, f"{here}/rest")
        rows = suffixes(rest, self.state["cells"], self.threshold).repartition("cell", "sub").sortWithinPartitions("cell", "sub").mapInPandas(_sorted, CHUNKS)
        hits = written(self._hits(written(rows, f"{here}/again"), None), f"{here}/all-hits")
        written(self._verified(hits, rest, hits.count(), False), f"{here}/near-2")

    def _hits(self, mine: DataFrame, most: int | None) -> DataFrame:
        """Matches of the new chunks in all segments, added up per pair."""
        threshold = self.threshold

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for p in batches:
                for a, b in zip(p.entries, p.old, strict=True):
                    for x in search(np.frombuffer(a, ENTRY), np.frombuffer(b, ENTRY), threshold, most):
                        yield pd.DataFrame(dict(zip(("new", "old", "n_new", "n_old", "covered"), x, strict=True)))

        hits = None
        new = mine.select("cell", "sub", "first", "last", "entries")
        for s in self.state["segments"]:
            old = self._table(s).select("cell", "sub", F.col("first").alias("f"), F.col("last").alias("l"), F.col("entries").alias("old"))
            there = new.withColumn("sub", F.col("sub").bitwiseAND(0))  # no literal: the join would lose the segment's bucketing
            if s["dealt"]:  # a cell's chunks go to all parts of the cell that have something
                there = new.drop("sub").join(self._table(s).select("cell", "sub").distinct(), "cell")
            n = there.join(old, ["cell", "sub"]).where("first <= l and f <= last").select("entries", "old").mapInPandas(run, HITS)
            hits = n if hits is None else hits.union(n)
        return hits.groupBy("new", "old").agg(*[F.max(c).alias(c) for c in ("n_new", "n_old")], F.sum("covered").alias("covered"))

    def _verified(self, hits: DataFrame, classes: DataFrame, size: int, partial: bool) -> DataFrame:
        """(id, key) of the new classes with a similar old one. Only elements of records in pairs with coverage enough are read.

        The elements behind the starts can be common besides the covered ones. Where not all matches of a record were taken,
        its coverage is no bound.
        """
        t = self.threshold
        rest = lambda c: F.ceil(F.col(c) * t - ROUNDING) - 1
        need = F.ceil((F.col("n_new") + F.col("n_old")) * (t / (1 + t)) - ROUNDING)
        enough = F.col("covered") >= need - F.greatest(rest("n_new"), rest("n_old"))
        pairs = hits.where("old <> -1")
        if partial:
            pairs = pairs.join(hits.where("old = -1").select("new", F.lit(True).alias("hidden")), "new", "left")
            enough = enough | F.col("hidden").isNotNull()
        pairs = pairs.where(enough).select(F.col("new").alias("a"), F.col("old").alias("b"))
        named = pairs.select(F.col("b").alias("id")).distinct()
        of_new = classes.select(F.col("id").alias("a"), "key", F.col("elements").alias("x"))
        of_old = self._read("classes", "id bigint, elements array<bigint>").join(F.broadcast(named) if size <= FEW else named, "id", "left_semi")
        of_old = of_old.select(F.col("id").alias("b"), F.col("elements").alias("y"))
        return pairs.join(of_new, "a").join(of_old, "b").where(shared_elements("x", "y") >= t).select(F.col("a").alias("id"), "key").distinct()

    def found(self, names: list[str], marked: DataFrame) -> DataFrame:
        """(record_id, kind) of the rows (id, exact, batch) of accepted batches."""
        paths = [f"batches/{b}/near-{k}" for b in names for k in (1, 2)]
        paths = [f"{self.path}/{x}" for x in paths if self._exists(x)]
        near = self.spark.read.schema("key binary").parquet(*paths) if paths else self.spark.createDataFrame([], "key binary")
        texts = self._read("texts", TEXTS, names).join(near.distinct().withColumn("near", F.lit(True)), "key", "left").select("batch", "exact", "old_text", "old_class", "near")
        rows = marked.select("id", "exact", "batch").join(texts, ["batch", "exact"])
        kind: Column = F.when(F.col("old_text"), "exact").when(F.col("old_class") | F.col("near").isNotNull(), "near")
        return rows.select(F.col("id").alias("record_id"), kind.alias("kind")).where("kind is not null")

    def _exists(self, what: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{what}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def close(self) -> None:
        """Forgets the tables' names in this session; the history's files stay."""
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names = {}


TEXTS = "batch string, exact binary, key binary, id bigint, old_text boolean, old_class boolean"
HITS = "new bigint, old bigint, n_new bigint, n_old bigint, covered bigint"


def duplicates(records: DataFrame, threshold: float, path: str) -> DataFrame:
    """Of rows (id, batch, text) those that repeat something of an earlier batch: (record_id, kind 'exact' or 'near').

    The batches are accepted one after the other; their streams are made in one pass beforehand.
    """
    spark = records.sparkSession
    rows = records.select("id", F.coalesce(F.col("batch").cast("int"), F.lit(2**31 - 1)).alias("batch"), "text")
    first = rows.agg(F.min("batch")).first()[0]
    history = History.create(spark, path, threshold)
    order = history.order(rows.where(F.col("batch") == F.lit(first)))
    marked = written(streams(rows, order, "batch"), f"{path}/marked", "batch")
    numbers = sorted(r[0] for r in marked.select("batch").distinct().collect())  # as many as there are batches
    names = {number: f"{number:010d}" for number in numbers}
    for number in numbers:
        history.accept_streams(spark.read.schema(MARKED).parquet(f"{path}/marked/batch={number}"), names[number])
    history.close()
    if not numbers:
        return spark.createDataFrame([], "record_id bigint, kind string")
    return history.found(list(names.values()), marked.withColumn("batch", F.format_string("%010d", "batch")))
