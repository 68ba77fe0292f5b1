"""Substring dedup: words covered by a window of WINDOW words that also starts in a document with a smaller doc_id.

Windows are found by doubling. The digest of 2L words is made of the digests of its two halves, so that lengths double from
single words. Two lengths are looked up over all documents:

1. Length 25. Of the 26 windows of 25 words inside every window of 50 the least by hash is its anchor (equal windows of 50
   have equal anchors), so anchors alone need to be counted. An anchor that is found in one document only ends here.
2. Anchors repeated at that length alone are extended to twice the length, 50 words, to the left and to the right. If the
   same extension occurs in a document with a smaller id, all windows around the anchor do, and are covered at once.
3. Where a repeated anchor has several extensions, the first document of each extension looks up its windows of 50 around the
   anchor one by one. After that every window is decided, no candidate is left.

Hence every text gives one row for each anchor (about one for 13 words), and copies of a passage, however many, give
single windows only where their surroundings differ. Texts that change or hold such windows are shuffled once, and
read again for the result.

Digests of 50 words and of extensions have 128 bits. Null text: no words. A null doc_id counts as smaller than all others.
Rows equal in doc_id and text are one document delivered twice and get equal results; rows of one doc_id with
different texts do not cover each other. Extra columns are ignored; empty tables give an empty result.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharewright.session import Stages

WINDOW = 50
#: Words handled together by one task, and distinct words it remembers: bounds of memory, not of the input.
CHUNK, REMEMBERED = 400_000, 500_000
# fixed odd multipliers of the two digest lanes
_ODD = ((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
_PLACE_BITS = 34


class _Words(dict):
    """word -> number; numbers point to 128-bit digests of the words."""

    def __init__(self):
        super().__init__()
        self.codes = bytearray(16)                      # number 0 stands between documents

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.codes) // 16
        self.codes += hashlib.blake2b(word, digest_size=16).digest()
        return number


def _join(a: np.ndarray, b: np.ndarray, lane: int) -> np.ndarray:
    """Digests of the sequences a followed by b."""
    p, q = (np.uint64(x) for x in _ODD[lane])
    x = (a ^ (a >> np.uint64(29))) * p + b
    x = (x ^ (x >> np.uint64(32))) * q
    return x ^ (x >> np.uint64(31))


def _doubled(words: np.ndarray, length: int, lane: int) -> np.ndarray:
    """Digests of all windows of `length` words: powers of two by doubling, put together by the binary digits."""
    power, size, out, done = words, 1, None, 0
    while True:
        if length & size:
            part = power[done:] if done else power
            out = part if out is None else _join(out[:len(part)], part[:len(out)], lane)
            done += size
        if size * 2 > length:
            return out[:len(words) - length + 1]
        power = _join(power[:-size], power[size:], lane)
        size *= 2


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:len(values) - (width - size)], values[width - size:]) if width > size else values


class _Chunk:
    """Digests of the windows of several documents, laid out one after the other with `half` empty words around each."""

    def __init__(self, documents: list[list[bytes]], known: _Words, window: int):
        self.window, self.half = window, window // 2
        sizes = np.array([len(d) for d in documents], dtype=np.int64)
        self.starts = self.half + np.concatenate(([0], np.cumsum(sizes + self.half)[:-1])).astype(np.int64)
        numbers = np.zeros(int(sizes.sum() + self.half * (len(documents) + 1)), dtype=np.int64)
        for start, words in zip(self.starts, documents):
            numbers[start:start + len(words)] = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        codes = np.frombuffer(bytes(known.codes), dtype=np.uint64).reshape(-1, 2)
        self.sizes = sizes
        self.short = [_doubled(codes[numbers, lane], self.half, lane) for lane in (0, 1)]

    def long(self, at: np.ndarray) -> list[np.ndarray]:
        """Both lanes of the windows of twice the half length at the places."""
        return [_join(d[at], d[at + self.half], lane) for lane, d in enumerate(self.short)]

    def window_starts(self) -> tuple[np.ndarray, np.ndarray]:
        """Places where a whole window starts, and the document of each."""
        n = np.maximum(self.sizes - self.window + 1, 0)
        owner = np.repeat(np.arange(len(n)), n)
        return self.starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n), owner

    def anchors(self):
        """owner, anchor place, first and last start of the windows that it anchors."""
        at, owner = self.window_starts()
        if not len(at):
            return owner, at, at, at
        low = np.uint64(1 << _PLACE_BITS) - np.uint64(1)
        marks = (self.short[0] & ~low) | np.arange(len(self.short[0]), dtype=np.uint64)
        place = (_sliding_min(marks, self.window - self.half + 1)[at] & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1]))))
        last = np.concatenate((first[1:], [len(at)])) - 1
        return owner[first], place[first], at[first], at[last]


def _chunks(rows, words_at_once: int = CHUNK):
    """Lists of (row, words) of bounded size."""
    out, size = [], 0
    for row, text in rows:
        words = (text.as_py() or b"").split()
        out.append((row, words))
        size += len(words) + 25
        if size >= words_at_once:
            yield out
            out, size = [], 0
    if out:
        yield out


def _fresh(known: _Words) -> _Words:
    return known if len(known) < REMEMBERED else _Words()


def _lists(values: np.ndarray, counts: np.ndarray, kind) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64) if kind == pa.int64() else values, kind))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-2**63)).alias("k"), F.xxhash64("text").alias("h"),
                       "doc_id", "text")


def _anchor_rows(docs: DataFrame, window: int) -> DataFrame:
    """One row a text: words, digest of the whole text, and its anchors with extensions and window ranges as lists."""
    def scan(batches):
        known = _Words()
        for batch in batches:
            k, h, texts = batch.column(0), batch.column(1), batch.column(2).cast(pa.binary())
            for part in _chunks(enumerate(texts)):
                known = _fresh(known)
                rows = pa.array([r for r, _ in part])
                chunk = _Chunk([w for _, w in part], known, window)
                owner, place, first, last = chunk.anchors()
                counts = np.bincount(owner, minlength=len(part))
                left, right = chunk.long(place - chunk.half), chunk.long(place)
                whole = [_join(a, b, lane) for lane, (a, b) in enumerate(zip(left, right))]
                base = chunk.starts[owner]
                yield pa.RecordBatch.from_arrays([
                    k.take(rows), h.take(rows), pa.array(chunk.sizes),
                    pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for _, w in part]),
                    _lists(chunk.short[0][place], counts, pa.int64()), _lists(whole[0], counts, pa.int64()),
                    _lists(whole[1], counts, pa.int64()), _lists((first - base).astype(np.int32), counts, pa.int32()),
                    _lists((last - base).astype(np.int32), counts, pa.int32())],
                    ["k", "h", "n_words", "whole", "a", "c1", "c2", "lo", "hi"])

    return docs.select("k", "h", "text").mapInArrow(
        scan, "k long, h long, n_words long, whole string, a array<long>, c1 array<long>, c2 array<long>, lo array<int>, hi array<int>")


def _windows(bodies: DataFrame, window: int) -> DataFrame:
    """k, h, at, w1, w2: the windows of each text whose starts lie in the ranges it asks for."""
    def scan(batches):
        known = _Words()
        for batch in batches:
            k, h, texts = batch.column(0), batch.column(1), batch.column(2).cast(pa.binary())
            asked = batch.column(3)
            for part in _chunks(enumerate(texts)):
                known = _fresh(known)
                chunk = _Chunk([w for _, w in part], known, window)
                at, row = [], []
                for i, (r, _) in enumerate(part):
                    for span in asked[r].as_py():
                        at.append(chunk.starts[i] + np.arange(span["lo"], span["hi"] + 1))
                        row.append(np.full(span["hi"] + 1 - span["lo"], i))
                if not at:
                    continue
                at, row = np.concatenate(at), np.concatenate(row)
                w1, w2 = chunk.long(at)
                rows = pa.array([part[i][0] for i in row])
                yield pa.RecordBatch.from_arrays(
                    [k.take(rows), h.take(rows), pa.array((at - chunk.starts[row]).astype(np.int32)),
                     pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64))], ["k", "h", "at", "w1", "w2"])

    return bodies.select("k", "h", "text", "ask").mapInArrow(scan, "k long, h long, at int, w1 long, w2 long")


def _cut(rows: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept: the words outside the covered ranges, joined by one space."""
    def scan(batches):
        for batch in batches:
            texts, covered = batch.column(1).cast(pa.binary()), batch.column(2)
            counts, removed, kept = [], [], []
            for text, spans in zip(texts, covered):
                words = (text.as_py() or b"").split()
                keep = np.zeros(len(words) + 1, dtype=np.int32)
                for span in spans.as_py():
                    keep[span["lo"]] += 1
                    keep[span["hi"]] -= 1
                stay = np.flatnonzero(np.cumsum(keep[:-1]) == 0).tolist()
                counts.append(len(words))
                removed.append(len(words) - len(stay))
                kept.append(b" ".join([words[i] for i in stay]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(kept, pa.binary()).cast(pa.string())],
                                             ["doc_id", "n_words", "n_removed", "kept"])

    return rows.select("doc_id", "text", "covered").mapInArrow(scan, "doc_id long, n_words long, n_removed long, kept string")


class SubstringDedup:
    """The covered ranges of all documents, and the two ways to read them."""

    def __init__(self, docs: DataFrame, window: int = WINDOW):
        if window < 2 or window % 2:
            raise ValueError("the window is twice the length of the anchors")
        self.docs, self.window = _keyed(docs), window
        self.stages = stages = Stages(docs.sparkSession, "substring")
        self.rows = rows = stages(_anchor_rows(self.docs, window), "anchors")
        found = rows.filter(F.size("a") > 0).select("k", "h", F.explode(F.arrays_zip("a", "c1", "c2", "lo", "hi")).alias("s")).select(
            "k", "h", "s.*")
        # length 25: anchors of one document alone end here
        twice = stages(found.groupBy("a").agg(F.min("k").alias("k1"), F.max("k").alias("k2")).filter("k1 < k2").select("a"), "twice")
        found = stages(found.join(twice, "a"), "repeated")
        # extended to both sides: the first document of each extension
        firsts = stages(found.groupBy("a", "c1", "c2").agg(F.min("k").alias("first")), "extensions")
        unlike = firsts.groupBy("a").agg(F.min("first").alias("f1"), F.max("first").alias("f2")).filter("f1 < f2").select(
            "a", F.lit(True).alias("unlike"))
        firsts = stages(firsts.join(unlike, "a", "left"), "first-documents")
        judged = found.join(firsts, ["a", "c1", "c2"]).filter((F.col("k") > F.col("first")) | F.col("unlike"))
        covers = F.col("k") > F.col("first")
        marks = judged.groupBy("k", "h").agg(
            F.collect_set(F.when(covers, F.struct("lo", (F.col("hi") + window).alias("hi")))).alias("covered"),
            F.collect_set(F.when(~covers, F.struct("lo", "hi"))).alias("ask"))
        marks = stages(marks, "marks")
        stages.drop(found)
        # repeated deliveries of a document ask once
        self.bodies = stages(self.docs.join(marks, ["k", "h"]), "bodies")
        asks = self.bodies.filter(F.size("ask") > 0).dropDuplicates(["k", "h"])
        windows = stages(_windows(asks, window), "windows")
        first = windows.groupBy("w1", "w2").agg(F.min("k").alias("k1"), F.max("k").alias("k2")).filter("k1 < k2").select(
            "w1", "w2", F.col("k1").alias("first"))
        later = windows.join(first, ["w1", "w2"]).filter(F.col("k") > F.col("first")).groupBy("k", "h").agg(
            F.collect_set(F.struct(F.col("at").alias("lo"), (F.col("at") + window).alias("hi"))).alias("more"))
        self.later = stages(later, "later")

    def _covered(self) -> DataFrame:
        joined = self.bodies.join(self.later, ["k", "h"], "left")
        both = F.concat("covered", F.coalesce("more", F.array().cast("array<struct<lo:int,hi:int>>")))
        return joined.select("doc_id", "text", both.alias("covered")).filter(F.size("covered") > 0)

    def reduced(self) -> DataFrame:
        """doc_id, n_words, n_removed, kept (text) of the documents that lose words."""
        return _cut(self._covered())

    def digests(self) -> DataFrame:
        """doc_id, n_words, n_removed, kept_sha256 of every row."""
        lost = self.bodies.select("k", "h", (F.size("covered") > 0).alias("some")).join(
            self.later.select("k", "h", F.lit(True).alias("more")), ["k", "h"], "left").filter(
            F.col("some") | F.col("more")).select("k", "h").distinct()
        kept = self.rows.select("k", "h", "n_words", "whole").join(lost, ["k", "h"], "left_anti").select(
            F.when(F.col("k") != -2**63, F.col("k")).alias("doc_id"), "n_words", F.lit(0).cast("long").alias("n_removed"),
            F.col("whole").alias("kept_sha256"))
        return kept.union(self.reduced().select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)))
