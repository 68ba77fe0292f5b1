"""Near duplicates by an exact n-gram Jaccard join with pivots.

Documents with equal shingle sets are one class. A rare-first prefix of every set leads documents that can be linked to a
common bucket; of buckets with the same members one stays. In a bucket, pivots stand for regions: every member is compared
with the bucket's pivot (Jaccard distance is a metric), members within the radius are linked to it, and the distances bound
all others by the triangle inequality: members whose distances to a pivot differ by more than the radius cannot be linked.
Classes already connected need no more comparing; buckets still holding several components get new pivots, and what the
windows leave of them is compared exactly. Sizes, places and parity sketches rule out most unlike pairs before their sets are
read: where a bucket is the first that two sets share, they share at most what each has left from there on, and a linked
pair is met in its first bucket. Members of a small bucket that have no such partner in it leave it before any text is moved.
Components are the same as those of all links.

The order of shingles (by the count of their cell in a table of fixed size, then by value) serves the choice of rare ones
only: any order gives the same links. The table has to be large, as a repeated shingle stands out of its cell only if the
others in it are few; a prefix of shingles that are not rare leads unlike documents together, the more of them the larger
the corpus is. Shingles are told by 64-bit digests, whole sets by 128 bits and their size. Whole sets are
made again from the texts of documents that may have a partner in a bucket, so that sets of all others are never written.

Null or wordless text: no shingles, linked with nothing. Repeated doc_ids: all rows of one doc_id share a component. Null
doc_ids: linked like others, component_id is the smallest id that is not null (null if there is none). Extra columns are
ignored; an empty table gives an empty result.
"""
from __future__ import annotations

import hashlib
import zlib
from functools import reduce
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sharewright.llm.substring_doubling import _chunks, _doubled, _fresh, _Words
from sharewright.session import Stages

SHINGLE, PERCENT = 5, 80
#: A byte a cell goes to every task, in blocks: a bound of the model, not of the input.
CELLS, BLOCK = 1 << 24, 1 << 16
SKETCH_BITS = 1024
#: Rounds end when the comparisons left, or those that the last round spared, are below CHEAP for each member, after
#: PIVOT_ROUNDS at the latest.
PIVOT_ROUNDS, CHEAP = 8, 3
#: Members of buckets up to this size are compared by size, place and sketch with each other; larger ones go to the pivots whole.
SMALL_BUCKET = 32


class _Sets:
    """The shingle sets of several documents: distinct digests sorted within each document, one after the other."""

    def __init__(self, documents: list[list[bytes]], known: _Words, n: int):
        digests, owner = _windows(documents, known, n)
        order = np.lexsort((digests, owner))
        digests, owner = digests[order], owner[order]
        first = np.concatenate(([True], (digests[1:] != digests[:-1]) | (owner[1:] != owner[:-1]))) if len(owner) else owner == 1
        self.values, self.owner = digests[first], owner[first]
        self.sizes = np.bincount(self.owner, minlength=len(documents))

    def marks(self) -> list[np.ndarray]:
        """Two 64-bit digests of each whole set, whatever its order."""
        out = []
        for lane, odd in enumerate((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)):
            x = (self.values ^ (self.values >> np.uint64(31 - lane))) * np.uint64(odd)
            x ^= x >> np.uint64(29 + lane)
            total = np.concatenate(([np.uint64(0)], np.cumsum(x * np.uint64(odd), dtype=np.uint64)))
            ends = np.concatenate(([0], np.cumsum(self.sizes)))
            out.append(total[ends[1:]] - total[ends[:-1]])
        return out

    def prefixes(self, times: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """The rarest shingles of each set, one of which any two linked sets share, and how many of them each set has."""
        keep = np.where(self.sizes > 0, self.sizes - -(-self.sizes * percent // 100) + 1, 0)
        order = np.lexsort((self.values, times[(self.values % np.uint64(CELLS)).astype(np.int64)], self.owner))
        start = np.cumsum(self.sizes) - self.sizes
        place = np.arange(len(self.values)) - start[self.owner]
        return self.values[order[place < keep[self.owner]]], keep

    def sketches(self) -> np.ndarray:
        """SKETCH_BITS parity bits of each set as longs, one set after the other. Bits in which two sketches differ are a lower
        bound of the number of shingles in which the sets differ."""
        cell = self.owner * SKETCH_BITS + (self.values & np.uint64(SKETCH_BITS - 1)).astype(np.int64)
        return np.packbits((np.bincount(cell, minlength=len(self.sizes) * SKETCH_BITS) & 1).astype(np.uint8)).view(np.int64)


def _windows(documents: list[list[bytes]], known: _Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Digest and document of every window of n words; of a shorter text the whole sequence is the only one."""
    sizes = np.array([len(d) for d in documents], dtype=np.int64)
    numbers = np.fromiter(map(known.__getitem__, chain.from_iterable(documents)), np.int64, int(sizes.sum()))
    codes = np.frombuffer(bytes(known.codes), dtype=np.uint64).reshape(-1, 2)[:, 0]
    count = np.maximum(sizes - n + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), count)
    starts = np.cumsum(sizes) - sizes
    at = starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    digests = _doubled(codes[numbers], n, 0)[at] if len(at) else np.zeros(0, dtype=np.uint64)
    short = [i for i, d in enumerate(documents) if 0 < len(d) < n]
    if short:
        whole = [int.from_bytes(hashlib.blake2b(b" ".join(documents[i]), digest_size=8, salt=b"whole").digest(), "little") for i in short]
        digests = np.concatenate((digests, np.array(whole, dtype=np.uint64)))
        owner = np.concatenate((owner, np.array(short, dtype=owner.dtype)))
    return digests, owner


def _words_of(column: pa.Array):
    """Chunks of (row, lower-cased words) of a text column."""
    yield from _chunks(enumerate(_Lower(t) for t in column.cast(pa.binary())))


class _Lower:
    """A text whose A-Z are lower-cased when it is read."""

    def __init__(self, text: pa.Scalar):
        self.text = text

    def as_py(self) -> bytes:
        return (self.text.as_py() or b"").lower()       # of bytes: A-Z only


def components(stages: Stages, links: DataFrame) -> DataFrame:
    """id, label: smallest id reachable over links (a, b). Labels jump along labels, so rounds grow with log(diameter)."""
    both = stages(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = stages(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("id") == F.col("a")).select("id", F.col("label").alias("old"),
                                                                   F.least("label", "near").alias("mid"))
        jump = labels.select(F.col("id").alias("mid"), F.col("label").alias("far"))
        new = stages(step.join(jump, "mid", "left").select(
            "id", "old", F.least("mid", "far").alias("label")), "labels")
        changed = new.filter("label <> old").limit(1).count()
        labels = new.select("id", "label")
        if not changed:
            return labels


def _distances(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """a, b, shared, whole (sizes of intersection and union), distance of the pairs."""
    # only sets that a pair names are shuffled
    sets = sets.join(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "id", "left_semi")
    x = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    y = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    both = (F.size("sa") + F.size("sb")).cast("long")
    return pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", shared.alias("shared"), both.alias("both")).select(
        "a", "b", "shared", (F.col("both") - F.col("shared")).alias("whole")).withColumn(
        "distance", 1 - F.col("shared") / F.col("whole"))


def _cell_counts(docs: DataFrame, n: int) -> np.ndarray:
    """Windows of all texts in each cell, as a byte that grows with the logarithm (steps of 4.4 %). A task counts to 255 and
    gives a compressed block of cells at a time, blocks are added up where they meet, and the driver gets CELLS bytes."""
    def count(batches):
        total, known = np.zeros(CELLS, dtype=np.uint8), _Words()
        for batch in batches:
            for part in _words_of(batch.column(0)):
                known = _fresh(known)
                digests, _ = _windows([w for _, w in part], known, n)
                cells, seen = np.unique((digests % np.uint64(CELLS)).astype(np.int64), return_counts=True)
                total[cells] = np.minimum(total[cells] + seen, 255)
        for block, cells in enumerate(total.reshape(-1, BLOCK)):
            if cells.any():
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([zlib.compress(cells, 1)])], ["block", "cells"])

    def gather(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
                if block not in total:
                    total[block] = np.zeros(BLOCK, dtype=np.uint32)
                total[block] += np.frombuffer(zlib.decompress(cells.as_py()), dtype=np.uint8)
        for block, cells in total.items():
            ranks = np.minimum(np.rint(16 * np.log2(1.0 + cells)), 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([zlib.compress(ranks, 1)])], ["block", "cells"])

    times = np.zeros((CELLS // BLOCK, BLOCK), dtype=np.uint8)
    schema = "block long, cells binary"
    for block, cells in docs.select("text").mapInArrow(count, schema).repartition("block").mapInArrow(gather, schema).collect():
        times[block] = np.frombuffer(zlib.decompress(cells), dtype=np.uint8)
    return times.reshape(-1)


def _scan(docs: DataFrame, times: np.ndarray, n: int, percent: int) -> DataFrame:
    """k, h (of the text), n, m1, m2 (of the set), prefix, sketch: one row a text."""
    def scan(batches):
        known = _Words()
        for batch in batches:
            for part in _words_of(batch.column(2)):
                known = _fresh(known)
                sets = _Sets([w for _, w in part], known, n)
                rows = pa.array([r for r, _ in part])
                prefix, keep = sets.prefixes(times, percent)
                ends = pa.array(np.concatenate(([0], np.cumsum(keep))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(sets.sizes.astype(np.int64)),
                     *[pa.array(m.view(np.int64)) for m in sets.marks()],
                     pa.ListArray.from_arrays(ends, pa.array(prefix.view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * (SKETCH_BITS // 64)),
                                              pa.array(sets.sketches()))],
                    ["k", "h", "n", "m1", "m2", "prefix", "sketch"])

    return docs.select("k", "h", "text").mapInArrow(
        scan, "k long, h long, n long, m1 long, m2 long, prefix array<long>, sketch array<long>")


def _sets(texts: DataFrame, n: int) -> DataFrame:
    """id, n, shingles (sorted) of texts (id, text)."""
    def scan(batches):
        known = _Words()
        for batch in batches:
            for part in _words_of(batch.column(1)):
                known = _fresh(known)
                sets = _Sets([w for _, w in part], known, n)
                ends = pa.array(np.concatenate(([0], np.cumsum(sets.sizes))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([r for r, _ in part])), pa.array(sets.sizes.astype(np.int64)),
                     pa.ListArray.from_arrays(ends, pa.array(sets.values.view(np.int64)))], ["id", "n", "shingles"])

    return texts.select("id", "text").mapInArrow(scan, "id long, n long, shingles array<long>")


def _alike(n_a: Column, ka: Column, n_b: Column, kb: Column, percent: int) -> Column:
    """Whether sketches allow a link: linked sets differ in at most (100 - percent) / (100 + percent) of their shingles together."""
    differ = reduce(add, [F.bit_count(F.get(ka, i).bitwiseXOR(F.get(kb, i))) for i in range(SKETCH_BITS // 64)])
    return differ.cast("long") * (100 + percent) <= (n_a.cast("long") + n_b) * (100 - percent)


def _within_reach(n_a: Column, left_a: Column, n_b: Column, left_b: Column, percent: int) -> Column:
    """Whether sizes allow a link, and the shingles from the place of the bucket on, if it is the first that the sets share."""
    return ((F.least(n_a, n_b).cast("long") * 100 >= F.greatest(n_a, n_b).cast("long") * percent)
            & (F.least(left_a, left_b).cast("long") * (100 + percent) >= (n_a.cast("long") + n_b) * percent))


def _possible(sketches: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sketches allow to be linked."""
    x = sketches.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka"))
    y = sketches.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb"))
    return pairs.select("a", "b").join(x, "a").join(y, "b").filter(
        _alike(F.col("na"), F.col("ka"), F.col("nb"), F.col("kb"), percent)).select("a", "b")


def _unlike_buckets(members: DataFrame) -> DataFrame:
    """Members of one bucket for each set of members: the others ask for the same comparisons. The bucket that stands first
    in the order of shingles, and so has the most shingles left in every member, stays."""
    marks = members.groupBy("bucket").agg(F.expr("bit_xor(id)").alias("m1"), F.expr("bit_xor(xxhash64(id))").alias("m2"),
                                          F.count(F.lit(1)).alias("k"), F.sum(F.col("left").cast("long")).alias("left"))
    return members.join(marks.groupBy("m1", "m2", "k").agg(F.max_by("bucket", "left").alias("bucket")).select("bucket"), "bucket")


def _with_partners(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Members without those of small buckets that no other member of the bucket can be linked with there."""
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("k"))
    small = members.join(sizes.filter(F.col("k") <= SMALL_BUCKET).select("bucket"), "bucket").join(
        sketches.select("id", "sketch"), "id")
    x, y = small.alias("x"), small.alias("y")
    partner = ((F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.id") != F.col("y.id"))
               & _within_reach(F.col("x.n"), F.col("x.left"), F.col("y.n"), F.col("y.left"), percent)
               & _alike(F.col("x.n"), F.col("x.sketch"), F.col("y.n"), F.col("y.sketch"), percent))
    large = members.join(sizes.filter(F.col("k") > SMALL_BUCKET).select("bucket"), "bucket")
    return x.join(y, partner, "left_semi").select("bucket", "id", "n", "left").unionByName(large.select("bucket", "id", "n", "left"))


def _label(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """members with the component of their class so far."""
    members = members.drop("label")
    if labels is None:
        return members.withColumn("label", F.col("id"))
    return members.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))


def _open_buckets(members: DataFrame) -> DataFrame:
    """Buckets that still hold more than one component."""
    return members.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select(
        "bucket")


def _pairs_left(members: DataFrame) -> int:
    """Comparisons that the exact step would make: members of a bucket times those outside its largest component."""
    return members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("k")).groupBy("bucket").agg(
        (F.sum("k") * (F.sum("k") - F.max("k"))).alias("pairs")).agg(F.sum("pairs")).first()[0] or 0


def near_duplicates(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, rounds: int = PIVOT_ROUNDS) -> DataFrame:
    """doc_id, n_shingles, component_id for every row."""
    spark = docs.sparkSession
    stages = Stages(spark, "jaccard")
    radius = 1 - percent / 100 + 1e-9
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-2**63)).alias("k"), F.xxhash64("text").alias("h"), "text")
    scanned = stages(_scan(texts, _cell_counts(texts, n), n, percent).withColumn("rid", F.monotonically_increasing_id()), "scanned")
    # documents of equal sets are one class, named by its first row
    classes = scanned.filter("n > 0").groupBy("m1", "m2", "n").agg(F.min("rid").alias("id"))
    rows = stages(scanned.select("k", "h", "n", "m1", "m2", "rid").join(classes, ["m1", "m2", "n"], "left").select(
        F.when(F.col("k") != -2**63, F.col("k")).alias("doc_id"), "k", "h", "n", "rid", "id"), "rows")
    full = rows.filter("n > 0")
    one = full.filter("rid = id").select("rid")
    # joins that move whole sets or texts are of the same kind at every size
    chosen = stages(scanned.join(one.hint("merge"), "rid", "left_semi").select("rid", "n", "prefix", "sketch"), "prefixes")
    stages.drop(scanned)
    entries = chosen.select(F.posexplode("prefix").alias("place", "bucket"), F.col("rid").alias("id"), F.col("n").cast("int").alias("n")).select(
        "bucket", "id", "n", (F.col("n") - F.col("place")).alias("left"))
    # a set has a shingle once, so a bucket counted twice holds two classes; the count packs better than two ids.
    # the smaller set of a linked pair has enough left for one of its own size
    enough = F.col("left").cast("long") * (100 + percent) >= F.col("n").cast("long") * 2 * percent
    shared = stages(entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("k"), F.max(enough).alias("enough"))
                    .filter("k > 1 and enough").select("bucket"), "shared")
    met = stages(entries.join(shared.hint("merge"), "bucket"), "shared-members")
    drawn = stages(chosen.select(F.col("rid").alias("id"), "n", "sketch"), "drawn")
    stages.drop(chosen, shared)
    members = stages(_unlike_buckets(met), "members")
    stages.drop(met)
    unlike, members = members, stages(_with_partners(members, drawn, percent), "partners")
    sketches = stages(drawn.join(members.select("id").distinct(), "id", "left_semi"), "sketches")
    stages.drop(unlike, drawn)
    # only classes that may have a partner are ever compared; texts are shuffled once, here
    wanted = full.filter("rid = id").join(members.select("id").distinct(), "id", "left_semi").select("k", "h", "id")
    wanted = stages(wanted.groupBy("k", "h").agg(F.min("id").alias("id")), "wanted")
    sets = stages(_sets(texts.join(wanted.hint("merge"), ["k", "h"]).dropDuplicates(["k", "h"]), n), "sets")
    links, labels, windows = None, None, []
    # all sets of a doc_id, however many its rows have, belong to that of its smallest one
    known = full.filter("doc_id is not null").select("doc_id", "id").distinct()
    smallest = known.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a <> b").select("doc_id", "a")
    twins = stages(known.join(smallest, "doc_id").filter("id <> a").select("a", F.col("id").alias("b")), "twins")
    links = twins
    left = None
    for turn in range(rounds):
        labels = components(stages, links)
        members = _label(members, labels)
        members = stages(members.join(_open_buckets(members), "bucket"), "open")
        if turn:
            before, left, least = left, _pairs_left(members), CHEAP * members.count()
            if left <= least or before is not None and before - left <= least:
                break
        # a pivot is the member with the least draw, so that buckets with common members choose the same pivots
        pivots = members.groupBy("bucket").agg(
            F.min(F.struct(F.xxhash64("id", F.lit(turn)), F.col("id"), F.col("n"), F.col("left"), F.col("label"))).alias("p")).select(
            "bucket", F.col("p.id").alias("pivot"), F.col("p.n").alias("pivot_n"), F.col("p.left").alias("pivot_left"),
            F.col("p.label").alias("pivot_label"))
        placed = stages(members.join(pivots, "bucket"), "placed")
        pairs = placed.filter((F.col("label") != F.col("pivot_label")) & _within_reach(
            F.col("n"), F.col("left"), F.col("pivot_n"), F.col("pivot_left"), percent)).select(
            F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
        near = stages(_possible(sketches, pairs, percent), "pairs")
        far = stages(_distances(sets, near), "distances")
        links = stages(links.union(far.filter(F.col("shared") * 100 >= F.col("whole") * percent).select("a", "b")), "links")
        window = f"w{turn}"
        windows.append(window)
        # the pivot has been compared with the whole bucket and leaves it
        opened, members = members, stages(placed.filter("id <> pivot").join(far.select(
            F.col("a").alias("id"), F.col("b").alias("pivot"), F.col("distance").alias(window)), ["id", "pivot"], "left").select(
            "bucket", "id", "n", "left", *windows), "windows")
        stages.drop(opened, placed, near, far)
    else:
        members = _label(members, components(stages, links))
        members = stages(members.join(_open_buckets(members), "bucket"), "rest")
    # of two members of unlike components one at least is outside the bucket's largest component
    counts = members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("k"))
    largest = counts.groupBy("bucket").agg(F.max(F.struct("k", "label")).alias("m")).select("bucket", F.col("m.label").alias("main"))
    # a pair that shares a bucket and the one before it, in both prefixes, has been met in the one before
    before = Window.partitionBy("id").orderBy(F.desc("left"))     # a prefix: bounded by the shingles of one text
    members = members.withColumn("before", F.lag("bucket").over(before))
    # the sketches go along, so that only pairs that they allow leave the join
    members = stages(members.join(sketches.select("id", "sketch"), "id"), "ordered")
    x = members.alias("x")
    y = stages(members.join(largest, "bucket").filter("label <> main").drop("main"), "outside").alias("y")
    # windows of the triangle inequality; an unknown distance excludes nothing
    inside = [F.coalesce(F.abs(F.col(f"x.{w}") - F.col(f"y.{w}")) <= radius, F.lit(True)) for w in windows]
    condition = ((F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.label") != F.col("y.label"))
                 & _within_reach(F.col("x.n"), F.col("x.left"), F.col("y.n"), F.col("y.left"), percent))
    condition = condition & ~F.coalesce(F.col("x.before") == F.col("y.before"), F.lit(False))
    for test in inside:
        condition = condition & test
    condition = condition & _alike(F.col("x.n"), F.col("x.sketch"), F.col("y.n"), F.col("y.sketch"), percent)
    pairs = stages(x.join(y, condition).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct(), "pairs")
    links = stages(links.union(_distances(sets, pairs).filter(F.col("shared") * 100 >= F.col("whole") * percent)
                               .select("a", "b")), "links")
    labels = components(stages, links)
    stages.drop(members, sets, sketches, wanted)
    labelled = rows.join(labels, "id", "left").select(
        "doc_id", "n", F.when(F.col("n") > 0, F.coalesce("label", "id")).alias("label"))
    least = labelled.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return labelled.join(stages(least, "least"), "label", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
