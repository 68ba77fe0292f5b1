"""Exact dedup against an immutable snapshot screened by static binary-fuse filters.

The snapshot keeps one row per digest, in buckets by digest. Each bucket has a static binary-fuse filter (three slots per
key, 16-bit fingerprints). Digests of a new batch are grouped first (duplicates inside the batch); each distinct digest is
screened by the filter of its bucket, in the task that owns the bucket; positives join the exact bucket by digest and their
texts are compared byte by byte. The number of buckets grows with the larger of snapshot and batch, so that filters and
the digests screened by one of them stay bounded.

Texts are equal after lower-casing A-Z. Null text counts as empty; a null doc_id is never preferred; repeated rows are
members of one group; extra columns are ignored; empty tables give an empty result.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharewright.session import Stages

KEYS_PER_BUCKET = 50_000


def lower_ascii(text: Column | str) -> Column:
    return F.translate(F.col(text) if isinstance(text, str) else text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normal(text: Column | str) -> Column:
    return lower_ascii(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64((seed * 0x9E3779B97F4A7C15) % 2**64)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


class FuseFilter:
    """Static filter over distinct 64-bit keys: no false negatives, about 1 in 65,536 false positives."""

    def __init__(self, seed: int, segment: int, windows: int, slots: np.ndarray):
        self.seed, self.segment, self.windows, self.slots = seed, segment, windows, slots

    @staticmethod
    def _places(h, segment, windows):
        """Three slots in three neighbouring segments, and the fingerprint."""
        first = ((h >> np.uint64(32)) * np.uint64(windows)) >> np.uint64(32)
        inner = np.uint64(segment - 1)
        places = np.stack([(first + np.uint64(k)) * np.uint64(segment) + ((h >> np.uint64(18 * k)) & inner)
                           for k in range(3)], axis=1).astype(np.int64)
        return places, ((h ^ (h >> np.uint64(32))) & np.uint64(0xFFFF)).astype(np.uint16)

    @classmethod
    def build(cls, keys: np.ndarray) -> "FuseFilter":
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        segment = 1 << min(18, max(2, int(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
        factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
        windows = max(1, math.ceil(n * factor / segment) - 2)
        for seed in range(1, 1000):
            if seed % 20 == 0:
                windows += max(1, windows // 8)
            places, prints = cls._places(_mix(keys, seed), segment, windows)
            layers = cls._peel(places, (windows + 2) * segment)
            if layers is not None:
                slots = np.zeros((windows + 2) * segment, dtype=np.uint16)
                for members, free in reversed(layers):
                    p = places[members]
                    slots[free] = prints[members] ^ slots[p[:, 0]] ^ slots[p[:, 1]] ^ slots[p[:, 2]]
                return cls(seed, segment, windows, slots)
        raise ValueError("no binary-fuse filter found")

    @staticmethod
    def _peel(places, size):
        """Layers of (keys, their free slot); slots of one layer are met by no other key of that layer or of later ones."""
        count = np.bincount(places.ravel(), minlength=size)
        owner = np.zeros(size, dtype=np.int64)
        ids = np.arange(len(places))
        for k in range(3):
            np.bitwise_xor.at(owner, places[:, k], ids)
        layers, left = [], len(places)
        single = np.flatnonzero(count == 1)
        while len(single):
            members, at = np.unique(owner[single], return_index=True)
            layers.append((members, single[at]))
            left -= len(members)
            touched = places[members].ravel()
            np.subtract.at(count, touched, 1)
            np.bitwise_xor.at(owner, touched, np.repeat(members, 3))
            touched = np.unique(touched)
            single = touched[count[touched] == 1]
        return None if left else layers

    def holds(self, keys: np.ndarray) -> np.ndarray:
        places, prints = self._places(_mix(keys.astype(np.uint64), self.seed), self.segment, self.windows)
        return (self.slots[places[:, 0]] ^ self.slots[places[:, 1]] ^ self.slots[places[:, 2]]) == prints


def build_filters(snapshot: DataFrame) -> DataFrame:
    """One filter row per bucket of the snapshot's groups (digest, bucket, key)."""
    def build(frame: pd.DataFrame) -> pd.DataFrame:
        f = FuseFilter.build(frame["key"].to_numpy().view(np.uint64))
        return pd.DataFrame({"bucket": [frame["bucket"].iloc[0]], "seed": [f.seed], "segment": [f.segment],
                             "windows": [f.windows], "slots": [f.slots.tobytes()]})

    return snapshot.select("bucket", "key").groupBy("bucket").applyInPandas(
        build, "bucket int, seed int, segment int, windows int, slots binary")


def screen(groups: DataFrame, filters: DataFrame) -> DataFrame:
    """Digests of a batch that their bucket's filter lets through."""
    schema = "text_sha256 string, bucket int"

    def probe(keys: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(keys) or not len(rows):
            return pd.DataFrame({"text_sha256": pd.Series(dtype=str), "bucket": pd.Series(dtype="int32")})
        r = rows.iloc[0]
        f = FuseFilter(int(r["seed"]), int(r["segment"]), int(r["windows"]), np.frombuffer(r["slots"], dtype=np.uint16))
        return keys.loc[f.holds(keys["key"].to_numpy().view(np.uint64)), ["text_sha256", "bucket"]]

    return groups.select("text_sha256", "bucket", "key").groupBy("bucket").cogroup(
        filters.groupBy("bucket")).applyInPandas(probe, schema)


def _groups(digests: DataFrame, n_buckets: int) -> DataFrame:
    """One row per digest of a batch: the row that stays, the size, the bucket and the 64-bit filter key."""
    return digests.groupBy("text_sha256").agg(F.max("doc_id").alias("last_id"), F.count(F.lit(1)).alias("n")).withColumns({
        "bucket": F.pmod(F.xxhash64("text_sha256", F.lit("bucket")), F.lit(n_buckets)).cast("int"),
        "key": F.xxhash64("text_sha256")})


def dedup_against_snapshot(documents: DataFrame, is_new: Column, keys_per_bucket: int = KEYS_PER_BUCKET) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of the snapshot and of the new batch."""
    stages = Stages(documents.sparkSession, "fuse-dedup")
    rows = stages(documents.select("doc_id", F.sha2(normal("text"), 256).alias("text_sha256"),
                                   F.coalesce(is_new, F.lit(True)).alias("is_new")), "digests")
    # the larger of snapshot and batch decides, so that neither meets the other in a few buckets
    sizes = rows.groupBy("is_new").count().agg(F.max("count")).first()[0] or 0
    n_buckets = max(1, math.ceil(sizes / keys_per_bucket))
    old = stages(_groups(rows.filter("not is_new"), n_buckets), "snapshot")
    new = stages(_groups(rows.filter("is_new"), n_buckets), "batch")
    positives = stages(screen(new, stages(build_filters(old), "filters")), "positives")
    pairs = stages(positives.join(new.select("text_sha256", F.col("last_id").alias("new_id"), F.col("n").alias("new_n")),
                                  "text_sha256").join(
        old.select("text_sha256", F.col("last_id").alias("old_id"), F.col("n").alias("old_n")), "text_sha256"), "candidates")
    # texts go through the network once, and only those of positives are written; a join of the same kind at every size
    ids = pairs.select(F.col("new_id").alias("doc_id")).union(pairs.select("old_id")).filter("doc_id is not null").distinct()
    texts = documents.select("doc_id", normal("text").alias("body")).join(ids.hint("merge"), "doc_id")
    bodies = stages(texts.select("doc_id", F.sha2("body", 256).alias("text_sha256"), F.encode("body", "UTF-8").alias("body"))
                    .dropDuplicates(["doc_id", "text_sha256"]), "bodies")
    # byte check of the two representatives of a digest; null ids hold no text of their own and are told by digest
    sides = [bodies.select("text_sha256", F.col("doc_id").alias(f"{s}_id"), F.col("body").alias(f"{s}_body")) for s in ("new", "old")]
    checked = pairs.join(sides[0].hint("merge"), ["text_sha256", "new_id"]).join(
        sides[1].hint("merge"), ["text_sha256", "old_id"]).filter("new_body = old_body").select("text_sha256").union(
        pairs.filter("new_id is null or old_id is null").select("text_sha256")).distinct()
    same = pairs.join(checked, "text_sha256", "left_semi").select(
        "text_sha256", F.expr("greatest(old_id, new_id)").alias("both_id"), (F.col("old_n") + F.col("new_n")).alias("both_n"))
    groups = stages(old.select("text_sha256", "last_id", "n", F.lit(False).alias("is_new")).union(
        new.select("text_sha256", "last_id", "n", F.lit(True))).join(same, "text_sha256", "left").select(
        "text_sha256", "is_new", F.coalesce("both_id", "last_id").alias("keep_id"),
        F.coalesce("both_n", "n").alias("group_size")), "groups")
    return rows.join(groups, ["text_sha256", "is_new"]).select(
        "doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        "text_sha256")
