"""Sharding by sampled splitters, law ``bytes``: shard sizes are equal up to one document or one small group of equal texts.

Records are ordered by (digest of the text, doc_id, row number), so equal texts are neighbours. A size-weighted sample of
keys gives quantile boundaries; records are cut into ranges by them, ranges above the row limit are sampled and cut again
until none is left, and only then are records ordered inside ranges. Range totals give every record its place in the whole
order, in bytes and in rows; the place in bytes gives the shard, the place in rows the slot.

Equal texts go to one shard as long as all of them together are at most 1 / GROUP_SHARE of a shard. A larger group is cut like
other records, as keeping it whole would break the law (a group may hold a third of all rows, sixteen shards a sixteenth each).

Null text has size 1 and the digest of the empty text. Repeated rows are told apart by the row number of the staged table.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sharewright.session import Stages

N_SHARDS = 16
ROWS_PER_RANGE = 200_000
SAMPLE = 20_000
GROUP_SHARE = 64


def _boundaries(records: DataFrame, n_parts: int, sample: int) -> list[str]:
    """Quantiles of a size-weighted sample: a record is kept with the probability 1 - exp(-size * sample / all sizes).

    The expected number of keys at the driver is at most `sample`, however many records and tasks there are.
    """
    total = records.agg(F.sum("size")).first()[0]
    if not total:
        return []
    draw = -F.log((F.pmod(F.xxhash64("key", F.lit(7)), F.lit(1 << 52)) + 1) / F.lit(float(1 << 52))) / F.col("size")
    keys = sorted(r[0] for r in records.filter(draw <= F.lit(sample / total)).select("key").collect())
    return sorted({keys[i * len(keys) // n_parts] for i in range(1, n_parts)}) if keys else []


def _ranges(records: DataFrame, bounds: list[str]) -> DataFrame:
    """Number of the range of every record: how many boundaries are not above its key."""
    sorted_bounds = np.array(bounds, dtype="S")

    @F.pandas_udf("long")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(sorted_bounds, keys.to_numpy().astype("S"), side="right"))

    return records.withColumn("part", place("key")) if bounds else records.withColumn("part", F.lit(0).cast("long"))


def shard_by_bytes(documents: DataFrame, n_shards: int = N_SHARDS, rows_per_range: int = ROWS_PER_RANGE,
                   sample: int = SAMPLE) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law)."""
    stages = Stages(documents.sparkSession, "shards")
    text = F.coalesce("text", F.lit(""))
    order_id = F.coalesce(F.col("doc_id").bitwiseXOR(F.lit(-2**63)), F.lit(0))
    records = stages(documents.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.concat(F.md5(F.encode(text, "UTF-8")), F.lpad(F.hex(order_id), 16, "0"),
                 F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")).alias("key")), "records")
    n_rows = records.count()
    bounds = _boundaries(records, max(1, min(sample // 4, -(-2 * n_rows // rows_per_range))), sample)
    while True:
        placed = _ranges(records, bounds)
        over = [r[0] for r in placed.groupBy("part").count().filter(F.col("count") > rows_per_range).collect()]
        if not over:
            break
        more = set(bounds)
        for part in over:
            inside = placed.filter(F.col("part") == part)
            rows = inside.count()
            more |= set(_boundaries(inside, max(2, min(sample // 4, -(-2 * rows // rows_per_range))), sample))
        if len(more) == len(bounds):
            break
        bounds = sorted(more)
    placed = stages(placed, "placed")
    # one row per range: the number of ranges is rows / rows_per_range
    totals = placed.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = stages(totals.select("part", F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
                                  F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before")), "totals")
    total = placed.agg(F.sum("size")).first()[0] or 1
    inside = Window.partitionBy("part").orderBy("key")
    placed = placed.withColumns({"upto": F.sum("size").over(inside), "nth": F.row_number().over(inside),
                                 "group": F.substring("key", 1, 32)}).join(totals, "part")
    ordered = stages(placed.select("doc_id", "size", "text_crc32", "group", (F.col("bytes_before") + F.col("upto")).alias("upto"),
                                   (F.col("rows_before") + F.col("nth") - 1).alias("nth")), "ordered")
    # equal texts are neighbours: their first and last byte say where the group lies
    groups = ordered.groupBy("group").agg(F.min(F.col("upto") - F.col("size")).alias("low"), F.max("upto").alias("high"),
                                          F.count(F.lit(1)).alias("n"))
    small = groups.filter((F.col("n") > 1) & ((F.col("high") - F.col("low")) * n_shards * GROUP_SHARE <= total)).drop("n")
    middle = F.coalesce(F.col("low") + F.col("high"), F.col("upto") * 2 - F.col("size"))
    ordered = stages(ordered.join(small, "group", "left").withColumn("middle", middle).select(
        "doc_id", "size", "text_crc32", "nth", F.expr(f"int(least({n_shards - 1}, middle * {n_shards} div (2 * {total})))").alias("shard")),
        "sharded")
    starts = ordered.groupBy("shard").agg(F.min("nth").alias("start"))
    return ordered.join(F.broadcast(starts), "shard").select(  # one row per shard
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("nth") - F.col("start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
