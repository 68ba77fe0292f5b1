"""One digest for an ordered sequence of any length: a tree of SHA-256 over blocks of fixed size.

Leaves are the digests of the items. BLOCK consecutive digests become the digest of their concatenation, level by level,
until one is left. Blocks are cut by position alone, so the result depends neither on the splits the items were read in nor on
the number of tasks, and no task ever holds more than BLOCK digests of a key.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Stages
from .keyed import attach

BLOCK = 1024


def sequence_digest(items: DataFrame, keys: Sequence[str], position: Column, content: Column, stages: Stages,
                    block: int = BLOCK) -> DataFrame:
    """keys, items, tree_digest (hex): per key, over `content` (binary) in the order of `position` (from 0, without gaps).

    A single item's digest is hashed once more, so that a sequence of one item never has the digest of its content. NULL
    content has a leaf of its own. Levels run until the longest key has one digest; each is a block-th of the one below.
    """
    if block < 2:
        raise ValueError("a block holds at least two digests")
    keys = list(keys)

    def blocks(level: DataFrame, *more: Column) -> DataFrame:
        runs = level.groupBy(*keys, F.floor(F.col("_at") / block).alias("_block")).agg(
            # one block: bounded by its size
            F.sort_array(F.collect_list(F.struct("_at", "_d"))).alias("_run"), F.count("*").alias("_n"), *more)
        joined = F.concat_ws("", F.transform("_run", lambda r: F.hex(r["_d"])))
        return runs.withColumn("_d", F.unhex(F.sha2(joined, 256))).withColumnRenamed("_block", "_at").drop("_run")

    leaf = F.coalesce(F.unhex(F.sha2(content, 256)), F.lit(b""))
    first = stages(blocks(items.select(*keys, position.cast("long").alias("_at"), leaf.alias("_d"))), "blocks")
    counts = stages(first.groupBy(*keys).agg(F.sum("_n").alias("items"), F.count("*").alias("_left")), "items")
    done = attach(first, counts.where("_left = 1"), keys, "inner").select(*keys, "items", "_d")
    level = attach(first, counts.where("_left > 1"), keys, "inner").select(*keys, "items", "_left", "_at", "_d")
    while True:
        # a key leaves when it is down to one digest, whatever the other keys still need
        level = stages(blocks(level, F.first("items").alias("items"), F.first("_left").alias("_left")).select(
            *keys, "items", F.ceil(F.col("_left") / block).alias("_left"), "_at", "_d"), "blocks")
        done = done.unionByName(level.where("_left = 1").select(*keys, "items", "_d"))
        level = level.where("_left > 1")
        if not level.limit(1).count():
            return done.select(*keys, "items", F.lower(F.hex("_d")).alias("tree_digest"))
