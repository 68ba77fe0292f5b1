"""Merkle manifest of a dataset: a hash tree of the rows of each group, and a tree of the group roots above them.

H is the lowercase hex SHA-256 of its concatenated inputs, digests as hex text. While a group has several nodes, every
FANOUT consecutive ones (fewer at the end, even one) become their H; what remains is the group's subroot. The subroots,
ordered by group, give the root by the same rule. A proof of a leaf is the siblings of its path, level by level.

Rows are numbered inside their group over ranges of (group, order), so that a group of any size is dealt out; aligned
blocks of FANOUT^2 leaves are hashed by one task each. Above the blocks a butterfly exchange runs: in round r the blocks
whose numbers differ only in digit r (base FANOUT) swap the roots of their subtrees. Each of them then hashes the common
ancestor, redundantly, and has the siblings of that level, so after the last round every block holds its whole upper
proof, and nothing is passed down. Where the last subtree of a level is too short to have a partner for each number,
its blocks stand in for the missing ones. One exchange moves at most two messages a block, and groups of FANOUT.

Null groups are a group of their own, ordered first. Null order values come first, equal ones are ordered by their leaf
digest, so repeated rows are neighbours. Other columns are ignored. An empty table gives an empty result.
"""
from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharewright.operators.keyed import running_number
from sharewright.session import Stages

FANOUT = 16


def leaf_digest(*values: Column) -> Column:
    """H of the values: `-` if null, else UTF-8 byte count, colon, value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def butterfly(nodes: DataFrame, stages: Stages, fanout: int = FANOUT) -> DataFrame:
    """tree, at, root, proof of each node of several trees.

    nodes: tree (any type, null allowed), at (position from 0, gapless in its tree), n (nodes in the tree), node (hex).
    proof: the siblings of the node's path, level by level from left to right, as one text.
    """
    nodes = stages(nodes.select("tree", "at", "n", "node", F.lit("").alias("proof")), "round")
    largest = nodes.agg(F.max("n")).first()[0] or 0
    step = 1
    while step < largest:
        # here a node's number is  high * (step * fanout) + digit * step + low;  its subtree has `step` members at most
        wide, low = F.lit(step * fanout), F.col("at") % step
        digit = F.floor(F.col("at") / step) % fanout
        first = F.col("at") - low                       # first member of the own subtree
        members = F.least(F.lit(step), F.col("n") - first)
        open_ = nodes.filter(F.col("n") > step)
        # a member speaks for its own number and, in a short last subtree, for every number it lacks
        spoken = F.when(members < step, F.sequence(low, F.lit(step - 1), members)).otherwise(F.array(low))
        said = open_.select("tree", F.floor(F.col("at") / wide).alias("high"), F.explode(spoken).alias("low"),
                            digit.alias("digit"), "node")
        heard = said.groupBy("tree", "high", "low").agg(
            F.sort_array(F.collect_list(F.struct("digit", "node"))).alias("run"))
        # collect_list here holds one node for each digit: `fanout` at most
        mine = open_.select("*", F.floor(F.col("at") / wide).alias("high"), low.alias("low"), digit.alias("digit"))
        siblings = F.array_join(F.transform(F.filter("run", lambda x: x.digit != F.col("digit")), lambda x: x.node), "")
        # each row meets exactly one run, found by the same key
        met = mine.alias("m").join(heard.alias("h"), F.col("m.tree").eqNullSafe(F.col("h.tree"))
                                   & (F.col("m.high") == F.col("h.high")) & (F.col("m.low") == F.col("h.low")))
        met = met.select("m.tree", "at", "n", F.sha2(F.array_join(F.transform("run", lambda x: x.node), ""), 256).alias("node"),
                         F.concat("proof", siblings).alias("proof"))
        nodes = stages(met.unionByName(nodes.filter(F.col("n") <= step)), "round")
        step *= fanout
    return nodes.select("tree", "at", F.col("node").alias("root"), "proof")


def _parents(nodes: list[str], fanout: int) -> list[str]:
    return [hashlib.sha256("".join(nodes[k:k + fanout]).encode()).hexdigest() for k in range(0, len(nodes), fanout)]


def _block_levels(leaves: list[str], levels: int, fanout: int) -> list[list[str]]:
    out = [leaves]
    for _ in range(levels):
        out.append(_parents(out[-1], fanout))
    return out


def fold(leaf: str, at: int, siblings: list[list[str]], fanout: int = FANOUT) -> str:
    """The root that a leaf and the siblings of its path give."""
    node = leaf
    for others in siblings:
        place = at % fanout
        node = hashlib.sha256("".join([*others[:place], node, *others[place:]]).encode()).hexdigest()
        at //= fanout
    return node


def _split_proof(proof: str, at: int, count: int, fanout: int) -> list[list[str]]:
    """The siblings of each level out of a proof text; count: nodes of the tree."""
    out, k = [], 0
    while count > 1:
        size = min(fanout, count - at // fanout * fanout) - 1
        out.append([proof[k + 64 * i:k + 64 * i + 64] for i in range(size)])
        k += 64 * size
        at, count = at // fanout, -(-count // fanout)
    return out


def manifest(rows: DataFrame, group: str, order: str, leaf: Column, changed: Column | None = None,
             fanout: int = FANOUT) -> DataFrame:
    """Of every row: `group`, `order`, at (place in its group), leaf, subroot, root, proof_sha256, folded_root.

    changed: the leaf digest of the row as it is found today (null: as it was). folded_root is the root that this digest
    gives with the siblings of the manifest.
    """
    stages = Stages(rows.sparkSession, "merkle")
    block = fanout ** 2
    leaves = rows.select(F.col(group).alias("tree"), F.col(order).alias("place"), leaf.alias("leaf"),
                         (changed if changed is not None else F.lit(None)).cast("string").alias("changed"))
    # running numbers need a key that is never null
    leaves = leaves.select(F.struct(F.col("tree").isNotNull().alias("known"), F.col("tree").alias("tree")).alias("key"),
                           "place", "leaf", "changed")
    leaves = stages(leaves, "digests")                  # hashed once; numbering looks at the rows twice
    numbered = running_number(leaves, ["key"], [F.col("place").asc_nulls_first(), F.col("leaf"), F.col("changed")], stages, "at")
    numbered = stages(numbered.select("key", "place", "leaf", "changed", (F.col("at") - 1).alias("at"),
                                      F.floor((F.col("at") - 1) / block).alias("block")), "leaves")
    counts = stages(numbered.groupBy("key").agg(F.count(F.lit(1)).alias("count")), "counts")

    def top(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("at")
        n = int(frame["count"].iloc[0])
        levels = (n > 1) + (n > fanout)
        row = frame.iloc[[0]][["key", "block", "count"]]
        return row.assign(node=_block_levels(frame["leaf"].tolist(), levels, fanout)[-1][0])

    key_type = numbered.schema["key"].dataType.simpleString()
    sized = numbered.join(counts, "key")
    tops = sized.select("key", "block", "at", "leaf", "count").groupBy("key", "block").applyInPandas(
        top, f"key {key_type}, block long, count long, node string")
    blocks = stages(tops.select(F.col("key").alias("tree"), F.col("block").alias("at"), "count",
                                F.ceil(F.col("count") / block).alias("n"), "node"), "blocks")
    upper = butterfly(blocks, stages, fanout)
    # the groups themselves, in their order, are the leaves of the last tree
    roots = upper.filter("at = 0").select(F.lit(0).alias("all"), F.col("tree").alias("key"), F.col("root").alias("subroot"))
    places = stages(running_number(roots, ["all"], [F.col("key")], stages, "at")
                    .select("key", "subroot", (F.col("at") - 1).alias("at")), "places")
    n_groups = places.count()
    last = butterfly(places.select(F.lit(0).alias("tree"), "at", F.lit(n_groups).cast("long").alias("n"),
                                   F.col("subroot").alias("node")), stages, fanout)
    above = places.join(last.select("at", "root", F.col("proof").alias("top_proof")), "at").select(
        "key", "subroot", "root", "top_proof", F.col("at").alias("group_at"))
    uppers = stages(upper.select(F.col("tree").alias("key"), F.col("at").alias("block"), "proof").join(above, "key").join(
        counts, "key"), "uppers")

    def prove(leaves_: pd.DataFrame, upper_: pd.DataFrame) -> pd.DataFrame:
        if not len(leaves_):
            return pd.DataFrame({c: [] for c in names})
        u = upper_.iloc[0]
        n, number = int(u["count"]), int(u["block"])
        frame = leaves_.sort_values("at").reset_index(drop=True)
        levels = (n > 1) + (n > fanout)
        tree = _block_levels(frame["leaf"].tolist(), levels, fanout)
        blocks_in = -(-n // block)
        higher = (_split_proof(u["proof"], number, blocks_in, fanout) if blocks_in > 1 else []), _split_proof(
            u["top_proof"], int(u["group_at"]), n_groups, fanout)
        proofs, folded = [], []
        for at, changed_ in enumerate(frame["changed"]):
            own, k = [], at
            for level in range(levels):
                run = tree[level][k // fanout * fanout:(k // fanout + 1) * fanout]
                own.append(run[:k % fanout] + run[k % fanout + 1:])
                k //= fanout
            text = "".join(["".join(s) for s in own] + ["".join(s) for part in higher for s in part])
            proofs.append(hashlib.sha256(text.encode()).hexdigest())
            found = changed_ if isinstance(changed_, str) else tree[0][at]
            node = fold(found, number * block + at, [*own, *higher[0]], fanout)
            folded.append(fold(node, int(u["group_at"]), higher[1], fanout))
        frame = frame.assign(subroot=u["subroot"], root=u["root"], proof_sha256=proofs, folded_root=folded)
        return frame[names]

    names = ["key", "place", "at", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    place_type = rows.schema[order].dataType.simpleString()
    out = numbered.groupBy("key", "block").cogroup(uppers.groupBy("key", "block")).applyInPandas(
        prove, f"key {key_type}, place {place_type}, at long, leaf string, subroot string, root string, proof_sha256 string, "
               "folded_root string")
    return out.select(F.col("key.tree").alias(group), F.col("place").alias(order), "at", "leaf", "subroot", "root",
                      "proof_sha256", "folded_root")
