"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

Tokens are summed per cell (source, language, topic); cell weights are raked in turn to the target shares of sources,
languages and topics until all three fit. A document is drawn with the probability scale * weight / tokens of its cell, at
most 1; the scale is fitted so that the expected tokens meet the budget. The draw is a hash of the document, so it is the
same on every run and on every retry.

Target shares are the power ``alpha`` of an axis value's tokens, or the given numbers for all values of an axis, scaled
to a sum of 1. Null source, language or text count as
''; a document without tokens belongs to its cell and has the probability of the cell (1 in a cell without tokens). Repeated
rows (equal doc_id and text) are drawn together. Extra columns are passed on by ``sample_mix``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sharewright.session import Stages

AXES = ("source", "lang", "topic")
ALPHA = {"source": 0.5, "lang": 0.7, "topic": 1.0}
BUDGET = 0.5
TOLERANCE, ROUNDS, STEP = 1e-6, 60, 5


def topic_of(text: Column) -> Column:
    """Coarse topic by signs of the text; the first that fits."""
    return (F.when(text.rlike(r"(?i)licen[sc]e|copyright|all rights reserved"), "legal")
            .when(text.rlike(r"[|{}<>]"), "markup").when(text.rlike(r"[0-9]"), "figures").otherwise("prose"))


def n_tokens_of(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")).cast("long")


def with_cells(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """Axis values and tokens of every document; `topic`: a column of the caller instead of the coarse one (null: '')."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"_source": F.coalesce("source", F.lit("")), "_lang": F.coalesce("lang", F.lit("")),
                             "_topic": topic_of(text) if topic is None else F.coalesce(topic.cast("string"), F.lit("")), "_tokens": n_tokens_of(text)})


def _share(value: Column, *by: str) -> Column:
    return F.sum(value).over(Window.partitionBy(*by))


def rake(stages: Stages, cells: DataFrame, alpha=ALPHA, targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """cells (source, lang, topic, tokens) with column weight, shares that sum to 1; one row per cell throughout."""
    cells = cells.filter("tokens > 0")
    for axis in AXES:
        sums = cells.groupBy(axis).agg(F.sum("tokens").cast("double").alias("t"))
        wish = F.pow("t", F.lit(float(alpha[axis])))
        for value, share in (targets or {}).get(axis, {}).items():
            wish = F.when(F.col(axis) == value, F.lit(float(share))).otherwise(wish)
        total = sums.agg(F.sum(wish).alias("all"))
        sums = sums.select(axis, (wish / total.scalar()).alias(f"{axis}_target"))
        cells = cells.join(sums, axis)
    cells = stages(cells.withColumn("weight", F.col("tokens").cast("double")), "cells")
    for _ in range(ROUNDS // STEP):
        for _ in range(STEP):
            for axis in AXES:
                cells = cells.withColumn("weight", F.col("weight") * F.col(f"{axis}_target") / _share(F.col("weight"), axis))
        cells = stages(cells, "raked")
        gap = cells.select([F.abs(_share(F.col("weight"), a) / F.col(f"{a}_target") - 1).alias(a) for a in AXES]).agg(
            *[F.max(a) for a in AXES]).first()
        if max((g or 0.0) for g in gap) <= TOLERANCE:
            break
    return cells


def calibrate(cells: DataFrame, budget: float) -> float:
    """Scale at which the expected tokens, with probabilities of at most 1, are ``budget`` of all tokens."""
    total = cells.agg(F.sum("tokens")).first()[0]
    if not total:
        return 1.0
    ratio = F.col("weight") / F.col("tokens")
    low, high = 0.0, 1.0 / (cells.agg(F.min(F.when(ratio > 0, ratio))).first()[0] or 1.0)
    for _ in range(4):
        steps = [low + (high - low) * i / 64 for i in range(65)]
        got = cells.agg(*[F.sum(F.least(F.lit(1.0), ratio * s) * F.col("tokens")) for s in steps]).first()
        k = next((i for i in range(1, 65) if got[i] >= budget * total), 64)
        low, high = steps[k - 1], steps[k]
    return high


def mix(docs: DataFrame, budget: float = BUDGET, alpha=ALPHA, targets=None, seed: int = 11,
        topic: Column | None = None) -> DataFrame:
    """``docs`` with topic, n_tokens, weight (of the cell), probability and kept."""
    stages = Stages(docs.sparkSession, "mixing")
    spread = with_cells(docs, topic)
    sums = stages(spread.groupBy("_source", "_lang", "_topic").agg(F.sum("_tokens").alias("tokens")), "sums")
    cells = rake(stages, sums.select(F.col("_source").alias("source"), F.col("_lang").alias("lang"),
                                     F.col("_topic").alias("topic"), "tokens"), alpha, targets)
    scale = calibrate(cells, budget)
    odds = stages(cells.select(F.col("source").alias("_source"), F.col("lang").alias("_lang"),
                               F.col("topic").alias("_topic"), F.round("weight", 9).alias("weight"),
                               F.round(F.least(F.lit(1.0), F.col("weight") / F.col("tokens") * scale), 9)
                               .alias("probability")), "odds")
    draw = F.pmod(F.xxhash64("doc_id", F.coalesce("text", F.lit("")), F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    return spread.withColumn("_draw", draw).join(odds, ["_source", "_lang", "_topic"], "left").select(
        *docs.columns, F.col("_topic").alias("mix_topic"), F.col("_tokens").alias("mix_tokens"),
        F.coalesce("weight", F.lit(0.0)).alias("mix_weight"),
        F.coalesce("probability", F.lit(1.0)).alias("mix_probability"),
        (F.col("_draw") < F.coalesce("probability", F.lit(1.0))).alias("mix_kept"))
