"""References derived from the data itself, with their evidence, and lookups against them."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keyed import attach


def dominant_reference(df: DataFrame, child: str, parent: str, min_evidence: float,
                       valid: Column | None = None) -> DataFrame:
    """child -> most frequent parent, with evidence = its share of the child's rows; ties go to the smaller parent.

    Two map-side combined aggregates; no window, so one child may hold any share of the rows.
    """
    rows = df if valid is None else df.where(valid)
    pairs = rows.groupBy(child, parent).agg(F.count("*").alias("n"))
    best = pairs.groupBy(child).agg(
        F.min(F.struct((-F.col("n")).alias("neg"), F.col(parent).alias("parent"))).alias("top"),
        F.sum("n").alias("total"))
    evidence = F.round(-F.col("top.neg") / F.col("total"), 4)
    return best.select(
        F.col(child), F.col("top.parent").alias("expected"), (-F.col("top.neg")).alias("confirming"), "total",
        evidence.alias("evidence"),
        F.when(evidence >= min_evidence, "APROVADO").otherwise("REVISAR").alias("status"))


def approved(reference: DataFrame, child: str, name: str = "expected") -> DataFrame:
    return reference.where(F.col("status") == "APROVADO").select(child, F.col("expected").alias(name))


def lookup(df: DataFrame, dimension: DataFrame, on: Sequence[str], marker: str | None = None) -> DataFrame:
    """Left equi lookup in a dimension with unique keys; `marker` is true where it was found.

    No broadcast hint: a staged dimension has a known size, so the planner broadcasts it exactly when it is small
    and otherwise falls back to a shuffled join whose hot row-side partitions adaptive execution splits.
    """
    return df.join(dimension.withColumn(marker, F.lit(True)) if marker else dimension, list(on), "left")


def missing_from(df: DataFrame, dimension: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows without a partner in the dimension."""
    return attach(df, dimension.select(*on).distinct(), on, "left_anti")


def entities_without(dimension: DataFrame, history: DataFrame, on: Sequence[str]) -> DataFrame:
    """One-row counts for a dataset rule: entities of the dimension that never occur in the history."""
    seen = history.select(*on).distinct().withColumn("_seen", F.lit(True))
    return dimension.select(*on).distinct().join(seen, list(on), "left").agg(
        F.count("*").alias("evaluated"), F.count_if(F.col("_seen").isNull()).alias("failed"))
