"""Per-key operators against plain windows, with one key holding a third of the rows."""
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sharewright.driver.registry import padded
from sharewright.operators.keyed import (alias_lists, alias_pieces, aliases, attach, exact_median, latest, number_copies,
                                         running_number, sample_rows, survivors, with_other_source, with_repeat_count)
from sharewright.operators.reference import dominant_reference
from sharewright.operators.versions import mark_versions


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    rows = [(i, None if i % 50 == 0 else ("hot" if i % 3 == 0 else f"k{rng.randrange(40)}"), rng.choice("AB"),
             rng.randrange(-300, 300) / 4) for i in range(3000)]
    return spark.createDataFrame(rows, "id int, key string, source string, v double").repartition(5).cache()


def test_repeat_count_and_sources_match_windows(skewed, stages):
    out = with_other_source(with_repeat_count(skewed, ["key"], stages), ["key"], "source", stages)
    w = Window.partitionBy("key")
    out = out.withColumns({"n": F.count("*").over(w), "two": F.min("source").over(w) != F.max("source").over(w)})
    assert out.count() == 3000
    wrong = (F.col("copies") != F.col("n")) | (F.coalesce("several_sources", F.lit(False)) != F.col("two"))
    assert out.where(wrong).count() == 0


def test_running_number_matches_row_number(skewed, stages):
    order = [F.col("v"), F.col("id")]
    out = running_number(skewed, ["key"], order, stages)
    out = out.withColumn("w", F.row_number().over(Window.partitionBy("key").orderBy(*order)))
    assert out.count() == 3000 and out.where("number <> w").count() == 0


def test_exact_median_matches_median(skewed, stages):
    out = exact_median(skewed, ["key"], F.col("v"), stages)
    expected = skewed.groupBy("key").agg(F.median("v").alias("m"), F.count("v").alias("n"))
    both = attach(out, expected, ["key"], "inner")
    assert both.count() == expected.count()
    assert both.where((F.abs(F.col("median") - F.col("m")) > 1e-12) | (F.col("observations") != F.col("n"))).count() == 0


def test_number_copies_gives_every_number_once(spark):
    df = spark.createDataFrame([("h", t % 2, "x") for t in range(70)] + [("g", 0, "y")], "hash string, at int, c string")
    out = number_copies(df, ["hash"], ["at"], chunk=7)
    assert sorted(r["copy"] for r in out.where("hash = 'h'").collect()) == list(range(1, 71))
    assert out.where("hash = 'h' AND at = 0").agg(F.max("copy")).first()[0] == 35        # older copies come first
    assert out.where("hash = 'g'").first()["copy"] == 1


def test_a_large_group_of_copies_is_expanded_by_several_tasks(spark):
    out = number_copies(spark.range(400).select(F.lit("h").alias("hash"), F.lit(0).alias("at")), ["hash"], ["at"], chunk=10)
    tasks = out.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
    assert len(tasks) > 1 and sum(r["n"] for r in tasks) == 400


def test_ids_longer_than_their_width_stay_apart(spark):
    df = spark.createDataFrame([(7,), (10001,), (100010,), (100011,)], "k long")
    assert [r[0] for r in df.orderBy("k").select(padded("P", "k", 5)).collect()] == ["P00007", "P10001", "P100010", "P100011"]


def test_survivor_and_aliases(spark, stages):
    df = spark.createDataFrame([("e", "P3", 0), ("e", "P2", 1), ("e", "P9", 1), ("f", "P1", None)], "ean string, id string, ok int")
    s = survivors(df, ["ean"], [-F.coalesce("ok", F.lit(-1))], "id", stages)
    assert {r.id: r.survivor for r in s.collect()} == {"P3": "P2", "P2": "P2", "P9": "P2", "P1": "P1"}
    rows = aliases(s, ["ean"], "id", "survivor")
    assert alias_lists(rows, ["ean"]).first().alias_ids == ["P3", "P9"]
    many = spark.createDataFrame([("e", "P0", f"A{i:05d}") for i in range(3000)], "ean string, survivor string, alias string")
    whole = alias_lists(many, ["ean"]).first()
    assert whole.n_aliases == 3000 and whole.alias_ids == [f"A{i:05d}" for i in range(3000)]


def test_alias_pieces_hold_every_alias_once_in_bounded_lists(spark, stages):
    rows = [("hot", "P0", f"A{i:05d}") for i in range(5003)] + [("x", "P1", "B2"), ("x", "P1", "B1"), ("x", "P1", "B1"), (None, "P2", "C")]
    df = spark.createDataFrame(rows, "ean string, survivor string, alias string").repartition(7)
    got = alias_pieces(df, ["ean"], stages, size=100).collect()
    hot = sorted((r for r in got if r.ean == "hot"), key=lambda r: r.piece)
    assert [r.piece for r in hot] == list(range(51)) and {len(r.alias_ids) for r in hot} == {100, 3}
    assert [a for r in hot for a in r.alias_ids] == [f"A{i:05d}" for i in range(5003)] and {r.n_aliases for r in hot} == {5003}
    rest = {r.ean: (r.survivor, r.n_aliases, r.piece, r.alias_ids) for r in got if r.ean != "hot"}
    assert rest == {"x": ("P1", 2, 0, ["B1", "B2"]), None: ("P2", 1, 0, ["C"])}
    assert alias_pieces(df.limit(0), ["ean"], stages).count() == 0


def test_median_of_infinite_values(spark, stages):
    inf = float("inf")
    df = spark.createDataFrame([("a", inf), ("a", inf), ("a", 1.0), ("b", -inf), ("b", 2.0), ("b", 3.0)], "key string, v double")
    out = {r.key: r.median for r in exact_median(df, ["key"], F.col("v"), stages).collect()}
    assert out == {"a": inf, "b": 2.0}


def test_latest_and_samples(skewed):
    got = {r.key: r.id for r in latest(skewed.select("key", "id", "v"), ["key"], "id").collect()}
    assert got == {r.key: r.m for r in skewed.groupBy("key").agg(F.max("id").alias("m")).collect()}
    first = sample_rows(skewed, ["key"], [F.col("id")], 2)
    assert first.groupBy("key").count().where("count > 2").count() == 0


def test_dominant_reference_ties_and_threshold(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", "z"), ("b", "z"), ("b", "q")], "child string, parent string")
    out = {r.child: (r.expected, r.evidence, r.status) for r in dominant_reference(df, "child", "parent", 0.6).collect()}
    assert out == {"a": ("x", 0.5, "REVISAR"), "b": ("z", 0.6667, "APROVADO")}
    assert dominant_reference(df.where("child = 'none'"), "child", "parent", 0.6).count() == 0


def test_copies_then_versions_then_sources(spark, stages):
    rows = [
        ("A", "k1", "h1", 1), ("A", "k1", "h1", 2),                      # copies only: one stays, no conflict
        ("A", "k2", "h2", 1), ("A", "k2", "h3", 1),                      # two versions in A ...
        ("B", "k2", "h4", 1),                                            # ... so B alone keeps k2
        ("A", "k3", "h5", 1), ("B", "k3", "h6", 1),                      # two sources
        ("A", "k4", "h7", 1), ("A", None, "h8", 1), ("A", None, "h9", 1),
    ]
    df = spark.createDataFrame(rows, "p string, k string, h string, at int")
    out = {(r.p, r.k, r.h, r["at"]): (r["copy"], r.versions, r.several_sources)
           for r in mark_versions(df, "p", ["k"], "h", ["at"], stages).collect()}
    assert len(out) == 10
    assert out[("A", "k1", "h1", 1)][0] == 1 and out[("A", "k1", "h1", 2)][0] == 2
    assert out[("A", "k2", "h2", 1)][1] == 2 and out[("B", "k2", "h4", 1)] == (None, None, None)
    assert out[("A", "k3", "h5", 1)][2] and out[("B", "k3", "h6", 1)][2]
    assert out[("A", "k4", "h7", 1)] == (None, None, None) and out[("A", None, "h8", 1)][1] == 2


def test_only_keys_with_copies_are_numbered(spark, stages):
    rows = [("A", "k1", "h1", 1), ("A", "k1", "h1", 2), ("A", "k2", "h2", 1), ("B", "k3", "h3", 1)]
    df = spark.createDataFrame(rows, "p string, k string, h string, at int")
    out = mark_versions(df, "p", ["k"], "h", ["at"], stages)
    assert sorted((r.k, r["copy"] or 0) for r in out.collect()) == [("k1", 1), ("k1", 2), ("k2", 0), ("k3", 0)]
    assert "LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString()


def test_exact_median_narrows_until_few_values_are_left(spark, stages):
    rng = random.Random(9)
    rows = [("hot", rng.uniform(100, 101)) for _ in range(2001)] + [("same", 5.0)] * 50 + [("neg", -rng.random()) for _ in range(200)]
    df = spark.createDataFrame(rows, "key string, v double")
    out = exact_median(df, ["key"], F.col("v"), stages, ordered_limit=3)
    expected = df.groupBy("key").agg(F.median("v").alias("m"), F.count("v").alias("n"))
    both = attach(out, expected, ["key"], "inner")
    assert both.count() == 3 and both.where((F.abs(F.col("median") - F.col("m")) > 1e-12) | (F.col("observations") != F.col("n"))).count() == 0
