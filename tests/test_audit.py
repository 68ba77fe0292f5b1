"""Audit helpers, stages, and the plan of a statistics join on a hot key."""
import time

import pytest
from pyspark.sql import functions as F

from sharewright.operators.audit import (GuaranteeError, catalogue_leaks, enforce, forbidden_columns, guarantees,
                                         latest_run, log_vs_quarantine, rule_trend)
from sharewright.operators.keyed import attach, one_row, repeated_keys
from sharewright.session import Stages, path_exists


def test_enforce_names_the_broken_guarantee(spark):
    def count(n):
        return spark.range(n).agg(F.count("*").alias("violations"))
    enforce(guarantees({"fine": count(0)}))
    with pytest.raises(GuaranteeError, match="broken: 3"):
        enforce(guarantees({"fine": count(0), "broken": count(3)}))


def test_latest_run_and_trend(spark):
    log = spark.createDataFrame([("r1", "A", "t", 3, 1), ("r2", "A", "t", 5, 2), ("r2", "B", "t", 1, 2)],
                                "run_id string, regra_id string, alvo string, falhas long, executado_em int")
    assert {r.regra_id for r in latest_run(log).collect()} == {"A", "B"}
    assert {(r.regra_id, r.run_id): r.change for r in rule_trend(log).collect()} == {("A", "r1"): None, ("A", "r2"): 2, ("B", "r2"): None}


def test_difference_shows_missing_quarantine_rows(spark):
    log = spark.createDataFrame([("FCT_001", "t", 2, "REJEITADO"), ("GLD_001", "t", 9, "REJEITADO"), ("FCT_002", "t", 0, "APROVADO")],
                                "regra_id string, alvo string, falhas long, resultado string")
    q = spark.createDataFrame([("FCT_001", "t")], "regra_id string, alvo string")
    assert [(r.regra_id, r.difference) for r in log_vs_quarantine(log, q).collect()] == [("FCT_001", 1)]


def test_forbidden_columns_in_schemas_and_catalogue(spark):
    frames = {"a": spark.range(1), "b": spark.range(1).withColumn("cnpj", F.lit("x"))}
    assert [tuple(r) for r in forbidden_columns(frames, ("cnpj",), spark).collect()] == [("b", "cnpj")]
    spark.sql("CREATE DATABASE IF NOT EXISTS gold_test")
    frames["b"].write.saveAsTable("gold_test.shares")
    spark.range(1).write.saveAsTable("gold_test.contacts")
    hits = {tuple(r) for r in catalogue_leaks(spark, "gold_test", ("cnpj",)).collect()}
    assert hits == {("shares", "cnpj"), ("contacts", "")}
    spark.sql("DROP DATABASE gold_test CASCADE")


def test_one_row_keeps_columns_and_nulls(spark):
    a, b = spark.range(3).agg(F.count("*").alias("n")), spark.range(0).agg(F.max("id").alias("m"))
    assert one_row(a, b).collect() == [(3, None)]


def test_stages_are_removed_together(spark):
    stages = Stages(spark, "gone")
    df = stages(spark.range(5), "a")
    assert df.count() == 5 and path_exists(spark, stages.root)
    stages.close()
    assert not path_exists(spark, stages.root)


def test_hot_key_is_split_by_adaptive_execution(spark, stages, capsys):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 1000).alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        out = attach(rows, stages(repeated_keys(rows, ["key"]), "stats"), ["key"])
        assert len(out.select("key", "copies", F.length("pad").alias("n")).where("n = 64").collect()) == 300_000
        out.collect()
        out.explain()
        assert "skew=true" in capsys.readouterr().out
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_stage_leaves_no_shuffle_files(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (found.apply(i).getName() for i in range(found.size()))
        return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}

    before, stages = files(), Stages(spark, "clean")
    staged = stages(spark.range(1000).repartition(3, "id"), "dealt")
    ends = time.time() + 10
    while files() - before and time.time() < ends:
        time.sleep(0.1)
    assert not files() - before and staged.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
    stages.close()
