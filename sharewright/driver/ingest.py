"""Ingest: text scan with lineage, hashes, copies, reconciliation, sinks."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.audit import duplicate_groups, duplicate_summary
from ..operators.keyed import attach, latest, number_copies, repeated_keys, running_number
from ..operators.rules import json_of
from ..session import Stages
from ..sources.ingest import content_hash, fingerprint, read_text_table, reconcile, with_lineage
from ..sources.sinks import append_log, overwrite, read_log, replace_by_target
from .registry import money, query, table, text


def _customer_text(spark, sf_dir):
    """customer as text: c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment."""
    c = table(spark, sf_dir, "customer")
    return c.select(text("c_custkey").alias("c_custkey"), "c_name", text("c_nationkey").alias("c_nationkey"),
                    text(money("c_acctbal")).alias("c_acctbal"), "c_mktsegment")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal,
       sha256(CAST(c_custkey AS VARCHAR) || '||' || c_name || '||' || CAST(c_nationkey AS VARCHAR) || '||' ||
              CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) || '||' || c_mktsegment) AS row_hash,
       'load-1' AS load_id, TRUE AS has_file, TRUE AS has_time
FROM customer""")
def raw_text_scan(spark, sf_dir):
    """The table as CSV with a byte order mark and blanks in the header, read back as text with lineage."""
    path = f"{Stages(spark, 'csv').root}/customer"
    out = _customer_text(spark, sf_dir).withColumnRenamed("c_custkey", "﻿c_custkey ")
    out.write.option("header", True).csv(path)
    df = with_lineage(read_text_table(spark, path), "load-1")
    return df.select("c_custkey", "c_name", "c_acctbal", F.col("_row_hash").alias("row_hash"),
                     F.col("_load_id").alias("load_id"), F.col("_source_file").isNotNull().alias("has_file"),
                     F.col("_source_modified_at").isNotNull().alias("has_time"))


@query(r"""
WITH RECURSIVE t AS (SELECT c_nationkey, c_custkey, CAST(c_custkey AS VARCHAR) || ',' || c_name || ',' ||
               CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS line FROM customer),
     files AS (SELECT CAST(c_nationkey AS VARCHAR) || '.txt' AS source_file, list(line ORDER BY c_custkey) AS lines,
               sum(strlen(line) + 1)::BIGINT AS length FROM t GROUP BY c_nationkey),
     level AS (SELECT source_file, 0 AS h, list_transform(lines, lambda x: sha256(x)) AS nodes FROM files
               UNION ALL
               SELECT source_file, h + 1, list_transform(range(0, (len(nodes) + 1023) // 1024),
                      lambda k: sha256(upper(array_to_string(nodes[1024 * k + 1:1024 * k + 1024], '')))) FROM level
               WHERE h = 0 OR len(nodes) > 1)
SELECT source_file, sha256(length || '|' || len(lines) || '|' || nodes[1]) AS digest
FROM files JOIN level USING (source_file) WHERE h > 0 AND len(nodes) = 1""")
def file_fingerprint(spark, sf_dir):
    """One digest per file, files of customers by nation, written as text and read back in splits."""
    stages = Stages(spark, "files")
    c = _customer_text(spark, sf_dir)
    lines = c.select(F.concat_ws(",", "c_custkey", "c_name", "c_acctbal").alias("value"), "c_nationkey", F.col("c_custkey").cast("long").alias("k"))
    path = f"{stages.root}/lines"
    lines.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "k").select("c_nationkey", "value").write.partitionBy(
        "c_nationkey").text(path)
    found = fingerprint(spark, path, stages)
    nation = F.regexp_extract("source_path", "c_nationkey=([0-9]+)/", 1)
    return found.select(F.concat(nation, F.lit(".txt")).alias("source_file"), "digest")


@query("""
SELECT sha256(text) AS row_hash, count(*) AS copies FROM documents GROUP BY 1 HAVING count(*) > 1""")
def row_hash_duplicates(spark, sf_dir):
    """Contents that occur more than once."""
    d = table(spark, sf_dir, "documents").select(content_hash(["text"]).alias("row_hash"))
    return duplicate_groups(d, ["row_hash"])


@query("""
SELECT source, count(*) AS repeated_keys, CAST(sum(copies - 1) AS BIGINT) AS excess_rows
FROM (SELECT source, sha256(text) AS h, count(*) AS copies FROM documents GROUP BY ALL HAVING count(*) > 1)
GROUP BY source""")
def duplicate_excess(spark, sf_dir):
    """Repeated contents and excess rows per source."""
    d = table(spark, sf_dir, "documents").select("source", content_hash(["text"]).alias("h"))
    return duplicate_summary(d, ["h"], ["source"])


@query("""
SELECT doc_id, copy, sha256(text) AS row_hash FROM (
  SELECT doc_id, text, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS copy,
         count(*) OVER (PARTITION BY sha256(text)) AS n
  FROM documents) WHERE n > 1""")
def copy_ordinals(spark, sf_dir):
    """Number of each copy of a repeated text, oldest first; a content may have any number of copies."""
    stages = Stages(spark, "copies")
    d = table(spark, sf_dir, "documents").select("doc_id", content_hash(["text"]).alias("row_hash"))
    repeated = stages(repeated_keys(d, ["row_hash"]).select("row_hash"), "repeated")
    rows = attach(d, repeated, ["row_hash"], "left_semi")
    out = running_number(rows, ["row_hash"], [F.col("doc_id")], stages, "copy")
    return out.select("doc_id", F.col("copy").cast("long").alias("copy"), "row_hash")


@query("""
SELECT l_returnflag, l_linenumber, count(*) AS n_rows, count(*) AS numbers, CAST(1 AS BIGINT) AS first_number,
       count(*) AS last_number
FROM lineitem GROUP BY ALL""")
def identical_rows_numbered(spark, sf_dir):
    """Rows equal in every column are collapsed, numbered and expanded again; every number occurs once."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linenumber", "l_linestatus")
    n = number_copies(rows, ["l_returnflag", "l_linenumber"], ["l_linestatus"], "number")
    return n.groupBy("l_returnflag", "l_linenumber").agg(
        F.count("*").alias("n_rows"), F.countDistinct("number").alias("numbers"),
        F.min("number").alias("first_number"), F.max("number").alias("last_number"))


@query("""
WITH loaded AS (
  SELECT 'customer' AS table_name, count(*) AS n, CAST(max(c_custkey) + 1 AS BIGINT) AS e FROM customer
  UNION ALL SELECT 'orders', count(*), CAST(max(o_orderkey) + 1 AS BIGINT) FROM orders
  UNION ALL SELECT 'part', count(*), CAST(max(p_partkey) + 1 AS BIGINT) FROM part
  UNION ALL SELECT 'documents', count(*), CAST(max(doc_id) AS BIGINT) FROM documents)
SELECT 'load-1' AS load_id, table_name, table_name || '.parquet' AS source_file, e AS expected_rows, n AS loaded_rows,
       CASE WHEN n = e THEN 'APROVADO' ELSE 'APROVADO_COM_ALERTA' END AS status
FROM loaded""")
def load_reconciliation(spark, sf_dir):
    """S8 (ING_001): loaded against declared rows; the declared count comes from the keys of the tables."""
    keys = {"customer": ("c_custkey", 1), "orders": ("o_orderkey", 1), "part": ("p_partkey", 1), "documents": ("doc_id", 0)}
    tables = {name: table(spark, sf_dir, name) for name in keys}
    declared = None
    for name, (key, plus) in keys.items():
        row = tables[name].agg((F.max(key) + plus).alias("expected_rows")).select(
            F.lit(name).alias("table_name"), F.lit(f"{name}.parquet").alias("source_file"), "expected_rows")
        declared = row if declared is None else declared.union(row)
    return reconcile(tables, declared, "load-1")


@query("""
SELECT user_id, event_id, event_type, CAST(ts AS VARCHAR) AS ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""")
def latest_row_per_key(spark, sf_dir):
    """Newest row per key as one aggregate."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts",
                                              F.struct("ts", "event_id").alias("_at"))
    return latest(e, ["user_id"], "_at").select("user_id", "event_id", "event_type", text("ts").alias("ts"))


@query("""
SELECT CASE WHEN c_acctbal < 0 THEN 'negative' ELSE c_mktsegment END AS alvo, count(*) AS n_rows
FROM customer WHERE c_acctbal < 0 OR c_mktsegment IN ('BUILDING') GROUP BY 1""")
def replace_by_target_sink(spark, sf_dir):
    """A second run replaces its own targets only; a target that is empty this time is cleared."""
    path = f"{Stages(spark, 'sink').root}/quarantine"
    c = table(spark, sf_dir, "customer").select(json_of(["c_custkey"]).alias("chave"), "c_acctbal", "c_mktsegment")
    first = c.select(F.when(F.col("c_acctbal") < 0, "negative").otherwise(F.col("c_mktsegment")).alias("alvo"), "chave")
    targets = ["negative", "BUILDING", "MACHINERY", "AUTOMOBILE", "HOUSEHOLD", "FURNITURE"]
    replace_by_target(first, path, targets)
    again = first.where(F.col("alvo").isin("negative"))
    replace_by_target(again, path, [t for t in targets if t != "BUILDING"])      # four targets are empty now
    return spark.read.schema("chave string, alvo string").parquet(path).groupBy("alvo").agg(F.count("*").alias("n_rows"))


@query("""
SELECT o_orderpriority, count(*) AS n_first, CAST(2 AS BIGINT) AS n_runs, count(*) AS n_second FROM orders GROUP BY 1""")
def append_log_sink(spark, sf_dir):
    """An append-only log whose second run has one more column; old rows read it as NULL."""
    path = f"{Stages(spark, 'sink').root}/log"
    counts = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("falhas"))
    append_log(counts.withColumn("run_id", F.lit("r1")), path)
    append_log(counts.withColumn("run_id", F.lit("r2")).withColumn("extra", F.lit(1)), path)
    log = read_log(spark, path)
    return log.groupBy("o_orderpriority").agg(
        F.sum(F.when(F.col("extra").isNull(), F.col("falhas"))).alias("n_first"),
        F.countDistinct("run_id").alias("n_runs"),
        F.sum(F.when(F.col("extra") == 1, F.col("falhas"))).alias("n_second"))


@query("SELECT o_orderstatus, count(*) AS n_rows FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def overwrite_sink(spark, sf_dir):
    """Writing twice leaves the second version only."""
    path = f"{Stages(spark, 'sink').root}/orders"
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    overwrite(o, path)
    return overwrite(o.where(F.col("o_orderstatus") != "P"), path).groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"))
