"""Declared coverage of nations by providers (return flags) against the lines that arrived."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..catalogue import default_catalogue
from ..functions import iso_label, monday_sequence
from ..operators.coverage import by_week_and_chain, coverage_trend, observed_coverage
from ..operators.weeks import calendar_of
from ..plans.coverages import conform_coverage
from ..plans.views import coverage_view
from ..session import Stages
from .registry import query, table, text

_COVERAGE = """l AS (SELECT l_returnflag AS provider, CAST(date_trunc('week', l_shipdate) AS DATE) AS d, l_suppkey AS store_id, s_nationkey AS nation
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
size AS (SELECT s_nationkey AS nation, count(*) AS n FROM supplier GROUP BY 1),
seen AS (SELECT provider, d, nation, count(DISTINCT store_id) AS stores, count(*) AS n_rows FROM l GROUP BY ALL),
raw1 AS (SELECT provider, strftime(d, '%G-%V') AS year_week, CAST(nation AS VARCHAR) AS retailer_name, d, CAST((d - DATE '1970-01-05') // 7 AS INTEGER) AS seq,
   CAST(n AS INTEGER) AS expected, CAST(stores + CASE WHEN CAST((d - DATE '1970-01-05') // 7 AS INTEGER) % 4 = 0 THEN 1 ELSE 0 END - CASE WHEN CAST((d - DATE '1970-01-05') // 7 AS INTEGER) % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS received,
   CASE WHEN provider = 'R' AND CAST((d - DATE '1970-01-05') // 7 AS INTEGER) % 13 = 0 THEN NULL WHEN provider = 'A' AND CAST((d - DATE '1970-01-05') // 7 AS INTEGER) % 11 = 0 THEN 'N' ELSE 'Y' END AS received_flag,
   stores, n_rows FROM seen JOIN size USING (nation)),
raw2 AS (SELECT * FROM raw1 UNION ALL SELECT * FROM raw1 WHERE provider = 'N' AND seq % 50 = 0),
k AS (SELECT *, count(*) OVER (PARTITION BY provider, year_week, retailer_name) AS copies,
   d + CASE WHEN provider = 'A' THEN 5 ELSE 8 END AS due, d + 6 + CAST(stores % 4 AS INTEGER) AS actual, CAST(retailer_name AS INTEGER) <> 24 AS known FROM raw2),
f AS (SELECT *, CASE WHEN coalesce(received_flag = 'Y', FALSE) THEN least(received, expected) ELSE 0 END AS effective FROM k),
ok AS (SELECT *, round(CAST(effective AS DOUBLE) / expected, 4) AS ratio FROM f WHERE copies = 1 AND known)"""


def _inputs(spark, sf_dir):
    """Coverage as providers would declare it (text), the calendar, the stores (one nation unknown) and what arrived."""
    start = F.trunc(F.col("l_shipdate").cast("date"), "week")
    l = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("provider"), start.alias("d"), F.col("l_suppkey").alias("store_id"), "l_shipdate")
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("store_id"), text("s_nationkey").alias("retailer_name"))
    per_store = l.groupBy("provider", "d", "store_id").agg(F.count("*").alias("_rows")).join(s, "store_id")
    seen = per_store.groupBy("provider", "d", "retailer_name").agg(F.count("*").alias("stores"))
    size = s.groupBy("retailer_name").agg(F.count("*").alias("expected"))
    seq = monday_sequence("d")
    received = F.col("stores") + F.when(seq % 4 == 0, 1).otherwise(0) - F.when(seq % 5 == 0, 1).otherwise(0)
    flag = (F.when((F.col("provider") == "R") & (seq % 13 == 0), F.lit(None))
            .when((F.col("provider") == "A") & (seq % 11 == 0), "N").otherwise("Y"))
    due = F.date_add("d", F.when(F.col("provider") == "A", 5).otherwise(8))
    raw = seen.join(size, "retailer_name").select(
        "provider", iso_label("d").alias("year_week"), "retailer_name", text("expected").alias("expected_stores"),
        text(received).alias("received_stores"), flag.alias("file_received"), text(due).alias("expected_delivery_date"),
        text(F.date_add("d", (F.col("stores") % 4 + 6).cast("int"))).alias("actual_delivery_date"),
        ((F.col("provider") == "N") & (seq % 50 == 0)).alias("twice"))
    raw = raw.withColumn("i", F.explode(F.when(F.col("twice"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("i", "twice")
    calendar = calendar_of(l, "l_shipdate")
    arrived = l.select("provider", iso_label("d").alias("year_week"), "store_id")
    return raw, calendar, s, arrived


def _conformed(spark, sf_dir):
    stages = Stages(spark, "coverage")
    raw, calendar, stores, arrived = _inputs(spark, sf_dir)
    known = stores.withColumn("retailer_name", F.when(F.col("retailer_name") == "24", "24 renamed").otherwise(F.col("retailer_name")))
    return conform_coverage(stages(raw, "raw"), stages(calendar, "calendar"), stages(known, "stores"), arrived,
                            default_catalogue(), stages)


@query(f"""WITH {_COVERAGE}
SELECT provider AS fornecedor, year_week AS semana, retailer_name AS rede, expected AS lojas_esperadas, received AS lojas_declaradas, effective AS lojas_consideradas,
  stores AS lojas_na_fato, ratio AS cobertura, received_flag AS arquivo_recebido, CAST(actual - due AS INTEGER) AS atraso_entrega_dias,
  concat_ws(',', CASE WHEN received > expected THEN 'COV_002' END, CASE WHEN received_flag = 'Y' AND received = 0 THEN 'COV_003' END,
    CASE WHEN actual > due THEN 'COV_005' END, CASE WHEN due <= d + 6 THEN 'COV_006' END, CASE WHEN received_flag = 'N' AND n_rows > 0 THEN 'COV_004' END,
    CASE WHEN stores > received THEN 'COV_008' END) AS alertas,
  CASE WHEN received > expected OR (coalesce(received_flag, '') = 'Y' AND received = 0) OR actual > due OR due <= d + 6 OR coalesce(received_flag, '') = 'N' OR stores > received
       THEN 'APROVADO_COM_ALERTA' ELSE 'APROVADO' END AS status FROM ok""")
def coverage_rows(spark, sf_dir):
    """Conformed coverage with effective ratio, delay, alerts and status."""
    v = coverage_view(_conformed(spark, sf_dir).rows)
    return v.withColumn("alertas", F.array_join("alertas", ","))


@query(f"""WITH {_COVERAGE},
c AS (SELECT count(*) AS n, count_if(copies > 1) AS dup, count_if(copies = 1) AS n1, count_if(copies = 1 AND NOT known) AS unk FROM f),
r AS (SELECT count(*) AS n2, count_if(received > expected) AS c2, count_if(coalesce(received_flag = 'Y' AND received = 0, FALSE)) AS c3, count_if(actual > due) AS c5,
      count_if(due <= d + 6) AS c6, count_if(coalesce(received_flag = 'N', FALSE)) AS c4, count_if(stores > received) AS c8 FROM ok)
SELECT 'ING_005' AS regra_id, n AS avaliados, CAST(0 AS BIGINT) AS falhas FROM c UNION ALL SELECT 'COV_001', n, dup FROM c UNION ALL SELECT 'COV_007', n1, unk FROM c
UNION ALL SELECT 'COV_002', n2, c2 FROM r UNION ALL SELECT 'COV_003', n2, c3 FROM r UNION ALL SELECT 'COV_004', n2, c4 FROM r
UNION ALL SELECT 'COV_005', n2, c5 FROM r UNION ALL SELECT 'COV_006', n2, c6 FROM r UNION ALL SELECT 'COV_008', n2, c8 FROM r""")
def coverage_rule_log(spark, sf_dir):
    """G1 (COV_001-008): counts of the coverage rules."""
    return _conformed(spark, sf_dir).log.select("regra_id", "avaliados", "falhas")


@query(f"""WITH {_COVERAGE}
SELECT provider, year_week, retailer_name, stores AS observed_stores, n_rows AS observed_rows FROM raw1""")
def observed_stores(spark, sf_dir):
    """Distinct stores and rows that arrived, before any rule."""
    _, _, stores, arrived = _inputs(spark, sf_dir)
    return observed_coverage(arrived, stores)


@query(f"""WITH {_COVERAGE}
SELECT year_week, retailer_name, CAST(sum(effective) AS BIGINT) AS effective_received_stores, CAST(sum(expected) AS BIGINT) AS expected_stores,
  coalesce(string_agg(CASE WHEN coalesce(received_flag, '') <> 'Y' THEN provider END, ',' ORDER BY provider), '') AS providers_missing,
  round(CAST(sum(effective) AS DOUBLE) / sum(expected), 4) AS coverage_ratio FROM ok GROUP BY ALL""")
def coverage_by_chain(spark, sf_dir):
    """Providers of a chain and week together, with the list of missing ones."""
    c = by_week_and_chain(_conformed(spark, sf_dir).rows)
    return c.withColumn("providers_missing", F.array_join("providers_missing", ","))


@query(f"""WITH {_COVERAGE}
SELECT provider, year_week, CAST((200 * sum(CAST(round(ratio * 10000) AS BIGINT)) + count(*)) // (2 * count(*)) AS DOUBLE) / 1000000 AS mean_coverage FROM ok GROUP BY ALL""")
def coverage_trends(spark, sf_dir):
    """Mean coverage per provider and week."""
    return coverage_trend(_conformed(spark, sf_dir).rows)
