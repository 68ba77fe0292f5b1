"""Price bands and anomalies of weekly series."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import iso_label, monday_sequence
from ..operators.anomaly import price_band, series_anomaly, sustained_events
from ..operators.keyed import exact_median
from ..session import Stages
from ..settings import PriceBand, SeriesLimits
from .registry import money, query, table

BAND = PriceBand(local_factor=1.5, product_factor=2.0, min_weeks=8, min_observations=20)
LIMITS = SeriesLimits(min_weeks=26, robust_z=2.5, high_ratio=2.0, low_ratio=0.33, extreme_ratio=4.0, max_spike_weeks=2)

_WEEKLY = """w AS (SELECT l_linestatus AS provider, l_suppkey AS store_id, p_brand AS product_id, CAST(date_trunc('week', l_shipdate) AS DATE) AS d,
  CAST(sum(l_quantity) AS BIGINT) AS units, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""


def _weekly(spark, sf_dir):
    """One row per provider, store, product and week."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("product_id"))
    start = F.trunc(F.col("l_shipdate").cast("date"), "week")
    l = table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.col("l_linestatus").alias("provider"), F.col("l_suppkey").alias("store_id"),
        start.alias("week_start_date"), "l_quantity", "l_extendedprice")
    return l.join(p, "l_partkey").groupBy("provider", "store_id", "product_id", "week_start_date").agg(
        F.sum("l_quantity").cast("bigint").alias("units"), F.sum(money("l_extendedprice")).alias("value"))


@query(f"""WITH {_WEEKLY},
b AS (SELECT *, CAST(value AS DOUBLE) / units AS pu FROM w),
lo AS (SELECT provider, store_id, product_id, median(pu) AS ml, count(*) AS nl FROM b GROUP BY ALL),
pr AS (SELECT product_id, median(pu) AS mp, count(*) AS np FROM b GROUP BY ALL),
j AS (SELECT b.*, round(pu, 4) AS unit_price, CASE WHEN nl >= 8 THEN 'LOCAL' WHEN np >= 20 THEN 'PRODUTO' END AS baseline,
        CASE WHEN nl >= 8 THEN round(ml / 1.5, 4) WHEN np >= 20 THEN round(mp / 2.0, 4) END AS low,
        CASE WHEN nl >= 8 THEN round(ml * 1.5, 4) WHEN np >= 20 THEN round(mp * 2.0, 4) END AS high
      FROM b JOIN lo USING (provider, store_id, product_id) JOIN pr USING (product_id))
SELECT product_id, baseline, count(*) AS n_rows, count_if(unit_price < low OR unit_price > high) AS outside,
       round(min(low), 2) AS low, round(max(high), 2) AS high FROM j GROUP BY ALL""")
def price_bands(spark, sf_dir):
    """C20, A2: unit price against the local median, else the product median."""
    out = price_band(_weekly(spark, sf_dir), ["provider", "store_id", "product_id"], "product_id", "value", "units",
                     BAND, Stages(spark, "prices"))
    return out.groupBy("product_id", F.col("price_baseline").alias("baseline")).agg(
        F.count("*").alias("n_rows"), F.count_if("outside_band").alias("outside"),
        F.round(F.min("price_band_low"), 2).alias("low"), F.round(F.max("price_band_high"), 2).alias("high"))


_POINTS = """w AS (SELECT l_suppkey AS store_id, CAST(date_trunc('week', l_shipdate) AS DATE) AS d, CAST(sum(l_quantity) AS BIGINT) AS units FROM lineitem GROUP BY ALL),
b AS (SELECT store_id, count(*) AS n, median(units) AS med FROM w GROUP BY ALL),
m AS (SELECT store_id, median(abs(units - med)) AS mad FROM w JOIN b USING (store_id) WHERE n >= 26 GROUP BY ALL),
z AS (SELECT w.*, n, med, mad, n >= 26 AND med > 0 AS el, units / med AS ratio,
             (units - med) / CASE WHEN mad > 0 THEN 1.4826 * mad ELSE 1.0 END AS z, CAST((d - DATE '1970-01-05') // 7 AS INTEGER) AS seq
      FROM w JOIN b USING (store_id) LEFT JOIN m USING (store_id)),
h AS (SELECT *, el AND z > 2.5 AND ratio >= 2.0 AS high, el AND z < -2.5 AND ratio <= 0.33 AS low FROM z),
i AS (SELECT *, seq - row_number() OVER (PARTITION BY store_id, high ORDER BY seq) AS island FROM h),
r AS (SELECT *, CASE WHEN high THEN count(*) OVER (PARTITION BY store_id, high, island) END AS run FROM i),
c AS (SELECT *, CASE WHEN high AND round(ratio, 3) >= 4.0 AND run <= 2 THEN 'POSSIVEL_ERRO' WHEN high THEN 'EVENTO_ATIPICO'
                     WHEN low THEN 'QUEDA_ATIPICA' WHEN el THEN 'VARIACAO_ACEITAVEL' END AS class FROM r)"""


def _points(spark, sf_dir):
    start = F.trunc(F.col("l_shipdate").cast("date"), "week")
    w = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("store_id"), start.alias("week_start_date")).agg(
        F.sum("l_quantity").cast("bigint").alias("units"))
    w = w.withColumns({"week_seq": monday_sequence("week_start_date"), "year_week": iso_label("week_start_date")})
    return series_anomaly(w, ["store_id"], "week_seq", "units", LIMITS)


@query(f"""WITH {_POINTS}
SELECT store_id, strftime(d, '%G-%V') AS year_week, units, round(ratio, 3) AS series_ratio, round(z, 2) AS series_robust_z, run AS anomaly_run_weeks,
       class AS anomaly_class FROM c WHERE class <> 'VARIACAO_ACEITAVEL'""")
def series_anomalies(spark, sf_dir):
    """Robust score, ratio, run length and class of every unusual point."""
    return _points(spark, sf_dir).where(F.col("anomaly_class") != "VARIACAO_ACEITAVEL").select(
        "store_id", "year_week", "units", "series_ratio", "series_robust_z", "anomaly_run_weeks", "anomaly_class")


@query(f"""WITH {_POINTS}
SELECT store_id, class AS anomaly_class, count(*) AS n_points, max(n) AS weeks, max(med) AS median_units, max(mad) AS mad_units FROM c GROUP BY ALL""")
def anomaly_classes(spark, sf_dir):
    """Points per class and series with the series' own statistics."""
    return _points(spark, sf_dir).groupBy("store_id", "anomaly_class").agg(
        F.count("*").alias("n_points"), F.max("series_weeks").alias("weeks"), F.max("series_median_units").alias("median_units"),
        F.max("series_mad_units").alias("mad_units"))


@query(f"""WITH {_POINTS}
SELECT store_id, count(*) AS weeks_in_event, min(strftime(d, '%G-%V')) AS first, max(strftime(d, '%G-%V')) AS last, round(max(round(ratio, 3)), 1) AS peak_ratio
FROM c WHERE class = 'EVENTO_ATIPICO' GROUP BY store_id ORDER BY weeks_in_event DESC, peak_ratio DESC, store_id LIMIT 20""")
def top_events(spark, sf_dir):
    """Longest events (a top-20 report)."""
    e = sustained_events(_points(spark, sf_dir), ["store_id"], "year_week")
    return e.orderBy(F.desc("weeks_in_event"), F.desc("peak_ratio"), "store_id").limit(20)


@query("""
SELECT event_type, round(median(value), 6) AS median_value, count(value) AS observations FROM events GROUP BY 1""")
def exact_medians(spark, sf_dir):
    """A2: exact median of groups of any size."""
    e = table(spark, sf_dir, "events").select("event_type", "value")
    out = exact_median(e, ["event_type"], F.col("value"), Stages(spark, "median"), "median_value")
    return out.withColumn("median_value", F.round("median_value", 6))


@query("""
WITH b AS (SELECT event_type, median(value) AS m FROM events GROUP BY 1)
SELECT event_type, round(median(abs(value - m)), 6) AS mad, count(*) AS observations FROM events JOIN b USING (event_type) GROUP BY 1""")
def median_deviations(spark, sf_dir):
    """Median absolute deviation in two passes, groups of any size."""
    from ..operators.keyed import attach
    stages = Stages(spark, "mad")
    e = table(spark, sf_dir, "events").select("event_type", "value")
    base = stages(exact_median(e, ["event_type"], F.col("value"), stages, "m").select("event_type", "m"), "base")
    deviation = F.abs(F.col("value") - F.col("m"))
    out = exact_median(attach(e, base, ["event_type"], "inner"), ["event_type"], deviation, stages, "mad")
    return out.withColumn("mad", F.round("mad", 6))
