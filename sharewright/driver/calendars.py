"""Calendars and validity intervals."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..catalogue import default_catalogue
from ..functions import iso_month, iso_year, thursday
from ..operators.history import asof, close_overlaps, residual_overlaps, successors, with_fallback
from ..operators.keyed import attach, one_row, repeated_keys
from ..operators.rules import RuleFlow
from ..operators.weeks import broken_week, calendar_of, compare_months, open_at, wrong_label
from ..session import Stages
from .registry import query, table, text

_WEEKS = """w AS (SELECT DISTINCT CAST(date_trunc('week', l_shipdate) AS DATE) AS d FROM lineitem)"""


def _weeks(spark, sf_dir):
    return calendar_of(table(spark, sf_dir, "lineitem").select("l_shipdate"), "l_shipdate")


@query(f"""WITH {_WEEKS}
SELECT strftime(d, '%G-%V') AS year_week, CAST(d AS VARCHAR) AS week_start_date, CAST(d + 6 AS VARCHAR) AS week_end_date,
       CAST(year(d + 3) AS INTEGER) AS year, CAST(month(d + 3) AS INTEGER) AS month, CAST((d - DATE '1970-01-05') // 7 AS INTEGER) AS week_seq FROM w""")
def iso_calendar(spark, sf_dir):
    """C14: ISO weeks of the shipping dates; year and month belong to the Thursday."""
    return _weeks(spark, sf_dir).withColumns({c: text(c) for c in ("week_start_date", "week_end_date")})


def _civil(spark, sf_dir):
    """The calendar as a source would send it: civil year and month of the Monday."""
    start = F.col("week_start_date")
    return _weeks(spark, sf_dir).withColumns({"year": F.year(start), "month": F.month(start)})


def _repaired(spark, sf_dir):
    flow = RuleFlow(_civil(spark, sf_dir), default_catalogue(), "dim_calendario", ["year_week"])
    start = "week_start_date"
    flow.correct("CAL_001", F.col("year") != iso_year(start), {"year": iso_year(start)})
    flow.correct("CAL_004", F.col("month") != iso_month(start), {"month": iso_month(start)})
    return flow.survivors()


@query(f"""WITH {_WEEKS}
SELECT strftime(d, '%G-%V') AS year_week, CAST(year(d) AS INTEGER) AS year_raw, CAST(year(d + 3) AS INTEGER) AS year,
       CAST(month(d) AS INTEGER) AS month_raw, CAST(month(d + 3) AS INTEGER) AS month,
       concat_ws(',', CASE WHEN year(d) <> year(d + 3) THEN 'CAL_001' END, CASE WHEN month(d) <> month(d + 3) THEN 'CAL_004' END) AS flags
FROM w WHERE year(d) <> year(d + 3) OR month(d) <> month(d + 3)""")
def calendar_repair(spark, sf_dir):
    """C14, V8: weeks whose civil year or month was replaced by the ISO one, before and after."""
    return _repaired(spark, sf_dir).where(F.size("dq_flags") > 0).select(
        "year_week", "year_raw", "year", "month_raw", "month", F.array_join("dq_flags", ",").alias("flags"))


@query(f"""WITH {_WEEKS},
b AS (SELECT strftime(d, '%Y-%m') AS m, count(*) AS n FROM w GROUP BY 1), a AS (SELECT strftime(d + 3, '%Y-%m') AS m, count(*) AS n FROM w GROUP BY 1)
SELECT coalesce(b.m, a.m) AS month_label, coalesce(b.n, 0) AS weeks_before, coalesce(a.n, 0) AS weeks_after FROM b FULL JOIN a ON a.m = b.m""")
def weeks_per_month(spark, sf_dir):
    """Weeks per month, civil against ISO (full outer)."""
    return compare_months(_repaired(spark, sf_dir))


@query(f"""WITH {_WEEKS}, g AS (SELECT *, d - lag(d) OVER (ORDER BY d) AS gap, year(d) || '-' || lpad(CAST(week(d) AS VARCHAR), 2, '0') AS label FROM w)
SELECT count(*) AS weeks, count_if(gap <> 7) AS broken,
       count_if(label <> strftime(d, '%G-%V') OR label IN (SELECT label FROM g GROUP BY 1 HAVING count(*) > 1)) AS wrong_labels FROM g""")
def calendar_checks(spark, sf_dir):
    """W7, W1 (CAL_002, CAL_003): gaps between weeks, labels that repeat or are not ISO."""
    start = F.col("week_start_date")
    label = F.concat(F.year(start).cast("string"), F.lit("-"), F.lpad(F.weekofyear(start).cast("string"), 2, "0"))
    c = _weeks(spark, sf_dir).withColumn("year_week", label)       # civil year with ISO week: wrong around New Year
    c = c.withColumns({"broken": broken_week(), "wrong": wrong_label()})
    return c.agg(F.count("*").alias("weeks"), F.count_if("broken").alias("broken"), F.count_if("wrong").alias("wrong_labels"))


# ------------------------------------------------------------------ validity intervals
_HIST = """o AS (SELECT o_custkey AS store_id, o_orderpriority AS category, CAST(o_orderdate AS DATE) AS valid_from, o_orderstatus AS status FROM orders),
u AS (SELECT *, count(*) OVER (PARTITION BY store_id, category, valid_from) AS n FROM o),
h AS (SELECT store_id, category, status, valid_from, DATE '9999-12-31' AS valid_to_raw,
             lead(valid_from) OVER (PARTITION BY store_id, category ORDER BY valid_from) AS nxt FROM u WHERE n = 1),
c AS (SELECT store_id, category, status, valid_from, valid_to_raw, coalesce(nxt - 1, valid_to_raw) AS valid_to, nxt IS NOT NULL AS closed FROM h)"""
_KEYS = ["store_id", "category"]


def _history(spark, sf_dir, stages):
    """Each order opens an interval for its customer and priority; same-day starts are set aside first."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("store_id"), F.col("o_orderpriority").alias("category"),
        F.col("o_orderdate").cast("date").alias("valid_from"), F.lit("9999-12-31").cast("date").alias("valid_to"),
        F.col("o_orderstatus").alias("status"))
    key = [*_KEYS, "valid_from"]
    repeated = stages(repeated_keys(o, key).select(*key), "same-day")
    return stages(close_overlaps(attach(o, repeated, key, "left_anti"), _KEYS), "history")


@query(f"""WITH {_HIST}
SELECT store_id, category, status, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to,
       CAST(valid_to_raw AS VARCHAR) AS valid_to_raw, closed FROM c""")
def interval_repair(spark, sf_dir):
    """C12, W8 (TER_001, TER_006): the later start wins, the earlier interval is closed the day before."""
    h = _history(spark, sf_dir, Stages(spark, "history"))
    return h.withColumns({c: text(c) for c in ("valid_from", "valid_to", "valid_to_raw")})


@query(f"""WITH {_HIST}
SELECT a.store_id, a.category, CAST(a.valid_to AS VARCHAR) AS valid_to, a.status, b.status AS next_status
FROM c a JOIN c b ON a.store_id = b.store_id AND a.category = b.category AND b.valid_from = a.valid_to + 1 WHERE a.closed""")
def interval_successors(spark, sf_dir):
    """Each closed interval with the one that replaces it."""
    h = _history(spark, sf_dir, Stages(spark, "history"))
    out = successors(h, _KEYS, ["status"]).where("closed")
    return out.select("store_id", "category", text("valid_to").alias("valid_to"), "status", "next_status")


@query(f"""WITH {_HIST} SELECT (SELECT count(*) FROM c) AS intervals, (SELECT count_if(closed) FROM c) AS closed, CAST(0 AS BIGINT) AS overlaps,
       (SELECT count(*) FROM u WHERE n > 1) AS same_day""")
def interval_audit(spark, sf_dir):
    """After the repair nothing overlaps."""
    stages = Stages(spark, "history")
    h = _history(spark, sf_dir, stages)
    total = h.agg(F.count("*").alias("intervals"), F.count_if("closed").alias("closed"))
    left = residual_overlaps(h, _KEYS).agg(F.count("*").alias("overlaps"))
    orders = table(spark, sf_dir, "orders").agg(F.count("*").alias("n"))
    return one_row(total, left, orders).select(
        "intervals", "closed", "overlaps", (F.col("n") - F.col("intervals")).alias("same_day"))


@query(f"""WITH {_HIST},
l AS (SELECT l_orderkey, l_linenumber, l_quantity, o_custkey AS store_id, o_orderpriority AS category, CASE WHEN l_linenumber = 1 THEN l_linestatus END AS own,
             CAST(date_trunc('week', l_shipdate) AS DATE) + 3 AS at FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
j AS (SELECT l.*, c.status FROM l LEFT JOIN c ON c.store_id = l.store_id AND c.category = l.category AND l.at BETWEEN c.valid_from AND c.valid_to)
SELECT coalesce(status, own, 'NONE') AS attribute, CASE WHEN status IS NOT NULL THEN 'HISTORY' WHEN own IS NOT NULL THEN 'OWN' ELSE 'NONE' END AS origin,
       count(*) AS n_rows, sum(l_quantity) AS quantity FROM j GROUP BY ALL""")
def asof_attribute(spark, sf_dir):
    """Attribute valid on the week's Thursday, then the row's own value, then a default; with its origin."""
    stages = Stages(spark, "asof")
    h = _history(spark, sf_dir, stages)
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("store_id"),
                                              F.col("o_orderpriority").alias("category"))
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", "l_quantity", "l_shipdate").join(o, "l_orderkey")
    own = F.when(F.col("l_linenumber") == 1, F.col("l_linestatus"))
    at = thursday(F.trunc(F.col("l_shipdate").cast("date"), "week"))
    rows = asof(l.withColumn("own", own), h, _KEYS, at, ["status"], stages=stages)
    rows = with_fallback(rows, "attribute", [("asof_status", "HISTORY"), ("own", "OWN")], "NONE", "origin")
    return rows.groupBy("attribute", "origin").agg(F.count("*").alias("n_rows"), F.sum("l_quantity").alias("quantity"))


@query("""
SELECT strftime(l_shipdate, '%G-%V') AS year_week, count(*) AS n_rows, count_if(o_orderdate < CAST(date_trunc('week', l_shipdate) AS DATE) + 7) AS open_rows
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def open_weeks(spark, sf_dir):
    """Rows recorded before the week of the shipment was over."""
    from ..functions import iso_label
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    start = F.trunc(F.col("l_shipdate").cast("date"), "week")
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", start.alias("start"), F.date_add(start, 6).alias("week_end")).join(o, "l_orderkey")
    return l.groupBy(iso_label("start").alias("year_week")).agg(
        F.count("*").alias("n_rows"), F.count_if(open_at("o_orderdate", "week_end")).alias("open_rows"))
