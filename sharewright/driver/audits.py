"""Audit, profiling and run-history queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.audit import excess, expectation_rows, fine_comb, frequency, latest_run, rule_trend
from ..operators.keyed import sample_rows
from .registry import money, query, table, text

_RUNS = """runs AS (SELECT strftime(o_orderdate, '%Y-%m') AS run_id, max(o_orderdate) AS executado_em, o_orderpriority AS regra_id, 'orders' AS alvo, count(*) AS avaliados,
  count_if(o_orderstatus = 'F') AS falhas FROM orders GROUP BY ALL)"""


def _runs(spark, sf_dir):
    """A rule log whose runs are the months of the orders."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("run_id"), F.col("o_orderpriority").alias("regra_id")).agg(
        F.max("o_orderdate").alias("executado_em"), F.count("*").alias("avaliados"),
        F.count_if(F.col("o_orderstatus") == "F").alias("falhas")).withColumn("alvo", F.lit("orders"))


@query(f"""WITH {_RUNS} SELECT run_id, regra_id, avaliados, falhas FROM runs WHERE run_id = (SELECT arg_max(run_id, executado_em) FROM runs)""")
def latest_run_log(spark, sf_dir):
    """Log of the newest run."""
    return latest_run(_runs(spark, sf_dir)).select("run_id", "regra_id", "avaliados", "falhas")


@query(f"""WITH {_RUNS} SELECT regra_id, run_id, falhas, falhas - lag(falhas) OVER (PARTITION BY regra_id ORDER BY executado_em, run_id) AS change FROM runs""")
def rule_trends(spark, sf_dir):
    """Q15: failures of a rule over the runs, with the change."""
    return rule_trend(_runs(spark, sf_dir)).select("regra_id", "run_id", "falhas", "change")


_CHECKS = [(1, "orders: repeated key", 0), (2, "lineitem: repeated key", 0), (3, "orders: unknown status", 0), (4, "customer: negative balance", 0),
           (5, "lineitem: shipped before ordered", 0), (6, "documents: blank text", 0), (7, "nation: rows", 25)]
_ROWS = " UNION ALL ".join(
    f"SELECT {o} AS ordem, '{layer}' AS camada, '{text_}' AS verificacao, CAST({e} AS BIGINT) AS esperado, CAST(({sql}) AS BIGINT) AS obtido"
    for (o, text_, e), layer, sql in zip(_CHECKS, ("Bronze", "Bronze", "Bronze", "Bronze", "Silver", "Bronze", "Bronze"), (
        "SELECT count(*) - count(DISTINCT o_orderkey) FROM orders",
        "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) FROM lineitem",
        "SELECT count_if(o_orderstatus NOT IN ('O', 'F', 'P')) FROM orders", "SELECT count_if(c_acctbal < 0) FROM customer",
        "SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate",
        "SELECT count_if(trim(text) = '') FROM documents", "SELECT count(*) FROM nation")))


@query(f"""SELECT *, CASE WHEN esperado = obtido THEN 'OK' ELSE 'FALHA' END AS status FROM ({_ROWS})""")
def fine_comb_checks(spark, sf_dir):
    """Expected against found, one aggregate per table instead of one query per check."""
    def t(name):
        return table(spark, sf_dir, name)

    ship = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate").join(t("orders").select("o_orderkey", "o_orderdate"), "o_orderkey")
    totals = [
        ("Bronze", t("orders").agg(excess(["o_orderkey"]).alias("c1"), F.count_if(~F.col("o_orderstatus").isin("O", "F", "P")).alias("c3")), (1, 3)),
        ("Bronze", t("lineitem").agg(excess(["l_orderkey", "l_linenumber"]).alias("c2")), (2,)),
        ("Bronze", t("customer").agg(F.count_if(F.col("c_acctbal") < 0).alias("c4")), (4,)),
        ("Silver", ship.agg(F.count_if(F.col("l_shipdate") < F.col("o_orderdate")).alias("c5")), (5,)),
        ("Bronze", t("documents").agg(F.count_if(F.trim("text") == "").alias("c6")), (6,)),
        ("Bronze", t("nation").agg(F.count("*").alias("c7")), (7,)),
    ]
    wanted = {c[0]: c for c in _CHECKS}
    return fine_comb([expectation_rows(df, layer, [wanted[i] for i in ids]) for layer, df, ids in totals])


@query("""SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY ALL""")
def hierarchy_crosstab(spark, sf_dir):
    """Category x subcategory counts."""
    return frequency(table(spark, sf_dir, "part"), ["p_type", "p_brand"])


@query("""SELECT p_brand, p_name, count(*) AS n_rows, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types FROM part GROUP BY ALL HAVING count(*) > 1""")
def duplicate_domains(spark, sf_dir):
    """Repeated codes with the distinct categories they carry (a small domain)."""
    return table(spark, sf_dir, "part").groupBy("p_brand", "p_name").agg(
        F.count("*").alias("n_rows"), F.array_join(F.array_sort(F.collect_set("p_type")), ",").alias("types")).where(F.col("n_rows") > 1)


@query("""SELECT 'customer' AS origin, count(*) AS n_rows, count_if(NOT regexp_matches(c_name, '^Customer#[0-9]{8}[05]$')) AS malformed FROM customer
UNION ALL SELECT 'supplier', count(*), count_if(NOT regexp_matches(s_name, '^Customer#[0-9]{8}[05]$')) FROM supplier""")
def pattern_on_both_sides(spark, sf_dir):
    """The same pattern test on two tables."""
    def one(name, column):
        ok = F.col(column).rlike("^Customer#[0-9]{8}[05]$")
        return table(spark, sf_dir, name).agg(F.count("*").alias("n_rows"), F.count_if(~ok).alias("malformed")).withColumn("origin", F.lit(name))
    return one("customer", "c_name").unionByName(one("supplier", "s_name"))


@query("""SELECT l_returnflag, (SELECT count(*) FROM lineitem) AS total_rows, count(*) AS n_rows, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value,
  round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / (SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem), 6) AS part FROM lineitem GROUP BY 1""")
def conservation_by_provider(spark, sf_dir):
    """Rows and value per provider against the total (scalar subqueries)."""
    per = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n_rows"), F.sum(money("l_extendedprice")).alias("value"))
    total = per.agg(F.sum("n_rows").alias("total_rows"), F.sum("value").alias("all"))
    out = per.withColumns({c: total.select(c).scalar() for c in ("total_rows", "all")})      # scalar subqueries
    return out.select("l_returnflag", "total_rows", "n_rows", F.col("value").cast("double").alias("value"),
                      F.round(F.col("value").cast("double") / F.col("all").cast("double"), 6).alias("part"))


@query("""SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000)""")
def semi_filter(spark, sf_dir):
    """Rows whose key occurs in another relation."""
    o = table(spark, sf_dir, "orders").where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400000))
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name").join(o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")


@query("""SELECT o_orderpriority, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n <= 5""")
def first_rows_per_group(spark, sf_dir):
    """First five rows per group; each task keeps its own five before the shuffle."""
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return sample_rows(o, ["o_orderpriority"], [F.desc("o_totalprice"), F.col("o_orderkey")], 5)


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_suppkey LIMIT 20""")
def top_rows(spark, sf_dir):
    """O2: top 20 (a report): each task keeps 20, nothing is sorted globally."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    return l.orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_suppkey").limit(20)


@query("""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n, count(DISTINCT user_id) AS users, min(value) AS lo, max(value) AS hi FROM events GROUP BY ALL""")
def daily_event_profile(spark, sf_dir):
    """Counts, distinct counts and extremes per group."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(text(F.to_date("ts")).alias("day"), "event_type").agg(
        F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), F.min("value").alias("lo"), F.max("value").alias("hi"))
