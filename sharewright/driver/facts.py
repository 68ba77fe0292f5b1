"""Row-level fact rules over lineitem: types, versions, orphans, signs, tolerances."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..catalogue import default_catalogue
from ..functions import iso_label, price_gap, proven_sign_flip
from ..operators.audit import conflicting_rows, rule_over_targets
from ..operators.conform import bad_types, typed
from ..operators.keyed import with_other_source, with_repeat_count
from ..operators.rules import RuleFlow
from ..operators.versions import mark_versions
from ..session import Stages
from ..sources.ingest import content_hash
from .registry import money, query, table, text

_TYPES = {"amount": "decimal(18,2)", "k": "int"}


@query("""
WITH r AS (SELECT event_id, event_type, CASE WHEN value < 1 THEN event_type ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
             CASE WHEN event_type = 'error' AND value > 50 THEN NULL ELSE json_extract_string(props, '$.k') END AS k FROM events)
SELECT event_type, count(*) AS n_rows, count_if(TRY_CAST(amount AS DECIMAL(18,2)) IS NULL OR TRY_CAST(k AS INTEGER) IS NULL) AS removed,
       coalesce(CAST(sum(CASE WHEN TRY_CAST(k AS INTEGER) IS NOT NULL THEN TRY_CAST(amount AS DECIMAL(18,2)) END) AS DOUBLE), 0) AS amount,
       min(CASE WHEN TRY_CAST(amount AS DECIMAL(18,2)) IS NULL THEN amount END) AS kept_text FROM r GROUP BY 1""")
def type_or_quarantine(spark, sf_dir):
    """P4, C16 (ING_005): text that does not convert removes the row, which keeps its original text."""
    amount = F.when(F.col("value") < 1, F.col("event_type")).otherwise(text(money("value")))
    k = F.when((F.col("event_type") == "error") & (F.col("value") > 50), F.lit(None)).otherwise(F.get_json_object("props", "$.k"))
    raw = table(spark, sf_dir, "events").select("event_id", "event_type", amount.alias("amount"), k.alias("k"))
    flow = RuleFlow(raw, default_catalogue(), "events", ["event_id"])
    flow.quarantine("ING_005", bad_types(_TYPES)).transform(lambda d: d.withColumns(typed(_TYPES)))
    flow.stage(Stages(spark, "types"), "typed")
    kept = flow.survivors().select("event_type", "amount", F.lit(None).cast("string").alias("bad"), F.lit(0).alias("gone"))
    gone = flow.quarantined().select(F.from_json("payload", "event_type string, amount string").alias("p")).select(
        "p.event_type", F.lit(None).cast("decimal(18,2)").alias("amount"), F.col("p.amount").alias("t"), F.lit(1).alias("gone"))
    gone = gone.select("event_type", "amount", F.when(F.col("t").try_cast("decimal(18,2)").isNull(), F.col("t")).alias("bad"), "gone")
    return kept.unionByName(gone).groupBy("event_type").agg(
        F.count("*").alias("n_rows"), F.sum("gone").alias("removed"),
        F.coalesce(F.sum("amount"), F.lit(0)).cast("double").alias("amount"), F.min("bad").alias("kept_text"))


# ------------------------------------------------------------------ copies, versions, sources
_KEY = ["week", "l_suppkey", "l_partkey"]
_SALES = """s AS (SELECT l_orderkey, l_linenumber, l_linestatus AS provider, strftime(l_shipdate, '%G-%V') AS week, l_suppkey, l_partkey % 40 AS l_partkey,
  CAST(l_quantity AS INTEGER) AS units, l_returnflag,
  sha256(CAST(CAST(l_quantity AS INTEGER) % 5 AS VARCHAR) || '||' || l_linestatus || '||' || strftime(l_shipdate, '%G-%V') || '||' || l_suppkey || '||' || (l_partkey % 40)) AS h FROM lineitem)"""


def _sales(spark, sf_dir):
    """Sales whose content is key, source and a coarse quantity, so that exact copies occur."""
    start = F.trunc(F.col("l_shipdate").cast("date"), "week")
    s = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_linestatus").alias("provider"), iso_label(start).alias("week"), "l_suppkey",
        (F.col("l_partkey") % 40).alias("l_partkey"), F.col("l_quantity").cast("int").alias("units"), "l_returnflag")
    return s.withColumn("q", F.col("units") % 5).withColumn("h", content_hash(["q", "provider", *_KEY])).drop("q")


@query(f"""WITH {_SALES},
d AS (SELECT provider, week, l_suppkey, l_partkey, h, count(*) AS n FROM s GROUP BY ALL),
v AS (SELECT provider, week, l_suppkey, l_partkey, count(*) AS versions FROM d GROUP BY ALL),
x AS (SELECT week, l_suppkey, l_partkey, count(DISTINCT provider) AS sources FROM v WHERE versions = 1 GROUP BY ALL)
SELECT 'FCT_001' AS regra_id, CAST(sum(n) AS BIGINT) AS avaliados, CAST(sum(n - 1) AS BIGINT) AS falhas FROM d
UNION ALL SELECT 'FCT_002', CAST(sum(versions) AS BIGINT), CAST(sum(CASE WHEN versions > 1 THEN versions ELSE 0 END) AS BIGINT) FROM v
UNION ALL SELECT 'FCT_003', CAST(sum(sources) AS BIGINT), CAST(sum(CASE WHEN sources > 1 THEN sources ELSE 0 END) AS BIGINT) FROM x""")
def version_rules(spark, sf_dir):
    """C17, W1-W3 (FCT_001-003): copies, conflicting versions, several sources; each on the survivors of the one before."""
    stages = Stages(spark, "versions")
    rows = _sales(spark, sf_dir).select("provider", *_KEY, "h", F.lit(0).alias("order"))
    flow = RuleFlow(rows, default_catalogue(), "sales", ["provider", *_KEY, "h"])
    flow.transform(lambda d: mark_versions(d, "provider", _KEY, "h", ["order"], stages))
    flow.quarantine("FCT_001", F.col("copy") > 1).quarantine("FCT_002", F.col("versions") > 1)
    flow.quarantine("FCT_003", F.col("several_sources"))
    return flow.counts().select("regra_id", "avaliados", "falhas")


@query(f"""WITH {_SALES}, k AS (SELECT week, l_suppkey, l_partkey FROM s GROUP BY ALL HAVING count(DISTINCT h) > 1)
SELECT s.week, s.l_suppkey, s.l_partkey, s.provider, s.units, l_orderkey, l_linenumber,
       row_number() OVER (PARTITION BY s.week, s.l_suppkey, s.l_partkey ORDER BY l_orderkey, l_linenumber, s.units, s.provider) AS version
FROM s JOIN k ON s.week = k.week AND s.l_suppkey = k.l_suppkey AND s.l_partkey = k.l_partkey""")
def conflicting_versions(spark, sf_dir):
    """Every version of a conflicting key side by side, numbered by age; a key may hold any number."""
    order = [F.col(c) for c in ("l_orderkey", "l_linenumber", "units", "provider")]
    out = conflicting_rows(_sales(spark, sf_dir).drop("l_returnflag"), _KEY, "h", order, Stages(spark, "conflicts"))
    return out.drop("h").withColumn("version", F.col("version").cast("long"))


@query(f"""WITH {_SALES}, d AS (SELECT provider, week, l_suppkey, l_partkey, h, count(*) AS n FROM s GROUP BY ALL),
v AS (SELECT provider, week, l_suppkey, l_partkey, count(*) AS v FROM d GROUP BY ALL)
SELECT provider, 'FCT_001' AS regra_id, CAST(sum(n) AS BIGINT) AS evaluated, CAST(sum(n - 1) AS BIGINT) AS failed FROM d GROUP BY provider
UNION ALL SELECT provider, 'FCT_002', CAST(sum(v) AS BIGINT), CAST(sum(CASE WHEN v > 1 THEN v ELSE 0 END) AS BIGINT) FROM v GROUP BY provider""")
def one_rule_many_targets(spark, sf_dir):
    """The same two rules over several targets."""
    return rule_over_targets(_sales(spark, sf_dir).select("provider", *_KEY, "h"), "provider", _KEY, "h")


@query("""
WITH k AS (SELECT strftime(l_shipdate, '%G-%V') AS week, l_suppkey, l_partkey, l_returnflag FROM lineitem),
x AS (SELECT *, count(*) OVER (PARTITION BY week, l_suppkey, l_partkey) AS n, min(l_returnflag) OVER (PARTITION BY week, l_suppkey, l_partkey) <>
             max(l_returnflag) OVER (PARTITION BY week, l_suppkey, l_partkey) AS several FROM k)
SELECT l_returnflag, count(*) AS n_rows, count_if(n > 1) AS repeated, count_if(several) AS several_sources FROM x GROUP BY 1""")
def repeated_and_shared_keys(spark, sf_dir):
    """Rows of repeated keys and of keys reported by several sources, as statistics joined back."""
    stages = Stages(spark, "keys")
    start = F.trunc(F.col("l_shipdate").cast("date"), "week")
    l = table(spark, sf_dir, "lineitem").select(iso_label(start).alias("week"), "l_suppkey", "l_partkey", "l_returnflag")
    l = with_repeat_count(l, _KEY, stages)
    l = with_other_source(l, _KEY, "l_returnflag", stages)
    return l.groupBy("l_returnflag").agg(F.count("*").alias("n_rows"), F.count("copies").alias("repeated"),
                                         F.count("several_sources").alias("several_sources"))


# ------------------------------------------------------------------ signs and tolerances
_SIGNS = """g AS (SELECT l_returnflag, CAST(l_quantity AS BIGINT) AS units, CASE WHEN l_tax >= 0.06 THEN -CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS value,
  CASE WHEN l_discount < 0.03 THEN CAST(round(l_extendedprice / l_quantity, 4) AS DECIMAL(18,4)) WHEN l_discount < 0.06 THEN CAST(round(l_extendedprice / l_quantity * 0.5, 4) AS DECIMAL(18,4)) END AS price FROM lineitem),
p AS (SELECT *, coalesce(value < 0 AND units > 0 AND price IS NOT NULL AND abs(units * price + value) <= 0.01 * abs(value) + 0.05, FALSE) AS proven FROM g)"""


def _signs(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    value = money("l_extendedprice")
    price = F.round(F.col("l_extendedprice") / F.col("l_quantity"), 4)
    half = F.round(F.col("l_extendedprice") / F.col("l_quantity") * 0.5, 4)
    return l.select(
        "l_returnflag", F.col("l_quantity").cast("bigint").alias("units"), F.when(F.col("l_tax") >= 0.06, -value).otherwise(value).alias("value"),
        F.when(F.col("l_discount") < 0.03, price).when(F.col("l_discount") < 0.06, half).cast("decimal(18,4)").alias("price"))


@query(f"""WITH {_SIGNS}
SELECT l_returnflag, count_if(proven) AS corrected, count_if(value < 0 AND NOT proven) AS removed,
       CAST(sum(CASE WHEN proven THEN abs(value) WHEN value >= 0 THEN value END) AS DOUBLE) AS kept_value FROM p GROUP BY 1""")
def sign_flips(spark, sf_dir):
    """C19, P9 (FCT_007, FCT_008): a negative value is corrected only when units x price proves it, else removed."""
    flow = RuleFlow(_signs(spark, sf_dir), default_catalogue(), "sales", ["l_returnflag"], value="value")
    flow.correct("FCT_007", proven_sign_flip("units", "price", "value", 0.01, 0.05), {"value": F.abs("value")})
    flow.quarantine("FCT_008", F.col("value") < 0)
    # one pass over rows and outcomes: no second scan for the removed part
    removed, flipped = F.col("_dq_removed").isNotNull(), F.col("value") != F.col("value_raw")
    return flow.df.groupBy("l_returnflag").agg(
        F.count_if(flipped).alias("corrected"), F.count_if(removed).alias("removed"),
        F.sum(F.when(~removed, F.col("value"))).cast("double").alias("kept_value"))


@query(f"""WITH {_SIGNS}
SELECT l_returnflag, count_if(price IS NOT NULL) AS evaluated, count_if(price IS NOT NULL AND abs(units * price - abs(value)) > 0.01 * abs(value) + 0.05) AS failed FROM p GROUP BY 1""")
def price_agreement(spark, sf_dir):
    """P9, Q7 (FCT_013): value against units x price, evaluated only where a price exists."""
    s = _signs(spark, sf_dir).withColumn("value", F.abs("value"))
    seen = F.col("price").isNotNull()
    far = price_gap("units", "price", "value") > 0.01 * F.col("value") + 0.05
    return s.groupBy("l_returnflag").agg(F.count_if(seen).alias("evaluated"), F.count_if(seen & far).alias("failed"))


@query("""
SELECT l_returnflag, count(*) AS evaluated, count_if(abs(l_extendedprice - l_quantity * p_retailprice) > 0.01 * (l_quantity * p_retailprice) + 1e-6) AS failed
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def volume_reconciliation(spark, sf_dir):
    """C24 (FCT_020): reported amount against quantity x catalogue size, as dataset counts."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    l = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_extendedprice", "l_quantity").join(p, "l_partkey")
    expected = F.col("l_quantity") * F.col("p_retailprice")
    far = F.abs(F.col("l_extendedprice") - expected) > 0.01 * expected + 1e-6
    return l.groupBy("l_returnflag").agg(F.count("*").alias("evaluated"), F.count_if(far).alias("failed"))


@query("""
SELECT l_returnflag, count_if(units = 0 AND value > 0) AS zero_units, count_if(vol = 0 AND units > 0) AS zero_volume, count_if(units = 0 AND vol = 0 AND value = 0) AS zero_sale,
       count_if(legacy <> value) AS legacy_differs
FROM (SELECT l_returnflag, CASE WHEN l_quantity < 3 THEN 0 ELSE l_quantity END AS units, CASE WHEN l_quantity < 3 OR l_discount = 0 THEN 0 ELSE l_quantity END AS vol,
             CASE WHEN l_quantity < 2 THEN 0 ELSE l_extendedprice END AS value, l_extendedprice AS legacy FROM lineitem) GROUP BY 1""")
def completeness_checks(spark, sf_dir):
    """P5, Q1 (ING_004, FCT_014-016): legacy against standard, zero units, zero volume, explicit zero sale."""
    q = F.col("l_quantity")
    raw = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.when(q < 3, 0.0).otherwise(q).alias("units"),
        F.when((q < 3) | (F.col("l_discount") == 0), 0.0).otherwise(q).alias("vol"),
        F.when(q < 2, 0.0).otherwise(F.col("l_extendedprice")).alias("value"), F.col("l_extendedprice").alias("legacy"))
    flow = RuleFlow(raw, default_catalogue(), "sales", ["l_returnflag"])
    flow.check("FCT_014", (F.col("units") == 0) & (F.col("value") > 0)).check("FCT_015", (F.col("vol") == 0) & (F.col("units") > 0))
    flow.check("FCT_016", (F.col("units") == 0) & (F.col("vol") == 0) & (F.col("value") == 0)).check("ING_004", F.col("legacy") != F.col("value"))

    def hit(rule):
        return F.count_if(F.array_contains("dq_flags", rule))
    return flow.survivors().groupBy("l_returnflag").agg(
        hit("FCT_014").alias("zero_units"), hit("FCT_015").alias("zero_volume"), hit("FCT_016").alias("zero_sale"), hit("ING_004").alias("legacy_differs"))
