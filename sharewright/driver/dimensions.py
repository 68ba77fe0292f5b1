"""Rule logs of the dimension plans and the schema rules, each against the same rules written one after the other in SQL."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..catalogue import default_catalogue
from ..operators.conform import schema_records
from ..plans.products import conform_products
from ..plans.stores import conform_stores
from ..plans.territories import conform_territories
from ..session import Stages
from ..settings import COUNTRY_BOX as B, STATES, Settings
from .registry import padded, query, table, text

SETTINGS = Settings(min_evidence=0.85)


def _log(conformed):
    return conformed.log.select("regra_id", "avaliados", "falhas")


def _rows(rule: str, source: str, failed: str) -> str:
    return f"SELECT '{rule}' AS regra_id, count(*) AS avaliados, count_if(coalesce({failed}, FALSE)) AS falhas FROM {source}"


_PRODUCTS = f"""p0 AS (SELECT p_partkey AS k, unnest(CASE WHEN p_partkey % 53 = 0 THEN [1, 2] ELSE [1] END) AS cp, p_partkey % 20 AS sub,
  CASE WHEN p_partkey % 13 = 0 THEN '' WHEN p_partkey % 41 = 0 THEN 'WRONG' WHEN p_partkey % 4 = 0 THEN CASE WHEN p_partkey % 11 = 0 THEN 'CHOCOLATE' ELSE 'CHOCOLATES' END
    ELSE 'CATEGORY ' || (p_partkey % 4) END AS category,
  CASE WHEN p_partkey % 10 = 1 THEN p_partkey - 1 ELSE p_partkey END AS code FROM part),
p1 AS (SELECT *, CASE category WHEN 'CHOCOLATE' THEN 'CHOCOLATES' ELSE category END AS official FROM p0 WHERE k % 53 <> 0),
n AS (SELECT sub, official, count(*) AS n FROM p1 WHERE official <> '' GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY sub) AS t, row_number() OVER (PARTITION BY sub ORDER BY n DESC, official) AS nth FROM n),
e AS (SELECT sub, official AS expected FROM r WHERE nth = 1 AND round(n / t, 4) >= {SETTINGS.min_evidence}),
p2 AS (SELECT p1.*, expected, CASE WHEN official = '' AND expected IS NOT NULL THEN expected ELSE official END AS filled FROM p1 LEFT JOIN e USING (sub)),
p3 AS (SELECT *, row_number() OVER (PARTITION BY CASE WHEN k % 19 = 0 THEN 'EAN' ELSE '' END || code
  ORDER BY coalesce(CAST(filled = expected AS INT), -1) DESC, CAST(k % 37 <> 0 AS INT) DESC, k) AS nth FROM p2),
p4 AS (SELECT *, filled <> expected AND k % 2 = 0 AS named FROM p3 WHERE nth = 1),
p5 AS (SELECT *, CASE WHEN named THEN expected ELSE filled END AS last FROM p4)"""


@query(f"WITH {_PRODUCTS} " + " UNION ALL ".join([
    _rows("PRD_001", "p0", "k % 53 = 0"), _rows("PRD_004", "p1", "k % 7 = 0"), _rows("PRD_005", "p1", "category = 'CHOCOLATE'"),
    _rows("PRD_006", "p2", "official = '' AND expected IS NOT NULL"), _rows("PRD_002", "p3", "nth > 1"), _rows("PRD_007", "p4", "named"),
    _rows("PRD_008", "p5", "last <> expected"), _rows("PRD_003", "p5", "k % 19 = 0")]))
def product_rule_log(spark, sf_dir):
    """PRD_001-008: repeated ids, spelling, synonyms, reference categories and one product per code, with every kind of failure."""
    k = F.col("p_partkey")
    sub = F.concat(F.lit("SUB "), text(k % 20))
    copies = F.when(k % 53 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    code = text(F.when(k % 10 == 1, k - 1).otherwise(k))
    raw = table(spark, sf_dir, "part").select(
        F.when(k % 37 == 0, padded("Q", k, 5)).otherwise(padded("P", k, 5)).alias("product_id"),
        F.when(k % 19 == 0, F.concat(F.lit("EAN"), code)).otherwise(F.concat(F.lit("7891"), F.lpad(code, 9, "0"))).alias("ean"),
        F.when(k % 2 == 0, F.concat(F.lit("ITEM OF "), sub)).otherwise(F.lit("ITEM")).alias("product_description"),
        F.when(k % 7 == 0, F.concat(F.lit(" "), F.lower("p_brand"))).otherwise(F.upper("p_brand")).alias("brand"),
        F.lit("M").alias("manufacturer"),
        F.when(k % 13 == 0, "").when(k % 41 == 0, "WRONG").when((k % 4 == 0) & (k % 11 == 0), "CHOCOLATE").when(k % 4 == 0, "CHOCOLATES")
        .otherwise(F.concat(F.lit("CATEGORY "), text(k % 4))).alias("category"), sub.alias("subcategory"),
        text("p_size").alias("package_size"), F.lit("G").alias("package_unit"), F.lit("Y").alias("is_own_product"),
        F.explode(copies).alias("_copy"), F.lit("part.csv").alias("_source_file")).drop("_copy")
    return _log(conform_products(raw, default_catalogue(), SETTINGS, Stages(spark, "products")))


_NAMES = "[" + ",".join(f"'{s}'" for s in STATES) + "]"
_INSIDE = f"lat BETWEEN {B['south']} AND {B['north']} AND lon BETWEEN {B['west']} AND {B['east']}"
_STORES = f"""s0 AS (SELECT c_custkey AS k, unnest(CASE WHEN c_custkey % 61 = 0 THEN [1, 2] ELSE [1] END) AS cp, c_nationkey AS city,
  CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 31 = 0 THEN 'XX' WHEN c_custkey % 9 = 0 THEN list_extract({_NAMES}, 1) ELSE list_extract({_NAMES}, c_nationkey + 1) END AS state,
  CASE WHEN c_custkey % 43 <> 0 THEN CAST(c_custkey % 60 AS DOUBLE) - 40 END AS lat, -CAST(c_custkey % 100 AS DOUBLE) AS lon FROM customer),
s1 AS (SELECT * FROM s0 WHERE k % 61 <> 0),
n AS (SELECT city, state, count(*) AS n FROM s1 WHERE state <> 'XX' GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY city) AS t, row_number() OVER (PARTITION BY city ORDER BY n DESC, state) AS nth FROM n),
e AS (SELECT city, state AS expected FROM r WHERE nth = 1 AND round(n / t, 4) >= {SETTINGS.min_evidence}),
s2 AS (SELECT s1.*, expected FROM s1 LEFT JOIN e USING (city)),
g AS (SELECT city, avg(lat) AS a, stddev(lat) AS s, count(*) AS n FROM s2 WHERE {_INSIDE} GROUP BY city),
d AS (SELECT max(a) - min(a) AS across, avg(s) AS within, CAST(sum(n) AS BIGINT) AS n FROM g)"""


@query(f"WITH {_STORES} " + " UNION ALL ".join([
    _rows("LOJ_001", "s0", "k % 61 = 0"), _rows("LOJ_002", "s2", "expected IS NOT NULL AND state IS DISTINCT FROM expected"),
    _rows("LOJ_003", "s2", "k % 6 = 0 AND k % 10 <> 0"), _rows("LOJ_004", "s2", f"NOT ({_INSIDE})"), _rows("LOJ_006", "s2", "k % 8 = 0"),
    _rows("LOJ_007", "s2", "k % 17 = 0"),
    "SELECT 'LOJ_005', n, CASE WHEN within > 0 AND across < within THEN n ELSE 0 END FROM d"]))
def store_rule_log(spark, sf_dir):
    """LOJ_001-007: repeated ids, state from the city, masked tax ids, coordinates, blank territory and seller."""
    k = F.col("c_custkey")
    names = F.array(*[F.lit(s) for s in STATES])
    tax = F.lpad(text(k), 14, "1")
    copies = F.when(k % 61 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    raw = table(spark, sf_dir, "customer").select(
        padded("S", k, 6).alias("store_id"), F.col("c_name").alias("store_name"),
        F.when(k % 10 == 0, F.concat(F.lit("X"), text(k % 10))).when(k % 6 == 0, F.concat(
            F.substring(tax, 1, 2), F.lit("."), F.substring(tax, 3, 6), F.lit("/"), F.substring(tax, 9, 6))).otherwise(tax).alias("cnpj"),
        F.lit("CHAIN").alias("retailer_name"), F.lit("SUPER").alias("channel"), text("c_nationkey").alias("city"),
        F.when(k % 29 == 0, F.lit(None)).when(k % 31 == 0, "XX").when(k % 9 == 0, STATES[0]).otherwise(
            F.element_at(names, F.col("c_nationkey") + 1)).alias("state"),
        F.when(k % 8 != 0, "T1").alias("territory_id"), F.when(k % 17 == 0, "  ").otherwise("V1").alias("seller_id"),
        F.when(k % 43 == 0, "unknown").otherwise(text(k % 60 - 40)).alias("latitude"), text(-(k % 100)).alias("longitude"),
        F.lit("Y").alias("active_flag"), F.explode(copies).alias("_copy"), F.lit("customer.csv").alias("_source_file")).drop("_copy")
    return _log(conform_stores(raw, default_catalogue(), SETTINGS, Stages(spark, "stores")))


_HISTORY = """h0 AS (SELECT s_suppkey AS s, n, CASE WHEN n = 1 THEN DATE '1990-01-01' ELSE DATE '1998-01-01' END AS lo,
    CASE WHEN n = 1 AND s_suppkey % 2 = 1 THEN DATE '1997-12-31' ELSE DATE '9999-12-31' END AS hi
  FROM (SELECT s_suppkey, unnest(CASE WHEN s_suppkey % 14 = 3 THEN [1, 1, 2] ELSE [1, 2] END) AS n FROM supplier)),
h1 AS (SELECT * FROM h0 WHERE NOT (s % 23 = 1 AND n = 1)),
h2 AS (SELECT *, count(*) OVER (PARTITION BY s, lo) AS same_day FROM h1 WHERE s % 12 <> 5),
h3 AS (SELECT *, lead(lo) OVER (PARTITION BY s ORDER BY lo) AS next FROM h2 WHERE same_day = 1)"""


@query(f"WITH {_HISTORY} " + " UNION ALL ".join([
    _rows("ING_005", "h0", "s % 23 = 1 AND n = 1"), _rows("TER_004", "h1", "s % 12 = 5"), _rows("TER_006", "h2", "same_day > 1"),
    _rows("TER_001", "h3", "hi >= next"), _rows("TER_002", "h3", "s % 7 = 0"), _rows("TER_005", "h3", "s % 9 = 0"),
    _rows("TER_003", "supplier", "s_suppkey NOT IN (SELECT s FROM h3)")]))
def territory_rule_log(spark, sf_dir):
    """TER_001-006, ING_005: unknown stores, two intervals of one day, overlaps, blanks, stores without history."""
    k = F.col("s_suppkey")
    suppliers = table(spark, sf_dir, "supplier")
    parts = F.when(k % 14 == 3, F.array(F.lit(1), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1), F.lit(2)))
    h = suppliers.select(k, F.explode(parts).alias("n"))
    first = F.col("n") == 1
    raw = h.select(
        F.when(k % 12 == 5, padded("X", k, 5)).otherwise(padded("S", k, 5)).alias("store_id"), F.lit("ALL").alias("category"),
        F.when(k % 7 != 0, "T1").alias("territory_id"), F.when(k % 9 == 0, " ").otherwise("V1").alias("seller_id"),
        F.when(first, "1990-01-01").otherwise("1998-01-01").alias("valid_from"),
        F.when(first & (k % 23 == 1), "soon").when(first & (k % 2 == 1), "1997-12-31").otherwise("9999-12-31").alias("valid_to"),
        F.lit("CRM").alias("assignment_source"), F.lit("history.csv").alias("_source_file"))
    stores = suppliers.select(padded("S", k, 5).alias("store_id"))
    return _log(conform_territories(raw, stores, default_catalogue(), Stages(spark, "territories")))


#: Two of the given tables as provider files: columns that are asked for, may be there, or are not mapped at all.
_SPECS = {
    "O": {"table": "orders", "required": {"key": "o_orderkey", "day": "o_orderdate", "channel": "o_channel"},
          "optional": {"priority": "o_orderpriority"}, "legacy": {"o_clerk": "key"}},
    "C": {"table": "customer", "required": {"key": "c_custkey", "name": "c_name"}, "optional": {}, "legacy": {}},
}


def _schema_sql() -> str:
    parts = []
    for provider, spec in _SPECS.items():
        asked = ", ".join(f"('{c}')" for c in spec["required"].values())
        known = ", ".join(f"'{c}'" for c in (*spec["required"].values(), *spec["optional"].values(), *spec["legacy"]))
        have = f"SELECT column_name FROM information_schema.columns WHERE table_name = '{spec['table']}'"
        parts += [f"SELECT 'ING_002' AS regra_id, 'fornecedor_{provider}' AS alvo, count(*) AS avaliados, count_if(c NOT IN ({have})) AS falhas "
                  f"FROM (VALUES {asked}) AS v(c)",
                  f"SELECT 'ING_003', 'fornecedor_{provider}', count(*), count_if(column_name NOT IN ({known})) FROM ({have})"]
    return " UNION ALL ".join(parts)


@query(_schema_sql())
def schema_rules(spark, sf_dir):
    """P2, P3, ING_002, ING_003: required columns that are missing and columns nobody mapped, from the schemas alone."""
    frames = {spec["table"]: table(spark, sf_dir, spec["table"]) for spec in _SPECS.values()}
    return schema_records(spark, frames, _SPECS).select("regra_id", "alvo", "avaliados", "falhas")
