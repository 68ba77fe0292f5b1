"""Share of category at several cuts, cell quality, status, gates and the views on top."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..catalogue import default_catalogue
from ..functions import iso_label
from ..operators.rules import rule_log
from ..operators.share import (HIGH_QUARANTINE, LOW_COVERAGE, NO_SALE, OFFICIAL, OPEN_WEEK, SHARE_COLUMNS, brand_cells, cell_coverage,
                               cell_rows, gate_counts, market_share, per_store)
from ..plans.evidence import fact_sample, own_share_series, retained_value, status_mix
from ..plans.views import official_shares, own_share
from ..session import Stages
from ..settings import CUTS, NO_TERRITORY
from .registry import as_double, money, query, table, text

MIN_COVERAGE, MAX_QUARANTINE = 0.30, 0.12

_BASE = """stores AS (SELECT CASE WHEN s_suppkey % 20 = 7 THEN -1 - s_suppkey ELSE s_suppkey END AS store_id, n_name AS retailer_name, r_name AS channel, CASE WHEN s_acctbal < 0 THEN NULL ELSE 'U' || (s_suppkey % 4) END AS state,
  CASE WHEN s_suppkey % 10 = 0 THEN 'SEM_TERRITORIO' ELSE 'T' || (s_suppkey % 7) END AS territory_id
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
lines AS (SELECT strftime(l_shipdate, '%G-%V') AS year_week, p_type AS category, p_brand AS brand, 'M' || (CAST(replace(p_brand, 'Brand#', '') AS INTEGER) % 5) AS manufacturer,
  CASE WHEN CAST(replace(p_brand, 'Brand#', '') AS INTEGER) % 6 = 0 THEN 'Y' ELSE 'N' END AS is_own_product, l_suppkey AS store_id,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS sales_value_brl, CAST(l_quantity AS DECIMAL(18,3)) AS sold_volume_kg, CAST(l_quantity AS BIGINT) AS units,
  CASE WHEN l_discount >= 0.09 THEN 'APROVADO_COM_ALERTA' ELSE 'APROVADO' END AS dq_status, l_shipdate >= TIMESTAMP '2001-10-29' AND l_linenumber = 1 AS open_row,
  l_suppkey % 20 = 7 OR l_discount >= 0.10 AS removed FROM lineitem JOIN part ON l_partkey = p_partkey),
fact AS (SELECT * FROM lines JOIN stores USING (store_id) WHERE NOT removed),
chain AS (SELECT w.year_week, c.retailer_name, round(CAST(w.n AS DOUBLE) / c.n, 4) AS coverage_ratio FROM
  (SELECT year_week, retailer_name, count(DISTINCT store_id) AS n FROM lines JOIN stores USING (store_id) GROUP BY ALL) w
  JOIN (SELECT retailer_name, count(*) AS n FROM stores GROUP BY 1) c USING (retailer_name))"""

_LEVEL = """CASE WHEN grouping(retailer_name) = 0 THEN 'REDE' WHEN grouping(channel) = 0 THEN 'CANAL' WHEN grouping(state) = 0 THEN 'UF'
  WHEN grouping(territory_id) = 0 THEN 'TERRITORIO' ELSE 'NACIONAL' END"""
_VALUE = """CASE WHEN grouping(retailer_name) = 0 THEN coalesce(retailer_name, '') WHEN grouping(channel) = 0 THEN coalesce(channel, '') WHEN grouping(state) = 0 THEN coalesce(state, '')
  WHEN grouping(territory_id) = 0 THEN coalesce(territory_id, '') ELSE 'BRASIL' END"""


def _sets(keys: str) -> str:
    return f"GROUPING SETS (({keys}), ({keys}, retailer_name), ({keys}, channel), ({keys}, state), ({keys}, territory_id))"


_CELLS = f"""g AS (SELECT {_LEVEL} AS level, {_VALUE} AS level_value, year_week, category, brand, manufacturer, is_own_product,
  sum(sales_value_brl) AS bv, sum(sold_volume_kg) AS bq, CAST(sum(units) AS BIGINT) AS bu, coalesce(sum(CASE WHEN dq_status = 'APROVADO_COM_ALERTA' THEN sales_value_brl END), 0) AS ba,
  count(DISTINCT store_id) AS bs FROM fact GROUP BY {_sets('year_week, category, brand, manufacturer, is_own_product')}),
cells AS (SELECT *, sum(bv) OVER c AS cv, sum(bq) OVER c AS cq, sum(ba) OVER c AS ca, dense_rank() OVER (PARTITION BY level, level_value, year_week, category ORDER BY bv DESC) AS rk
  FROM g WINDOW c AS (PARTITION BY level, level_value, year_week, category))"""
_QUALITY = f"""kept AS (SELECT {_LEVEL} AS level, {_VALUE} AS level_value, year_week, count(*) AS n FROM fact GROUP BY {_sets('year_week')}),
lost AS (SELECT {_LEVEL} AS level, {_VALUE} AS level_value, year_week, count(*) AS n_all, count(known) AS n_known
  FROM (SELECT year_week, retailer_name, channel, state, territory_id, s.store_id AS known FROM lines l LEFT JOIN stores s USING (store_id) WHERE removed) GROUP BY {_sets('year_week')}),
lost2 AS (SELECT level, level_value, year_week, CASE WHEN level = 'NACIONAL' THEN n_all ELSE n_known END AS q FROM lost WHERE level = 'NACIONAL' OR n_known > 0),
rows_q AS (SELECT coalesce(k.level, l.level) AS level, coalesce(k.level_value, l.level_value) AS level_value, coalesce(k.year_week, l.year_week) AS year_week, coalesce(q, 0) AS quarantined_rows, coalesce(n, 0) AS consumable_rows
  FROM (SELECT * FROM kept WHERE level_value <> '') k FULL JOIN (SELECT * FROM lost2 WHERE level_value <> '') l ON k.level = l.level AND k.level_value = l.level_value AND k.year_week = l.year_week),
weights AS (SELECT retailer_name, channel, state, territory_id, count(*) AS n FROM stores GROUP BY ALL),
cov AS (SELECT {_LEVEL} AS level, {_VALUE} AS level_value, year_week, CAST((2 * sum(CAST(round(coverage_ratio * 10000) AS BIGINT) * n) + sum(n)) // (2 * sum(n)) AS DOUBLE) / 10000 AS coverage_ratio FROM chain JOIN weights USING (retailer_name) GROUP BY {_sets('year_week')}),
quality AS (SELECT r.*, round(CAST(quarantined_rows AS DOUBLE) / (quarantined_rows + consumable_rows), 4) AS quarantine_row_pct, c.coverage_ratio FROM rows_q r
  LEFT JOIN (SELECT * FROM cov WHERE level_value <> '') c ON c.level = r.level AND c.level_value = r.level_value AND c.year_week = r.year_week)"""
_SHARES = f"""{_BASE}, {_CELLS}, {_QUALITY},
open_weeks AS (SELECT DISTINCT year_week FROM fact WHERE open_row),
s1 AS (SELECT cells.*, q.coverage_ratio, q.quarantine_row_pct, CASE WHEN cv > 0 THEN round(CAST(bv * 100 AS DOUBLE) / CAST(cv * 100 AS DOUBLE), 8) END AS ms_value,
  CASE WHEN cq > 0 THEN round(CAST(bq * 1000 AS DOUBLE) / CAST(cq * 1000 AS DOUBLE), 8) END AS ms_volume, CASE WHEN cv > 0 THEN round(CAST(ca * 100 AS DOUBLE) / CAST(cv * 100 AS DOUBLE), 4) END AS value_alert_pct,
  cells.year_week IN (SELECT year_week FROM open_weeks) AS is_open
  FROM cells LEFT JOIN quality q ON q.level = cells.level AND q.level_value = cells.level_value AND q.year_week = cells.year_week),
s2 AS (SELECT *, CASE WHEN is_open THEN 'NAO_OFICIAL_SEMANA_ABERTA' WHEN coalesce(coverage_ratio, 0) < {MIN_COVERAGE} THEN 'NAO_OFICIAL_COBERTURA'
  WHEN quarantine_row_pct > {MAX_QUARANTINE} THEN 'NAO_OFICIAL_QUARENTENA' WHEN ms_value IS NULL THEN 'SEM_VENDA_NA_CATEGORIA' ELSE 'OFICIAL' END AS ms_status FROM s1),
ms AS (SELECT level, level_value, year_week, category, brand, manufacturer, is_own_product, CAST(bv AS DOUBLE) AS brand_value_brl, CAST(cv AS DOUBLE) AS category_value_brl, ms_value,
  CASE WHEN ms_status = 'OFICIAL' THEN ms_value END AS ms_value_official, CAST(bq AS DOUBLE) AS brand_volume_kg, CAST(cq AS DOUBLE) AS category_volume_kg, ms_volume, bu AS brand_units,
  rk AS ms_rank, bs AS brand_stores, coverage_ratio, quarantine_row_pct, value_alert_pct, ms_status FROM s2)"""


def _stores(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    # some stores are registered under another code: their sales are orphans
    return s.select(F.when(k % 20 == 7, -1 - k).otherwise(k).alias("store_id"), F.col("n_name").alias("retailer_name"), F.col("r_name").alias("channel"),
                    F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("U"), text(k % 4))).alias("state"),
                    F.when(k % 10 != 0, F.concat(F.lit("T"), text(k % 7))).otherwise(NO_TERRITORY).alias("territory_id"))


def _lines(spark, sf_dir):
    number = F.regexp_replace("p_brand", "Brand#", "").cast("int")
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
        F.concat(F.lit("M"), text(number % 5)).alias("manufacturer"), F.when(number % 6 == 0, "Y").otherwise("N").alias("is_own_product"))
    l = table(spark, sf_dir, "lineitem").select(
        "l_partkey", iso_label(F.trunc(F.col("l_shipdate").cast("date"), "week")).alias("year_week"), F.col("l_suppkey").alias("store_id"),
        money("l_extendedprice").alias("sales_value_brl"), F.col("l_quantity").cast("decimal(18,3)").alias("sold_volume_kg"),
        F.col("l_quantity").cast("bigint").alias("units"),
        F.when(F.col("l_discount") >= 0.09, "APROVADO_COM_ALERTA").otherwise("APROVADO").alias("dq_status"),
        ((F.col("l_shipdate") >= F.lit("2001-10-29").cast("timestamp")) & (F.col("l_linenumber") == 1)).alias("week_open_at_ingestion"),
        ((F.col("l_suppkey") % 20 == 7) | (F.col("l_discount") >= 0.10)).alias("removed"))
    return l.join(p, "l_partkey")


def _inputs(spark, sf_dir, stages):
    """Fact, removed rows, stores and chain coverage."""
    stores = stages(_stores(spark, sf_dir), "stores")
    lines = stages(_lines(spark, sf_dir).join(stores, "store_id", "left"), "lines")
    fact = lines.where(~F.col("removed"))
    removed = lines.where("removed").select("year_week", "store_id")
    seen = lines.where(F.col("retailer_name").isNotNull()).groupBy("year_week", "retailer_name", "store_id").agg(F.count("*").alias("_n"))
    seen = seen.groupBy("year_week", "retailer_name").agg(F.count("*").alias("n"))
    size = stores.groupBy("retailer_name").agg(F.count("*").alias("size"))
    chain = seen.join(size, "retailer_name").select("year_week", "retailer_name", F.round(F.col("n") / F.col("size"), 4).alias("coverage_ratio"))
    return fact, removed, stores, stages(chain, "chain")


#: The cut without columns: its cells do not depend on those of the other cuts.
WHOLE_MARKET = {name: columns for name, columns in CUTS.items() if not columns}


def _shares(spark, sf_dir, stages, cuts=CUTS):
    fact, removed, stores, chain = _inputs(spark, sf_dir, stages)
    ms = market_share(fact, removed, stores, chain, cuts, MIN_COVERAGE, MAX_QUARANTINE, NO_TERRITORY, stages)
    return ms, fact, removed


def _cents(column):
    return (F.col(column) * 100).cast("bigint")


# what the gates see of the fact; one of the columns is declared forbidden there
_FACT_COLUMNS = ("year_week", "store_id", "category", "brand", "channel", "sales_value_brl", "dq_status")
_MONEY = ("brand_value_brl", "category_value_brl", "brand_volume_kg", "category_volume_kg")


@query("""
WITH g AS (SELECT strftime(l_shipdate, '%G-%V') AS year_week, p_type AS category, p_brand AS brand, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v, count(DISTINCT c_nationkey) AS nations
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
SELECT year_week, category, brand, CAST(v AS DOUBLE) AS brand_value, CAST(sum(v) OVER w AS DOUBLE) AS category_value, round(CAST(v * 100 AS DOUBLE) / CAST(sum(v) OVER w * 100 AS DOUBLE), 8) AS share,
  dense_rank() OVER (PARTITION BY year_week, category ORDER BY v DESC) AS share_rank, nations FROM g WINDOW w AS (PARTITION BY year_week, category)""")
def share_national(spark, sf_dir):
    """Share of each brand in its category and week, over a five-table star."""
    from pyspark.sql import Window
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category"), F.col("p_brand").alias("brand"))
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey")), "c_nationkey")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    o = o.join(c.select("c_custkey", "c_nationkey"), "c_custkey").select("l_orderkey", "c_nationkey")
    l = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", iso_label(F.trunc(F.col("l_shipdate").cast("date"), "week")).alias("year_week"), money("l_extendedprice").alias("v"))
    g = l.join(p, "l_partkey").join(o, "l_orderkey").groupBy("year_week", "category", "brand").agg(
        F.sum("v").alias("brand_value"), F.countDistinct("c_nationkey").alias("nations"))
    cell = Window.partitionBy("year_week", "category")                         # one row per brand
    g = g.withColumns({"category_value": F.sum("brand_value").over(cell),
                       "share_rank": F.dense_rank().over(cell.orderBy(F.desc("brand_value")))})
    g = g.withColumn("share", F.round(_cents("brand_value") / _cents("category_value"), 8))
    return as_double(g, "brand_value", "category_value")


@query(f"""WITH {_BASE}, {_CELLS}
SELECT level, level_value, year_week, category, brand, CAST(bv AS DOUBLE) AS brand_value_brl, CAST(cv AS DOUBLE) AS category_value_brl, bs AS brand_stores, rk AS ms_rank,
  CASE WHEN cv > 0 THEN round(CAST(bv * 100 AS DOUBLE) / CAST(cv * 100 AS DOUBLE), 8) END AS ms_value FROM cells""")
def share_all_cuts(spark, sf_dir):
    """The same measures at five cuts from one reduction and one expansion."""
    stages = Stages(spark, "cuts")
    fact, *_ = _inputs(spark, sf_dir, stages)
    cells = brand_cells(per_store(fact, CUTS), CUTS)
    return as_double(cells, "brand_value_brl", "category_value_brl").select(
        "level", "level_value", "year_week", "category", "brand", "brand_value_brl", "category_value_brl", "brand_stores", "ms_rank", "ms_value")


@query(f"""WITH {_BASE}, {_QUALITY} SELECT level, level_value, year_week, quarantined_rows, consumable_rows, quarantine_row_pct, coverage_ratio FROM quality""")
def cell_quality(spark, sf_dir):
    """Coverage weighted by stores, and quarantined share, per week and cut (full outer)."""
    stages = Stages(spark, "quality")
    fact, removed, stores, chain = _inputs(spark, sf_dir, stages)
    rows = cell_rows(fact, removed, stores, CUTS)
    return rows.join(cell_coverage(chain, stores, CUTS), ["level", "level_value", "year_week"], "left")


@query(f"""WITH {_SHARES} SELECT * FROM ms""")
def share_with_status(spark, sf_dir):
    """Shares at all cuts with quality, publication status and official value."""
    ms, *_ = _shares(spark, sf_dir, Stages(spark, "shares"))
    return as_double(ms, *_MONEY)


@query(f"""WITH {_SHARES}
SELECT 'GLD_001' AS regra_id, (SELECT count(*) FROM lines) AS avaliados, CAST(0 AS BIGINT) AS falhas, 'APROVADO' AS resultado
UNION ALL SELECT 'GLD_002', (SELECT count(*) FROM fact), 0, 'APROVADO'
UNION ALL SELECT 'GLD_003', count(*), count_if(abs(s - 1) > 1e-4), CASE WHEN count_if(abs(s - 1) > 1e-4) = 0 THEN 'APROVADO' ELSE 'REJEITADO' END
  FROM (SELECT sum(ms_value) AS s FROM ms WHERE ms_value IS NOT NULL GROUP BY level, level_value, year_week, category)
UNION ALL SELECT 'GLD_004', count(*), count_if(ms_status NOT IN ('OFICIAL', 'SEM_VENDA_NA_CATEGORIA')), 'APROVADO_COM_ALERTA' FROM ms
UNION ALL SELECT 'GLD_005', count(*), count_if(c = 'channel'), 'REJEITADO' FROM (SELECT DISTINCT unnest({sorted({*_FACT_COLUMNS, *SHARE_COLUMNS})}) AS c)""")
def publication_gates(spark, sf_dir):
    """G8 (GLD_001-005), P13: conservation of rows and value, sum of shares, official cells, a column that must not be published."""
    stages = Stages(spark, "gates")
    ms, fact, removed = _shares(spark, sf_dir, stages)
    ms = stages(ms, "shares")                    # read by three aggregates
    lines = fact.select("store_id").union(removed.select("store_id"))
    gates = gate_counts(spark, lines, fact, removed, fact.select(*_FACT_COLUMNS), ms, 1e-4, ("contact_name", "channel"))
    return rule_log(gates, default_catalogue(), "run").select("regra_id", "avaliados", "falhas", "resultado")


@query(f"""WITH {_SHARES}
SELECT level AS nivel, level_value AS recorte, year_week AS semana, category AS categoria, brand AS marca, manufacturer AS fabricante, is_own_product AS produto_proprio,
  ms_value_official AS market_share_valor, ms_volume AS market_share_volume, brand_value_brl AS venda_marca_brl, category_value_brl AS venda_categoria_brl, ms_rank AS ranking,
  coverage_ratio AS cobertura, value_alert_pct AS pct_valor_em_alerta FROM ms WHERE ms_status = 'OFICIAL'""")
def official_view(spark, sf_dir):
    """Official cells under business names."""
    ms, *_ = _shares(spark, sf_dir, Stages(spark, "view"))
    return as_double(official_shares(ms), "venda_marca_brl", "venda_categoria_brl")


@query(f"""WITH {_SHARES}
SELECT level AS nivel, level_value AS recorte, year_week AS semana, category AS categoria, round(sum(brand_value_brl), 2) AS venda_propria_brl, max(category_value_brl) AS venda_categoria_brl,
  round(sum(brand_value_brl) / max(category_value_brl), 6) AS share_proprio, CAST(round(sum(CAST(ms_value_official AS DECIMAL(10,8))), 6) AS DOUBLE) AS share_proprio_oficial, max(ms_status) AS status
FROM ms WHERE is_own_product = 'Y' GROUP BY ALL""")
def own_share_view(spark, sf_dir):
    """Share of the own brands per cell."""
    ms, *_ = _shares(spark, sf_dir, Stages(spark, "own"))
    out = own_share(ms)
    return as_double(out, "venda_propria_brl", "venda_categoria_brl", "share_proprio")


@query(f"""WITH {_SHARES}, n AS (SELECT year_week, category, CAST(sum(CAST(ms_value AS DECIMAL(10,8))) * 100000000 AS BIGINT) AS share, max(CASE WHEN ms_status <> 'OFICIAL' THEN 1 ELSE 0 END) AS unofficial FROM ms
  WHERE level = 'NACIONAL' AND is_own_product = 'Y' GROUP BY ALL),
o AS (SELECT *, CASE WHEN unofficial = 0 THEN share END AS official FROM n)
SELECT year_week, category, CAST((share + 50) // 100 AS DOUBLE) / 1000000 AS share, CAST(unofficial AS INTEGER) AS unofficial,
  CASE WHEN count(official) OVER w >= 3 THEN CAST((2 * sum(official) OVER w + 100 * count(official) OVER w) // (200 * count(official) OVER w) AS DOUBLE) / 1000000 END AS moving_mean FROM o WINDOW w AS (PARTITION BY category ORDER BY year_week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""")
def own_share_moving_mean(spark, sf_dir):
    """Own share and its mean over the last four official weeks, needing three."""
    ms, *_ = _shares(spark, sf_dir, Stages(spark, "series"), WHOLE_MARKET)
    s = own_share_series(ms)
    return s.withColumns({c: F.round(c, 6).cast("double") for c in ("share", "moving_mean")})


_STATUSES = [OFFICIAL, LOW_COVERAGE, HIGH_QUARANTINE, OPEN_WEEK, NO_SALE]
_PIVOT = ", ".join(f"round(100.0 * count_if(ms_status = '{s}') / count(*), 4) AS {s}" for s in _STATUSES)


@query(f"""WITH {_SHARES} SELECT level, {_PIVOT} FROM ms GROUP BY level""")
def status_by_level(spark, sf_dir):
    """Percentage of each status per cut (pivot)."""
    ms, *_ = _shares(spark, sf_dir, Stages(spark, "status"))
    return status_mix(ms, _STATUSES)


@query(f"""WITH {_SHARES}
SELECT f.store_id, f.brand, f.year_week, CAST(f.sales_value_brl AS DOUBLE) AS sales_value_brl FROM fact f
WHERE year_week = (SELECT max(year_week) FROM ms WHERE level = 'NACIONAL' AND ms_status = 'OFICIAL')
ORDER BY store_id, brand, f.sales_value_brl LIMIT 500""")
def last_official_facts(spark, sf_dir):
    """Sample of the last official week (a top-k report)."""
    ms, fact, _ = _shares(spark, sf_dir, Stages(spark, "sample"), WHOLE_MARKET)
    rows = fact.withColumn("ean", F.struct("brand", "sales_value_brl")).withColumn("dq_flags", F.lit(None))
    out = fact_sample(rows.select("store_id", "brand", "year_week", "sales_value_brl", "ean", "dq_flags"), ms)
    return as_double(out.drop("ean"), "sales_value_brl")


@query(f"""WITH {_BASE}
SELECT CASE WHEN store_id % 20 = 7 THEN 'FCT_004' ELSE 'FCT_008' END AS regra_id, count(*) AS n_rows, CAST(sum(sales_value_brl) AS DOUBLE) AS retained FROM lines WHERE removed GROUP BY 1""")
def retained_values(spark, sf_dir):
    """Rows and value held back per rule."""
    lines = _lines(spark, sf_dir).where("removed").select(
        F.lit("fato_vendas").alias("alvo"), F.when(F.col("store_id") % 20 == 7, "FCT_004").otherwise("FCT_008").alias("regra_id"),
        F.col("sales_value_brl").alias("valor_brl"))
    return as_double(retained_value(lines, "fato_vendas"), "retained")
