"""Dimension conforming over part, customer and supplier: text, references, survivors, codes, coordinates."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import blank, digits, inside_box, normalise, suggest_code, unmaskable
from ..operators.conform import base_unit_size, conflict, fillable, mapping_frame, named_in
from ..operators.geo import follows_group, geo_status, group_dispersion
from ..operators.keyed import alias_lists, alias_pieces, aliases, attach, survivors
from ..operators.reference import approved, dominant_reference, entities_without, lookup, missing_from
from ..session import Stages
from ..settings import COUNTRY_BOX, STATES
from .registry import money, padded, query, table, text

B = COUNTRY_BOX


@query("""
SELECT p_partkey, upper(trim(regexp_replace('  ' || p_name || '   ' || lower(p_brand) || ' ', '\\s+', ' ', 'g'))) AS normal,
       TRUE AS differs FROM part""")
def normal_text(spark, sf_dir):
    """Single spaces, trimmed, upper case."""
    raw = F.concat(F.lit("  "), F.col("p_name"), F.lit("   "), F.lower("p_brand"), F.lit(" "))
    p = table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"))
    return p.select("p_partkey", normalise("raw").alias("normal"), (F.col("raw") != normalise("raw")).alias("differs"))


@query("""
SELECT CASE p_type WHEN 'ECONOMY' THEN 'STANDARD' WHEN 'PROMO' THEN 'SPECIAL' ELSE p_type END AS category,
       count(*) AS n_rows, count_if(p_type IN ('ECONOMY', 'PROMO')) AS corrected FROM part GROUP BY 1""")
def synonyms(spark, sf_dir):
    """Configured spellings as a relation, joined instead of a map literal."""
    names = mapping_frame(spark, {"ECONOMY": "STANDARD", "PROMO": "SPECIAL"}, "p_type", "official")
    p = table(spark, sf_dir, "part").select("p_type").join(F.broadcast(names), "p_type", "left")
    return p.groupBy(F.coalesce("official", "p_type").alias("category")).agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("official").isNotNull()).alias("corrected"))


@query("""
WITH c AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY source) AS t, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) AS k FROM c)
SELECT source, lang AS expected, n AS confirming, CAST(t AS BIGINT) AS total, round(n / t, 4) AS evidence,
       CASE WHEN round(n / t, 4) >= 0.6 THEN 'APROVADO' ELSE 'REVISAR' END AS status FROM r WHERE k = 1""")
def derived_reference(spark, sf_dir):
    """Dominant language per source with its evidence."""
    d = table(spark, sf_dir, "documents").select("source", "lang")
    return dominant_reference(d, "source", "lang", 0.6)


_PRODUCTS = """p AS (
  SELECT p_partkey, p_brand AS subcategory, CASE WHEN p_size % 10 = 0 THEN '' ELSE p_type END AS category,
         p_name || CASE WHEN p_size % 3 = 0 THEN ' ' || p_brand ELSE '' END AS description FROM part),
c AS (SELECT subcategory, category, count(*) AS n FROM p WHERE category <> '' GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY subcategory) AS t,
             row_number() OVER (PARTITION BY subcategory ORDER BY n DESC, category) AS k FROM c),
e AS (SELECT subcategory, category AS expected FROM r WHERE k = 1 AND round(n / t, 4) >= 0.2)"""


@query(f"""WITH {_PRODUCTS}
SELECT p_partkey, CASE WHEN category = '' AND expected IS NOT NULL THEN 'filled'
       WHEN category <> expected AND contains(description, subcategory) THEN 'corrected'
       WHEN category <> expected THEN 'conflict' ELSE 'kept' END AS action,
       CASE WHEN expected IS NOT NULL AND (category = '' OR (category <> expected AND contains(description, subcategory)))
            THEN expected ELSE category END AS category
FROM p LEFT JOIN e USING (subcategory)""")
def reference_fixes(spark, sf_dir):
    """Blanks filled from the derived reference, conflicts fixed only with evidence in the text."""
    stages = Stages(spark, "fixes")
    p = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_brand").alias("subcategory"),
        F.when(F.col("p_size") % 10 == 0, "").otherwise(F.col("p_type")).alias("category"),
        F.concat("p_name", F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(" "), "p_brand")).otherwise("")).alias("description"))
    ref = stages(dominant_reference(p, "subcategory", "category", 0.2, F.col("category") != ""), "reference")
    p = attach(p, approved(ref, "subcategory"), ["subcategory"])
    fill = fillable("category", "expected")
    fix = conflict("category", "expected") & named_in("description", "subcategory")
    action = F.when(fill, "filled").when(fix, "corrected").when(conflict("category", "expected"), "conflict").otherwise("kept")
    return p.select("p_partkey", action.alias("action"),
                    F.when(fill | fix, F.col("expected")).otherwise(F.col("category")).alias("category"))


_SURV = """s AS (
  SELECT p_partkey, p_brand, p_name, p_size, row_number() OVER w AS k, first_value(p_partkey) OVER w AS survivor
  FROM part WINDOW w AS (PARTITION BY p_brand, p_name ORDER BY (p_size % 2 = 0) DESC, (p_type = 'PROMO') DESC, p_partkey
                         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""


def _survivors(spark, sf_dir, stages):
    p = table(spark, sf_dir, "part")
    rank = [-(F.col("p_size") % 2 == 0).cast("int"), -(F.col("p_type") == "PROMO").cast("int")]
    return survivors(p, ["p_brand", "p_name"], rank, "p_partkey", stages)


@query(f"""WITH {_SURV}
SELECT p_partkey, survivor, CASE WHEN p_partkey = survivor THEN 'kept' ELSE 'REJEITADO' END AS outcome FROM s""")
def survivor_dedup(spark, sf_dir):
    """Best row per key by evidence; losers know their survivor."""
    s = _survivors(spark, sf_dir, Stages(spark, "survivors"))
    kept = F.when(F.col("p_partkey") == F.col("survivor"), "kept").otherwise("REJEITADO")
    return s.select("p_partkey", "survivor", kept.alias("outcome"))


@query(f"""WITH {_SURV}
SELECT p_brand, p_name, survivor, count(*) AS n_aliases, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_partkey) AS alias_ids
FROM s WHERE p_partkey <> survivor GROUP BY ALL""")
def alias_list(spark, sf_dir):
    """Sorted list of the lost identifiers of a key (one row each in alias_rows)."""
    stages = Stages(spark, "aliases")
    rows = stages(aliases(_survivors(spark, sf_dir, stages), ["p_brand", "p_name"], "p_partkey", "survivor"), "aliases")
    out = alias_lists(rows, ["p_brand", "p_name"])
    return out.withColumn("alias_ids", F.array_join(F.transform("alias_ids", lambda x: x.cast("string")), ","))


@query(f"""WITH {_SURV},
a AS (SELECT p_brand, survivor, p_partkey FROM s WHERE p_partkey <> survivor),
n AS (SELECT *, row_number() OVER (PARTITION BY p_brand, head ORDER BY p_partkey) - 1 AS place, count(*) OVER (PARTITION BY p_brand, head) AS n
      FROM (SELECT *, min(survivor) OVER (PARTITION BY p_brand) AS head FROM a))
SELECT p_brand, head AS survivor, n AS n_aliases, place // 5 AS piece, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_partkey) AS alias_ids
FROM n GROUP BY ALL""")
def alias_list_pieces(spark, sf_dir):
    """All lost identifiers of a brand under its first survivor, in numbered lists of five."""
    stages = Stages(spark, "aliases")
    lost = stages(aliases(_survivors(spark, sf_dir, stages), ["p_brand"], "p_partkey", "survivor"), "aliases")
    first = stages(lost.groupBy("p_brand").agg(F.min("survivor").alias("head")), "first")
    rows = attach(lost, first, ["p_brand"]).select("p_brand", F.col("head").alias("survivor"), "alias")
    out = alias_pieces(rows, ["p_brand"], stages, size=5)
    return out.withColumn("alias_ids", F.array_join(F.transform("alias_ids", lambda x: x.cast("string")), ","))


@query(f"""WITH {_SURV} SELECT p_brand, p_name, survivor, p_partkey AS alias FROM s WHERE p_partkey <> survivor""")
def alias_rows(spark, sf_dir):
    """One row per lost identifier."""
    stages = Stages(spark, "aliases")
    return aliases(_survivors(spark, sf_dir, stages), ["p_brand", "p_name"], "p_partkey", "survivor")


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'EAN-' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') ELSE lpad(CAST(p_partkey AS VARCHAR), 13, '7') END AS code,
       p_partkey % 7 = 0 AS malformed,
       CASE WHEN p_partkey % 7 = 0 THEN '7891000' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') END AS suggestion,
       round(CASE WHEN p_size % 2 = 0 THEN p_size * 0.001 ELSE p_size END, 6) AS size_kg_l FROM part""")
def code_suggestions(spark, sf_dir):
    """Malformed codes get a suggestion, never a change; package size in base units."""
    k = F.col("p_partkey")
    code = F.when(k % 7 == 0, F.concat(F.lit("EAN-"), F.lpad(text(k), 8, "0"))).otherwise(F.lpad(text(k), 13, "7"))
    p = table(spark, sf_dir, "part").select(
        "p_partkey", code.alias("code"), padded("P", k, 6).alias("product_id"), "p_size",
        F.when(F.col("p_size") % 2 == 0, "G").otherwise("KG").alias("unit"))
    bad = ~F.col("code").rlike(r"^\d{13}$")
    return p.select("p_partkey", "code", bad.alias("malformed"), F.when(bad, suggest_code("product_id")).alias("suggestion"),
                    base_unit_size("p_size", "unit").alias("size_kg_l"))


@query("""
WITH t AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '12.345.678/' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || '-90'
                                  WHEN c_custkey % 3 = 1 THEN lpad(CAST(c_custkey AS VARCHAR), 14, '1') ELSE '12-' || c_custkey END AS tax_id FROM customer)
SELECT c_custkey, tax_id AS tax_id_raw, CASE WHEN c_custkey % 3 = 0 THEN regexp_replace(tax_id, '[^0-9]', '', 'g') ELSE tax_id END AS tax_id FROM t""")
def strip_mask(spark, sf_dir):
    """A mask is removed only if exactly the right number of digits remains."""
    k = F.col("c_custkey")
    masked = F.concat(F.lit("12.345.678/"), F.lpad(text(k % 10000), 4, "0"), F.lit("-90"))
    raw = F.when(k % 3 == 0, masked).when(k % 3 == 1, F.lpad(text(k), 14, "1")).otherwise(F.concat(F.lit("12-"), text(k)))
    c = table(spark, sf_dir, "customer").select("c_custkey", raw.alias("tax_id_raw"))
    fix = unmaskable("tax_id_raw", 14)
    return c.withColumn("tax_id", F.when(fix, digits("tax_id_raw")).otherwise(F.col("tax_id_raw")))


@query("""
SELECT c_nationkey, count(*) AS n_rows, count_if(c_mktsegment = 'BUILDING') AS in_domain,
       count_if(c_custkey % 11 = 0 OR c_custkey % 13 = 0) AS blanks
FROM customer GROUP BY 1""")
def domain_and_blanks(spark, sf_dir):
    """Domain membership and blank tests (NULL and spaces alike)."""
    k = F.col("c_custkey")
    note = F.when(k % 11 == 0, F.lit(None)).when(k % 13 == 0, "   ").otherwise("x")
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment", note.alias("note"))
    return c.groupBy("c_nationkey").agg(F.count("*").alias("n_rows"), F.count_if(F.col("c_mktsegment").isin("BUILDING")).alias("in_domain"),
                                        F.count_if(blank("note")).alias("blanks"))


_STATES = "[" + ",".join(f"'{s}'" for s in STATES) + "]"
_CITY = f"""c AS (SELECT c_custkey, c_nationkey AS city, CASE WHEN c_acctbal < 0 THEN 'XX' WHEN c_custkey % 9 = 0 THEN list_extract({_STATES}, 1)
                     ELSE list_extract({_STATES}, c_nationkey + 1) END AS state FROM customer),
n AS (SELECT city, state, count(*) AS n FROM c WHERE state <> 'XX' GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY city) AS t, row_number() OVER (PARTITION BY city ORDER BY n DESC, state) AS k FROM n),
e AS (SELECT city, state AS expected FROM r WHERE k = 1 AND round(n / t, 4) >= 0.85)"""


@query(f"""WITH {_CITY}
SELECT city, count(*) AS n_rows, count_if(coalesce(state <> expected, FALSE)) AS corrected, max(expected) AS expected
FROM c LEFT JOIN e USING (city) GROUP BY city""")
def state_from_city(spark, sf_dir):
    """C3, P6 (LOJ_002): state corrected to the dominant valid state of its city, where evidence is strong enough."""
    stages = Stages(spark, "cities")
    names = F.array(*[F.lit(s) for s in STATES])
    c = table(spark, sf_dir, "customer")
    state = F.when(F.col("c_acctbal") < 0, "XX").when(F.col("c_custkey") % 9 == 0, STATES[0]).otherwise(
        F.element_at(names, F.col("c_nationkey") + 1))
    c = c.select(F.col("c_nationkey").alias("city"), state.alias("state"))
    ref = stages(dominant_reference(c, "city", "state", 0.85, F.col("state").isin(*STATES)), "reference")
    c = attach(c, approved(ref, "city"), ["city"])
    return c.groupBy("city").agg(F.count("*").alias("n_rows"), F.count_if(conflict("state", "expected")).alias("corrected"),
                                 F.max("expected").alias("expected"))


_GEO = """g AS (SELECT c_nationkey AS city, CAST(c_acctbal AS DOUBLE) / 250 AS lat, -(c_custkey % 100) * 1.0 AS lon FROM customer)"""
_IN = f"lat BETWEEN {B['south']} AND {B['north']} AND lon BETWEEN {B['west']} AND {B['east']}"
_SWAP = f"lon BETWEEN {B['south']} AND {B['north']} AND lat BETWEEN {B['west']} AND {B['east']}"


def _geo(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("city"), (F.col("c_acctbal") / 250).alias("lat"), (-(F.col("c_custkey") % 100) * 1.0).cast("double").alias("lon"))


@query(f"""WITH {_GEO}
SELECT CASE WHEN NOT ({_IN}) AND ({_SWAP}) THEN 'REVALIDAR_INVERSAO' WHEN NOT ({_IN}) THEN 'REVALIDAR' ELSE 'NAO_VALIDADA' END AS geo_status,
       count(*) AS n_rows FROM g GROUP BY 1""")
def geo_labels(spark, sf_dir):
    """Coordinate labels; nothing is corrected."""
    return _geo(spark, sf_dir).groupBy(geo_status(F.col("lat"), F.col("lon"), dict(B)).alias("geo_status")).agg(
        F.count("*").alias("n_rows"))


@query(f"""WITH {_GEO}, i AS (SELECT * FROM g WHERE {_IN}),
p AS (SELECT city, avg(lat) AS a, avg(lon) AS o, stddev(lat) AS s, count(*) AS n FROM i GROUP BY city),
d AS (SELECT max(a) - min(a) AS lat_range, max(o) - min(o) AS lon_range, avg(s) AS lat_within, CAST(sum(n) AS BIGINT) AS evaluated FROM p)
SELECT round(lat_range, 6) AS lat_range, round(lon_range, 6) AS lon_range, round(lat_within, 6) AS lat_within,
       (SELECT round(corr(lat, lon), 6) FROM i) AS correlation, evaluated,
       CASE WHEN lat_within > 0 AND lat_range < lat_within THEN evaluated ELSE 0 END AS failed FROM d""")
def geo_consistency(spark, sf_dir):
    """Do coordinates follow the city? Range of city means against the spread inside a city."""
    g = _geo(spark, sf_dir).where(inside_box("lat", "lon", dict(B)))
    out = follows_group(group_dispersion(g, "city", "lat", "lon"))
    return out.select(*[F.round(c, 6).alias(c) for c in ("lat_range", "lon_range", "lat_within", "correlation")], "evaluated", "failed")


@query("""
SELECT p_brand, round(stddev(p_retailprice), 4) AS sd, round(stddev_pop(p_retailprice), 4) AS sd_pop,
       round(covar_pop(p_retailprice, p_size), 4) AS covariance, round(corr(p_retailprice, p_size), 6) AS correlation FROM part GROUP BY 1""")
def dispersion_measures(spark, sf_dir):
    """Deviation, covariance and correlation; a constant column gives NULL, not an error."""
    x, y = F.col("p_retailprice"), F.col("p_size")
    corr = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.round(F.stddev(x), 4).alias("sd"), F.round(F.stddev_pop(x), 4).alias("sd_pop"),
        F.round(F.covar_pop(x, y), 4).alias("covariance"), F.round(corr, 6).alias("correlation"))


@query("""
SELECT source, count(*) AS n_rows, count(l.doc_id) AS labelled, count_if(l.doc_id IS NULL) AS orphans
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source""")
def orphan_lookup(spark, sf_dir):
    """Left lookup with a presence marker; rows without a partner are orphans."""
    stages = Stages(spark, "orphans")
    labels = stages(table(spark, sf_dir, "labels").select("doc_id").distinct(), "labels")   # staged: size known
    d = lookup(table(spark, sf_dir, "documents").select("doc_id", "source"), labels, ["doc_id"], "_found")
    return d.groupBy("source").agg(F.count("*").alias("n_rows"), F.count_if(F.col("_found")).alias("labelled"),
                                   F.count_if(F.col("_found").isNull()).alias("orphans"))


@query("""
SELECT l_returnflag, count(*) AS n_rows, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM lineitem WHERE l_suppkey NOT IN (SELECT CASE WHEN s_acctbal >= 0 THEN s_suppkey ELSE -1 - s_suppkey END FROM supplier) GROUP BY 1""")
def missing_dimension_rows(spark, sf_dir):
    """Fact rows whose supplier is registered under another key."""
    s = table(spark, sf_dir, "supplier").select(
        F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey")).otherwise(-1 - F.col("s_suppkey")).alias("l_suppkey"))
    rows = missing_from(table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_extendedprice"), s, ["l_suppkey"])
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n_rows"), F.sum(money("l_extendedprice")).cast("double").alias("value"))


@query("""
SELECT (SELECT count(*) FROM customer) AS evaluated,
       (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) AS failed""")
def customers_without_orders(spark, sf_dir):
    """Entities of a dimension that never occur in the history."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return entities_without(c, o, ["c_custkey"])


@query(f"""WITH {_CITY}, f AS (SELECT c_custkey, city, state AS state_raw, coalesce(expected, state) AS state, state <> expected AS bad_state, c_custkey % 17 = 0 AS no_seller
                               FROM c LEFT JOIN e USING (city))
SELECT c_custkey AS store_id, city, 'LOJ_002' AS regra_id, state_raw AS valor_origem, state AS valor_silver FROM f WHERE bad_state
UNION ALL SELECT c_custkey, city, 'LOJ_007', '<vazio>', '<vazio>' FROM f WHERE no_seller""")
def store_work_queue(spark, sf_dir):
    """One row per store and open finding, with the value before and after."""
    from ..catalogue import default_catalogue
    from ..operators.rules import RuleFlow
    from ..plans.views import store_queue
    stages = Stages(spark, "stores")
    names = F.array(*[F.lit(s) for s in STATES])
    c = table(spark, sf_dir, "customer")
    state = F.when(F.col("c_acctbal") < 0, "XX").when(F.col("c_custkey") % 9 == 0, STATES[0]).otherwise(
        F.element_at(names, F.col("c_nationkey") + 1))
    stores = c.select(F.col("c_custkey").alias("store_id"), F.col("c_nationkey").alias("city"), state.alias("state"),
                      F.when(F.col("c_custkey") % 17 == 0, "").otherwise("V").alias("seller_id"),
                      F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude"), F.lit("NAO_VALIDADA").alias("geo_status"))
    ref = stages(dominant_reference(stores, "city", "state", 0.85, F.col("state").isin(*STATES)), "reference")
    flow = RuleFlow(attach(stores, approved(ref, "city"), ["city"]), default_catalogue(), "dim_loja", ["store_id"])
    flow.correct("LOJ_002", conflict("state", "expected"), {"state": F.col("expected")}).check("LOJ_007", blank("seller_id"))
    return store_queue(flow.survivors()).select("store_id", "city", "regra_id", "valor_origem", "valor_silver")
