"""Rule algebra over customers and suppliers seen as one harmonised account table."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..catalogue import default_catalogue
from ..functions import blank, normalise
from ..operators.audit import flag_distribution, guarantees, log_vs_quarantine, log_vs_trail, record_history
from ..operators.conform import harmonise
from ..operators.keyed import one_row, sample_rows
from ..operators.rules import RuleFlow, consumable, record
from ..plans.views import quarantine_queue
from ..session import Stages
from .registry import money, query, table, text

SPECS = {
    "C": {"table": "customer", "required": {"id": "c_custkey", "name": "c_name", "nation": "c_nationkey",
                                            "balance": "c_acctbal"},
          "optional": {"segment": "c_mktsegment"}},
    "S": {"table": "supplier", "required": {"id": "s_suppkey", "name": "s_name", "nation": "s_nationkey",
                                            "balance": "s_acctbal"}},
}

_ACCOUNTS = """accounts AS (
  SELECT 'C' AS provider, c_custkey AS id, c_name AS name, c_nationkey AS nation, CAST(c_acctbal AS DECIMAL(18,2)) AS balance,
         c_mktsegment AS segment FROM customer
  UNION ALL SELECT 'S', s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(18,2)), NULL FROM supplier),
flow AS (
  SELECT *, upper(name) AS fixed_name, segment IS NULL AS f_blank,
         balance < 0 AND balance >= -500 AS f_flip, balance < -500 AS f_negative,
         provider = 'C' AS e_cust, provider = 'C' AND (abs(balance) > 9000) AND NOT balance < -500 AS f_event
  FROM accounts)"""


def _accounts(spark, sf_dir):
    frames = {n: table(spark, sf_dir, n) for n in ("customer", "supplier")}
    return harmonise(frames, SPECS).withColumn("balance", money("balance"))


def _flow(spark, sf_dir) -> RuleFlow:
    """Normal names (corrected), blank segments (flagged), small negatives (sign corrected), large ones (removed),
    large balances of customers only (flagged, evaluated on a subset)."""
    flow = RuleFlow(_accounts(spark, sf_dir), default_catalogue(), "accounts", ["provider", "id"], value="balance")
    flow.correct("PRD_004", F.col("name") != normalise("name"), {"name": normalise("name")})
    flow.check("LOJ_006", blank("segment"))
    small = (F.col("balance") < 0) & (F.col("balance") >= -500)
    flow.correct("FCT_007", small, {"balance": F.abs("balance")})
    flow.quarantine("FCT_008", F.col("balance") < 0, reason=F.concat(F.lit("balance "), text("balance")))
    flow.check("FCT_011", F.abs("balance") > 9000, evaluated=F.col("provider") == "C")
    return flow


@query(f"""WITH {_ACCOUNTS}
SELECT provider, id, name, nation, CAST(balance AS DOUBLE) AS balance, segment FROM accounts""")
def harmonise_union(spark, sf_dir):
    """Two sources renamed to one schema and united by name."""
    return _accounts(spark, sf_dir).withColumn("balance", F.col("balance").cast("double"))


@query(f"""WITH {_ACCOUNTS}
SELECT provider, id, fixed_name AS name, name AS name_raw,
       CAST(CASE WHEN f_flip THEN abs(balance) ELSE balance END AS DOUBLE) AS balance, CAST(balance AS DOUBLE) AS balance_raw,
       concat_ws(',', CASE WHEN name <> fixed_name THEN 'PRD_004' END, CASE WHEN f_blank THEN 'LOJ_006' END,
                 CASE WHEN f_flip THEN 'FCT_007' END, CASE WHEN f_event THEN 'FCT_011' END) AS flags,
       CASE WHEN f_blank OR f_event THEN 'APROVADO_COM_ALERTA'
            WHEN name <> fixed_name OR f_flip THEN 'CORRIGIDO_AUTOMATICAMENTE' ELSE 'APROVADO' END AS status
FROM flow WHERE NOT f_negative""")
def accounts_survivors(spark, sf_dir):
    """Q1, Q2, Q5-Q7, Q9: flags in rule order, originals, status by precedence."""
    rows = _flow(spark, sf_dir).survivors()
    return rows.select("provider", "id", "name", "name_raw", F.col("balance").cast("double").alias("balance"),
                       F.col("balance_raw").cast("double").alias("balance_raw"),
                       F.array_join("dq_flags", ",").alias("flags"), F.col("dq_status").alias("status"))


@query(f"""WITH {_ACCOUNTS}
SELECT 'QUARENTENA' AS classificacao, 'FCT_008' AS regra_id, 'ALTA' AS severidade, 'VALIDADE' AS dimensao,
       'accounts' AS alvo, '{{"provider":"' || provider || '","id":' || id || '}}' AS chave,
       'balance ' || CAST(balance AS VARCHAR) AS motivo, CAST(balance AS DOUBLE) AS valor_brl,
       fixed_name AS payload_name, name AS payload_original
FROM flow WHERE f_negative""")
def accounts_quarantine(spark, sf_dir):
    """Q3: removed rows with key, reason, value, and payload as it was at removal."""
    q = _flow(spark, sf_dir).quarantined()
    return q.select("classificacao", "regra_id", "severidade", "dimensao", "alvo", "chave", "motivo", "valor_brl",
                    F.get_json_object("payload", "$.name").alias("payload_name"),
                    F.get_json_object("payload", "$.name_raw").alias("payload_original"))


@query(f"""WITH {_ACCOUNTS}
SELECT 'PRD_004' AS regra_id, provider, CAST(id AS VARCHAR) AS id, 'name' AS coluna, name AS valor_antes, fixed_name AS valor_depois
FROM flow WHERE name <> fixed_name
UNION ALL
SELECT 'FCT_007', provider, CAST(id AS VARCHAR), 'balance', CAST(balance AS VARCHAR), CAST(abs(balance) AS VARCHAR) FROM flow WHERE f_flip""")
def accounts_trail(spark, sf_dir):
    """Q2, V8: before/after entries of every correction, also of rows removed later."""
    t = _flow(spark, sf_dir).corrections()
    return t.select("regra_id", F.get_json_object("chave", "$.provider").alias("provider"),
                    F.get_json_object("chave", "$.id").alias("id"), "coluna", "valor_antes", "valor_depois")


_LOG = f"""{_ACCOUNTS}, counts AS (
  SELECT 'PRD_004' AS regra_id, count(*) AS avaliados, count_if(name <> fixed_name) AS falhas,
         sum(CASE WHEN name <> fixed_name THEN abs(balance) END) AS v, 'CORRIGIDO_AUTOMATICAMENTE' AS o FROM flow
  UNION ALL SELECT 'LOJ_006', count(*), count_if(f_blank), sum(CASE WHEN f_blank THEN abs(balance) END), 'APROVADO_COM_ALERTA' FROM flow
  UNION ALL SELECT 'FCT_007', count(*), count_if(f_flip), sum(CASE WHEN f_flip THEN abs(balance) END), 'CORRIGIDO_AUTOMATICAMENTE' FROM flow
  UNION ALL SELECT 'FCT_008', count(*), count_if(f_negative), sum(CASE WHEN f_negative THEN abs(balance) END), 'QUARENTENA' FROM flow
  UNION ALL SELECT 'FCT_011', count_if(e_cust AND NOT f_negative), count_if(f_event), sum(CASE WHEN f_event THEN abs(balance) END),
                   'APROVADO_COM_ALERTA' FROM flow)"""


@query(f"""WITH {_LOG}
SELECT regra_id, avaliados, falhas, round(falhas / avaliados, 6) AS pct_falha, CAST(v AS DOUBLE) AS valor_impactado_brl,
       CASE WHEN falhas = 0 THEN 'APROVADO' ELSE o END AS resultado
FROM counts""")
def accounts_rule_log(spark, sf_dir):
    """Q8, Q10, Q11: evaluated, failed, share and value of every rule from one aggregate."""
    return _flow(spark, sf_dir).log().select("regra_id", "avaliados", "falhas", "pct_falha", "valor_impactado_brl", "resultado")


@query(f"""WITH {_ACCOUNTS}
SELECT 'TER_003' AS regra_id, (SELECT count(*) FROM nation) AS avaliados,
       (SELECT count(*) FROM nation WHERE n_nationkey NOT IN (SELECT nation FROM flow WHERE f_negative)) AS falhas""")
def dataset_rule(spark, sf_dir):
    """A dataset rule from a one-row relation (nations without any removed account)."""
    removed = _flow(spark, sf_dir).quarantined().select(
        F.get_json_object("payload", "$.nation").cast("int").alias("n_nationkey")).distinct()
    nations = table(spark, sf_dir, "nation").select("n_nationkey")
    counts = nations.join(removed.withColumn("_hit", F.lit(True)), "n_nationkey", "left").agg(
        F.count("*").alias("evaluated"), F.count_if(F.col("_hit").isNull()).alias("failed"))
    return record("TER_003", "accounts", counts).select("regra_id", "avaliados", "falhas")


@query(f"""WITH {_ACCOUNTS}
SELECT provider, count(*) AS n_rows, CAST(sum(CASE WHEN f_flip THEN abs(balance) ELSE balance END) AS DOUBLE) AS balance
FROM flow WHERE NOT f_negative GROUP BY provider""")
def consumable_accounts(spark, sf_dir):
    """Q12: rows that go on to consumption."""
    rows = consumable(_flow(spark, sf_dir).survivors())
    return rows.groupBy("provider").agg(F.count("*").alias("n_rows"), F.sum("balance").cast("double").alias("balance"))


@query(f"""WITH {_ACCOUNTS}
SELECT f AS flag, provider, count(*) AS n_rows, CAST(sum(v) AS DOUBLE) AS value FROM (
  SELECT provider, CASE WHEN f_flip THEN abs(balance) ELSE balance END AS v, unnest(list_filter([CASE WHEN name <> fixed_name THEN 'PRD_004' END,
         CASE WHEN f_blank THEN 'LOJ_006' END, CASE WHEN f_flip THEN 'FCT_007' END, CASE WHEN f_event THEN 'FCT_011' END],
         lambda x: x IS NOT NULL)) AS f
  FROM flow WHERE NOT f_negative) GROUP BY ALL""")
def flag_mix(spark, sf_dir):
    """Rows and value per flag and provider."""
    out = flag_distribution(_flow(spark, sf_dir).survivors(), ["provider"], "balance")
    return out.withColumn("value", F.col("value").cast("double"))


@query(f"""WITH {_ACCOUNTS}
SELECT nation, count(*) AS n_rows, count_if(f_flip) AS flipped, count_if(f_flip OR f_event) AS overlap,
       count_if(name = fixed_name AND NOT f_blank AND NOT f_flip AND NOT f_event) AS clean
FROM flow WHERE NOT f_negative GROUP BY nation""")
def flag_predicates(spark, sf_dir):
    """Contains, overlap and emptiness tests on the flags."""
    rows = _flow(spark, sf_dir).survivors()
    wanted = F.array(F.lit("FCT_007"), F.lit("FCT_011"))
    return rows.groupBy("nation").agg(
        F.count("*").alias("n_rows"), F.count_if(F.array_contains("dq_flags", "FCT_007")).alias("flipped"),
        F.count_if(F.arrays_overlap("dq_flags", wanted)).alias("overlap"),
        F.count_if(F.size("dq_flags") == 0).alias("clean"))


@query(f"""WITH {_LOG}
SELECT 'trail' AS against, regra_id, falhas AS logged, falhas AS recorded, CAST(0 AS BIGINT) AS difference FROM counts
WHERE falhas > 0 AND o = 'CORRIGIDO_AUTOMATICAMENTE'
UNION ALL SELECT 'quarantine', regra_id, falhas, falhas, 0 FROM counts WHERE falhas > 0 AND o = 'QUARENTENA'""")
def log_against_outputs(spark, sf_dir):
    """The log agrees with the trail and with the quarantine, rule by rule."""
    flow = _flow(spark, sf_dir).stage(Stages(spark, "accounts"), "rows")
    log = flow.log()
    trail = log_vs_trail(log, flow.corrections()).withColumn("against", F.lit("trail"))
    rows = log_vs_quarantine(log, flow.quarantined()).withColumn("against", F.lit("quarantine"))
    return trail.unionByName(rows).drop("alvo")


@query(f"""WITH {_ACCOUNTS}
SELECT regra_id, classificacao, provider, count(*) AS linhas, CAST(sum(abs(balance)) AS DOUBLE) AS valor_retido_brl,
       min('balance ' || CAST(balance AS VARCHAR)) AS exemplo_motivo, 'FORNECEDOR' AS responsavel
FROM (SELECT *, 'FCT_008' AS regra_id, 'QUARENTENA' AS classificacao FROM flow WHERE f_negative) GROUP BY ALL""")
def quarantine_work_queue(spark, sf_dir):
    """Removed rows per rule and provider with action and owner."""
    q = quarantine_queue(_flow(spark, sf_dir).quarantined(), "accounts", ("provider",))
    return q.select("regra_id", "classificacao", "provider", "linhas",
                    F.col("valor_retido_brl").cast("double").alias("valor_retido_brl"), "exemplo_motivo", "responsavel")


@query(f"""WITH {_ACCOUNTS}, n AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY balance, provider, id) AS k FROM flow WHERE f_negative)
SELECT nation, provider, id, CAST(balance AS DOUBLE) AS balance FROM n WHERE k <= 5""")
def quarantine_samples(spark, sf_dir):
    """First five removed rows per group."""
    q = _flow(spark, sf_dir).quarantined().select(
        F.from_json("payload", "provider string, id bigint, nation int, balance decimal(18,2)").alias("p")).select("p.*")
    out = sample_rows(q, ["nation"], [F.col("balance"), F.col("provider"), F.col("id")], 5)
    return out.withColumn("balance", F.col("balance").cast("double"))


@query(f"""WITH {_ACCOUNTS}
SELECT 'PRD_004' AS regra_id, 'name' AS coluna, name AS valor_antes, fixed_name AS valor_depois FROM flow WHERE provider = 'C' AND id = (SELECT max(c_custkey) FROM customer WHERE c_acctbal < 0 AND c_acctbal >= -500) AND name <> fixed_name
UNION ALL
SELECT 'FCT_007', 'balance', CAST(balance AS VARCHAR), CAST(abs(balance) AS VARCHAR) FROM flow
WHERE provider = 'C' AND id = (SELECT max(c_custkey) FROM customer WHERE c_acctbal < 0 AND c_acctbal >= -500)""")
def record_story(spark, sf_dir):
    """V8: everything that was corrected on one record, found through its key (scalar subquery, nothing collected)."""
    c = table(spark, sf_dir, "customer")
    last = c.where((F.col("c_acctbal") < 0) & (F.col("c_acctbal") >= -500)).agg(text(F.max("c_custkey")).alias("id"))
    trail = _flow(spark, sf_dir).corrections().where(F.get_json_object("chave", "$.provider") == "C")
    trail = trail.withColumn("id", F.get_json_object("chave", "$.id")).join(F.broadcast(last), "id", "left_semi")
    return record_history(trail, "accounts", "provider", "C")


@query(f"""WITH {_ACCOUNTS}
SELECT 'negative balance' AS guarantee, CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 'repeated account', 0
UNION ALL SELECT 'rows lost', 0
UNION ALL SELECT 'blank segment', count(*) FROM flow WHERE f_blank AND NOT f_negative""")
def step_guarantees(spark, sf_dir):
    """Guarantees of a step as counts of violations."""
    flow = _flow(spark, sf_dir).stage(Stages(spark, "accounts"), "rows")
    rows = flow.survivors()
    kept = rows.agg(F.count_if(F.col("balance") < 0).alias("neg"),
                    (F.count("*") - F.countDistinct("provider", "id")).alias("dup"),
                    F.count_if(F.array_contains("dq_flags", "LOJ_006")).alias("blank"), F.count("*").alias("kept"))
    total = _accounts(spark, sf_dir).agg(F.count("*").alias("n_in"))
    removed = flow.quarantined().agg(F.count("*").alias("removed"))
    one = one_row(kept, total, removed)
    return guarantees({
        "negative balance": one.select(F.col("neg").alias("violations")),
        "repeated account": one.select(F.col("dup").alias("violations")),
        "rows lost": one.select((F.col("n_in") - F.col("kept") - F.col("removed")).alias("violations")),
        "blank segment": one.select(F.col("blank").alias("violations")),
    })
