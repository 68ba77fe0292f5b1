"""Rule algebra: flags, corrections, removals, status, log."""
import pytest
from rule_counts import failures
from pyspark.sql import functions as F

from sharewright.model import DIMENSIONS, Catalogue, Rule
from sharewright.operators.rules import RuleFlow, record, rule_log, status_of


def test_catalogue_rejects_unknown_and_duplicate_ids(rules):
    with pytest.raises(KeyError):
        rules["XXX_999"]
    rule = rules["FCT_001"]
    with pytest.raises(ValueError):
        Catalogue([rule, rule])
    with pytest.raises(ValueError):
        Rule("A", "NOPE", "ALTA", "APROVADO", "", "", "", "")


def test_catalogue_covers_the_dimensions(rules):
    assert len(rules) == 63
    assert {r.dimension for r in rules} == set(DIMENSIONS)


def test_catalogue_is_also_a_relation(spark, rules):
    assert rules.frame(spark).count() == 63


def test_null_is_not_a_failure_and_check_changes_nothing(spark, rules):
    df = spark.createDataFrame([("p", 5), ("q", -7), ("r", None)], "k string, v int")
    flow = RuleFlow(df, rules, "t", ["k"]).check("FCT_014", F.col("v") < 0)
    rows = {r.k: r for r in flow.survivors().collect()}
    assert (rows["q"].v, rows["q"].dq_flags) == (-7, ["FCT_014"])
    assert rows["r"].dq_flags == [] and rows["r"].dq_status == "APROVADO"
    assert failures(flow.log()) == {"FCT_014": 1}


def test_correct_keeps_the_first_original_and_a_trail(spark, rules):
    df = spark.createDataFrame([("p", " ab "), ("q", "CD")], "k string, txt string")
    flow = RuleFlow(df, rules, "t", ["k"])
    flow.correct("PRD_004", F.col("txt") != F.upper(F.trim("txt")), {"txt": F.upper(F.trim("txt"))})
    flow.correct("PRD_005", F.col("txt") == "AB", {"txt": F.lit("ABBA")})
    rows = {r.k: r for r in flow.survivors().collect()}
    assert (rows["p"].txt, rows["p"].txt_raw, rows["p"].dq_flags) == ("ABBA", " ab ", ["PRD_004", "PRD_005"])
    assert (rows["q"].txt, rows["q"].txt_raw, rows["q"].dq_status) == ("CD", "CD", "APROVADO")
    trail = [(t.regra_id, t.chave, t.coluna, t.valor_antes, t.valor_depois)
             for t in flow.corrections().orderBy("regra_id").collect()]
    assert trail == [("PRD_004", '{"k":"p"}', "txt", " ab ", "AB"), ("PRD_005", '{"k":"p"}', "txt", "AB", "ABBA")]


def test_correct_is_simultaneous_and_trails_unchanged_columns_unless_asked(spark, rules):
    df = spark.createDataFrame([(1, 2, 2)], "k int, a int, b int")
    swap = {"a": F.col("b"), "b": F.col("a") + 10}
    flow = RuleFlow(df, rules, "t", ["k"]).correct("PRD_004", F.lit(True), swap)
    row = flow.survivors().first()
    assert (row.a, row.b) == (2, 12)
    assert flow.corrections().count() == 2
    only = RuleFlow(df, rules, "t", ["k"]).correct("PRD_004", F.lit(True), swap, changed_only=True)
    assert [t.coluna for t in only.corrections().collect()] == ["b"]


def test_quarantine_keeps_payload_reason_and_absolute_value(spark, rules):
    df = spark.createDataFrame([("p", 12.0, "f1"), ("q", -3.5, "f2")], "k string, amount double, _source_file string")
    flow = RuleFlow(df, rules, "t", ["k"], value="amount").quarantine("FCT_008", F.col("amount") < 0)
    assert [r.k for r in flow.survivors().collect()] == ["p"]
    q = flow.quarantined().first()
    assert (q.regra_id, q.classificacao, q.severidade, q.dimensao, q.arquivo_origem) == (
        "FCT_008", "QUARENTENA", "ALTA", "VALIDADE", "f2")
    assert q.chave == '{"k":"q"}' and q.valor_brl == -3.5 and '"amount":-3.5' in q.payload
    assert flow.log().first().valor_impactado_brl == 3.5


def test_rules_see_only_rows_not_removed_before(spark, rules):
    df = spark.createDataFrame([(i, i) for i in range(10)], "k int, v int")
    flow = RuleFlow(df, rules, "t", ["k"])
    flow.quarantine("FCT_004", F.col("v") < 3).check("FCT_014", F.col("v") < 5, evaluated=F.col("v") % 2 == 0)
    flow.quarantine("FCT_005", F.col("v") < 4)
    log = {r.regra_id: (r.avaliados, r.falhas, r.pct_falha) for r in flow.log().collect()}
    assert log == {"FCT_004": (10, 3, 0.3), "FCT_014": (3, 1, 0.333333), "FCT_005": (7, 1, 0.142857)}
    assert flow.survivors().count() + flow.quarantined().count() == 10


def test_stage_changes_nothing(spark, rules, stages):
    def build(stage):
        df = spark.createDataFrame([(i, float(i - 5)) for i in range(12)], "k int, v double")
        flow = RuleFlow(df, rules, "t", ["k"], value="v")
        flow.quarantine("FCT_004", F.col("k") < 2)
        if stage:
            flow.stage(stages, "a")
        flow.correct("FCT_007", F.col("v") == -2, {"v": F.abs("v")}).check("FCT_014", F.col("v") > 4)
        if stage:
            flow.stage(stages, "b")
        flow.quarantine("FCT_008", F.col("v") < 0)
        return [sorted(map(str, f.collect())) for f in
                (flow.survivors(), flow.quarantined(), flow.corrections(), flow.log())]
    assert build(False) == build(True)


def test_removed_rows_are_staged_with_their_payload_only(spark, rules, stages):
    df = spark.createDataFrame([(i, float(i), "long text", "f.csv") for i in range(4)], "k int, v double, c string, _source_file string")
    flow = RuleFlow(df, rules, "t", ["k"], value="v").quarantine("FCT_004", F.col("k") < 2).stage(stages, "a")
    written, = flow._parked
    assert written.where("k IS NOT NULL OR c IS NOT NULL OR v IS NULL").count() == 0 and written.count() == 2
    gone = flow.quarantined().orderBy("valor_brl").collect()
    assert [(r.chave, r.valor_brl, r.arquivo_origem) for r in gone] == [('{"k":0}', 0.0, "f.csv"), ('{"k":1}', 1.0, "f.csv")]
    assert all('"c":"long text"' in r.payload for r in gone)
    assert sorted(r.k for r in flow.survivors().collect()) == [2, 3]


def test_status_takes_the_strongest_label_and_ignores_unknown_ids(spark, rules):
    rows = [(["PRD_004", "PRD_003"],), (["PRD_004"],), ([],), (["ZZZ"],), (["FCT_016"],)]
    df = spark.createDataFrame(rows, "f array<string>").select(status_of(F.col("f"), rules).alias("s"))
    assert [r.s for r in df.collect()] == [
        "APROVADO_COM_ALERTA", "CORRIGIDO_AUTOMATICAMENTE", "APROVADO", "APROVADO", "APROVADO"]


def test_existing_flags_are_kept(spark, rules):
    df = spark.createDataFrame([(1, ["COV_002"])], "k int, dq_flags array<string>")
    row = RuleFlow(df, rules, "t", ["k"]).check("COV_005", F.lit(True)).survivors().first()
    assert row.dq_flags == ["COV_002", "COV_005"]


def test_dataset_rule_and_empty_input(spark, rules):
    counts = spark.createDataFrame([(10, 4)], "evaluated long, failed long")
    row = rule_log(record("TER_003", "t", counts, "text"), rules, "r").first()
    assert (row.avaliados, row.falhas, row.pct_falha, row.resultado) == (10, 4, 0.4, "APROVADO_COM_ALERTA")
    empty = spark.createDataFrame([], "k int, v int")
    row = RuleFlow(empty, rules, "t", ["k"]).check("FCT_014", F.col("v") < 0).log().first()
    assert (row.avaliados, row.falhas, row.pct_falha, row.resultado) == (0, 0, 0.0, "APROVADO")


def many_rules(n):
    return Catalogue([Rule(f"R_{i:03d}", DIMENSIONS[i % len(DIMENSIONS)], "ALTA", "APROVADO_COM_ALERTA" if i % 3 else "QUARENTENA",
                           "", f"rule {i}", "", "") for i in range(n)])


def apply_rule(flow, i):
    rule, failing = f"R_{i:03d}", F.col("v") % (i + 7) == 3
    if i % 40 == 0:
        return flow.quarantine(rule, failing)
    if i % 10 == 5:
        return flow.correct(rule, failing, {"v": F.col("v") + 1000})
    return flow.check(rule, failing, evaluated=F.col("v") > i if i % 4 == 1 else None)


def test_a_flow_of_130_rules_equals_the_rules_one_by_one(spark, stages):
    n = 130
    df = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 37 % 1009).alias("v"))
    whole = RuleFlow(df, many_rules(n), "t", ["k"], value="v")
    rows = {k: k * 37 % 1009 for k in range(400)}
    log, removed, trail, flags = [], [], [], {k: [] for k in rows}
    for i in range(n):
        apply_rule(whole, i)
        if i in (30, 100):                              # before and after the second mask is opened
            whole.stage(stages, "half")
        rule, failing = f"R_{i:03d}", [k for k, v in rows.items() if v % (i + 7) == 3]
        masked = i % 40 and i % 10 != 5 and i % 4 == 1
        seen = [k for k in rows if not masked or rows[k] > i]
        failing = [k for k in failing if k in set(seen)]
        log.append((rule, len(seen), len(failing), float(sum(rows[k] for k in failing)) if failing else None))
        for k in failing:
            if i % 40 == 0:
                removed.append((rule, f'{{"k":{k}}}', float(rows.pop(k))))
            elif i % 10 == 5:
                trail.append((rule, f'{{"k":{k}}}', str(rows[k]), str(rows[k] + 1000)))
                rows[k] += 1000
            if i % 40:
                flags[k].append(rule)
    assert sorted((r.regra_id, r.avaliados, r.falhas, r.valor_impactado_brl) for r in whole.log().collect()) == sorted(log)
    assert sorted((r.regra_id, r.chave, r.valor_brl) for r in whole.quarantined().collect()) == sorted(removed)
    assert sorted((r.regra_id, r.chave, r.valor_antes, r.valor_depois) for r in whole.corrections().collect()) == sorted(trail)
    assert {r.k: (r.v, r.dq_flags) for r in whole.survivors().collect()} == {k: (v, flags[k]) for k, v in rows.items()}
    assert not [c for c in whole.survivors().columns if c.startswith("_dq_")]
