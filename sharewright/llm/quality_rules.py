"""Quality rules: a learned decision list over text statistics, with DataFrame functions only.

Sequential covering: labelled rows are split by a hash into growing and pruning rows; a rule grows by the threshold
condition with the largest information gain, is pruned from its end on the pruning rows, and its rows are covered; the next
rule starts from what is left. Each step is one aggregation of (statistic, bin) counts over the labelled rows, so the work
on the driver is bounded by statistics x bins. The list is an ordered ``when`` expression. The model is bounded, the data are
not: at most MAX_RULES rules of MAX_CONDITIONS conditions, thresholds at the BINS-quantiles of the labelled rows.

Null text counts as empty. Labels that are null or contradict each other for one document are left out. Without labels of
both kinds the list is empty and only the base rules decide. Extra columns are ignored; repeated rows are judged alike.
"""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharewright.session import Stages

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
BINS = 32
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_lines", "n_upper",
          "n_digits", "n_stops")
MAX_RULES, MAX_CONDITIONS = 6, 3
MIN_PRECISION, MIN_ROWS = 0.9, 5


def statistics(docs: DataFrame, *keep: str | Column) -> DataFrame:
    """Counts of the base rules and ratios, one row per document; nothing is shuffled."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", *keep, text.alias("text"))
    keep = [c for c in base.columns if c not in ("doc_id", "text")]
    base = base.withColumn("words", F.filter(
        F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "").alias("words"))
    windows = F.when(F.size("words") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("words") - WINDOW),
        lambda i: F.struct(F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]).alias("h"), i.alias("i"))))
    base = base.withColumn("windows", F.sort_array(windows))
    repeated = F.sort_array(F.transform(F.filter(
        "windows", lambda w, k: (F.get("windows", k - 1)["h"] == w["h"]) | (F.get("windows", k + 1)["h"] == w["h"])),
        lambda w: w["i"]))
    base = base.withColumn("starts", repeated)
    # words of overlapping windows count once
    covered = F.aggregate(F.transform(
        "starts", lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", k + 1) - s, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.translate(x, WHITE, "") != "")
    base = base.withColumn("full_lines", lines)
    counts = base.select(
        "doc_id", *keep, F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", WHITE, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("full_lines") - F.size(F.array_distinct("full_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct_words"),
        F.size("full_lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("text", "[^A-Z]", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace("text", "[^0-9]", "")).cast("long").alias("n_digits"),
        F.length(F.regexp_replace("text", "[^.,;:!?]", "")).cast("long").alias("n_stops"))
    return counts.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def measures() -> dict[str, Column]:
    """Statistics the rules may test."""
    def per(top, below):
        return F.coalesce(F.col(top) / F.nullif(F.col(below).cast("double"), F.lit(0.0)), F.lit(0.0))

    return {"words": F.col("n_words").cast("double"), "word_length": per("word_chars", "n_words"),
            "symbols_per_word": per("n_symbols", "n_words"), "dup_lines": per("n_dup_lines", "n_lines"),
            "repeats": per("n_repeat_words", "n_words"), "distinct": per("n_distinct_words", "n_words"),
            "words_per_line": per("n_words", "n_lines"), "upper": per("n_upper", "word_chars"),
            "digits": per("n_digits", "word_chars"), "stops": per("n_stops", "n_words")}


class Condition(tuple):
    """(measure, side, threshold): measure <= threshold or measure > threshold."""

    def test(self) -> Column:
        name, side, threshold = self
        value = measures()[name]
        return value <= F.lit(threshold) if side == "<=" else value > F.lit(threshold)


def conjunction(rule: list[Condition]) -> Column:
    return reduce(lambda a, b: a & b, [c.test() for c in rule], F.lit(True))


def _gain(pos, neg, pos0, neg0):
    if not pos:
        return 0.0
    return pos * (math.log2(pos / (pos + neg)) - math.log2(pos0 / (pos0 + neg0)))


def learn_rules(labelled: DataFrame, stages: Stages) -> list[list[Condition]]:
    """Ordered conjunctions that reject; ``labelled`` holds the counts and a column ``bad`` (0 or 1).

    Every measure is staged as its bin number, a small integer, and what a rule leaves is staged again, so that the plan of a step
    does not grow with the rules before it.
    """
    names = list(measures())
    cuts = labelled.select([F.percentile_approx(c, [i / BINS for i in range(1, BINS)], 10000).alias(n)
                            for n, c in measures().items()]).first()
    edges = {n: sorted(set(cuts[n] or [])) for n in names}

    def bin_of(name: str, value: Column) -> Column:
        """Edges below the value: value <= edges[b] says the same as bin <= b."""
        return F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges[name]]), lambda e: value > e)).cast("byte")

    rows = stages(labelled.select(
        "bad", (F.pmod(F.xxhash64("doc_id", F.lit("grow")), F.lit(3)) != 0).alias("grow"),
        *[bin_of(n, c).alias(n) for n, c in measures().items()]), "bins")

    def fits(rule: list[Condition]) -> Column:
        tests = [(F.col(n) <= edges[n].index(t)) if side == "<=" else (F.col(n) > edges[n].index(t)) for n, side, t in rule]
        return reduce(lambda a, b: a & b, tests, F.lit(True))

    def best(rule: list[Condition]):
        kept = rows.filter(F.col("grow") & fits(rule)).select("bad", F.posexplode(F.array(*names)).alias("m", "b"))
        table = {n: {} for n in names}
        for m, b, bad, n in kept.groupBy("m", "b").agg(F.sum("bad"), F.count(F.lit(1))).collect():     # measures x bins
            table[names[m]][b] = (bad, n - bad)
        total = [sum(v[k] for v in table[names[0]].values()) for k in (0, 1)]
        options = []
        for n in names:
            low = [0, 0]
            for b, edge in enumerate(edges[n]):
                low = [low[k] + table[n].get(b, (0, 0))[k] for k in (0, 1)]
                high = [total[k] - low[k] for k in (0, 1)]
                for side, (p, q) in (("<=", low), (">", high)):
                    options.append((_gain(p, q, *total) if total[0] else 0.0, n, side, float(edge), p, q))
        return max(options, default=None)

    rules: list[list[Condition]] = []
    while len(rules) < MAX_RULES:
        rule, good = [], False
        while len(rule) < MAX_CONDITIONS:
            found = best(rule)
            if found is None or found[0] <= 1e-9:
                break
            rule.append(Condition(found[1:4]))
            if found[5] == 0:
                break
        if rule:
            # prune from the end: the shortest prefix with the best (right - wrong) / covered on the pruning rows
            prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
            got = rows.filter(~F.col("grow")).select(
                [F.coalesce(F.sum(F.when(fits(r), w)), F.lit(0)) for r in prefixes
                 for w in (F.col("bad"), 1 - F.col("bad"))]).first()
            scored = [((got[2 * k] + 1) / (got[2 * k] + got[2 * k + 1] + 2), -k) for k in range(len(prefixes))]
            k = -max(scored)[1]
            p, q = got[2 * k], got[2 * k + 1]
            rule, good = prefixes[k], p >= MIN_ROWS and p / (p + q) >= MIN_PRECISION
        if not good:
            break
        rules.append(rule)
        left = stages(rows.filter(~fits(rule)), "uncovered")
        stages.drop(rows)
        rows = left
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """The decision list as one ordered expression: the number of the first rule that fits, 0 if none does."""
    out = None
    for number, rule in enumerate(rules, 1):
        out = F.when(conjunction(rule), F.lit(number)) if out is None else out.when(conjunction(rule), F.lit(number))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def judge(docs: DataFrame, labels: DataFrame, *keep: str | Column) -> DataFrame:
    """Counts, base_failed, rule (0: none) and kept for every document; ``keep`` names columns to carry along."""
    stages = Stages(docs.sparkSession, "quality")
    clear = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("lo"), F.max("quality").alias("hi")).filter("lo = hi").select(
        "doc_id", (F.col("lo") == 0).cast("long").alias("bad"))
    counts = stages(statistics(docs, *keep), "counts")
    labelled = stages(counts.select("doc_id", "base_failed", *COUNTS).join(clear, "doc_id").filter("not base_failed"), "labelled")
    kinds = labelled.agg(F.min("bad"), F.max("bad")).first()
    rules = learn_rules(labelled, stages) if tuple(kinds) == (0, 1) else []
    judged = counts.withColumn("rule", verdict(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
