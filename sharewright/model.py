"""Rule model: what a rule is, how its outcomes rank, and the catalogue that owns the rules."""
from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Outcome labels from weakest to strongest. A row takes the strongest label among its rules.
OUTCOMES = ("APROVADO", "CORRIGIDO_AUTOMATICAMENTE", "APROVADO_COM_ALERTA", "QUARENTENA", "REJEITADO")
APPROVED, CORRECTED, ALERTED, QUARANTINED, REJECTED = OUTCOMES

# Rows with these labels go on to consumption.
CONSUMABLE = (APPROVED, CORRECTED, ALERTED)

# Severities and quality dimensions a rule may carry.
SEVERITIES = ("CRITICA", "ALTA", "MEDIA", "BAIXA", "INFO")
DIMENSIONS = (
    "COMPLETUDE", "VALIDADE", "UNICIDADE", "CONSISTENCIA", "INTEGRIDADE_REFERENCIAL",
    "ACURACIA", "TEMPORALIDADE", "COBERTURA", "RECONCILIACAO",
)


@dataclass(frozen=True)
class Rule:
    """One catalogued rule. Counts are not stored here: every run computes them."""

    id: str
    dimension: str
    severity: str
    outcome: str          # label of a row (or dataset) that fails
    scope: str
    description: str
    criterion: str
    treatment: str

    def __post_init__(self) -> None:
        for value, domain in ((self.dimension, DIMENSIONS), (self.severity, SEVERITIES), (self.outcome, OUTCOMES)):
            if value not in domain:
                raise ValueError(f"rule {self.id}: {value!r} is not one of {domain}")

    @property
    def rank(self) -> int:
        return OUTCOMES.index(self.outcome)


class Catalogue:
    """Rules by id. Duplicate ids are refused, unknown ids fail at plan-building time."""

    def __init__(self, rules: Iterable[Rule]):
        self._rules: dict[str, Rule] = {}
        for rule in rules:
            if rule.id in self._rules:
                raise ValueError(f"rule {rule.id} is defined twice")
            self._rules[rule.id] = rule

    def __getitem__(self, rule_id: str) -> Rule:
        if rule_id not in self._rules:
            raise KeyError(f"rule {rule_id} is not in the catalogue")
        return self._rules[rule_id]

    def __iter__(self) -> Iterator[Rule]:
        return iter(self._rules.values())

    def __len__(self) -> int:
        return len(self._rules)

    def frame(self, spark: SparkSession) -> DataFrame:
        """The catalogue as a relation (one row per rule, so always small)."""
        return spark.createDataFrame(
            [(r.id, r.description, r.dimension, r.scope, r.severity, r.criterion, r.treatment, r.outcome, r.rank)
             for r in self],
            "regra_id string, descricao string, dimensao string, escopo string, severidade string, "
            "criterio string, tratamento string, se_falhar string, precedencia int",
        )
