from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property, reduce

from pyspark.sql import DataFrame

from ..operators.rules import RuleFlow, rule_log


class Conformed:
    """Result of a plan: rows, removed rows, trail and log, each planned only when asked for."""

    def __init__(self, flow: RuleFlow, rows: DataFrame | None = None, datasets: Sequence[DataFrame] = (),
                 **extras: DataFrame):
        self._flow, self._rows, self._datasets, self.extras = flow, rows, tuple(datasets), extras

    @cached_property
    def rows(self) -> DataFrame:
        return self._flow.survivors() if self._rows is None else self._rows

    @cached_property
    def quarantine(self) -> DataFrame:
        return self._flow.quarantined()

    @cached_property
    def corrections(self) -> DataFrame:
        return self._flow.corrections()

    @cached_property
    def counts(self) -> DataFrame:
        """Counts of the row rules and the dataset rules, before they are described by the catalogue."""
        return reduce(lambda a, b: a.unionByName(b), [self._flow.counts(), *self._datasets])

    @cached_property
    def log(self) -> DataFrame:
        return rule_log(self.counts, self._flow.catalogue, self._flow.run_id)
