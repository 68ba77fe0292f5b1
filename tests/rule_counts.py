"""Counts of a rule log, for assertions."""
from __future__ import annotations


def failures(log) -> dict[str, int]:
    return {r["regra_id"]: r["falhas"] for r in log.collect()}
