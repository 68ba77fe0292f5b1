"""Queries registered over the benchmark tables, each next to its DuckDB twin."""
from . import (accounts, audits, calendars, catalogues, coverages, dimensions, facts, ingest, runs, series,  # noqa: F401
               shares)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
