"""Week expressions. A week starts on Monday and belongs to the year and month of its Thursday."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def thursday(start: str | Column) -> Column:
    return F.date_add(_col(start), 3)


def iso_year(start: str | Column) -> Column:
    return F.year(thursday(start))


def iso_month(start: str | Column) -> Column:
    return F.month(thursday(start))


def iso_label(start: str | Column) -> Column:
    """YYYY-WW of the week starting at `start`."""
    week = F.lpad(F.weekofyear(_col(start)).cast("string"), 2, "0")
    return F.concat(iso_year(start).cast("string"), F.lit("-"), week)


def monday_sequence(start: str | Column) -> Column:
    """Running week number: whole weeks since Monday 1970-01-05."""
    return F.floor(F.datediff(_col(start), F.lit("1970-01-05")) / 7).cast("int")
