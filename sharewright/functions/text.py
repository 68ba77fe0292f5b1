"""Text expressions: normal form, blanks, masks, suggested codes."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_false(condition: Column) -> Column:
    """A failure predicate with NULL read as "did not fail"."""
    return F.coalesce(condition, F.lit(False))


def normalise(c: str | Column) -> Column:
    """Single spaces, no outer blanks, upper case."""
    return F.upper(F.trim(F.regexp_replace(_col(c), r"\s+", " ")))


def blank(c: str | Column) -> Column:
    return _col(c).isNull() | (F.trim(_col(c)) == "")


def digits(c: str | Column) -> Column:
    return F.regexp_replace(_col(c), r"\D", "")


def unmaskable(c: str | Column, length: int) -> Column:
    """Not plain digits yet, but exactly `length` digits remain without the mask."""
    return ~_col(c).rlike(rf"^\d{{{length}}}$") & (F.length(digits(c)) == length)


def suggest_code(identifier: str | Column, prefix: str = "7891000", width: int = 6) -> Column:
    """Code built from the trailing digits of an identifier: a suggestion, never a correction."""
    return F.concat(F.lit(prefix), F.lpad(F.regexp_extract(_col(identifier), r"(\d+)$", 1), width, "0"))


def json_field(c: str | Column, field: str) -> Column:
    """A field of a flat JSON object written by to_json, NULL where it is left out.

    Without escapes a quote only ends a name or a text, so the text is cut out; all else goes to the parser.
    """
    c, parsed, name = _col(c), F.get_json_object(_col(c), f"$.{field}"), f'"{field}":'
    cut = F.substring_index(F.substring_index(c, f'{name}"', -1), '"', 1)
    return (F.when(F.contains(c, F.lit("\\")), parsed).when(F.contains(c, F.lit(f'{name}"')), cut)
            .when(F.contains(c, F.lit(name)), parsed))
