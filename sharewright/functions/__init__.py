"""Column expressions. Everything here is a built-in composition, so it stays inside code generation."""
from .dates import iso_label, iso_month, iso_year, monday_sequence, thursday
from .numeric import inside_box, price_gap, proven_sign_flip, robust_z
from .text import blank, digits, json_field, normalise, not_false, suggest_code, unmaskable

__all__ = [
    "blank", "digits", "inside_box", "iso_label", "iso_month", "iso_year", "json_field", "monday_sequence", "normalise",
    "not_false", "price_gap", "proven_sign_flip", "robust_z", "suggest_code", "thursday", "unmaskable",
]
