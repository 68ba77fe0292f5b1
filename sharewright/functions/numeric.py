"""Numeric proofs and scores."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

# Fixed value: makes the median absolute deviation comparable with a standard deviation.
MAD_SCALE = 1.4826


def price_gap(units, price, value) -> Column:
    """Distance between units x price and the reported value."""
    return F.abs(_col(units) * _col(price) - _col(value))


def proven_sign_flip(units, price, value, relative: float, absolute: float) -> Column:
    """A negative value whose positive form is confirmed by units x price within tolerance."""
    value = _col(value)
    return (
        (value < 0) & (_col(units) > 0) & _col(price).isNotNull()
        & (price_gap(units, price, -value) <= relative * F.abs(value) + absolute)
    )


def robust_z(value, median, mad) -> Column:
    """Deviation in robust standard deviations; a constant series (MAD 0 or unknown) uses one unit as scale."""
    scale = F.when(_col(mad) > 0, MAD_SCALE * _col(mad)).otherwise(F.lit(1.0))
    return F.try_divide(_col(value) - _col(median), scale)


def inside_box(lat, lon, box: dict[str, float]) -> Column:
    return _col(lat).between(box["south"], box["north"]) & _col(lon).between(box["west"], box["east"])
