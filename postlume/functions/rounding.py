"""Decimal rounding of doubles, half to even on the exact binary value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0                  # 2**27 + 1: cuts a double into two 26-bit halves
_INTEGRAL_FROM = 4503599627370496.0   # 2**52: no fraction bits beyond this


def round_exact(name: str, digits: int) -> Column:
    """Column ``name`` to ``digits`` places, as Python's ``round`` does it.

    ``round`` and ``bround`` work on the shortest decimal text of a double, so
    0.00625 (in binary a little more than that) counts as a tie. Here the
    product with the power of ten is kept as an unevaluated sum of two doubles
    (Dekker's product): half a unit away from ``rint``, it is a tie only if that
    product lost nothing; else the lost part decides.
    """
    scale = float(10 ** digits)
    scale_high = scale * _SPLIT - (scale * _SPLIT - scale)
    scale_low = scale - scale_high

    product = f"({name} * {scale!r}D)"
    high = f"({name} * {_SPLIT!r}D - ({name} * {_SPLIT!r}D - {name}))"
    lost = (f"(({high} * {scale_high!r}D - {product}) + {high} * {scale_low!r}D"
            f" + ({name} - {high}) * {scale_high!r}D + ({name} - {high}) * {scale_low!r}D)")
    half = f"({product} - rint({product}))"
    return F.expr(f"""
        CASE WHEN abs({product}) < {_INTEGRAL_FROM!r}D
             THEN (rint({product}) + CASE WHEN abs({half}) = 0.5D AND signum({lost}) = {half} * 2D
                                          THEN {half} * 2D ELSE 0D END) / {scale!r}D
             ELSE {name} END""")
