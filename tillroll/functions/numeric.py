"""Exact rounding helpers.

Money columns are DECIMAL with two places.  A ratio that the reports store
with ``s`` places is rounded once, half away from zero, from the exact
quotient of two integers (amounts in cents, counts).  Doing the division in
DECIMAL first would round twice (Spark keeps six places, then the cast
rounds again), which moves class borders.

Integer division is written as ``(x - x % y) / y``: the remainder is removed
first, so the decimal quotient is an exact integer.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

INT = "decimal(38,0)"


def as_int(c: Column) -> Column:
    return c.cast(INT)


def unscaled(c: Column, scale: int) -> Column:
    """Decimal with ``scale`` places → the integer of its smallest units."""
    return (c * F.lit(10 ** scale)).cast(INT)


def cents(c: Column) -> Column:
    return unscaled(c, 2)


def int_div(x: Column, y: Column) -> Column:
    """floor(x / y) for x >= 0, y > 0, exact on DECIMAL(38,0)."""
    return ((x - x % y) / y).cast(INT)


def scale_down(int_col: Column, scale: int, precision: int = 20) -> Column:
    """Integer of 10^-scale units → DECIMAL(precision, scale), exactly."""
    if scale == 0:
        return int_col.cast(f"decimal({precision},0)")
    step = F.lit(Decimal(1).scaleb(-scale))
    return (int_col.cast(f"decimal({min(38 - scale - 2, 36)},0)") * step).cast(f"decimal({precision},{scale})")


def ratio_half_up(num: Column, den: Column, scale: int, mult: int = 1,
                  precision: int = 20) -> Column:
    """round(mult * num / den, scale) half away from zero; NULL when den = 0.

    ``num`` and ``den`` are integer valued (counts, or amounts via ``cents``).
    """
    n, d = as_int(num), as_int(den)
    big_n = F.abs(n) * F.lit(mult * 10 ** scale)
    big_d = F.abs(d)
    q = int_div(big_n * 2 + big_d, big_d * 2)
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    return F.when(d != 0, scale_down(signed, scale, precision))


def avg_half_up(sum_units: Column, count: Column, in_scale: int, out_scale: int,
                precision: int = 20) -> Column:
    """AVG of a decimal with ``in_scale`` places, rounded once to ``out_scale``."""
    return ratio_half_up(sum_units, as_int(count) * F.lit(10 ** in_scale), out_scale,
                         precision=precision)


def sqrt_half_up(num: Column, den: Column, scale: int, precision: int = 20) -> Column:
    """round(sqrt(num / den), scale) half up, exact for integers num >= 0, den > 0.

    A double gives a candidate r; the answer is the largest r with
    (2r - 1)^2 * den <= 4 * num * 10^(2 scale), so r is corrected by one step
    either way with integer tests.
    """
    n, d = as_int(num), as_int(den)
    rhs = n * F.lit(4 * 10 ** (2 * scale))
    est = F.floor(F.sqrt(n.cast("double") / d.cast("double")) * F.lit(float(10 ** scale)) + F.lit(0.5)).cast(INT)

    def fits(r: Column) -> Column:
        t = r * 2 - 1
        return (r <= 0) | (t * t * d <= rhs)

    r = (F.when(fits(est + 1), est + 1)
         .when(fits(est), est)
         .otherwise(est - 1))
    return F.when(d > 0, scale_down(r, scale, precision))


def round_double(c: Column, scale: int, precision: int = 38) -> Column:
    """Round a DOUBLE to ``scale`` places and type it as DECIMAL."""
    return F.round(c, scale).cast(f"decimal({precision},{scale})")
