"""Numeric expressions: bands, clips, sentinels, ratios, array arithmetic."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Working type for money. Sums are cast back to it so that later products keep all digits.
MONEY = "decimal(24,7)"


def money(value: Column) -> Column:
    return value.cast(MONEY)


def times(amount: Column, factor: Column) -> Column:
    """Money times a row count, exactly."""
    return money(amount.cast(MONEY) * factor.cast("decimal(12,0)"))


def clip(value: Column, low: float, high: float) -> Column:
    """Value limited to [low, high]; null stays null."""
    return F.when(value > high, F.lit(high)).when(value < low, F.lit(low)).otherwise(value)


def right_closed_band(value: Column, edges: Sequence[float]) -> Column:
    """Band index for ``[e0,e1] (e1,e2] …``; null outside. (Bucketizer closes the left side.)"""
    out = F.when(value.isNull() | (value < edges[0]) | (value > edges[-1]), F.lit(None).cast("int"))
    for i, edge in enumerate(edges[1:]):
        out = out.when(value <= edge, F.lit(i))
    return out


def zero_to_null(value: Column) -> Column:
    return F.when(value != 0, value)


def nonpositive_to(value: Column, sentinel: float) -> Column:
    """``sentinel`` where the value is zero or negative; null stays null."""
    return F.when(value <= 0, F.lit(sentinel)).otherwise(value)


def as_flag(condition: Column) -> Column:
    """1 where true, else 0 (also for null)."""
    return F.when(condition, 1).otherwise(0)


def ratio(top: Column, bottom: Column) -> Column:
    """Division that is null, not an error, on a zero denominator."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def utilisation(free: Column, office: Column, blocked: Column) -> Column:
    """Share of bookable time used; full when nothing was free."""
    return F.when(free == 0, F.lit(1.0)).otherwise(1 - ratio(free, free + office - blocked))


def argmax(values: Column) -> Column:
    """Zero-based position of the first maximum."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def round_half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


def row_scaled(values: Column) -> Column:
    """Values of one row scaled to 0..1 by the row's own minimum and maximum."""
    low, high = F.array_min(values), F.array_max(values)
    return F.transform(values, lambda v: F.try_divide(v - low, high - low))


def log_gamma(x: Column, shift: int = 10) -> Column:
    """ln of the gamma function for x > 0: Stirling's series at x + ``shift``, taken back step by step."""
    big = x + shift
    series = (big - 0.5) * F.log(big) - big + 0.5 * math.log(2 * math.pi) + 1 / (12 * big) - 1 / (360 * big**3) + 1 / (1260 * big**5) - 1 / (1680 * big**7)
    return series - sum((F.log(x + i) for i in range(1, shift)), F.log(x))


def _beta_fraction(x: Column, a: Column, b: Column, terms: int) -> Column:
    """The regularised incomplete beta function by its continued fraction, which is quick where x < (a + 1) / (a + b + 2)."""
    m = lambda k: F.floor(k / 2).cast("double")

    def step(below: Column, k: Column) -> Column:
        odd = -(a + m(k)) * (a + b + m(k)) * x / ((a + 2 * m(k)) * (a + 2 * m(k) + 1))
        even = m(k) * (b - m(k)) * x / ((a + 2 * m(k) - 1) * (a + 2 * m(k)))
        return 1 + F.when(k % 2 == 1, odd).otherwise(even) / below

    fraction = F.aggregate(F.sequence(F.lit(terms), F.lit(1)), F.lit(1.0), step)
    front = F.exp(a * F.log(x) + b * F.log1p(-x) + log_gamma(a + b) - log_gamma(a) - log_gamma(b)) / a
    return F.when(x <= 0, 0.0).otherwise(front / fraction)


def two_sided_p(t: Column, df: Column, terms: int = 200) -> Column:
    """Chance of a Student t at least this far from zero with ``df`` degrees of freedom; null where
    there are none.

    A continued fraction of ``terms`` steps as one expression, from the side on which it converges quickly.
    """
    df, half = df.cast("double"), F.lit(0.5)
    a, outer, inner = df / 2, df / (df + t * t), t * t / (df + t * t)
    p = F.when(outer < (a + 1) / (a + 2.5), _beta_fraction(outer, a, half, terms)).otherwise(1 - _beta_fraction(inner, half, a, terms))
    return F.when((df > 0) & t.isNotNull(), F.least(F.lit(1.0), p))
