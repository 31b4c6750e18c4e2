"""Derived measures. Operation order is fixed, so doubles agree bit for bit."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def balance(gain: str | Column, loss: str | Column) -> Column:
    """``gain - loss``; NULL when either is NULL."""
    return _col(gain) - _col(loss)


def ratio(num: str | Column, den: str | Column, scale: float = 1.0, den_scale: float = 1.0) -> Column:
    """``num / den * scale``; a zero or NULL denominator gives NULL.

    ``den_scale`` converts the denominator's unit first, for example 1000 when
    it is stored in thousands.
    """
    den = _col(den) if den_scale == 1.0 else _col(den) * F.lit(float(den_scale))
    return _col(num) / F.nullif(den, F.lit(0.0)) * F.lit(float(scale))


def share(part: str | Column, total: str | Column) -> Column:
    """Percentage of a part in its total."""
    return ratio(part, total, 100.0)


def parts_diff(total: str | Column, parts: Iterable[str | Column]) -> Column:
    """``total - (part + part + ...)``; NULL as soon as one component is NULL."""
    return _col(total) - reduce(lambda a, b: a + b, [_col(p) for p in parts])


def missing_flag(component: str | Column) -> Column:
    """1 when the component is NULL, else 0."""
    return _col(component).isNull().cast("int")


def within(diff: str | Column, tolerance: float) -> Column:
    """Reading of a difference: ``ok``, ``investigate`` or ``gap`` (not computable)."""
    diff = _col(diff)
    return (
        F.when(diff.isNull(), F.lit("gap"))
        .when(F.abs(diff) <= F.lit(tolerance), F.lit("ok"))
        .otherwise(F.lit("investigate"))
    )
