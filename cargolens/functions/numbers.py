"""Zero-safe arithmetic used by the reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Division that yields NULL, not an error, for a zero denominator."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def percent(numerator: str | Column, denominator: str | Column) -> Column:
    return ratio(numerator, denominator) * 100


def zero_safe_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation over the rows where both sides are present; NaN is missing.

    NULL for a constant side or a single row, where ``corr`` would raise.
    """
    x, y = nan_to_null(col(x).cast("double")), nan_to_null(col(y).cast("double"))
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def nan_to_null(c: str | Column) -> Column:
    return F.when(~F.isnan(col(c)), col(c))
