"""Aggregate expressions whose missing-value rules differ from the built-in ones."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.scalars import _col


def safe_ratio(top: Column | str, bottom: Column | str) -> Column:
    """NULL instead of an error when the denominator is zero."""
    return F.try_divide(_col(top), _col(bottom))


def percent(top: Column | str, bottom: Column | str) -> Column:
    return safe_ratio(top, bottom) * 100


def sum_if(condition: Column, value: Column | str) -> Column:
    return F.sum(F.when(condition, _col(value)).otherwise(0))


def weighted_mean(value: Column | str, weight: Column | str) -> Column:
    return safe_ratio(F.sum(_col(value) * _col(weight)), F.sum(_col(weight)))


def strict_sum(value: Column | str, over: WindowSpec | None = None) -> Column:
    """Sum that is NULL as soon as one value of the group (or window) is NULL."""
    v = _col(value)
    parts = [F.count(v), F.count(F.lit(1)), F.sum(v)]
    known, rows, total = [p.over(over) for p in parts] if over is not None else parts
    return F.when(known == rows, total)


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over rows where both sides are present; NULL if one is constant.

    ``corr`` itself raises on a constant column. Each side is masked by the other so the
    deviations cover the same rows as the covariance.
    """
    x, y = _col(x), _col(y)
    a = F.when(y.isNotNull(), x).cast("double")
    b = F.when(x.isNotNull(), y).cast("double")
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def rmse(truth: Column | str, estimate: Column | str) -> Column:
    gap = _col(truth) - _col(estimate)
    return F.sqrt(F.avg(gap * gap))


def mae(truth: Column | str, estimate: Column | str) -> Column:
    return F.avg(F.abs(_col(truth) - _col(estimate)))


def squared_corr(truth: Column | str, estimate: Column | str) -> Column:
    """R squared as the square of the correlation, not one minus a residual ratio."""
    c = safe_corr(truth, estimate)
    return c * c


def line_slope(y: Column | str, x: Column | str) -> Column:
    return F.regr_slope(_col(y), _col(x))


def line_intercept(y: Column | str, x: Column | str) -> Column:
    return F.regr_intercept(_col(y), _col(x))
