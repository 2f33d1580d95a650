"""Forecast scores as aggregate columns; e is actual minus predicted."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def rmse(e: Column) -> Column:
    return F.sqrt(F.avg(e * e))


def mae(e: Column) -> Column:
    return F.avg(F.abs(e))


def mape(y: Column, e: Column) -> Column:
    """In percent; days without demand have no relative error and are left out."""
    return 100.0 * F.avg(F.abs(e) / F.nullif(F.abs(y), F.lit(0.0)))


def r2(y: Column, e: Column) -> Column:
    """1 - SSE/SST in one pass; NULL where the target does not vary."""
    return 1.0 - F.sum(e * e) / F.nullif(F.var_pop(y) * F.count(y), F.lit(0.0))


def error_mean(e: Column) -> Column:
    return F.avg(e)


def error_std(e: Column) -> Column:
    """Population form, so that rmse^2 = mean^2 + std^2."""
    return F.stddev_pop(e)


def implied_variance(rmse_: Column, r2_: Column) -> Column:
    """Variance of the scored target that a stored pair of rmse and r2 implies."""
    return rmse_ * rmse_ / F.nullif(1.0 - r2_, F.lit(0.0))


def rounded(c: Column, digits: int = 6) -> Column:
    """Rounded for reports; adding zero turns -0.0 into 0.0."""
    return F.round(c, digits) + F.lit(0.0)
