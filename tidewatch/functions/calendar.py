"""Day arithmetic and seasonal terms."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_number(day: Column) -> Column:
    return F.unix_date(day)


def batch_number(day: Column, origin: Column, days: int) -> Column:
    """Batches of `days` days, the first starting at `origin` with number 1."""
    return (F.floor(F.datediff(day, origin) / days) + 1).cast("int")


def fourier_terms(t: Column, period: float, order: int, prefix: str) -> list[Column]:
    """sin and cos of 2*pi*k*t/period for k = 1..order, named <prefix>_sin_k and <prefix>_cos_k."""
    terms = []
    for k in range(1, order + 1):
        angle = t * (2.0 * math.pi * k / period)
        terms += [F.sin(angle).alias(f"{prefix}_sin_{k}"), F.cos(angle).alias(f"{prefix}_cos_{k}")]
    return terms
