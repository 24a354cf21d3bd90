"""Aggregate expressions that behave under ANSI mode and with missing values."""

from pyspark.sql import Column, functions as F

from .nulls import col, is_missing, number


def share(condition: Column) -> Column:
    """Share of all rows for which the condition holds."""
    return F.try_divide(F.count_if(condition).cast("double"), F.count(F.lit(1)))


def missing_rate(c) -> Column:
    return share(is_missing(c))


def zero_rate(c) -> Column:
    return share(number(c) == 0.0)


def pearson(x, y) -> Column:
    """Correlation over complete pairs; null where either side is constant."""
    a, b = number(x), number(y)
    complete = a.isNotNull() & b.isNotNull()
    a, b = F.when(complete, a), F.when(complete, b)
    return F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))


def log_of(c, base: str = "log2", offset: float = 1.0) -> Column:
    """Logarithm of a shifted value; an unknown base means base 2, and x + offset <= 0 gives null."""
    shifted = col(c) + F.lit(offset)
    return {"log2": F.log2, "log10": F.log10, "ln": F.ln}.get(base, F.log2)(shifted)
