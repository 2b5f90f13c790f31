"""Exact amounts: decimals from the hit to the last rounding, so no sum depends on row order."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,6)"


def money(amount: Column) -> Column:
    """An amount as a wide decimal; one that does not fit fails the job instead of becoming null."""
    exact = amount.try_cast(MONEY)
    too_large = F.raise_error(F.concat(F.lit("amount out of range: "), amount.cast("string")))
    return F.when(exact.isNull() & amount.isNotNull(), too_large.cast(MONEY)).otherwise(exact)


def cents(amount: Column) -> Column:
    """Rounded half up to two decimals, as a double."""
    return F.round(amount, 2).cast("double")


def ratio_cents(part: Column, whole: Column) -> Column:
    """part / whole, rounded half up to two decimals without an inexact step; whole is positive."""
    whole = whole.cast(MONEY)
    hundredths = F.call_function("div", F.abs(part) * 200 + whole, whole * 2)
    return F.signum(part).cast("double") * hundredths / F.lit(100.0)


def percent(part: Column, whole: Column) -> Column:
    """part of whole in percent, two decimals; 0 where there is no whole."""
    return F.when(whole > 0, ratio_cents(part * 100, whole)).otherwise(F.lit(0.0))


def mean(total: Column, n: Column) -> Column:
    """total / n, two decimals; 0 where n is 0."""
    return F.when(n > 0, ratio_cents(total, n)).otherwise(F.lit(0.0))
