"""Scalar arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Doubles at or above 2**52 have no fractional part.
_INTEGRAL_FROM = float(2**52)


def round_half_up(value: Column, places: int = 2) -> Column:
    """Round to ``places`` decimals with ties going toward +infinity; NaN gives 0.

    ``F.round`` sends ties away from zero and rounds the decimal text of the
    double, so it gives -0.13 for -0.125 and 1.01 for 1.005 where this rule
    gives -0.12 and 1.0. Values that have no decimals to lose, infinities among
    them, stay as they are.
    """
    scale = float(10**places)
    known = F.nanvl(value, F.lit(0.0))
    scaled = known * scale
    whole = F.floor(F.when(F.abs(scaled) < _INTEGRAL_FROM, scaled).otherwise(0.0))
    near = F.when(scaled - whole >= 0.5, whole + 1).otherwise(whole) / scale
    return F.when(F.abs(scaled) < _INTEGRAL_FROM, near).otherwise(known)


def sd(variance: Column) -> Column:
    return F.sqrt(variance)


def array_mean(values: Column) -> Column:
    """Mean of an array of doubles, 0.0 for an empty one."""
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(values) > 0, total / F.size(values)).otherwise(F.lit(0.0))


def array_variance(values: Column) -> Column:
    """Sample variance of an array: 0.0 when empty, NaN for a single value.

    One running pass (count, mean, sum of squared deviations), so it does not
    lose digits on values that are far from zero.
    """

    def step(acc: Column, x: Column) -> Column:
        n = acc["n"] + 1
        delta = x - acc["mean"]
        mean = acc["mean"] + delta / n
        return F.struct(
            n.alias("n"),
            mean.alias("mean"),
            (acc["m2"] + delta * (x - mean)).alias("m2"),
        )

    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    n = F.size(values)
    folded = F.aggregate(values, start, step, lambda acc: acc["m2"] / F.greatest(acc["n"] - 1, F.lit(1.0)))
    return F.when(n > 1, folded).when(n == 1, F.lit(float("nan"))).otherwise(F.lit(0.0))
