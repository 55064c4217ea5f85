"""Histograms over ascending split points; bins are closed on the left.

``m`` splits give ``m + 1`` bins: below the first split, between neighbours, and
from the last split up. NaN and NULL belong to no bin.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalstats.model import HISTOGRAM_SPLITS

def _checked(splits: Sequence[float]) -> list[float]:
    points = [float(s) for s in splits]
    if not points or any(not a < b for a, b in pairwise(points)):
        raise ValueError("splits must be strictly ascending and not empty")
    return points


def bin_index(value: Column, splits: Sequence[float]) -> Column:
    """0-based bin of a value, as nested comparisons (log2 of the bins deep)."""
    points = _checked(splits)

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < points[middle], search(low, middle)).otherwise(search(middle + 1, high))

    return F.when(value.isNotNull() & ~F.isnan(value), search(0, len(points)))


def bin_counts(value: Column, splits: Sequence[float] = HISTOGRAM_SPLITS) -> list[Column]:
    """One counting aggregate per bin, ``bin1`` and up. NaN must be NULL already."""
    points = _checked(splits)
    inside = [
        value < points[0],
        *[(value >= low) & (value < high) for low, high in pairwise(points)],
        value >= points[-1],
    ]
    return [F.count_if(condition).cast("double").alias(f"bin{i}") for i, condition in enumerate(inside, 1)]


def histogram(df: DataFrame, keys: Sequence[str], splits: Sequence[float], value: str = "value") -> DataFrame:
    """``keys, samples, histogram ARRAY<DOUBLE>`` with all ``m + 1`` bins per key.

    One aggregation with map-side combining for any number of splits, on tables and
    streams alike.
    """
    points = _checked(splits)
    v = F.col(value)
    # The bin of a row is found once, by bisection; every bin has its counter.
    binned = df.withColumn("_bin", bin_index(v, points))
    counters = [F.count_if(F.col("_bin") == i).cast("double") for i in range(len(points) + 1)]
    return binned.groupBy(*keys).agg(
        F.count("_bin").alias("samples"),
        F.array(*counters).alias("histogram"),
    )


def histogram_rows(df: DataFrame, splits: Sequence[float], array: str = "histogram") -> DataFrame:
    """Unfold an array histogram to one row per bin with its bounds (NULL = open)."""
    points = [None, *_checked(splits), None]
    bounds = F.array(*[F.lit(p).cast("double") for p in points])
    others = [c for c in df.columns if c != array]
    return df.select(*others, F.posexplode(array).alias("bin", "n")).select(
        *others,
        "bin",
        F.get(bounds, F.col("bin")).alias("lower"),
        F.get(bounds, F.col("bin") + 1).alias("upper"),
        "n",
    )
