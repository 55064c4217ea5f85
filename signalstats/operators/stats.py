"""Aggregate rows: samples, min, percentiles, max, mean, sd, variance, histogram.

Two steps. :func:`aggregate` makes one *mergeable* row per key (counts, moments
and a quantile sketch); :func:`finalize` turns it into the rounded statistics.
The first is a single group-by whose map side already combines, so at most one
row per key and task is shuffled however many rows the key has; the second is a
projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalstats.functions.numeric import round_half_up
from signalstats.model import HISTOGRAM_SPLITS, PERCENTILES, SKETCH_K
from signalstats.operators.histogram import bin_counts
from signalstats.operators.quantiles import exact_percentiles, sketch, sketch_quantiles

STATS = ("min", *PERCENTILES, "max", "mean", "sd", "variance")
BINS = tuple(f"bin{i}" for i in range(1, len(HISTOGRAM_SPLITS) + 2))
PARTIAL = ("samples", "min", "max", "mean", "variance", "sketch", *BINS)

# Left unset, not zero, when a key has only NaN values.
_UNSET_WHEN_EMPTY = "p90"


def aggregates(value: Column, k: int = SKETCH_K, with_sketch: bool = True) -> list[Column]:
    """The aggregate columns of a mergeable row. NaN values are not counted."""
    known = F.when(~F.isnan(value), value)
    return [
        F.count(known).alias("samples"),
        F.min(known).alias("min"),
        F.max(known).alias("max"),
        F.avg(known).alias("mean"),
        F.var_samp(known).alias("variance"),
        *([sketch(value, k).alias("sketch")] if with_sketch else []),
        *bin_counts(known),
    ]


def aggregate(df: DataFrame, keys: Sequence[str], value: str = "value", k: int = SKETCH_K) -> DataFrame:
    """One mergeable row per key; works on batch and streaming DataFrames."""
    return df.groupBy(*keys).agg(*aggregates(F.col(value), k))


def rounded(quantiles: dict[str, Column]) -> list[Column]:
    """The statistics columns, from the moments of the row and its quantiles."""
    stats = {**_moments(), **quantiles}
    empty = F.col("samples") == 0
    columns = []
    for name in STATS:
        instead = F.lit(None) if name == _UNSET_WHEN_EMPTY else F.lit(0.0)
        columns.append(F.when(empty, instead).otherwise(round_half_up(stats[name])).alias(name))
    return columns


def _settled(x: Column) -> Column:
    """Sums of doubles differ in their last bits with the order in which tasks
    combine. Nine decimals are enough to drop that, so that a retried or
    differently split job rounds ties at two decimals the same way."""
    return F.round(x, 9)


def _moments() -> dict[str, Column]:
    variance = F.coalesce(F.col("variance"), F.lit(0.0))
    return {
        "min": F.col("min"),
        "max": F.col("max"),
        "mean": _settled(F.col("mean")),
        "variance": _settled(variance),
        "sd": _settled(F.sqrt(variance)),
    }


def finalize(partial: DataFrame) -> DataFrame:
    """Mergeable rows to flat statistics, rounded to two decimals."""
    others = [c for c in partial.columns if c not in PARTIAL]
    # One call reads all percentiles from the sketch.
    found = sketch_quantiles(F.col("sketch"), list(PERCENTILES.values()), F.col("samples") > 0)
    read = partial.withColumn("_q", found)
    quantiles = {name: F.get("_q", F.lit(i)) for i, name in enumerate(PERCENTILES)}
    return read.select(
        *others,
        "samples",
        *rounded(quantiles),
        *BINS,
    )


def statistics(df: DataFrame, keys: Sequence[str], value: str = "value", k: int = SKETCH_K) -> DataFrame:
    """Flat statistics per key; percentiles are exact up to ``k`` values a key."""
    return finalize(aggregate(df, keys, value, k))


def exact_statistics(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Flat statistics with exact percentiles for keys of any size (batch only)."""
    moments = df.groupBy(F.struct(*keys).alias("key")).agg(*aggregates(F.col(value), with_sketch=False))
    percentiles = exact_percentiles(df, keys, value).select(F.struct(*keys).alias("key"), *PERCENTILES)
    quantiles = {name: F.col(name) for name in PERCENTILES}
    return moments.join(percentiles, "key", "left").select(
        "key.*",
        "samples",
        *rounded(quantiles),
        *BINS,
    )


def average_of(df: DataFrame, field: str, name: str | None = None) -> DataFrame:
    """Average of one (possibly nested) result field over the whole result."""
    return df.agg(F.avg(field).alias(name or f"avg_{field.replace('.', '_')}"))
