"""Quantile sketches as BINARY columns, and exact quantiles.

Quantile convention: the value at 0-based sorted position
``min(floor(p * n), n - 1)``. Spark's sketches return the ``ceil(p * n)``-th
value instead, which differs whenever ``p * n`` is whole (median of 1, 2, 3, 4:
3 here, 2 there), so ranks are asked for just above ``p``. The step has to
survive the sketch's rounding of ``p * n`` to seven decimals at two values, and
must not reach the next position at ``SKETCH_K`` values.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalstats.model import PERCENTILES, SKETCH_K

_ABOVE = 1e-7


def rank_above(p: float) -> float:
    """The rank to ask a sketch for, see above."""
    if not 0.0 <= p <= 1.0:
        raise ValueError(f"rank out of [0, 1]: {p}")
    return min(p + _ABOVE, 1.0)


# -- sketches ---------------------------------------------------------------


def sketch(value: Column, k: int = SKETCH_K) -> Column:
    """Aggregate: quantile sketch of a DOUBLE column (NaN and NULL are skipped)."""
    return F.kll_sketch_agg_double(F.when(~F.isnan(value), value), F.lit(k))


def merge_sketches(sketches: Column, k: int = SKETCH_K) -> Column:
    """Aggregate: union of a column of sketches."""
    return F.kll_merge_agg_double(sketches, F.lit(k))


def union(left: Column, right: Column) -> Column:
    """Union of two sketch columns of the same row."""
    return F.kll_sketch_merge_double(left, right)


def sketch_size(sketch: Column) -> Column:
    return F.kll_sketch_get_n_double(sketch)


def sketch_quantiles(sketch: Column, ps: Sequence[float], filled: Column | None = None) -> Column:
    """``ARRAY<DOUBLE>`` of the values at the given ranks, NULL for an empty sketch.

    ``filled`` says whether the sketch holds values, where the row knows already.
    """
    ranks = F.array(*[F.lit(rank_above(p)) for p in ps])
    known = sketch_size(sketch) > 0 if filled is None else filled
    return F.when(known, F.kll_sketch_get_quantile_double(sketch, ranks))


def sketch_min(sketch: Column) -> Column:
    return F.get(sketch_quantiles(sketch, [0.0]), F.lit(0))


def sketch_max(sketch: Column) -> Column:
    return F.get(sketch_quantiles(sketch, [1.0]), F.lit(0))


def evenly_spaced(sketch: Column, points: int) -> Column:
    """Quantile curve at ``i / (points - 1)``, from the minimum to the maximum."""
    if points < 2:
        raise ValueError("a curve needs two points or more")
    return sketch_quantiles(sketch, [i / (points - 1) for i in range(points)])


def sketch_histogram(sketch: Column, splits: Sequence[float]) -> Column:
    """``ARRAY<DOUBLE>`` of bin masses times the size: a histogram without the rows.

    Spark's rank counts values up to and including the split; the next lower
    double makes the bins closed on the left.
    """
    below = [math.nextafter(float(s), -math.inf) for s in splits]
    ranks = F.kll_sketch_get_rank_double(sketch, F.array(*[F.lit(b) for b in below]))
    n = sketch_size(sketch).cast("double")
    edges = F.concat(F.array(F.lit(0.0)), ranks, F.array(F.lit(1.0)))
    masses = F.zip_with(F.slice(edges, 2, len(below) + 1), F.slice(edges, 1, len(below) + 1), lambda hi, lo: (hi - lo) * n)
    zeros = F.array(*[F.lit(0.0)] * (len(below) + 1))
    return F.when(sketch_size(sketch) > 0, masses).otherwise(zeros)


# -- exact quantiles --------------------------------------------------------

_CELL_BITS = 18
_CELLS = float(1 << _CELL_BITS)


def _cells(v: Column) -> list[Column]:
    """Three levels of cells that keep the order of doubles: sign and binary
    exponent, then 18 and 18 more bits of the fraction.

    Every step but the logarithm is exact, and that one is monotone, which is
    all the selection below needs. A third-level cell holds at most 2**16
    different doubles.
    """
    size = F.abs(v)
    exponent = F.least(F.floor(F.log2(size)), F.lit(1023))
    sign = F.when(v < 0, -1).otherwise(1)
    infinite = size == float("inf")
    top = F.when(v == 0, F.lit(0)).when(infinite, sign * 4000).otherwise(sign * (exponent + 1100))
    fraction = F.when((v == 0) | infinite, 0.0).otherwise(size / F.pow(F.lit(2.0), exponent) - 1) * _CELLS
    cells = [top, sign * F.floor(fraction), sign * F.floor((fraction - F.floor(fraction)) * _CELLS)]
    # Never NULL, and said so: else every join on a cell would push its own
    # not-null filter down to the scan and the counts could not be shared.
    return [F.coalesce(cell, F.lit(0).cast("long")) for cell in cells]


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str = "value",
    percentiles: Mapping[str, float] = PERCENTILES,
) -> DataFrame:
    """``keys`` + one exact percentile column each, for groups of any size.

    Selection by refinement: equal values are counted, the counts summed over cells of
    the double's exponent and first 18 bits of fraction, and the cell that holds each
    wanted position found from these sums. Only then are the values joined, by key and
    cell, with the cells they are wanted from. That join is the second and last
    shuffle of the values; a key's values are spread over 2**18 cells per exponent,
    and a value with a third of all rows is one row. Running sums go over at most
    2**18 cells, and the last one over at most 2**16 values.
    ``percentile_disc`` would hold all values of a key in one task.
    """
    v = F.col(value).cast("double")
    counts = (
        df.filter(v.isNotNull() & ~F.isnan(v))
        .groupBy(F.struct(*keys).alias("key"), v.alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumns({f"c{i}": cell for i, cell in enumerate(_cells(F.col("v")))})
    )
    cells = counts.groupBy("key", "c0", "c1").agg(F.sum("n").alias("n"))

    # Level 0: one row per (key, wanted percentile) with its cell and the
    # position that is left inside it.
    per_key = Window.partitionBy("key")
    running = per_key.orderBy("c0").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.col("total")
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("q"), F.least(F.floor(F.lit(p) * total), total - 1).alias("position"))
            for name, p in percentiles.items()
        ]
    )
    targets = (
        cells.groupBy("key", "c0")
        .agg(F.sum("n").alias("n"))
        .withColumn("upto", F.sum("n").over(running))
        .withColumn("total", F.sum("n").over(per_key))
        .select("key", "c0", "n", "upto", F.explode(wanted).alias("w"))
        .filter((F.col("w.position") >= F.col("upto") - F.col("n")) & (F.col("w.position") < F.col("upto")))
        .select("key", "c0", "w.q", (F.col("w.position") - F.col("upto") + F.col("n")).alias("position"))
    )

    def chosen(inside: DataFrame, step: str, found: Sequence[str]) -> DataFrame:
        """The cell (or value) of ``step`` that holds each position."""
        running = (
            Window.partitionBy("key", "q").orderBy(step).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        before = F.col("upto") - F.col("n")
        return (
            inside.withColumn("upto", F.sum("n").over(running))
            .filter((F.col("position") >= before) & (F.col("position") < F.col("upto")))
            .select("key", "q", *found, step, (F.col("position") - before).alias("position"))
        )

    # Level 1 on the sums; the values of the chosen cells; level 2 and the values on those.
    targets = chosen(cells.join(targets, ["key", "c0"]), "c1", ["c0"])
    inside = counts.join(targets, ["key", "c0", "c1"]).select("key", "q", "c2", "v", "n", "position")
    sums = inside.groupBy("key", "q", "c2", "position").agg(F.sum("n").alias("n"))
    within = chosen(sums, "c2", [])
    targets = chosen(inside.drop("position").join(within, ["key", "q", "c2"]), "v", [])

    picked = [F.max(F.when(F.col("q") == name, F.col("v"))).alias(name) for name in percentiles]
    return targets.groupBy("key").agg(*picked).select("key.*", *percentiles)
