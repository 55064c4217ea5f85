"""Roll stored aggregate rows up to longer windows or fewer dimensions.

Sketches, counts and moments all merge, so a 1 h table is built from the 5 min
table, and 1 d from 1 h, without reading the events again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalstats.functions.windows import event_window_start
from signalstats.model import SKETCH_K, WINDOW_MINUTES
from signalstats.operators.quantiles import merge_sketches
from signalstats.operators.stats import BINS


def roll_up(partial: DataFrame, keys: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """Merge mergeable rows (see ``stats.aggregate``) into one row per key.

    The variance of the union is the variance inside the rows plus that of their
    means around the mean of the key. That mean is found first, in a pass of its own
    over the stored rows, so values far from zero lose no digits.
    """
    key = F.struct(*keys)
    n = F.col("samples").cast("double")
    means = partial.groupBy(key.alias("_key")).agg(
        F.try_divide(F.sum(n * F.col("mean")), F.sum(n)).alias("_about")
    )
    offset = F.col("mean") - F.col("_about")
    inside = F.coalesce(F.col("variance"), F.lit(0.0)) * (n - 1)
    merged = (
        partial.withColumn("_key", key)
        .join(means, "_key")
        .groupBy("_key")
        .agg(
            F.sum("samples").alias("samples"),
            F.min("min").alias("min"),
            F.max("max").alias("max"),
            F.first("_about").alias("_about"),
            F.sum(n * offset).alias("_first"),
            F.sum(inside + n * offset * offset).alias("_second"),
            merge_sketches(F.col("sketch"), k).alias("sketch"),
            *[F.sum(b).alias(b) for b in BINS],
        )
    )
    total = F.col("samples").cast("double")
    # What rounding has left of the mean deviation, usually nothing.
    shift = F.try_divide("_first", total)
    spread = F.col("_second") - shift * F.col("_first")
    return merged.select(
        "_key.*",
        "samples",
        "min",
        "max",
        F.when(total > 0, F.col("_about") + shift).alias("mean"),
        F.when(total > 1, spread / (total - 1)).alias("variance"),
        "sketch",
        *BINS,
    )


def roll_up_windows(partial: DataFrame, minutes: int, keys: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """Merge ``window_start`` (epoch ms) rows into windows of ``minutes``.

    Windows are calendar-aligned, so that a longer window holds exactly the
    shorter ones inside it. The stored length (see ``batch.window_partials``) must
    divide the wanted one.
    """
    if 60 % minutes and minutes % 60:
        raise ValueError("window must divide an hour or be whole hours")
    stored = partial.schema["window_start"].metadata.get(WINDOW_MINUTES)
    if stored is None:
        raise ValueError("the rows do not tell the length of their windows")
    if minutes % stored:
        raise ValueError(f"windows of {stored} minutes do not nest in {minutes} minutes")
    if minutes <= 60:
        start = event_window_start(F.col("window_start"), minutes)
    else:
        start = F.col("window_start") - F.pmod("window_start", F.lit(minutes * 60_000))
    rolled = roll_up(partial.withColumn("window_start", start), keys, k)
    return rolled.withMetadata("window_start", {WINDOW_MINUTES: minutes})


def merge_parts(partial: DataFrame, keys: Sequence[str], order: str, k: int = SKETCH_K) -> DataFrame:
    """The same in one group-by, which a stream can do: for keys with a bounded number of
    mergeable rows, such as the hours of a day.

    Counts and moments of the rows of a key are listed and merged one after another by
    ``order``, a column that tells them apart; sketches and bins merge on their own.
    """
    moments = F.struct(F.col(order).alias("at"), "samples", "mean", "variance")
    merged = partial.groupBy(*keys).agg(
        F.array_sort(F.collect_list(moments)).alias("_parts"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        merge_sketches(F.col("sketch"), k).alias("sketch"),
        *[F.sum(b).alias(b) for b in BINS],
    )

    def joined(a: Column, part: Column) -> Column:
        n, more = a.n, part.samples.cast("double")
        total, apart = n + more, part.mean - a.mean
        inside = F.coalesce(part.variance, F.lit(0.0)) * (more - 1)
        both = F.struct(
            total.alias("n"),
            (a.mean + apart * more / total).alias("mean"),
            (a.spread + inside + apart * apart * n * more / total).alias("spread"),
        )
        alone = F.struct(more.alias("n"), part.mean.alias("mean"), inside.alias("spread"))
        return F.when(more == 0, a).when(n == 0, alone).otherwise(both)

    nothing = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("spread"))
    read = merged.withColumn("_all", F.aggregate("_parts", nothing, joined))
    return read.select(
        *keys,
        F.col("_all.n").cast("bigint").alias("samples"),
        "min",
        "max",
        F.when(F.col("_all.n") > 0, F.col("_all.mean")).alias("mean"),
        F.when(F.col("_all.n") > 1, F.col("_all.spread") / (F.col("_all.n") - 1)).alias("variance"),
        "sketch",
        *BINS,
    )
