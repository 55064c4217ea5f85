"""Rows that a windowed aggregation drops as late, put aside with the watermark they missed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from signalstats.functions.windows import MINUTE_MS, event_window_start
from signalstats.streaming.pipeline import writer

#: Ledger folders used in turn: a trigger that runs again finds the one before untouched.
_SLOTS = 4
_LEDGER = "number BIGINT, before BIGINT, through BIGINT"


def late_rows_to_table(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    minutes: int,
    watermark_minutes: int,
    closes: str = "start",
    name: str | None = None,
    every: str | None = None,
    drain: bool = True,
) -> StreamingQuery:
    """Write the late ones of a stream of metric rows below ``path``, one folder per trigger.

    The rule is that of ``pipeline.window_statistics`` with the same parameters: a row is
    late when its window was closed by the watermark with which the trigger *before* ran,
    so by the rows up to two triggers ago. The table has the columns of ``rows`` and
    ``watermark`` (epoch ms), the partition column ``batch`` is the trigger.

    The query reads the source on its own and keeps no state but two numbers: a ledger of
    the latest window start before and through each trigger. Each trigger is one pass that
    finds its own latest start while it writes. Its triggers agree with those of the
    aggregation when both drain a source with the same rate limit; of two queries that run
    freely, one may see a row a trigger earlier, so that their decisions differ for rows that
    arrive just when a window closes. ``progress_rows`` has the aggregation's own count.
    """
    if closes not in ("start", "end"):
        raise ValueError(f"a window closes at its start or its end, not at {closes!r}")
    spark = rows.sparkSession
    delay = watermark_minutes * MINUTE_MS
    start = event_window_start(F.col("event_time"), minutes)
    closing = start if closes == "start" else start + minutes * MINUTE_MS

    def slot(batch: int) -> str:
        return f"{path}/ledger/slot={batch % _SLOTS}"

    def through(batch: int) -> tuple[int | None, int | None]:
        """Latest window start before and through a trigger."""
        if batch < 0:
            return None, None
        row = spark.read.schema(_LEDGER).parquet(slot(batch)).where(F.col("number") == batch).first()
        return (row.before, row.through) if row else (None, None)

    def put_aside(batch_rows: DataFrame, batch: int) -> None:
        before, so_far = through(batch - 1)
        aside = f"{path}/rows/batch={batch}"
        if before is None:  # nothing can be late yet
            own = batch_rows.agg(F.max(start)).first()[0]
            batch_rows.where(F.lit(False)).withColumn("watermark", F.lit(None).cast("bigint")).write.mode(
                "overwrite"
            ).parquet(aside)
        else:
            seen, bound = Observation(), F.lit(before - delay)
            watched = batch_rows.observe(seen, F.max(start).alias("latest"))
            watched.where(closing <= bound).withColumn("watermark", bound).write.mode("overwrite").parquet(aside)
            own = seen.get["latest"]
        latest = [x for x in (so_far, own) if x is not None]
        spark.createDataFrame([(batch, so_far, max(latest, default=None))], _LEDGER).coalesce(1).write.mode(
            "overwrite"
        ).parquet(slot(batch))

    return writer(rows, "append", checkpoint, name, every, drain).foreachBatch(put_aside).start()


def late_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table that :func:`late_rows_to_table` has written; ``schema`` is that of its rows."""
    more = [T.StructField(name, T.LongType()) for name in ("watermark", "batch")]
    return spark.read.schema(T.StructType([*schema.fields, *more])).parquet(f"{path}/rows")
