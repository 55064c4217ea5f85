"""Optional removal of repeated events by id (off in the default plans)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalstats.functions.windows import DAY_MS
from signalstats.sources.ledger import LedgerTable


def drop_repeated(events: DataFrame, event_id: str = "event_id") -> DataFrame:
    """Keep one event per id; events without an id all stay.

    On a stream the events need a watermark, which bounds how long ids are
    remembered. In a batch the source is read once and repeated ids are combined
    before the shuffle, so an id repeated a million times costs one row per task; the
    one that stays is the smallest of its columns in their order. Events without an
    id get a number each, which spreads them.
    """
    others = [c for c in events.columns if c != event_id]
    if events.isStreaming:
        known = events.filter(F.col(event_id).isNotNull()).dropDuplicatesWithinWatermark([event_id])
        return known.unionByName(events.filter(F.col(event_id).isNull()))
    alone = F.when(F.col(event_id).isNull(), F.monotonically_increasing_id())
    numbered = events.select(F.col(event_id), alone.alias("_alone"), F.struct(*others).alias("_event"))
    kept = numbered.groupBy(event_id, "_alone").agg(F.min("_event").alias("_event"))
    return kept.select(*(F.col(c) if c == event_id else F.col(f"_event.{c}").alias(c) for c in events.columns))


class SeenEvents:
    """Ids of all events of a stream so far, to drop repeats however late they come.

    A repeated event carries the time of the first, so the index is cut into days of event
    time: a trigger reads the days of its own events and no others, however old the index
    is. An event without an id or time is never a repeat. ``keep`` is a function for
    ``foreachBatch``: it hands the new events of a trigger to ``sink`` and then adds their
    ids to the index. A trigger that runs again after a failure looks at the index as it was
    before it, and replaces what it has added; so ``sink`` gets the same events, once per run.
    """

    def __init__(
        self, spark: SparkSession, path: str, event_id: str = "event_id", event_time: str = "event_time", merge_every: int = 20
    ):
        self._id, self._time = event_id, event_time
        schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("day", T.LongType())])
        self._index = LedgerTable(spark, path, schema, ["id", "day"], F.col("day"), merge_every)

    def _day(self) -> Column:
        return F.floor(F.col(self._time) / F.lit(DAY_MS)).cast("bigint")

    def new_events(self, events: DataFrame, batch: int) -> DataFrame:
        """Events of a batch whose id no batch before it had; one per id."""
        once = drop_repeated(events, self._id).withColumn("_day", self._day())
        days = [str(r[0]) for r in once.select("_day").where("_day IS NOT NULL").distinct().collect()]
        seen = self._index.rows_before(batch, days).select(F.col("id").alias("_seen"), F.col("day").alias("_seen_day"))
        known = (F.col(self._id).cast("string") == F.col("_seen")) & (F.col("_day") == F.col("_seen_day"))
        return once.join(seen.distinct(), known, "left_anti").drop("_day")

    def keep(self, sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        def write(events: DataFrame, batch: int) -> None:
            new = self.new_events(events, batch).persist()
            try:
                sink(new, batch)
                ids = new.select(F.col(self._id).cast("string").alias("id"), self._day().alias("day"))
                self._index.write(ids.where("id IS NOT NULL AND day IS NOT NULL"), batch)
            finally:
                new.unpersist()

        return write
