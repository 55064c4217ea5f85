"""Keep streaming queries running."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


def run_forever(
    spark: SparkSession,
    start: Callable[[], object],
    max_restarts: int | None = None,
    pause: float = 5.0,
) -> int:
    """Start queries, wait, and start them again from their checkpoints after a failure.

    ``start`` starts one or more queries. Runs on the calling thread until a
    query ends without an error and gives the number of restarts. When one
    query fails, the others are stopped before all start again.
    """
    restarts = 0
    while True:
        start()
        try:
            spark.streams.awaitAnyTermination()
            return restarts
        except StreamingQueryException as failure:
            log.warning("streaming query failed: %s", failure)
            for query in spark.streams.active:
                log.warning("stopping %s, status %s", query.name, query.status)
                query.stop()
            # Without this, waiting would report the old failure at once.
            spark.streams.resetTerminated()
            if max_restarts is not None and restarts >= max_restarts:
                raise
            restarts += 1
            time.sleep(pause)
