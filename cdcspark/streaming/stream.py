"""Helpers around Structured Streaming: retry of batches, rates of changes."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Sink = Callable[[DataFrame, int], None]


def with_retry(sink: Sink, tries: int = 30, pause: float = 0.1, longest: float = 30.0) -> Sink:
    """Try a batch again with growing pauses; the last error is raised."""

    def run(df: DataFrame, batch: int) -> None:
        for k in range(tries):
            try:
                return sink(df, batch)
            except Exception:
                if k == tries - 1:
                    raise
                time.sleep(min(pause * 2**k, longest))

    return run


def change_rates(events: DataFrame, late: str = "10 minutes", width: str = "1 hour", by: str = "op") -> DataFrame:
    """Events per window and kind; rows later than the watermark are left out in streams."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", width), by).agg(F.count(F.lit(1)).alias("events"))
