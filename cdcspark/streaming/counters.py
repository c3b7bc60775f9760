"""Counters of a running stream: observed in each batch, folded once per batch."""

from __future__ import annotations

import threading
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

OPS = ("S", "I", "U", "D")


def observed(changes: DataFrame, name: str = "cdc", kept: Column | None = None, tables: tuple[str, ...] = ()) -> DataFrame:
    """``changes`` with counts of each batch: read, kept and filtered events by kind, for each of ``tables`` (all together without)."""
    kept = F.lit(True) if kept is None else F.coalesce(kept, F.lit(False))
    counts = [F.count_if((F.col("op") == o) & (F.lit(True) if t is None else F.lower("tbl") == t.lower()) & (kept if what == "kept" else F.lit(True))).alias(f"{what}:{t or ''}:{o}") for t in (tables or (None,)) for o in OPS for what in ("read", "kept")]
    return changes.observe(name, *counts)


class LiveCounters(StreamingQueryListener):
    """Totals over the batches of a stream that is ``observed``; a batch that runs again, after a failure or a new start, counts once."""

    def __init__(self, name: str = "cdc"):
        self.name, self.batches, self._lock = name, {}, threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            with self._lock:
                self.batches[str(event.progress.id), event.progress.batchId] = row.asDict()

    def onQueryTerminated(self, event) -> None:
        pass

    def wait(self, query, seconds: float = 30.0) -> None:
        """Until the last batch of a query that has ended was heard of: listeners hear of it a little later."""
        last, until = query.lastProgress, time.monotonic() + seconds
        while last is not None and (str(last.id), last.batchId) not in self.batches and time.monotonic() < until:
            time.sleep(0.05)

    def totals(self) -> list[tuple[str, str, int, int, int]]:
        """(tbl, op, read, kept, filtered) of what was seen; without tables ``tbl`` is empty."""
        out: dict[tuple[str, str], dict[str, int]] = {}
        with self._lock:
            for row in self.batches.values():
                for key, n in row.items():
                    what, tbl, op = key.split(":")
                    got = out.setdefault((tbl, op), {"read": 0, "kept": 0})
                    got[what] += n
        return sorted((t, o, x["read"], x["kept"], x["read"] - x["kept"]) for (t, o), x in out.items() if x["read"])

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.totals(), "tbl string, op string, read long, kept long, filtered long")
