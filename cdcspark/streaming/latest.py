"""The latest row of each key, kept in Spark's state store.

Without a retention the state is that of a streaming aggregation, the latest operation of each key and the time
of the batch that brought it; what this batch brought takes effect. No key costs a call to Python.

With one, deletes are to be forgotten one by one, which needs timers, and a processor in Python (some
hundreds of microseconds a key) takes the aggregation's place. A checkpoint belongs to one of the two forms.

``LatestRow`` is a stateful processor: per key it holds the row and its place, lets only later places through,
and remembers deletes as tombstones, so that an older change that comes late does not bring a row back.
A tombstone is forgotten some time after its delete, by a timer. State, timers and the offsets of the source
are in the stream's checkpoint; a stream that starts again goes on as if it had not stopped. The changes that
take effect are the stream's output, and a file sink writes each of them once.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from ..operators import apply

#: The provider that has timers and keeps state on disk.
PROVIDER = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class LatestRow(StatefulProcessor):
    """``retention``: milliseconds after which a delete is forgotten; none: never."""

    def __init__(self, keys: list[str], fields: StructType, retention: int | None):
        self.keys, self.fields, self.retention = keys, fields, retention
        self.names = [f.name for f in fields]
        self.kind = self.names.index("kind")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.row = handle.getValueState("row", self.fields)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        at = [self.names.index(c) for c in apply.PLACE]
        place = lambda r: tuple(r[i] for i in at)
        best = max((tuple(r)[len(self.keys) :] for r in rows), key=place)
        held = self.row.get() if self.row.exists() else None
        if held is not None and place(held) >= place(best):
            return
        self.row.update(best)
        if self.retention is not None and best[self.kind] == "D":
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.retention)
        yield Row(*self.keys, *self.names)(*key, *best)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.row.exists() and self.row.get()[self.kind] == "D":
            self.row.clear()
        yield from ()

    def close(self) -> None:
        pass


def latest_changes(ops: DataFrame, keys: list[str], values: list[str], retention: int | None = None) -> DataFrame:
    """Of a stream of operations per key (see ``key_ops``) those that take effect: later than all of their key before."""
    ops = ops.select(*keys, "kind", *values, *apply.PLACE)
    fields = StructType([f for f in ops.schema if f.name not in keys])
    return ops.groupBy(*keys).transformWithState(LatestRow(keys, fields, retention), ops.schema, "Append", "None" if retention is None else "ProcessingTime")


def aggregated_changes(ops: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The same in native state, for a sink in update mode. ``current_timestamp`` is one time for a whole batch; of equal places the first batch's stays."""
    ops = ops.select(*keys, "kind", *values, *apply.PLACE, F.unix_micros(F.current_timestamp()).alias("_came"))
    last = F.max_by(F.struct("kind", *values, *apply.PLACE, "_came"), F.struct(*apply.PLACE, -F.col("_came"))).alias("l")
    new = ops.groupBy(*keys).agg(last).filter(F.col("l._came") == F.unix_micros(F.current_timestamp()))
    return new.select(*keys, *[F.col(f"l.{c}").alias(c) for c in ("kind", *values, *apply.PLACE)])


def apply_stream(changes: DataFrame, keys: list[str], values: list[str], path: str, checkpoint: str, transform=lambda d: d, trigger: dict | None = None, retention: int | None = None) -> StreamingQuery:
    """Apply a stream of typed changes: the effective ones go to Parquet files at ``path``, each exactly once."""
    for name, value in PROVIDER.items():
        changes.sparkSession.conf.set(name, value)
    ops = apply.key_ops(transform(changes), keys, values)
    if retention is None:
        # a batch that is run again after a stop has its number again and replaces its files
        each = lambda df, batch: df.write.mode("overwrite").parquet(f"{path}/of_batch={batch}")
        out = aggregated_changes(ops, keys, values).writeStream.foreachBatch(each).outputMode("update")
    else:
        out = latest_changes(ops, keys, values, retention).writeStream.format("parquet").option("path", path).outputMode("append")
    return out.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def current_rows(spark: SparkSession, path: str, keys: list[str], values: list[str]) -> DataFrame:
    """Rows alive after all effective changes written so far."""
    return apply.compact(spark.read.parquet(path), keys, values).filter("kind = 'U'").select(*keys, *values)


def drain(start, progress=lambda: None) -> int:
    """Run a stream with ``availableNow`` again and again until a run finds nothing more; how many runs had rows.

    A source with a limit on its batches gives one batch a run.
    """
    runs = 0
    while True:
        query = start()
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        if not any(p.numInputRows for p in query.recentProgress):
            return runs
        runs += 1
        progress()
