"""A change log as a stream: files of JSON lines in the order of their numbers, read by places in them.

``ChangeLog`` is a Python data source. Its offset is a place (file, byte) in the log, a batch covers the bytes
between two places and is cut into partitions at line ends, and ``limit`` bounds the bytes of a batch, so a
stream that starts far behind catches up in steps. A stream that was stopped goes on at the place of its
checkpoint. Lines are parsed in Spark, not here. A line that is still being written (without its end) is left
for a later batch. Files only grow, and new ones have higher numbers.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .scans import ENVELOPE

LINES = "line string, file string, at long"
#: Bytes that one task reads.
SPLIT = 32 << 20


@dataclass
class Stretch(InputPartition):
    """Bytes ``begin`` to ``end`` of a file; both are places where a line begins."""

    path: str
    begin: int
    end: int


class Log:
    """The files of a folder in the order of the numbers in their names."""

    def __init__(self, path: str):
        self.path = path
        self.fs, self.root = pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")

    def files(self) -> list[tuple[str, int]]:
        """(name below the folder, bytes), in order."""
        infos = self.fs.get_file_info(pafs.FileSelector(self.root, recursive=True, allow_not_found=True))
        names = [(x.path[len(self.root) :].lstrip("/"), x.size) for x in infos if x.is_file and not x.base_name.startswith(("_", "."))]
        return sorted(names, key=lambda x: order(x[0]))

    def line_end(self, name: str, at: int, size: int) -> int:
        """The end of the last whole line that begins before ``at``, or of the first one after the file's begin if it is longer."""
        with self.fs.open_input_file(f"{self.root}/{name}") as f:
            while at < size:
                f.seek(max(at - 1, 0))
                block = f.read(1 << 16)
                found = block.find(b"\n")
                if found >= 0:
                    return max(at - 1, 0) + found + 1
                at += len(block)
            f.seek(0)
            at, low = size, max(0, size - (1 << 16))
            while at > 0:
                f.seek(low)
                found = f.read(at - low).rfind(b"\n")
                if found >= 0:
                    return low + found + 1
                at, low = low, max(0, low - (1 << 16))
        return 0

    def cut(self, name: str, begin: int, end: int, size: int) -> Iterator[Stretch]:
        while begin < end:
            stop = min(self.line_end(name, begin + SPLIT, size), end) if begin + SPLIT < end else end
            yield Stretch(f"{self.root}/{name}", begin, stop)
            begin = stop


def order(name: str) -> tuple:
    """Numbers in a file's name before the rest of it; of part files the one in their folder's name counts."""
    return [int(x) for x in re.findall(r"\d+", name.split("/part-")[0])], name


def lines(log: Log, part: Stretch | None) -> Iterator[pa.RecordBatch]:
    """(line, file, at) of a stretch, a batch for about a megabyte; an empty log has one without a stretch."""
    if part is None:
        return
    name = part.path[len(log.root) :].lstrip("/")
    with log.fs.open_input_file(part.path) as f:
        f.seek(part.begin)
        at, rest = part.begin, b""
        while at + len(rest) < part.end or rest:
            more = f.read(min(1 << 20, part.end - at - len(rest)))
            whole = rest + more
            stop = whole.rfind(b"\n") + 1 if more else len(whole)
            rest, whole = whole[stop:], whole[:stop]
            if not whole:
                continue
            each = whole.split(b"\n")[: -1 if whole.endswith(b"\n") else None]
            begin, places = at, []
            for x in each:
                places.append(begin)
                begin += len(x) + 1
            at += len(whole)
            if each:
                yield pa.RecordBatch.from_arrays([pa.array([x.decode() for x in each], pa.string()), pa.array([name] * len(each), pa.string()), pa.array(places, pa.int64())], ["line", "file", "at"])


class ChangeLog(DataSource):
    """``spark.read`` or ``spark.readStream`` with format ``changelog``; options: path, limit (bytes of a batch), progress (file that keeps the place behind a limit)."""

    @classmethod
    def name(cls) -> str:
        return "changelog"

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> DataSourceReader:
        return LogReader(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LogStreamReader(self.options["path"], int(self.options.get("limit", 0)), self.options.get("progress"))


class LogReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Stretch]:
        log = Log(self.path)
        return [p for name, size in log.files() for p in log.cut(name, 0, log.line_end(name, size, size), size)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return lines(Log(self.path), partition)


class LogStreamReader(DataSourceStreamReader):
    """Places as {"file", "at"}: everything before is read. An empty file name is the begin of the log."""

    def __init__(self, path: str, limit: int, progress: str | None):
        if limit and not progress:
            raise ValueError("a limit needs a progress file, so that a stream that starts again knows its place")
        self.path, self.limit, self.progress, self.last = path, limit, progress, None

    def initialOffset(self) -> dict:
        return {"file": "", "at": 0}

    def _place(self) -> dict:
        """Where the next batch begins at the latest: what was given out, or committed before a stop."""
        if self.last is None:
            log = Log(self.progress)
            known = log.fs.get_file_info(log.root).is_file
            self.last = json.loads(log.fs.open_input_file(log.root).read()) if known else self.initialOffset()
        return self.last

    def latestOffset(self) -> dict:
        log = Log(self.path)
        start = self._place() if self.limit else self.initialOffset()
        left, out = self.limit or None, start
        for name, size in log.files():
            if order(name) < order(start["file"]):
                continue
            begin = start["at"] if name == start["file"] else 0
            if left is not None and size - begin > left:
                end = log.line_end(name, begin + left, size)
            else:
                end = log.line_end(name, size, size)
            if end > begin:
                out = {"file": name, "at": end}
            if left is not None:
                left -= end - begin
                if left <= 0:
                    break
        self.last = out if self.limit else None
        return out

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        if self.limit and order(self._place()["file"]) <= order(end["file"]):
            self.last = max(self.last, end, key=lambda x: (order(x["file"]), x["at"]))
        log, out = Log(self.path), []
        for name, size in log.files():
            if order(start["file"]) <= order(name) <= order(end["file"]):
                begin = start["at"] if name == start["file"] else 0
                stop = end["at"] if name == end["file"] else log.line_end(name, size, size)
                out += log.cut(name, begin, stop, size)
        return out

    def commit(self, end: dict) -> None:
        if self.progress:
            log = Log(self.progress)
            log.fs.create_dir(log.root.rpartition("/")[0], recursive=True)
            with log.fs.open_output_stream(log.root) as f:
                f.write(json.dumps(end).encode())

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return lines(Log(self.path), partition)


def _parsed(raw: DataFrame, schema: str) -> DataFrame:
    return raw.select(F.from_json("line", schema).alias("e"), F.col("file").alias("log_file"), F.col("at").alias("log_at")).select("e.*", "log_file", "log_at")


def change_log(spark: SparkSession, path: str, schema: str = ENVELOPE) -> DataFrame:
    """All events of a log, each with its place (log_file, log_at)."""
    spark.dataSource.register(ChangeLog)
    return _parsed(spark.read.format("changelog").option("path", path).load(), schema)


def change_log_stream(spark: SparkSession, path: str, schema: str = ENVELOPE, limit: int = 0, progress: str | None = None) -> DataFrame:
    """The same as a stream; ``limit``: bytes of a batch at most (a longer line is a batch of its own)."""
    spark.dataSource.register(ChangeLog)
    reader = spark.readStream.format("changelog").option("path", path).option("limit", limit)
    return _parsed((reader.option("progress", progress) if progress else reader).load(), schema)


def write_log(feed: DataFrame, path: str) -> None:
    """A feed as a change log: a folder for each of its files, JSON lines in order of their places.

    Events of one place (a whole snapshot has one) are dealt over tasks by a hash of the event.
    """
    rows = feed.select(F.struct(*feed.columns).alias("r"), F.coalesce(F.nullif("bfile", F.lit("")), F.lit("log.000000")).alias("bfile"), "pos", "row_seq", F.xxhash64(*feed.columns).alias("h"))
    rows.repartitionByRange("bfile", "pos", "row_seq", "h").sortWithinPartitions("bfile", "pos", "row_seq").select("bfile", F.to_json("r").alias("value")).write.partitionBy("bfile").text(path)
