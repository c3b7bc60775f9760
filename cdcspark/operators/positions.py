"""Positions of tables and streams: what was applied, where to go on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import cut, small
from .apply import file_number


def is_valid(p: DataFrame) -> DataFrame:
    """Without blank files and zero positions."""
    return p.filter((F.trim("bfile") != "") & (F.col("pos") > 0))


def latest(p: DataFrame) -> DataFrame:
    """The furthest position per (kind, key)."""
    top = F.max(F.struct(file_number("bfile").alias("n"), "pos", "bfile", "updated_at")).alias("m")
    return is_valid(p).groupBy("kind", "key").agg(top).select("kind", "key", F.col("m.bfile").alias("bfile"), F.col("m.pos").alias("pos"), F.col("m.updated_at").alias("updated_at"))


def lookup(p: DataFrame, kind: str, key: str) -> DataFrame:
    """The newest stored position of a key, whatever its case."""
    hit = p.filter((F.col("kind") == kind) & (F.lower("key") == key.lower()))
    return hit.groupBy("kind").agg(F.max_by("bfile", "updated_at").alias("bfile"), F.max_by("pos", "updated_at").alias("pos"))


def resume_point(p: DataFrame, furthest: bool = False) -> DataFrame:
    """Where to read on: the least position over tables (``furthest``: the greatest over all)."""
    v = latest(p) if furthest else latest(p).filter("kind = 'table'")
    s = F.struct(file_number("bfile").alias("n"), "pos", "bfile")
    return v.agg((F.max(s) if furthest else F.min(s)).alias("m")).select(F.col("m.bfile").alias("bfile"), F.col("m.pos").alias("pos"))


def skip_applied(feed: DataFrame, p: DataFrame) -> DataFrame:
    """Events beyond their table's position, the furthest whatever its case; snapshots and unknown tables pass.

    Of the positions only those of tables that the feed has are looked at, so that many positions of others do
    not make the feed itself go through an exchange by table.
    """
    tables = small(cut(feed.select(F.lower("tbl").alias("_t")).filter("_t is not null").distinct()))
    own = is_valid(p).filter("kind = 'table'").select(F.lower("key").alias("_t"), F.struct(file_number("bfile").alias("n"), F.col("pos").cast("long").alias("p")).alias("_at"))
    t = small(cut(own.join(tables, "_t", "left_semi").groupBy("_t").agg(F.max("_at").alias("_at"))))
    j = feed.join(t, F.lower(feed["tbl"]) == F.col("_t"), "left")
    new = F.col("_at").isNull() | (F.col("op") == "S") | (F.struct(file_number("bfile").alias("n"), F.col("pos").cast("long").alias("p")) > F.col("_at"))
    return j.filter(new).select(feed.columns)


def clamp(p: DataFrame, server_file: str, server_pos: int) -> DataFrame:
    """Positions not beyond the server's in the same file."""
    return p.withColumn("pos", F.when(F.col("bfile") == server_file, F.least("pos", F.lit(server_pos))).otherwise(F.col("pos")))


def lag(feed: DataFrame, p: DataFrame) -> DataFrame:
    """Per table the distance from the applied to the newest position, null over different files."""
    seen = feed.groupBy(F.lower("tbl").alias("tbl")).agg(F.max(F.struct(file_number("bfile").alias("n"), "pos", "bfile")).alias("m"))
    t = latest(p).filter("kind = 'table'").select(F.lower("key").alias("tbl"), F.col("bfile").alias("_f"), F.col("pos").alias("_p"))
    return seen.join(t, "tbl").select("tbl", F.when(F.col("m.bfile") == F.col("_f"), F.col("m.pos") - F.col("_p")).alias("lag"))
