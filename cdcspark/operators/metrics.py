"""Counters over feeds and targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .apply import file_number

NO_COLUMN = "(no column)"


def events_by_op(feed: DataFrame, table: str = "tbl") -> DataFrame:
    return feed.groupBy(F.col(table).alias("tbl"), "op").agg(F.count(F.lit(1)).alias("events"))


def progress(feed: DataFrame, kept: Column, key: Column) -> DataFrame:
    """Per table: events read, synced and filtered, the key of the last event and its place."""
    place = F.struct(file_number("bfile"), "pos", "row_seq")
    return feed.groupBy("tbl").agg(F.count(F.lit(1)).alias("read"), F.count_if(kept).alias("synced"), F.count_if(~kept).alias("filtered"), F.max_by(key, place).alias("last_key"), F.max("pos").alias("last_pos"))


def deciding_column(cols: list[str]) -> Column:
    """Name of the first filter column with a value in the image that counts."""
    out = F.lit(NO_COLUMN)
    for c in reversed(cols):
        out = F.when(F.when(F.col("op") == "D", F.col(f"b_{c}")).otherwise(F.col(f"a_{c}")).isNotNull(), F.lit(c)).otherwise(out)
    return out


def filter_statistics(feed: DataFrame, plugin: str, cols: list[str], kept: Column) -> DataFrame:
    return feed.groupBy(F.lit(plugin).alias("plugin"), "tbl", deciding_column(cols).alias("column")).agg(F.count(F.lit(1)).alias("seen"), F.count_if(kept).alias("passed"), F.count_if(~kept).alias("filtered"))


def highest_place(feed: DataFrame, by: str = "tbl") -> DataFrame:
    top = F.max(F.struct(file_number("bfile").alias("n"), "pos", "bfile")).alias("m")
    return feed.groupBy(by).agg(top).select(by, F.col("m.bfile").alias("bfile"), F.col("m.pos").alias("pos"))


def key_range(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.min(key).alias("low"), F.max(key).alias("high"))


def rows_per_key(keys: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """For each wanted key how many target rows have it: 0, 1 or more."""
    n = target.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return keys.select(key).distinct().join(n, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def joined_text(df: DataFrame, by: str, column: str, sep: str = ",", distinct: bool = True) -> DataFrame:
    """Values of a group in order, joined."""
    word = "DISTINCT " if distinct else ""
    return df.groupBy(by).agg(F.expr(f"listagg({word}{column}, '{sep}') WITHIN GROUP (ORDER BY {column})").alias("joined"))


def first_samples(df: DataFrame, by: str, column: str, n: int) -> DataFrame:
    """Count per group and its first ``n`` values. Ranks are cut before gathering, so a group stays small."""
    from pyspark.sql import Window

    ranked = df.select(by, column).withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy(column)))
    few = ranked.filter(F.col("_r") <= n).groupBy(by).agg(F.array_join(F.array_sort(F.collect_list(column)), ",").alias("samples"))
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).join(few, by)
