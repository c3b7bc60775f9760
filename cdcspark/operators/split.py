"""Splitting a database by a filter column: dry runs and delete scripts, never run here."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import cut


def cleanup_targets(catalog: DataFrame, filter_cols: list[str]) -> DataFrame:
    """(tbl, column, reason): tables with exactly one filter column and a key; others with a reason."""
    match = F.lower("column").isin([c.lower() for c in filter_cols])
    t = catalog.groupBy("tbl").agg(F.count_if(match).alias("n"), F.max(F.when(match, F.col("column"))).alias("column"), F.count_if("is_pk").alias("keys"))
    reason = F.when(F.col("n") == 0, "no filter column").when(F.col("n") > 1, "matched multiple filter columns").when(F.col("keys") == 0, "no primary key")
    return t.select("tbl", F.when(reason.isNull(), F.col("column")).alias("column"), reason.alias("reason"))


def matching(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.filter(F.lower(F.col(column).cast("string")).isin([v.lower() for v in values]))


def dry_run(tables: dict[str, tuple[DataFrame, str]], values: list[str]) -> DataFrame:
    """(tbl, rows) of matching rows, one scan per table, and their sum as ``(total)``."""
    out = None
    for name, (df, column) in tables.items():
        part = matching(df, column, values).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("tbl"), "rows")
        out = part if out is None else out.unionByName(part)
    return out.unionByName(out.agg(F.sum("rows").alias("rows")).select(F.lit("(total)").alias("tbl"), "rows"))


def key_list(df: DataFrame, column: str, values: list[str], key: str) -> DataFrame:
    return matching(df, column, values).select(key).orderBy(key)


def delete_script(keys: DataFrame, key: str, table: str, batch: int = 1000) -> DataFrame:
    """(batch, sql): deletes of ``batch`` keys each (1 to 10000), by key order.

    Keys are range-partitioned; a row's number is its partition's offset plus its place in it, so no
    task sees all keys. The offsets are one count per partition.
    """
    size = min(max(batch, 1), 10_000)
    spark = keys.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    k = cut(keys.select(F.col(key).alias("_k")).repartitionByRange(parts, "_k").withColumn("_p", F.spark_partition_id()))  # once: its samples differ between runs
    bounds = k.groupBy("_p").agg(F.count(F.lit(1)).alias("n"), F.min("_k").alias("low"))
    first = F.coalesce(F.sum("n").over(Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bounds = F.broadcast(bounds.withColumn("_first", first).select("_p", "_first"))  # a row per partition
    n = F.col("_first") + F.row_number().over(Window.partitionBy("_p").orderBy("_k")) - 1
    batches = k.join(bounds, "_p").select("_k", F.floor(n / size).alias("batch")).groupBy("batch").agg(F.array_sort(F.collect_list("_k")).alias("ks"))
    quoted = F.array_join(F.transform("ks", lambda x: F.concat(F.lit("'"), F.replace(x.cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))), ", ")
    return batches.select("batch", F.concat(F.lit(f"DELETE FROM {table} WHERE {key} IN ("), quoted, F.lit(");")).alias("sql"))


def write_script(script: DataFrame, path: str, confirm: str, table: str) -> None:
    """Write the statements as text, only with the table's name as confirmation."""
    if confirm != table:
        raise ValueError(f"confirm with {table!r} to write its delete script")
    script.orderBy("batch").select("sql").write.text(path)


def check_plugins(names: list[str]) -> None:
    """A split must not run together with shifted keys."""
    if "Split" in names and "Plus" in names:
        raise ValueError("Split and Plus exclude each other")
