"""Writers for ``foreachBatch`` and batch jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import apply


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def jdbc_stage(df: DataFrame, url: str, table: str, batch: int = 1024, **options: str) -> None:
    """Rows into a staging table; one set-based statement of the database takes them on from there."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch), truncate="true", **options).mode("overwrite").save()


def op_coded_json(feed: DataFrame, keys: list[str], values: list[str], path: str, omit_nulls: bool = True) -> None:
    """NDJSON with ``__op`` per row."""
    rows = apply.op_coded(feed, keys, values)
    rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": str(omit_nulls).lower()}).alias("value")).write.mode("append").text(path)


def search_index(latest: DataFrame, keys: list[str], values: list[str], path: str) -> None:
    """Documents and ids to delete, in two folders of NDJSON."""
    docs = apply.documents(latest, keys, values).persist()
    try:
        docs.filter("kind = 'U'").select("doc").write.mode("append").text(f"{path}/documents")
        docs.filter("kind = 'D'").select(F.to_json(F.struct(*keys))).write.mode("append").text(f"{path}/deleted")
    finally:
        docs.unpersist()
