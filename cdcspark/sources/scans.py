"""Snapshots, change feeds and catalogs as DataFrames."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.apply import file_number

ENVELOPE = "src_db string, tbl string, op string, before map<string,string>, after map<string,string>, bfile string, pos bigint, row_seq int, ts timestamp"


def snapshot(df: DataFrame, src_db: str, tbl: str) -> DataFrame:
    """Every row as an event of op S before all log places."""
    row = [F.col(c).alias(f"a_{c}") for c in df.columns]
    none = [F.lit(None).cast(t).alias(f"b_{c}") for c, t in df.dtypes]
    return df.select(F.lit(src_db).alias("src_db"), F.lit(tbl).alias("tbl"), F.lit("S").alias("op"), *none, *row, F.lit("").alias("bfile"), F.lit(0).cast("long").alias("pos"), F.lit(0).alias("row_seq"))


def snapshot_jdbc(spark: SparkSession, url: str, table: str, predicates: list[str], **options: str) -> DataFrame:
    """A table read in ranges side by side, a task for each predicate (see ``ranges.predicates``); needs the database's driver on the class path."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)


def page(df: DataFrame, key: str, after: object, n: int) -> DataFrame:
    """The next ``n`` rows after a key."""
    rest = df if after is None else df.filter(F.col(key) > F.lit(after))
    return rest.orderBy(key).limit(n)


def handover(snap: DataFrame, changes: DataFrame, bfile: str, pos: int) -> DataFrame:
    """Snapshot rows, then the changes after the place that was noted before the snapshot."""
    n = int("".join(c for c in bfile.rpartition(".")[2] if c.isdigit()) or 0)
    later = F.struct(file_number("bfile"), F.col("pos").cast("long")) > F.struct(F.lit(n).cast("long"), F.lit(pos).cast("long"))
    return snap.unionByName(changes.filter(later))


def select_tables(catalog: DataFrame, names: str = "*", prefixes: tuple[str, ...] = (), exclude: str | None = None, include: str | None = None) -> DataFrame:
    """Tables by ``*``/``all`` or a comma list; prefixes compare without case, patterns with it."""
    t = catalog.select("tbl").distinct()
    wanted = [x.strip().lower() for x in names.split(",") if x.strip()]
    if wanted not in (["*"], ["all"]):
        t = t.filter(F.lower("tbl").isin(wanted))
    for p in prefixes:
        t = t.filter(~F.lower("tbl").startswith(p.lower()))
    if exclude:
        t = t.filter(~F.col("tbl").rlike(exclude))
    return t.filter(F.col("tbl").rlike(include)) if include else t


def key_supported(kind: str | Column) -> Column:
    k = F.lower(kind)
    length = F.regexp_extract(k, r"char\((\d+)\)", 1).try_cast("int")
    return k.rlike(r"^(tiny|small|medium|big)?int") | (k.rlike(r"^(var)?char") & (F.coalesce(length, F.lit(1)) <= 512))


def classify_keys(catalog: DataFrame, schema_only: bool = True) -> DataFrame:
    """(tbl, class): ``cdc`` with one supported key column, else ``schema_only`` or ``skip``."""
    t = catalog.groupBy("tbl").agg(F.count_if("is_pk").alias("n"), F.count_if(F.col("is_pk") & key_supported("type")).alias("good"))
    return t.select("tbl", F.when((F.col("n") == 1) & (F.col("good") == 1), "cdc").otherwise("schema_only" if schema_only else "skip").alias("class"))


def without_related(tables: DataFrame, fks: DataFrame) -> DataFrame:
    """Tables on neither side of a foreign key."""
    child, parent = fks.select(F.col("child").alias("tbl")), fks.select(F.col("parent").alias("tbl"))
    return tables.join(child, "tbl", "left_anti").join(parent, "tbl", "left_anti")


def wrap_sample(df: DataFrame, key: str, start: object, n: int) -> DataFrame:
    """``n`` rows from ``start`` on, going on at the front when there are too few."""
    return df.orderBy(F.col(key) < F.lit(start), key).limit(n)


def random_start(df: DataFrame, key: str, seed: int) -> int | None:
    """A start between the least and greatest key, drawn from the seed."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    return low if low is None else int(low + random.Random(seed).random() * (high - low))


def index_catalog(rows: DataFrame) -> DataFrame:
    """(tbl, idx, columns, skip): index rows (tbl, idx, seq, column, kind, prefix) as column lists; kinds that have no meaning elsewhere with a reason."""
    why = F.when(F.upper("kind") != "BTREE", "not a BTREE index").when(F.col("column").isNull(), "expression index").when(F.col("prefix").isNotNull(), "prefix index")
    return rows.groupBy("tbl", "idx").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", F.coalesce("column", F.lit("?")).alias("c")))), lambda x: x["c"]), ",").alias("columns"), F.max(why).alias("skip"))


def fk_catalog(rows: DataFrame, selected: DataFrame) -> DataFrame:
    """(child, name, parent, columns, parents): foreign keys whose tables are both selected."""
    low = selected.select(F.lower("tbl").alias("_t"))
    r = rows.join(low, F.lower("child") == F.col("_t"), "left_semi").join(low, F.lower("parent") == F.col("_t"), "left_semi")
    cols = F.array_sort(F.collect_list(F.struct("seq", "column", "parent_column")))
    got = r.groupBy("child", "name", "parent").agg(cols.alias("c"))
    return got.select("child", "name", "parent", F.array_join(F.transform("c", lambda x: x["column"]), ",").alias("columns"), F.array_join(F.transform("c", lambda x: x["parent_column"]), ",").alias("parents"))


def comments(catalog: DataFrame, selected: DataFrame) -> DataFrame:
    return catalog.join(selected.select("tbl"), "tbl", "left_semi").select("tbl", F.coalesce("comment", F.lit("")).alias("comment"))
