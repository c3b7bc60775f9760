"""One pass over a batch, many targets: each row under its own target's columns, refused values kept aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.drift import spark_type

REJECTS = "_rejects"
#: Spark types whose texts are checked, and how a value that fits is written.
CHECKED = ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp")


def fits(value: Column, kind: Column) -> Column:
    """Whether a text is a value of the (Spark) type that a column names; null fits any."""
    out = F.lit(True)
    for t in CHECKED:
        out = F.when(kind == t, value.try_cast(t).isNotNull()).otherwise(out)
    out = F.when(kind.startswith("decimal"), value.try_cast("decimal(38,18)").isNotNull()).otherwise(out)
    return value.isNull() | out


def _quoted(text: Column) -> Column:
    """A text as a JSON string."""
    one = F.to_json(F.array(text))
    return F.substring(one, F.lit(2), F.length(one) - 2)


def written_as(value: Column, kind: Column) -> Column:
    """A text in JSON as the type has it: numbers without quotes, ``null`` for what is missing or does not fit."""
    number = F.when(kind.isin("float", "double"), value.try_cast("double").cast("string")).when(kind.startswith("decimal"), value.try_cast("decimal(38,18)").cast("string")).when(kind.isin("tinyint", "smallint", "int", "bigint"), value.try_cast("bigint").cast("string"))
    plain = number.isNotNull() & ~number.isin("NaN", "Infinity", "-Infinity")
    return F.when(value.isNull() | ~fits(value, kind), "null").when(plain, number).otherwise(_quoted(value))


def aligned(feed: DataFrame, columns: DataFrame, image: str = "after") -> DataFrame:
    """(feed, doc, bad): the image as JSON with the target's columns in its order, and the names of values that do not fit.

    ``columns``: (tgt_db, tbl, ordinal, column, type) of all targets, types of the source's dialect. Missing columns are null,
    names compare without case, names that the target lacks are left out. Rows of unknown targets have no ``doc``.
    """
    c = F.struct("ordinal", F.col("column").alias("name"), spark_type("type").alias("kind"))
    plan = columns.groupBy(F.lower("tgt_db").alias("_db"), F.lower("tbl").alias("_t")).agg(F.array_sort(F.collect_list(c)).alias("_plan"))
    j = feed.join(plan, (F.lower(feed["tgt_db"]) == F.col("_db")) & (F.lower(feed["tbl"]) == F.col("_t")), "left")
    low = F.map_from_entries(F.transform(F.map_entries(image), lambda e: F.struct(F.lower(e["key"]), e["value"])))
    j = j.withColumn("_low", low)
    pair = lambda x: F.concat(_quoted(x["name"]), F.lit(":"), written_as(F.col("_low")[F.lower(x["name"])], x["kind"]))
    doc = F.concat(F.lit("{"), F.array_join(F.transform("_plan", pair), ","), F.lit("}"))
    bad = F.transform(F.filter("_plan", lambda x: ~fits(F.col("_low")[F.lower(x["name"])], x["kind"])), lambda x: x["name"])
    return j.select(*feed.columns, doc.alias("doc"), bad.alias("bad"))


def write_targets(feed: DataFrame, columns: DataFrame, path: str, image: str = "after", buckets: int = 4) -> None:
    """A folder of JSON lines for each target, in one pass and one exchange by (target, bucket); no target lands in one task.

    Rows of unknown targets and those with a value that does not fit go whole to ``_rejects``, with the reason.
    """
    rows = aligned(feed, columns, image)
    reason = F.when(F.col("doc").isNull(), "unknown target").when(F.size("bad") > 0, F.concat(F.lit("does not fit: "), F.array_join("bad", ",")))
    whole = F.to_json(F.struct(reason.alias("reason"), *feed.columns))
    out = rows.select(F.when(reason.isNull(), F.lower("tgt_db")).otherwise(REJECTS).alias("target"), F.when(reason.isNull(), F.lower("tbl")).otherwise("rows").alias("name"), F.when(reason.isNull(), F.col("doc")).otherwise(whole).alias("value"))
    spread = F.pmod(F.xxhash64("value"), F.lit(buckets))
    out.repartition("target", "name", spread).write.mode("append").partitionBy("target", "name").text(path)


def read_target(spark: SparkSession, path: str, tgt_db: str, tbl: str, schema: str) -> DataFrame:
    """Rows of one target under its own schema."""
    return spark.read.schema(schema).json(f"{path}/target={tgt_db.lower()}/name={tbl.lower()}")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(reason, row as JSON) of what was refused."""
    rows = spark.read.text(f"{path}/target={REJECTS}/name=rows")
    return rows.select(F.get_json_object("value", "$.reason").alias("reason"), "value")
