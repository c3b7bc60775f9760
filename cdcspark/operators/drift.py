"""Schema drift: type mapping, diff plans, safe widening, alignment, defaults and comments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integer types by width.
INTEGERS = ("tinyint", "smallint", "mediumint", "int", "bigint")

#: Spark type of each source base type; unsigned integers take one step more.
SPARK_TYPES = {"tinyint": "tinyint", "smallint": "smallint", "mediumint": "int", "int": "int", "bigint": "bigint", "boolean": "tinyint", "bit": "bigint", "float": "float", "double": "double", "date": "date", "time": "string", "datetime": "timestamp_ntz", "timestamp": "timestamp", "year": "smallint", "char": "string", "varchar": "string", "text": "string", "json": "string", "enum": "string", "set": "string", "binary": "binary", "varbinary": "binary", "blob": "binary"}
UNSIGNED = {"tinyint": "smallint", "smallint": "int", "mediumint": "int", "int": "bigint", "bigint": "decimal(20,0)"}


def token(c: str | Column) -> Column:
    """Lower case, integer display widths removed, single spaces."""
    t = F.lower(F.trim(c))
    t = F.regexp_replace(t, r"\b(tinyint|smallint|mediumint|int|integer|bigint)\s*\(\s*\d+\s*\)", "$1")
    return F.regexp_replace(F.regexp_replace(t, r"\binteger\b", "int"), r"\s+", " ")


def base(t: Column) -> Column:
    return F.regexp_extract(t, r"^([a-z]+)", 1)


def size(t: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(t, r"\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", group).try_cast("int"), F.lit(0))


def rank(t: Column) -> Column:
    """Width of an integer type, unsigned one step wider; null for others."""
    out = F.lit(None).cast("int")
    for i, n in enumerate(INTEGERS):
        out = F.when(base(t) == n, F.lit(2 * i)).otherwise(out)
    return out + F.when(t.contains("unsigned"), 1).otherwise(0)


def spark_type(c: str | Column) -> Column:
    """Spark type of a source type token."""
    t = token(c)
    out = F.lit("string")
    for n, s in SPARK_TYPES.items():
        out = F.when(base(t) == n, F.lit(s)).otherwise(out)
    for n, s in UNSIGNED.items():
        out = F.when((base(t) == n) & t.contains("unsigned"), F.lit(s)).otherwise(out)
    p, s = F.least(size(t, 1), F.lit(38)), F.least(size(t, 2), F.lit(38))
    return F.when(base(t).isin("decimal", "numeric"), F.concat(F.lit("decimal("), F.when(p > 0, p).otherwise(10).cast("string"), F.lit(","), s.cast("string"), F.lit(")"))).otherwise(out)


#: Types of the analytic store by the beginning of the source's; the first that fits.
STORE_TYPES = (("tinyint(1)", "BOOLEAN"), ("tinyint", "TINYINT"), ("smallint", "SMALLINT"), ("mediumint", "INT"), ("int", "INT"), ("bigint", "BIGINT"), ("float", "FLOAT"), ("double", "DOUBLE"), ("datetime", "DATETIME"), ("timestamp", "DATETIME"), ("date", "DATE"), ("time", "VARCHAR(32)"))


def store_type(c: str | Column) -> Column:
    """Type of the analytic store: decimals and bounded text keep their sizes, all else without one is text."""
    t = F.lower(F.trim(c))
    out = F.when(t.rlike("^(decimal|numeric|varchar|char)"), F.upper(t)).otherwise("STRING")
    for start, name in reversed(STORE_TYPES):
        out = F.when(t.startswith(start), name).otherwise(out)
    return out


def text_kind(t: Column, long_text: int = 512) -> Column:
    """Text types: their length, or a very large one for unbounded text."""
    bounded = base(t).isin("char", "varchar")
    return F.when(bounded & (size(t, 1) <= long_text), size(t, 1)).when(bounded | base(t).isin("text", "mediumtext", "longtext", "clob"), F.lit(1 << 30))


def widens(source: Column, target: Column) -> Column:
    """True where the target type must change to hold the source's: never narrows.

    Text needs text of its length (and of its padding), bytes need bytes, an integer a wider integer or
    any decimal, a decimal one of its digits, a timestamp a timestamp; a bit holds no number.
    """
    s, t = token(source), token(target)
    decimal = lambda x: base(x).isin("decimal", "numeric")
    binary = lambda x: base(x).isin("binary", "varbinary", "tinyblob", "blob", "mediumblob", "longblob")
    stamp = lambda x: base(x).isin("timestamp", "datetime")
    whole = lambda x: size(x, 1) - size(x, 2)
    padding = base(s).isin("char", "varchar") & base(t).isin("char", "varchar") & (base(s) != base(t))
    text = text_kind(t).isNull() | padding | (text_kind(s) > text_kind(t))
    out = F.when(text_kind(s).isNotNull(), text).when(binary(s), ~binary(t))
    out = out.when(rank(s).isNotNull(), F.when(rank(t).isNotNull(), rank(s) > rank(t)).otherwise(~decimal(t)))
    out = out.when(decimal(s), F.when(decimal(t), (whole(s) > whole(t)) | (size(s, 2) > size(t, 2))).otherwise(True))
    return F.coalesce(out.when(stamp(s), ~stamp(t)), F.lit(False))


def diff_plan(source: DataFrame, target: DataFrame) -> DataFrame:
    """(tbl, column, action) for catalogs (tbl, column, type, nullable, is_pk, generated)."""
    t = target.select("tbl", F.lower("column").alias("_c"), F.col("type").alias("_type"), F.col("nullable").alias("_null"))
    j = source.withColumn("_c", F.lower("column")).join(t, ["tbl", "_c"], "left")
    same = token("type") == token("_type")
    action = F.when(F.col("generated"), "SKIP").when(F.col("_type").isNull(), "ADD")
    action = action.when(~same & widens(F.col("type"), F.col("_type")), F.when(F.col("is_pk"), "BLOCKED").otherwise("MODIFY"))
    action = action.when(F.col("nullable") & ~F.col("_null"), F.when(F.col("is_pk"), "BLOCKED").otherwise("RELAX_NULL")).otherwise("KEEP")
    return j.select("tbl", "column", action.alias("action"))


def column_sets(source: DataFrame, target: DataFrame) -> DataFrame:
    """(tbl, columns, common, only_source, only_target) of every table of either catalog; names compare without case."""
    none = F.array().cast("array<string>")
    s, g = (df.groupBy("tbl").agg(F.collect_set(F.lower("column")).alias(n)) for df, n in ((source, "s"), (target, "g")))
    s, g = s.join(g, "tbl", "full_outer").select("tbl", F.coalesce("s", none).alias("s"), F.coalesce("g", none).alias("g")), None
    sets = {"columns": F.array_union("s", "g"), "common": F.array_intersect("s", "g"), "only_source": F.array_except("s", "g"), "only_target": F.array_except("g", "s")}
    return s.select("tbl", *[F.array_sort(c).alias(n) for n, c in sets.items()])


def align(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """The target's columns in its order: missing ones null, the others cast; names compare without case."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(have[n.lower()]) if n.lower() in have else F.lit(None)).cast(t).alias(n) for n, t in schema.items()])


def late_types(feed: DataFrame, known: list[str], place: Column) -> DataFrame:
    """(column, type) of image names outside the catalog, from the first non-null value; else string."""
    e = feed.select(F.explode("after").alias("column", "v"), place.alias("_at")).filter(~F.lower("column").isin([k.lower() for k in known]))
    first = e.groupBy(F.lower("column").alias("column")).agg(F.min_by("v", F.when(F.col("v").isNotNull(), F.col("_at"))).alias("v"))
    v = F.col("v")
    kind = F.when(v.isNull(), "string").when(v.rlike(r"^-?\d{1,18}$"), "bigint").when(v.rlike(r"^-?\d+\.\d+$"), "double").when(v.rlike(r"^\d{4}-\d\d-\d\d$"), "date").when(v.rlike(r"^\d{4}-\d\d-\d\d[ T]\d\d:\d\d:\d\d"), "timestamp").otherwise("string")
    return first.select("column", kind.alias("type"))


def merged_conflicts(catalog: DataFrame) -> DataFrame:
    """(tgt_db, tbl, versions): tables of one target on whose columns its sources disagree."""
    sig = catalog.groupBy("tgt_db", "tbl", "src_db").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", F.lower("column"), token("type"), F.col("is_pk").cast("string")))), ",").alias("sig"))
    return sig.groupBy("tgt_db", "tbl").agg(F.countDistinct("sig").alias("versions")).filter("versions > 1")


def plain_default(c: str | Column) -> Column:
    """Declared default without quotes, brackets and case of keywords."""
    t = F.regexp_replace(F.trim(c), r"^\((.*)\)$", "$1")
    t = F.regexp_replace(t, r"^'(.*)'$", "$1")
    low = F.lower(t)
    return F.when(low.isin("null", ""), F.lit(None)).when(low.rlike(r"^(now|current_timestamp)(\(\d*\))?$"), "current_timestamp").otherwise(t)


def changed(source: DataFrame, target: DataFrame, what: str, normal=lambda c: c) -> DataFrame:
    """(tbl, column, source, target) where a property of a column differs."""
    s, t = (df.select("tbl", F.lower("column").alias("column"), normal(F.col(what)).alias(n)) for df, n in ((source, "source"), (target, "target")))
    return s.join(t, ["tbl", "column"]).filter(~F.col("source").eqNullSafe(F.col("target")))
