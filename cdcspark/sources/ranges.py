"""Key ranges of a snapshot that hold like numbers of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import cut

#: Rows of a sketch for each range: bounds are off by a range's hundredth at most.
ACCURACY = 100
WHOLE = ("tinyint", "smallint", "int", "bigint")


def _number(key: Column, prefix: Column) -> Column:
    """The six bytes of a text after ``prefix`` bytes as a number, in the order of the texts."""
    rest = F.substring(F.hex(key.cast("binary")), prefix * 2 + 1, F.lit(12))
    return F.conv(F.rpad(rest, 12, "0"), 16, 10).cast("bigint")


def _common(low: Column, high: Column) -> Column:
    """Bytes at the front that two texts share."""
    a, b = F.hex(low.cast("binary")), F.hex(high.cast("binary"))
    n = F.least(F.octet_length(low), F.octet_length(high))
    same = F.filter(F.sequence(F.lit(0), n), lambda i: F.substring(a, F.lit(1), i * 2) == F.substring(b, F.lit(1), i * 2))
    return F.array_max(same)


def equi_depth(df: DataFrame, key: str, n: int) -> DataFrame:
    """(part, low, high, rows): ranges (both ends included) of like numbers of rows in order of the key, about ``n`` of them.

    The bounds are quantiles of the keys, from sketches that each task makes and that are merged. Texts are put as
    numbers by the bytes after what all of a range share. A range that still has more than twice its share
    is cut again, texts by the bytes that come next, until it is small enough or holds one key only.
    Null keys are in no range.
    """
    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"))
    whole = dict(rows.dtypes)["key"] in WHOLE
    share = max(1, -(-rows.count() // n))
    todo, done = rows.withColumn("at", F.lit(0).cast("long")), None
    while True:
        if whole:  # sketches hold 53 bits: the distance from the range's first key, in steps of its size
            wide = F.max("key").cast("decimal(20)") - F.min("key").cast("decimal(20)")
            of = todo.groupBy("at").agg(F.min("key").alias("_from"), F.greatest(F.lit(1), F.ceil(wide / F.lit(1 << 52))).cast("decimal(20)").alias("_step"))
            x = F.floor((F.col("key").cast("decimal(20)") - F.col("_from")) / F.col("_step")).cast("bigint")
        else:
            of = todo.groupBy("at").agg(_common(F.min("key"), F.max("key")).alias("_skip"))
            x = _number(F.col("key"), F.col("_skip"))
        numbers = todo.join(F.broadcast(of), "at").withColumn("x", x)  # a row per range
        got = cut(_ranges(numbers.select("key", "at", "x"), share))
        large = (F.col("rows") > 2 * share) & (F.col("low") != F.col("high"))
        done = got.filter(~large) if done is None else done.unionByName(got.filter(~large))
        again = cut(got.filter(large).select(F.monotonically_increasing_id().alias("at"), "low", "high"))
        if again.isEmpty():
            return _numbered(done)
        # ranges do not meet: a row is in one of the few that are cut again
        todo = cut(rows.join(F.broadcast(again), (F.col("key") >= F.col("low")) & (F.col("key") <= F.col("high"))).select("key", "at"))


def _ranges(rows: DataFrame, share: int) -> DataFrame:
    """(low, high, rows) of the parts between quantiles of ``x``; ``rows``: (key, at, x), each ``at`` cut by itself.

    A number that is a bound more than once has a part of its own, so that what is left beside it is cut as well.
    """
    sizes = rows.groupBy("at").agg(F.count(F.lit(1)).alias("rows"))
    most = max(1, -(-(sizes.agg(F.max("rows")).first()[0] or 0) // share))
    marks = [k / most for k in range(1, most)]
    found = F.percentile_approx("x", marks, ACCURACY * most) if marks else F.array().cast("array<bigint>")
    bounds = rows.groupBy("at").agg(found.alias("_all"))
    twice = F.filter("_all", lambda b: F.size(F.filter("_all", lambda o: o == b)) > 1)
    bounds = bounds.select("at", F.array_distinct("_all").alias("_b"), F.array_distinct(twice).alias("_own"))
    j = rows.join(F.broadcast(bounds), "at")
    part = 2 * F.size(F.filter("_b", lambda b: b < F.col("x"))) + F.array_contains("_own", F.col("x")).cast("int")
    return j.groupBy("at", part.alias("_p")).agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("rows")).select("low", "high", "rows")


def _numbered(ranges: DataFrame) -> DataFrame:
    return ranges.select((F.row_number().over(Window.orderBy("low")) - 1).alias("part"), "low", "high", "rows")  # a row per range


def predicates(ranges: DataFrame, key: str) -> list[str]:
    """Conditions of the ranges in order, as a JDBC scan takes them: a task for each."""
    literal = lambda x: str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"
    return [f"{key} BETWEEN {literal(r.low)} AND {literal(r.high)}" for r in ranges.orderBy("part").collect()]  # a row per range
