"""Column layouts of tables over the log: which one holds at a row's place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .apply import file_number
from .transforms import name_values

#: Log places that one segment of a table covers: its rows are sorted together, however many a table has.
SEGMENT = 1 << 26


def at_position(feed: DataFrame, layouts: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Rows of ``feed`` with the columns of the last layout of their table at or before their place, as struct ``layout``.

    ``layouts``: (tbl, bfile, pos, and any other columns); of two at one place the greater one counts, table names compare without
    case. Rows before the first layout get null. Nothing is joined by range: both sides are put together,
    cut into segments of the log by table, and the last layout is carried on, within a segment row by row
    and over segments by their last layouts. So a table with most rows is dealt over tasks by place.
    """
    own = [c for c in layouts.columns if c not in ("tbl", "bfile", "pos")]
    place = [file_number("bfile").alias("_file"), F.col("pos").cast("long").alias("_pos")]
    mine = layouts.select(F.lower("tbl").alias("_tbl"), *place, F.struct(*own).alias("layout"))
    mine = mine.groupBy("_tbl", "_file", "_pos").agg(F.max("layout").alias("layout"))
    rows = feed.select(F.lower("tbl").alias("_tbl"), *place, F.struct("*").alias("_row"))
    part = F.floor(F.col("_pos") / segment).alias("_part")
    both = mine.select("*", part, F.lit(None).cast(rows.schema["_row"].dataType).alias("_row")).unionByName(rows.select("_tbl", "_file", "_pos", "_row", part, F.lit(None).cast(mine.schema["layout"].dataType).alias("layout")))
    inside = Window.partitionBy("_tbl", "_file", "_part").orderBy("_pos", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("_here", F.last("layout", ignorenulls=True).over(inside)).filter("_row is not null")
    # what a segment begins with: the last layout of any segment before it; layouts are few, their segments fewer
    ends = mine.withColumn("_part", part).groupBy("_tbl", "_file", "_part").agg(F.max_by("layout", "_pos").alias("_last"))
    spots = rows.select("_tbl", "_file", part).distinct().join(ends, ["_tbl", "_file", "_part"], "full_outer")
    order = Window.partitionBy("_tbl").orderBy("_file", "_part").rowsBetween(Window.unboundedPreceding, -1)
    begin = spots.select("_tbl", "_file", "_part", F.last("_last", ignorenulls=True).over(order).alias("_begin"))
    out = seen.join(begin, ["_tbl", "_file", "_part"], "left")
    return out.select("_row.*", F.coalesce("_here", "_begin").alias("layout"))


def named(feed: DataFrame, layouts: DataFrame, values: str, segment: int = SEGMENT) -> DataFrame:
    """``feed`` with ``image``: its positional ``values`` under the names of the layout at its place.

    ``layouts`` have ``names`` and ``hidden``, places (from 1) whose values belong to no name. Rows without a
    layout have no image.
    """
    got = at_position(feed, layouts, segment)
    got = got.select(*feed.columns, F.col(values).alias("_v"), F.col("layout.names").alias("_n"), F.col("layout.hidden").alias("_h"))
    return got.select(*feed.columns, F.when(F.col("_n").isNotNull(), name_values("_v", "_n", "_h")).alias("image"))
