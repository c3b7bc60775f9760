"""Ordered apply of row changes: last writer wins, partial updates, merges, replay safety.

A change row has ``op`` (S snapshot, I, U, D), the images as columns ``b_<name>`` and ``a_<name>``
and its place ``bfile``, ``pos``, ``row_seq``. ``key_ops`` turns changes into operations per key;
everything after works on those. Places compare by the number at the end of the file name, so
``log.999999`` comes before ``log.1000000``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACE = ("_file", "_pos", "_seq")


def file_number(name: str | Column) -> Column:
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(name, r"(\d+)$", 1), F.lit("")), F.lit("9" * 18)).cast("long"), F.lit(0))


def key_ops(feed: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(keys, kind U or D, values, place): a key change is a delete of the old and an upsert of the new key.

    The delete takes the even and the upsert the odd sequence number of the event's row. Rows with a
    null key are ignored.
    """
    place = lambda odd: [file_number("bfile").alias("_file"), F.col("pos").cast("long").alias("_pos"), (F.col("row_seq").cast("long") * 2 + odd).alias("_seq")]
    moved = F.lit(False)
    for k in keys:
        moved = moved | ~F.col(f"b_{k}").eqNullSafe(F.col(f"a_{k}"))
    gone = F.when((F.col("op") == "D") | ((F.col("op") == "U") & moved), F.struct(*[F.col(f"b_{k}").alias(k) for k in keys], F.lit("D").alias("kind"), *[F.lit(None).cast(feed.schema[f"a_{v}"].dataType).alias(v) for v in values], *place(0)))
    kept = F.when(F.col("op") != "D", F.struct(*[F.col(f"a_{k}").alias(k) for k in keys], F.lit("U").alias("kind"), *[F.col(f"a_{v}").alias(v) for v in values], *place(1)))
    ops = feed.select(F.explode(F.array(gone, kept)).alias("o")).filter("o is not null").select("o.*")
    return ops.dropna(subset=keys)


def compact(ops: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The last operation of each key, with its place; one shuffle, combined before it."""
    last = F.max_by(F.struct("kind", *values, *PLACE), F.struct(*PLACE)).alias("l")
    return ops.groupBy(*keys).agg(last).select(*keys, F.col("l.kind").alias("kind"), *[F.col(f"l.{c}").alias(c) for c in (*values, *PLACE)])


def current(ops: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Rows alive after all operations."""
    return compact(ops, keys, values).filter("kind = 'U'").select(*keys, *values)


def to_state(latest: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Compacted operations as state rows; deletes stay as tombstones."""
    return latest.select(*keys, *values, *PLACE, (F.col("kind") == "D").alias("_deleted"))


def as_ops(state: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """State rows as operations again."""
    return state.select(*keys, F.when(F.col("_deleted"), "D").otherwise("U").alias("kind"), *values, *PLACE)


def merge(state: DataFrame, latest: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """State after a compacted batch: a full outer join; the later place wins, so replays change nothing."""
    b = to_state(latest, keys, values)
    cols = [*values, *PLACE, "_deleted"]
    j = state.select(*keys, F.struct(*cols).alias("_s")).join(b.select(*keys, F.struct(*cols).alias("_b")), keys, "full_outer")
    newer = F.col("_b").isNotNull() & (F.col("_s").isNull() | (F.struct(*[F.col(f"_b.{c}") for c in PLACE]) > F.struct(*[F.col(f"_s.{c}") for c in PLACE])))
    return j.select(*keys, F.when(newer, F.col("_b")).otherwise(F.col("_s")).alias("r")).select(*keys, "r.*")


def alive(state: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    return state.filter("not _deleted").select(*keys, *values)


def expire_tombstones(state: DataFrame, before_file: int) -> DataFrame:
    """Forget deletes of log files before ``before_file``; later changes of those keys must not come late."""
    return state.filter(~F.col("_deleted") | (F.col("_file") >= before_file))


def upsert(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Replace by key, else insert; ``rows`` has one row per key. Key-only tables keep what they have.

    Rows with a null in their key are left out.
    """
    values = [c for c in target.columns if c not in keys]
    if not values:
        return target.unionByName(rows.select(*keys)).dropDuplicates(keys)
    rows = rows.dropna(subset=keys)  # a null key matches nothing and would be inserted anew each time
    j = target.select(*keys, F.struct(*values).alias("_t")).join(rows.select(*keys, F.struct(*values).alias("_r")), keys, "full_outer")
    return j.select(*keys, F.coalesce("_r", "_t").alias("r")).select(*keys, "r.*")


def upsert_counts(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """(updated, inserted): how many rows hit a key of the target and how many don't."""
    j = rows.select(*keys).join(target.select(*keys).withColumn("_hit", F.lit(True)), keys, "left")
    return j.agg(F.count_if("_hit").alias("updated"), F.count_if(F.col("_hit").isNull()).alias("inserted"))


def insert_missing(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Insert ignoring duplicates: rows of known keys change nothing."""
    return target.unionByName(rows.join(target, keys, "left_anti").dropDuplicates(keys))


def update_first(target: DataFrame, where: Column, order: list[Column], n: int, change: dict[str, Column], keys: list[str]) -> DataFrame:
    """Change the first ``n`` rows that meet ``where``, in an order; all other rows stay as they are."""
    first = target.filter(where).orderBy(*order).limit(n).select(*keys, F.lit(True).alias("_hit"))
    j = target.join(first, keys, "left")
    return j.select(*[F.when(F.col("_hit"), change[c]).otherwise(F.col(c)).alias(c) if c in change else F.col(c) for c in target.columns])


def insert_or_change(target: DataFrame, rows: DataFrame, keys: list[str], change: dict[str, Column]) -> DataFrame:
    """Insert rows of new keys; rows of known keys change the target's by ``change``.

    In ``change``, ``old`` and ``new`` are structs of the values that the target has and the row brings.
    """
    values = [c for c in target.columns if c not in keys]
    j = target.select(*keys, F.struct(*values).alias("old")).join(rows.dropna(subset=keys).select(*keys, F.struct(*values).alias("new")), keys, "full_outer")
    both = F.col("old").isNotNull() & F.col("new").isNotNull()
    kept = lambda c: F.coalesce(F.col("old"), F.col("new"))[c]
    return j.select(*keys, *[F.when(both, change[c]).otherwise(kept(c)).alias(c) if c in change else kept(c).alias(c) for c in values])


def delete_keys(target: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Delete by key; null keys match nothing."""
    return target.join(gone.select(*keys).dropna(), keys, "left_anti")


def replace_rows(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Delete the keys, then insert the rows."""
    return delete_keys(target, rows, keys).unionByName(rows)


def partial_ops(feed: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, kind, image, place) from map images ``before`` and ``after``: U rows hold only what changed.

    A key change deletes the old key and inserts the new one from ``before`` overlaid by ``after``
    (needs ``spark.sql.mapKeyDedupPolicy=LAST_WIN`` only where both have a name; done by filter here).
    """
    k = [F.col(f"before.{x}") for x in keys], [F.coalesce(F.col(f"after.{x}"), F.col(f"before.{x}")) for x in keys]
    moved = F.lit(False)
    for old, new in zip(*k, strict=True):
        moved = moved | (old.isNotNull() & (old != new))
    whole = F.map_concat(F.map_filter("before", lambda n, _: ~F.map_contains_key(F.col("after"), n)), F.col("after"))
    place = lambda odd: [file_number("bfile").alias("_file"), F.col("pos").cast("long").alias("_pos"), (F.col("row_seq").cast("long") * 2 + odd).alias("_seq")]
    empty = F.lit(None).cast("map<string,string>")
    gone = F.when((F.col("op") == "D") | ((F.col("op") == "U") & moved), F.struct(*[c.alias(n) for c, n in zip(k[0], keys, strict=True)], F.lit("D").alias("kind"), empty.alias("image"), *place(0)))
    put = F.when(F.col("op") != "D", F.struct(*[c.alias(n) for c, n in zip(k[1], keys, strict=True)], F.when((F.col("op") == "U") & ~moved, "P").otherwise("U").alias("kind"), F.when((F.col("op") == "U") & moved, whole).otherwise(F.col("after")).alias("image"), *place(1)))
    return feed.select(F.explode(F.array(gone, put)).alias("o")).filter("o is not null").select("o.*").dropna(subset=keys)


def apply_partial(ops: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Current rows: each column has its last value since the row was last inserted or deleted.

    One aggregation: full images and deletes set every column, patches (kind P) only those they
    hold; an explicit null is a value. A patch of an unknown key inserts it.
    """
    place = F.struct(*PLACE)
    each = [F.max_by(F.struct(F.col(f"image.{v}").alias("v")), F.when((F.col("kind") != "P") | F.map_contains_key(F.col("image"), F.lit(v)), place)).alias(v) for v in values]
    got = ops.groupBy(*keys).agg(F.max_by("kind", place).alias("kind"), *each)
    return got.filter("kind <> 'D'").select(*keys, *[F.col(f"{v}.v").alias(v) for v in values])


def apply_flagged(ops: DataFrame, keys: list[str], values: list[str], has: str = "has_") -> DataFrame:
    """``apply_partial`` for typed columns: a patch (kind P) holds a value where its flag ``has_<name>`` is set."""
    place = F.struct(*PLACE)
    each = [F.max_by(F.struct(F.col(v).alias("v")), F.when((F.col("kind") != "P") | F.col(f"{has}{v}"), place)).alias(v) for v in values]
    got = ops.groupBy(*keys).agg(F.max_by("kind", place).alias("kind"), *each)
    return got.filter("kind <> 'D'").select(*keys, *[F.col(f"{v}.v").alias(v) for v in values])


def drop_duplicates(feed: DataFrame) -> DataFrame:
    """One row per place of a table: a replayed stretch of the log counts once. Snapshot rows have no place and stay."""
    live = feed.filter("op <> 'S'").dropDuplicates(["src_db", "tbl", "bfile", "pos", "row_seq"])
    return feed.filter("op = 'S'").unionByName(live)


def op_coded(feed: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Append rows for stores that take ``__op``: 0 with all values, 1 with the key alone."""
    gone = F.col("op") == "D"
    return feed.select(*[F.coalesce(F.when(gone, F.col(f"b_{k}")), F.col(f"a_{k}"), F.col(f"b_{k}")).alias(k) for k in keys], *[F.when(~gone, F.col(f"a_{v}")).alias(v) for v in values], F.when(gone, 1).otherwise(0).alias("__op"))


def documents(latest: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Compacted operations for a search index: (key, kind, doc as JSON; null for deletes)."""
    body = F.to_json(F.struct(*keys, *values), {"ignoreNullFields": "false"})
    return latest.select(*keys, "kind", F.when(F.col("kind") == "U", body).alias("doc"))


def update_from(target: DataFrame, source: DataFrame, on: list[str], sets: dict[str, str], where: Column | None = None) -> DataFrame:
    """UPDATE ... JOIN: rows of ``target`` with a partner take its columns; two partners are an error."""
    s = source if where is None else source.filter(where)
    one = s.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(f"_new_{t}") for t, c in sets.items()])
    j = target.join(one, on, "left")
    checked = F.when(F.col("_n") > 1, F.raise_error(F.lit("more than one row to update from"))).otherwise(F.col("_n"))
    j = j.withColumn("_n", checked)
    return j.select(*[F.when(F.col("_n").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in sets else F.col(c) for c in target.columns])
