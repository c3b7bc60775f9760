"""Checks that constraints of the source would have made: keys, orphans, cascades, apply order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import cut


def orphans(child: DataFrame, parent: DataFrame, child_cols: list[str], parent_cols: list[str]) -> DataFrame:
    """Child rows whose key has no parent; keys with a null are exempt."""
    if len(child_cols) != len(parent_cols):
        raise ValueError("child and parent keys differ in length")
    p = parent.select(*[F.col(b).alias(f"_p_{a}") for a, b in zip(child_cols, parent_cols, strict=True)])
    on = [child[a] == p[f"_p_{a}"] for a in child_cols]
    return child.dropna(subset=child_cols).join(p, on, "left_anti")


def duplicates(df: DataFrame, cols: list[str]) -> DataFrame:
    """Values of a unique index that several rows have; nulls are never equal."""
    return df.dropna(subset=cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def key_edges(links: list[tuple[str, DataFrame, str, str, str, str]]) -> DataFrame:
    """(ptbl, pkey, tbl, key, action): each row that refers to a parent. ``links``: (parent table, child frame, child table, child's foreign key, child's key, rule)."""
    out = None
    for parent, child, name, fk, key, rule in links:
        part = child.filter(F.col(fk).isNotNull()).select(F.lit(parent).alias("ptbl"), F.col(fk).alias("pkey"), F.lit(name).alias("tbl"), F.col(key).alias("key"), F.lit(rule).alias("action"))
        out = part if out is None else out.unionByName(part)
    return out


def cascade(deleted: DataFrame, links: list[tuple[str, DataFrame, str, str, str, str]], start: str) -> DataFrame:
    """(tbl, key, action): rows reached from deleted rows of ``start`` along foreign keys, of any depth.

    Links may form any graph, self-references and cycles included: each hop joins only the rows that the
    hop before was the first to reach, and ends when there are none. ``SET NULL`` reaches a row but not beyond it;
    a row that both rules reach is there with each. The deleted rows themselves are no result, but for
    those that a cycle reaches again.
    """
    edges = key_edges(links)
    front = deleted.select(F.lit(start).alias("ptbl"), F.col(deleted.columns[0]).alias("pkey")).distinct()
    reached = None
    while True:
        hit = edges.join(front, ["ptbl", "pkey"]).select("tbl", "key", "action").distinct()
        new = cut(hit if reached is None else hit.join(reached, ["tbl", "key", "action"], "left_anti"))
        if new.isEmpty():
            return new if reached is None else reached
        reached = new if reached is None else cut(reached.unionByName(new))
        front = new.filter("action = 'CASCADE'").select(F.col("tbl").alias("ptbl"), F.col("key").alias("pkey"))


def depths(rows: DataFrame, refs: DataFrame) -> DataFrame:
    """(tbl, key, depth): how many rows of ``rows`` stand above a row along its foreign keys; null on a cycle or below one.

    ``rows``: (tbl, key), ``refs``: (tbl, key, ptbl, pkey). References to rows that are not there, to the
    row itself, and null ones count nothing. Where each row has one parent at most, pointers are
    doubled: after k rounds a row knows its ancestor 2**k above, so a chain of n rows takes log2(n) rounds.
    Rows of several parents take their depth when the last parent has one, a round for each depth.
    """
    rows = cut(rows.select("tbl", "key").distinct())
    own = refs.select("tbl", "key", "ptbl", "pkey").filter("not (tbl = ptbl and key = pkey)").distinct()
    own = own.join(rows, ["tbl", "key"], "left_semi").join(rows.select(F.col("tbl").alias("ptbl"), F.col("key").alias("pkey")), ["ptbl", "pkey"], "left_semi")
    own = cut(own.select("tbl", "key", "ptbl", "pkey"))
    several = own.groupBy("tbl", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if several.isEmpty():
        return _doubled(rows, own)
    done = cut(rows.join(own, ["tbl", "key"], "left_anti").withColumn("depth", F.lit(0)))
    left = own
    while True:
        seen = left.join(done.select(F.col("tbl").alias("ptbl"), F.col("key").alias("pkey"), "depth"), ["ptbl", "pkey"], "left")
        state = seen.groupBy("tbl", "key").agg(F.bool_and(F.col("depth").isNotNull()).alias("free"), (F.max("depth") + 1).alias("depth"))
        new = cut(state.filter("free").select("tbl", "key", "depth"))
        if new.isEmpty():
            return done.unionByName(left.select("tbl", "key").distinct().withColumn("depth", F.lit(None).cast("int")))
        done = cut(done.unionByName(new))
        left = cut(left.join(new, ["tbl", "key"], "left_anti"))


def _doubled(rows: DataFrame, parent: DataFrame) -> DataFrame:
    """Depths in a forest: (ancestor, how far above) of each row, twice as far every round, until it has none.

    Only rows that others refer to take part in the rounds; every row then stands one below its parent.
    """
    inner = parent.select(F.col("ptbl").alias("tbl"), F.col("pkey").alias("key")).distinct()
    at = cut(inner.join(parent, ["tbl", "key"], "left").select("tbl", "key", F.when(F.col("ptbl").isNotNull(), F.struct("ptbl", "pkey")).alias("up"), F.col("ptbl").isNotNull().cast("int").alias("depth")))
    open_ = at.filter("up is not null").count()
    while open_:
        above = at.select(F.struct(F.col("tbl").alias("ptbl"), F.col("key").alias("pkey")).alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"))
        todo = at.filter("up is not null").join(above, "up").select("tbl", "key", F.col("_up").alias("up"), (F.col("depth") + F.col("_depth")).alias("depth"))
        at = cut(at.filter("up is null").unionByName(todo))
        before, open_ = open_, at.filter("up is not null").count()
        if open_ == before:  # each round but the last ends some chain, so all that is left goes round in a circle
            break
    above = at.select(F.col("tbl").alias("ptbl"), F.col("key").alias("pkey"), F.when(F.col("up").isNull(), F.col("depth") + 1).alias("depth"))
    return rows.join(parent, ["tbl", "key"], "left").join(above, ["ptbl", "pkey"], "left").select("tbl", "key", F.when(F.col("ptbl").isNull(), 0).otherwise(F.col("depth")).alias("depth"))


def waves(ops: DataFrame, refs: DataFrame) -> DataFrame:
    """(tbl, key, kind, wave): when each row of a batch may be written so that no foreign key is ever broken.

    ``ops``: (tbl, key, kind U or D), a row per key; ``refs``: (tbl, key, ptbl, pkey) of the images that are
    written or deleted. Parents' upserts come before their children's; when all upserts are done no row that
    stays refers to one that goes, and then deletes go out, children's before their parents'. Rows on
    a cycle, or below one, have no wave.
    """
    up = depths(ops.filter("kind = 'U'"), refs)
    down = depths(ops.filter("kind = 'D'"), refs)
    up, down = (cut(x) for x in (up, down))
    last, deepest = up.agg(F.coalesce(F.max("depth"), F.lit(-1))).first()[0], down.agg(F.coalesce(F.max("depth"), F.lit(-1))).first()[0]
    one = up.select("tbl", "key", F.lit("U").alias("kind"), F.col("depth").alias("wave"))
    return one.unionByName(down.select("tbl", "key", F.lit("D").alias("kind"), (F.lit(last + 1 + deepest) - F.col("depth")).alias("wave")))


def in_order(deletes: dict[str, DataFrame], upserts: dict[str, DataFrame], edges: list[tuple[str, str]], run) -> list[tuple[str, str]]:
    """Call ``run(action, table, rows)`` so that no key of ``edges`` (child, parent) is ever broken.

    Children's deletes come first, then parents' upserts before their children's; tables on a cycle
    come last. Returns the (action, table) pairs in their order.
    """
    order, cyclic = apply_order(sorted({*deletes, *upserts}), edges)
    order += cyclic
    todo = [("delete", t, deletes[t]) for t in reversed(order) if t in deletes] + [("upsert", t, upserts[t]) for t in order if t in upserts]
    for action, name, rows in todo:
        run(action, name, rows)
    return [(action, name) for action, name, _ in todo]


def referential_rules(usage: DataFrame, rules: DataFrame) -> DataFrame:
    """Constraint usage (child, name, ...) with each one's rules (child, name, on_delete, on_update), ``NO ACTION`` where none is told."""
    r = rules.select("child", "name", "on_delete", "on_update")
    j = usage.join(r, ["child", "name"], "left")
    return j.withColumns({c: F.coalesce(c, F.lit("NO ACTION")) for c in ("on_delete", "on_update")})


def apply_order(tables: list[str], edges: list[tuple[str, str]]) -> tuple[list[str], list[str]]:
    """Tables parents first, and those on a cycle. ``edges``: (child, parent); a few rows of a catalog."""
    left, order = set(tables), []
    while True:
        free = sorted(t for t in left if not any(c == t and p in left and p != t for c, p in edges))
        if not free:
            return order, sorted(left)
        order += free
        left -= set(free)
