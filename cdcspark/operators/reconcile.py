"""Source against target: comparison by kind, mismatch reports, digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import cut, shared_path

#: Most unequal buckets that are broadcast; more are joined.
MAX_BUCKETS = 100_000
NUMERIC = ("integer", "year", "decimal")
#: What a cast to double may read; other texts are not cast, and no unclosed JSON is parsed, as a failure costs far more than a look.
DOUBLE = r"(?i)^[\s\x00-\x20\x7f-\x9f]*[+-]?(nan|inf(inity)?|0x[0-9a-f.]+p[+-]?[0-9]+[df]?|[0-9.]+(e[+-]?[0-9]+)?[df]?)[\s\x00-\x20\x7f-\x9f]*$"
CLOSED = r"(?s)^\s*(\{.*\}|\[.*\]|[^\s{\[].*)\s*$"


def kind_of(type_token: str) -> str:
    """Compare kind of a source column type."""
    t = type_token.lower().split("(")[0].split()[0]
    for kind, names in (("integer", ("tinyint", "smallint", "mediumint", "int", "bigint", "bit")), ("decimal", ("decimal", "numeric")), ("float", ("float", "double")), ("char", ("char",)), ("binary", ("binary", "varbinary", "blob", "longblob", "mediumblob", "tinyblob"))):
        if t in names:
            return kind
    return t if t in ("year", "date", "time", "datetime", "timestamp", "json") else "text"


def column_plan(columns: list[tuple[str, str, bool]]) -> list[tuple[str, str]]:
    """(name, kind) of the columns to compare: (name, type, generated) without generated ones."""
    return [(n, kind_of(t)) for n, t, generated in columns if not generated]


def normalised(c: Column, kind: str) -> Column:
    if kind == "date":
        return F.split(c.cast("string"), "[ T]")[0]
    if kind in ("time", "datetime", "timestamp"):
        return F.regexp_replace(c.cast("string"), r"(\.\d*[1-9])0+$|\.0*$", "$1")
    if kind == "char":
        return F.rtrim(c)
    if kind == "json":
        return F.coalesce(F.when(c.rlike(CLOSED), F.to_json(F.try_parse_json(c))), c)  # text that is no JSON stays
    if kind == "binary":
        return F.hex(c)
    return c


def _with(value: Column, f) -> Column:
    """``f(value)``, with ``value`` computed once however often ``f`` names it."""
    return F.transform(F.array(value), f)[0]


def decimal_text(c: Column) -> Column:
    """One writing of a decimal number of any length: sign, digits without outer zeros, power of ten; null for other texts."""

    def text(t: Column) -> Column:
        power = F.when(t.contains("E"), F.regexp_extract(t, r"E([+-]?[0-9]+)", 1).try_cast("long")).otherwise(F.lit(0))
        return _with(F.regexp_extract(t, r"^[+-]?[0-9.]+", 0), lambda m: _with(F.ltrim(F.replace(m, F.lit("."), F.lit("")), F.lit("+-0")), lambda digits: _with(F.rtrim(digits, F.lit("0")), lambda short: F.when(short == "", "0").otherwise(
            F.concat(F.when(t.startswith("-"), "-").otherwise(""), short, F.lit("e"), (power - F.when(m.contains("."), F.length(m) - F.instr(m, ".")).otherwise(0) + F.length(digits) - F.length(short)).cast("string"))
        ))))

    return _with(F.upper(F.trim(c.cast("string"))), lambda t: F.when(t.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)(E[+-]?[0-9]{1,9})?$"), text(t)))


def _double(c: Column) -> Column:
    return F.when(c.cast("string").rlike(DOUBLE), c.try_cast("double"))


def equal(a: Column, b: Column, kind: str) -> Column:
    """True where both are null or equal by kind; never null.

    Equal texts are equal. Numbers are compared at their full length, and as floats only where a text
    is no decimal number.
    """
    text = a.cast("string") == b.cast("string")
    if kind in NUMERIC:
        same = _with(F.struct(decimal_text(a).alias("x"), decimal_text(b).alias("y")), lambda p: F.coalesce(p["x"] == p["y"], _double(a) == _double(b), F.lit(False)))
    elif kind == "float":
        x, y = a.try_cast("double"), b.try_cast("double")
        special = F.isnan(x) | F.isnan(y) | (F.abs(x) == float("inf")) | (F.abs(y) == float("inf"))
        same = F.when(special, x == y).otherwise(F.abs(x - y) <= F.greatest(F.abs(x), F.abs(y), F.lit(1.0)) * 1e-6)
    else:
        same = normalised(a, kind) == normalised(b, kind)
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).when(text, True).otherwise(F.coalesce(same, F.lit(False)))


def mismatches(source: DataFrame, target: DataFrame, table: str, key: str, plan: list[tuple[str, str]]) -> DataFrame:
    """(tbl, key, column, reason, source, target): one row per differing column, or per one-sided row."""
    cols = [n for n, _ in plan]
    j = source.select(key, F.struct(*cols).alias("_s")).join(target.select(key, F.struct(*cols).alias("_t")), key, "full_outer")
    s, t = (lambda n: F.col(f"_s.{n}")), (lambda n: F.col(f"_t.{n}"))
    both = F.col("_s").isNotNull() & F.col("_t").isNotNull()
    no = F.lit(None).cast("string")
    row = lambda c, r, a, b: F.struct(c.alias("column"), r.alias("reason"), a.alias("source"), b.alias("target"))
    reason = lambda n: F.when(s(n).isNull(), "source is NULL").when(t(n).isNull(), "target is NULL").otherwise("value differs")
    items = [F.when(F.col("_t").isNull(), row(no, F.lit("target row not found"), no, no)), F.when(F.col("_s").isNull(), row(no, F.lit("source row not found"), no, no))]
    items += [F.when(both & ~equal(s(n), t(n), k), row(F.lit(n), reason(n), s(n).cast("string"), t(n).cast("string"))) for n, k in plan]
    out = j.select(F.lit(table).alias("tbl"), F.col(key).cast("string").alias("key"), F.explode(F.array_compact(F.array(*items))).alias("m"))
    return out.select("tbl", "key", "m.*")


def sampled(source: DataFrame, target: DataFrame, sample: DataFrame, table: str, key: str, plan: list[tuple[str, str]]) -> DataFrame:
    """Mismatches of the sample's keys only."""
    k = sample.select(key).distinct()
    return mismatches(source.join(k, key, "left_semi"), target.join(k, key, "left_semi"), table, key, plan)


def summary(found: DataFrame) -> DataFrame:
    """Per table: mismatches and keys with one."""
    return found.groupBy("tbl").agg(F.count(F.lit(1)).alias("mismatches"), F.countDistinct("key").alias("keys"))


#: Characters and bytes of a chunk that large values are compared by.
TEXT_CHUNK, BYTES_CHUNK = 200, 1000


def large_differences(source: DataFrame, target: DataFrame, key: str, column: str) -> DataFrame:
    """(key, source_bytes, target_bytes, chunk, place): keys whose long values differ, with the first unequal chunk and place.

    Only lengths and a digest of each value are shuffled; of values that differ the digests of their chunks,
    and of the first chunk that differs the chunk itself. Places count characters of text and bytes of binary, from 0.
    A null is no value and is left to ``mismatches``.
    """
    binary = dict(source.dtypes)[column] == "binary"
    size = BYTES_CHUNK if binary else TEXT_CHUNK
    whole = lambda df, n: df.filter(F.col(column).isNotNull()).select(key, F.struct(F.octet_length(column).alias("n"), F.sha2(F.col(column).cast("binary"), 256).alias("h")).alias(n))
    both = whole(source, "_s").join(whole(target, "_t"), key).filter(~F.col("_s").eqNullSafe(F.col("_t")))
    both = cut(both.select(key, F.col("_s.n").alias("source_bytes"), F.col("_t.n").alias("target_bytes")))
    chunk = lambda i: F.substring(F.col(column), i * size + 1, F.lit(size))
    n_chunks = F.ceil(F.length(column) / size).cast("int")
    hashes = lambda df, n: df.join(both.select(key), key, "left_semi").select(key, F.transform(F.when(n_chunks > 0, F.sequence(F.lit(0), n_chunks - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.xxhash64(chunk(i))).alias(n))
    pairs = hashes(source, "_s").join(hashes(target, "_t"), key)
    first = F.array_position(F.transform(F.arrays_zip("_s", "_t"), lambda x: ~x["_s"].eqNullSafe(x["_t"])), True) - 1
    places = cut(pairs.select(key, first.cast("int").alias("chunk")))
    text = lambda df, n: df.join(places, key).select(key, "chunk", F.when(F.col("chunk") < n_chunks, chunk(F.col("chunk"))).otherwise(F.lit("").cast(dict(df.dtypes)[column])).alias(n))
    found = text(source, "_s").join(text(target, "_t"), [key, "chunk"])
    same = F.filter(F.sequence(F.lit(1), F.lit(size)), lambda i: (F.length(F.substring(F.col("_s"), i, F.lit(1))) == 0) | (F.length(F.substring(F.col("_t"), i, F.lit(1))) == 0) | (F.substring(F.col("_s"), i, F.lit(1)) != F.substring(F.col("_t"), i, F.lit(1))))
    place = (F.col("chunk") * size + F.get(same, 0) - 1).cast("long")
    return both.join(found.select(key, "chunk", place.alias("place")), key)


def preview(c: str, n: int = 500) -> Column:
    return F.concat(F.lit("len="), F.length(c).cast("string"), F.lit(" value="), F.substring(c, 1, n))


def comparable(c: Column, kind: str, same_type: bool) -> Column:
    """A value whose equality means that ``equal`` holds; the converse need not be true of numbers within a tolerance.

    Columns of one type are taken as they are where that is enough; of two types, a text that both write alike.
    """
    if kind in NUMERIC:
        return c if same_type else F.coalesce(decimal_text(c), c.cast("string"))
    if kind == "float":
        number = c.try_cast("double")
        return F.when(number.isNull() | F.isnan(number), c.cast("string")).otherwise((number + 0.0).cast("string"))
    return normalised(c, kind) if kind == "binary" else normalised(c, kind).cast("string")


#: Keys of a leaf of a digest tree, and nodes of a level that one of the level above covers.
LEAF, FAN = 64, 32
WHOLE = ("tinyint", "smallint", "int", "bigint")


def leaf_of(key: Column, numeric: bool, leaf: int = LEAF) -> Column:
    """The leaf of a key: a range of ``leaf`` whole numbers, or a range of hashes of other keys."""
    return F.floor(key / leaf) if numeric else F.shiftright(F.xxhash64(key), 32)


def leaves(df: DataFrame, key: str, plan: list[tuple[str, str]], other: DataFrame, leaf: int = LEAF) -> DataFrame:
    """(node, rows, low, high): order-free digests of the rows of each leaf, comparable with those of ``other``.

    A row's hash is over its normalised columns and a flag for each null, so no two rows are written alike;
    two sums of independent hashes are kept, so a node's digest is the sum of its children's.
    """
    mine, theirs = dict(df.dtypes), dict(other.dtypes)
    numeric = mine[key] in WHOLE and theirs[key] in WHOLE
    name = F.col(key).cast("long") if numeric else F.col(key) if mine[key] == theirs[key] else F.coalesce(decimal_text(F.col(key)), F.col(key).cast("string"))
    every = [name] + [x for c, k in plan for x in (F.col(c).isNull(), comparable(F.col(c), k, mine[c] == theirs[c]))]
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *every).cast("decimal(38,0)")).alias(("low", "high")[seed])
    return df.filter(F.col(key).isNotNull()).groupBy(leaf_of(name, numeric, leaf).alias("node")).agg(F.count(F.lit(1)).alias("rows"), total(0), total(1))


def level_above(level: DataFrame, fan: int = FAN) -> DataFrame:
    return level.groupBy(F.floor(F.col("node") / fan).alias("node")).agg(*[F.sum(c).alias(c) for c in ("rows", "low", "high")])


class DigestTree:
    """Digests of a table in levels, leaves first, kept beside it: ``path`` has a folder for each level.

    A level above has a ``fan``-th of the nodes, up to one with no more than ``fan``.
    """

    def __init__(self, spark: SparkSession, path: str, levels: int, fan: int = FAN):
        self.spark, self.path, self.levels, self.fan = spark, path.rstrip("/"), levels, fan

    @classmethod
    def write(cls, bottom: DataFrame, path: str, fan: int = FAN, levels: int | None = None) -> DigestTree:
        """Store the levels over the leaves ``bottom``: as many as needed, or ``levels`` to match another tree."""
        spark, n = bottom.sparkSession, 0
        level = bottom
        while True:
            level.repartitionByRange(max(1, min(64, spark.sparkContext.defaultParallelism)), "node").sortWithinPartitions("node").write.mode("overwrite").parquet(f"{path}/level={n}")
            level = spark.read.parquet(f"{path}/level={n}")
            n += 1
            if n == levels or (levels is None and level.count() <= fan):
                return cls(spark, path, n, fan)
            level = level_above(level, fan)

    def level(self, n: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/level={n}")

    def unequal(self, other: DigestTree, worth: float = 1.0) -> tuple[DataFrame, list[tuple[int, int, int]]]:
        """The leaves that differ, and (level, nodes looked at, nodes unequal), the top first: below a node that is equal nothing is read.

        On a level of which more than ``worth`` differs it ends, with that level's nodes.
        """
        report, bad = [], None
        for n in reversed(range(self.levels)):
            mine, theirs = (t.level(n).select("node", F.struct("rows", "low", "high").alias(c)) for t, c in ((self, "_s"), (other, "_t")))
            if bad is not None:
                up = bad.withColumnRenamed("node", "_up")
                mine, theirs = (x.join(up, F.floor(F.col("node") / self.fan) == F.col("_up"), "left_semi") for x in (mine, theirs))
            seen = mine.join(theirs, "node", "full_outer").select("node", (~F.col("_s").eqNullSafe(F.col("_t"))).alias("bad"))
            seen = cut(seen)
            looked, differ = seen.agg(F.count(F.lit(1)), F.count_if("bad")).first()
            report.append((n, looked, differ))
            bad = seen.filter("bad").select("node")
            if not differ or differ > worth * looked:
                break
        return bad, report


def trees(source: DataFrame, target: DataFrame, key: str, plan: list[tuple[str, str]], path: str, leaf: int = LEAF, fan: int = FAN) -> tuple[DigestTree, DigestTree]:
    """Digest trees of both tables, of the same height."""
    one = DigestTree.write(leaves(source, key, plan, target, leaf), f"{path}/source", fan)
    return one, DigestTree.write(leaves(target, key, plan, source, leaf), f"{path}/target", fan, one.levels)


def drill(source: DataFrame, target: DataFrame, table: str, key: str, plan: list[tuple[str, str]], path: str | None = None, leaf: int = LEAF, fan: int = FAN, both: tuple[DigestTree, DigestTree] | None = None, worth: float = 0.5) -> DataFrame:
    """What ``mismatches`` finds, looked for only below the nodes whose digests differ.

    ``path``: where the trees are stored (the shared folder by default), ``both``: trees stored before. Rows
    without a key are compared as they are. Unequal nodes are broadcast up to ``MAX_BUCKETS``, else joined.
    Where more than ``worth`` of a level differs, going down gains little: its nodes are compared whole.
    """
    one, two = both or trees(source, target, key, plan, path or shared_path(source.sparkSession, "digests"), leaf, fan)
    bad, report = one.unequal(two, worth)
    height, looked, differ = report[-1]
    if height == one.levels - 1 and differ > worth * looked:
        return mismatches(source, target, table, key, plan)
    few = F.broadcast(bad) if differ <= MAX_BUCKETS else bad
    numeric = all(dict(df.dtypes)[key] in WHOLE for df in (source, target))
    same = dict(source.dtypes)[key] == dict(target.dtypes)[key]
    name = F.col(key).cast("long") if numeric else F.col(key) if same else F.coalesce(decimal_text(F.col(key)), F.col(key).cast("string"))
    keep = lambda df: df.withColumn("_leaf", F.floor(leaf_of(name, numeric, leaf) / fan**height)).join(few.withColumnRenamed("node", "_leaf"), "_leaf", "left_semi").drop("_leaf").unionByName(df.filter(F.col(key).isNull()))
    return mismatches(keep(source), keep(target), table, key, plan)


def checked(tables: dict[str, tuple[DataFrame, DataFrame, str, list[tuple[str, str]]]]) -> DataFrame:
    """(tbl, rows, mismatches, keys, state): ``tables`` are name to (source, target, key, plan).

    ``rows``: compared ones of the source. A table without a mismatch is ``clean``, and one that the
    target lacks a column of is an ``error`` and not compared.
    """
    out = None
    for name, (source, target, key, plan) in tables.items():
        rows = source.agg(F.count(F.lit(1)).alias("rows"))
        if {key, *[n for n, _ in plan]} <= set(target.columns):
            found = mismatches(source, target, name, key, plan).agg(F.count(F.lit(1)).alias("mismatches"), F.countDistinct("key").alias("keys"))
            part = rows.join(F.broadcast(found)).withColumn("state", F.when(F.col("mismatches") == 0, "clean").otherwise("mismatch"))  # one row each
        else:
            part = rows.select("rows", F.lit(0).cast("long").alias("mismatches"), F.lit(0).cast("long").alias("keys"), F.lit("error").alias("state"))
        part = part.select(F.lit(name).alias("tbl"), "rows", "mismatches", "keys", "state")
        out = part if out is None else out.unionByName(part)
    return out
