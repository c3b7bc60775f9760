"""Per-event filters and transforms, each a DataFrame to DataFrame function."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import small

Transform = Callable[[DataFrame], DataFrame]

#: Target names that are reserved and take a trailing underscore.
RESERVED = ("rowid", "rownum", "level", "uid", "trxid", "versions_starttime", "versions_endtime", "versions_operation")


def image(side: str, cols: list[str]) -> Column:
    """The first non-null of the columns of one image (``b`` or ``a``), as text."""
    return F.coalesce(*[F.col(f"{side}_{c}").cast("string") for c in cols])


def keeps(side: str, cols: list[str], values: list[str]) -> Column:
    v = image(side, cols)
    return v.isNull() | F.lower(v).isin([x.lower() for x in values])


def column_in(cols: list[str], values: list[str], exact: bool = True) -> Transform:
    """Keep events whose deciding column (the first non-null one) has one of the values.

    With ``exact`` an update that leaves the filter becomes a delete and one that enters it an
    insert; without, updates are judged by the new image alone.
    """

    def run(df: DataFrame) -> DataFrame:
        before, after = keeps("b", cols, values), keeps("a", cols, values)
        if not exact:
            return df.filter(F.when(F.col("op") == "D", before).otherwise(after))
        op = F.when(F.col("op") == "D", F.when(before, "D")).when(F.col("op") != "U", F.when(after, F.col("op")))
        op = op.otherwise(F.when(before & after, "U").when(before, "D").when(after, "I"))
        out = df.withColumn("op", op).filter("op is not null")
        clear = lambda side, bad: {c: F.when(F.col("op") == bad, F.lit(None).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c in df.columns if c.startswith(side)}
        return out.withColumns(clear("a_", "D") | clear("b_", "I"))

    return run


def plus(table: str, column: str, amount: int) -> Transform:
    """Add to a column of a table in both images; null stays null."""

    def run(df: DataFrame) -> DataFrame:
        hit = F.lower("tbl") == table.lower()
        names = [c for c in df.columns if c.lower() in (f"b_{column.lower()}", f"a_{column.lower()}")]
        return df.withColumns({c: F.when(hit, F.col(c) + F.lit(amount)).otherwise(F.col(c)).cast(df.schema[c].dataType) for c in names})

    return run


def chain(*steps: Transform) -> Transform:
    return lambda df: reduce(DataFrame.transform, steps, df)


_registry: dict[str, Callable[..., Transform]] = {"ColumnIn": column_in, "Plus": plus}


def register_transform(name: str, factory: Callable[..., Transform]) -> None:
    """Make a transform available by name; it gets its configuration as keyword arguments."""
    _registry[name] = factory


def build_chain(config: list[tuple[str, dict]]) -> Transform:
    return chain(*(_registry[name](**args) for name, args in config))


def effective_key(key: str = "key") -> Column:
    return F.coalesce(F.col(f"a_{key}"), F.col(f"b_{key}"))


def route(df: DataFrame, routes: DataFrame) -> DataFrame:
    """Add ``tgt_db`` by the source database, whatever its case. ``routes`` is a row per source."""
    r = small(routes.select(F.lower("src_db").alias("_src"), "tgt_db"))
    return df.join(r, F.lower(df["src_db"]) == F.col("_src"), "left").drop("_src")


def route_errors(routes: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """(name, error): duplicate and unknown routes, sources without one, undeclared targets."""
    r, low = routes.select(F.lower("src_db").alias("name"), F.lower("tgt_db").alias("tgt")), lambda df: df.select(F.lower("db").alias("name")).distinct()
    s, t = low(sources), low(targets)
    twice = r.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name", F.lit("duplicate route").alias("error"))
    unknown = r.select("name").distinct().join(s, "name", "left_anti").withColumn("error", F.lit("unknown source"))
    missing = s.join(r, "name", "left_anti").withColumn("error", F.lit("no route"))
    nowhere = r.select(F.col("tgt").alias("name")).distinct().join(t, "name", "left_anti").withColumn("error", F.lit("undeclared target"))
    return twice.unionByName(unknown).unionByName(missing).unionByName(nowhere)


def dispatch(df: DataFrame, selected: DataFrame) -> DataFrame:
    """Events of selected (db, tbl) pairs; names compare without case."""
    s = small(selected.select(F.lower("db").alias("_d"), F.lower("tbl").alias("_t")))
    return df.join(s, (F.lower(df["src_db"]) == F.col("_d")) & (F.lower(df["tbl"]) == F.col("_t")), "left_semi")


def write_columns(source: DataFrame, target: DataFrame, seen: DataFrame) -> DataFrame:
    """(tbl, column): non-generated source columns that the target has, and those seen in events; by target name."""
    low = lambda df: df.select("tbl", F.lower("column").alias("column"))
    ordinary = low(source.filter("not generated")).join(low(target), ["tbl", "column"], "left_semi")
    extra = low(seen).join(low(target), ["tbl", "column"], "left_semi").join(low(source.filter("generated")), ["tbl", "column"], "left_anti")
    return ordinary.unionByName(extra).distinct()


def target_name(column: str | Column, reserved: tuple[str, ...] = RESERVED) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.when(F.lower(c).isin(list(reserved)), F.concat(c, F.lit("_"))).otherwise(c)


def name_clashes(columns: DataFrame, reserved: tuple[str, ...] = RESERVED) -> DataFrame:
    """(tbl, target, n) where two columns of a table get one target name."""
    return columns.groupBy("tbl", F.lower(target_name("column", reserved)).alias("target")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def lower_keys(map_col: str) -> Column:
    """A map with lower-case names; of two spellings the last one wins."""
    pairs = F.map_entries(map_col)
    low = F.transform(pairs, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(low, lambda e, i: ~F.exists(F.slice(low, i + 2, F.size(low)), lambda o: o["key"] == e["key"]))
    return F.map_from_entries(last)


def name_values(values: str, names: str, hidden: str) -> Column:
    """Positional values as a map: names at ``hidden`` places are skipped with their values; short rows are padded with null, long ones cut."""
    keep = F.filter(F.transform(F.col(names), lambda n, i: F.struct(n.alias("n"), i.alias("i"))), lambda x: ~F.array_contains(F.coalesce(F.col(hidden), F.array().cast("array<int>")), x["i"] + 1))
    return F.map_from_arrays(F.transform(keep, lambda x: x["n"]), F.transform(keep, lambda x: F.get(F.col(values), x["i"])))


def hidden_place(layouts: DataFrame) -> DataFrame:
    """(tbl, hidden): the one place of ``wire`` types to leave out so that they fit ``types`` best; null on ties.

    ``layouts``: a row per table layout with arrays ``types`` and ``wire``, one longer.
    """
    c = layouts.filter(F.size("wire") == F.size("types") + 1).select("tbl", "types", "wire", F.explode(F.sequence(F.lit(0), F.size("types"))).alias("at"))
    rest = F.filter("wire", lambda _, i: i != F.col("at"))
    score = F.aggregate(F.zip_with("types", rest, lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, x: s + x)
    best = c.select("tbl", "at", score.alias("score")).groupBy("tbl").agg(F.max("score").alias("top"), F.collect_list(F.struct("score", "at")).alias("all"))
    top = F.filter("all", lambda x: x["score"] == F.col("top"))
    return best.select("tbl", F.when(F.size(top) == 1, top[0]["at"] + 1).alias("hidden"))


#: What a required column gets when an event does not have it.
ZEROS = {"datetime": "1970-01-01 00:00:00", "timestamp": "1970-01-01 00:00:00", "date": "1970-01-01", "time": "00:00:00", "year": 0, "float": 0.0, "double": 0.0, "real": 0.0, "int": 0, "decimal": 0, "numeric": 0, "bit": 0, "bool": 0, "json": "{}"}


def zero_of(kind: str) -> str:
    """The zero of a type: of the first name that it contains, or an empty text."""
    return str(next((v for k, v in ZEROS.items() if k in kind.lower()), ""))


def fill_required(map_col: str, required: dict[str, str]) -> Column:
    """Map image with a typed zero for each required column that is absent; explicit nulls stay."""
    out = F.col(map_col)
    for name, kind in required.items():
        out = F.when(F.map_contains_key(F.col(map_col), F.lit(name)), out).otherwise(F.map_concat(out, F.create_map(F.lit(name), F.lit(zero_of(kind)))))
    return out


def typed(df: DataFrame, map_col: str, spec: dict[str, str]) -> DataFrame:
    """Columns from a map image by ``name -> Spark type``; ``_bad`` lists names whose text does not fit."""
    text = {n: F.col(map_col)[n] for n in spec}
    bad = F.filter(F.array(*[F.when(text[n].isNotNull() & text[n].try_cast(t).isNull(), F.lit(n)) for n, t in spec.items()]), lambda x: x.isNotNull())
    return df.select("*", *[text[n].try_cast(t).alias(n) for n, t in spec.items()], bad.alias("_bad"))


def canonical(column: str, kind: str) -> Column:
    """Text of a value: null as ``null``, bytes as lower hex, timestamps to the second."""
    c = F.col(column)
    text = F.lower(F.hex(c)) if kind == "binary" else F.date_format(c, "yyyy-MM-dd HH:mm:ss") if kind == "timestamp" else c.cast("string")
    return F.coalesce(text, F.lit("null"))


def render_json(cols: list[str], binary: tuple[str, ...] = (), stamps: tuple[str, ...] = ()) -> Column:
    """Image as JSON: numbers stay numbers, bytes become hex, timestamps microseconds, nulls are written."""
    one = lambda c: F.lower(F.hex(c)).alias(c) if c in binary else F.unix_micros(c).alias(c) if c in stamps else F.col(c)
    return F.to_json(F.struct(*[one(c) for c in cols]), {"ignoreNullFields": "false"})

