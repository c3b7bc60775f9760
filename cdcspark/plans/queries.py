"""Registered queries: each operator over the supplied tables, with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import mysqlfn as fn
from ..operators import apply, drift, integrity, layouts, metrics, positions, reconcile, reject, split
from ..operators import transforms as tr
from ..scratch import cut, shared_path
from ..sources import changelog, ddl, ranges, scans, targets
from ..streaming import counters, latest
from . import fixtures as fx
from . import replication

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
KEY, VALUES = ["key"], ["status", "price"]


class Tables:
    """The supplied tables, and fixtures over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        text = text.replace('"column"', "`column`").replace('"key"', "`key`").replace('"default"', "`default`")
        return self.spark.sql(text, **{t: getattr(self, t) for t in TABLES if "{" + t + "}" in text})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def duck(text: str) -> str:
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text


def query(sql: str, **fixtures: str) -> Callable:
    """Register a function of ``Tables`` under its name; ``fixtures`` become CTEs of the SQL."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        ctes = ", ".join(f"{n} AS ({t})" for n, t in fixtures.items())
        body = sql.strip()
        if ctes:
            more = "RECURSIVE " if body[:15].upper() == "WITH RECURSIVE " else ""
            body = f"WITH {more}{ctes}, {body[5 + len(more) :]}" if body[:5].upper() == "WITH " else f"WITH {ctes} {body}"
        SQL[f.__name__] = duck(body)
        return f

    return add


ORD = "CAST(coalesce(nullif(regexp_extract(bfile, '([0-9]+)$', 1), ''), '0') AS BIGINT)"
OPS = f"""
ops AS (SELECT a_key AS k, 'U' AS kind, a_status AS status, a_price AS price, {ORD} AS n, pos, row_seq * 2 + 1 AS seq FROM feed WHERE op <> 'D'
  UNION ALL SELECT b_key, 'D', NULL, NULL, {ORD}, pos, row_seq * 2 FROM feed WHERE op = 'D' OR (op = 'U' AND b_key <> a_key)),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, pos DESC, seq DESC) AS rn FROM ops)"""
CURRENT = f"{OPS}, cur AS (SELECT k AS \"key\", status, price FROM r WHERE rn = 1 AND kind = 'U')"
ALL = 'SELECT "key", status, price FROM cur'


def feed(t: Tables) -> DataFrame:
    return t.sql(fx.ORDERS_FEED)


def current(t: Tables) -> DataFrame:
    return replication.replicate(feed(t), KEY, VALUES)


# ---------------------------------------------------------------- scans


@query("SELECT 'shard_a' AS src_db, 'S' AS op, o_orderkey AS a_o_orderkey, o_totalprice AS a_o_totalprice, CAST(0 AS BIGINT) AS pos FROM orders")
def a1_snapshot_scan(t):
    return scans.snapshot(t.orders, "shard_a", "orders").select("src_db", "op", "a_o_orderkey", "a_o_totalprice", "pos")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 100")
def a2_keyset_page(t):
    return scans.page(t.orders, "o_orderkey", 500, 100).select("o_orderkey", "o_orderstatus")


@query("SELECT op, count(*) AS n, CAST(sum(pos) AS BIGINT) AS places FROM feed WHERE op <> 'S' GROUP BY op", feed=fx.ORDERS_FEED)
def a3_change_feed(t):
    return feed(t).filter("op <> 'S'").groupBy("op").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("places"))


@query(f"WITH feed AS (SELECT * FROM all_ WHERE op = 'S' OR {ORD} > 1 OR ({ORD} = 1 AND pos > 5000)), {CURRENT} {ALL}", all_=fx.ORDERS_FEED)
def a4_handover(t):
    f = feed(t)
    both = scans.handover(f.filter("op = 'S'"), f.filter("op <> 'S'"), "binlog.000001", 5000)
    return replication.replicate(both, KEY, VALUES)


@query("SELECT DISTINCT tbl FROM cat WHERE NOT starts_with(lower(tbl), 'tmp_') AND NOT regexp_matches(tbl, '^log') AND regexp_matches(tbl, 's$')", cat=fx.CATALOG)
def a5_table_selection(t):
    return scans.select_tables(t.sql(fx.CATALOG), "*", ("TMP_",), "^log", "s$")


@query("""SELECT tbl, CASE WHEN count(*) FILTER (is_pk) = 1 AND count(*) FILTER (is_pk AND (regexp_matches(lower(type), '^(tiny|small|medium|big)?int') OR (regexp_matches(lower(type), '^(var)?char') AND CAST(coalesce(nullif(regexp_extract(lower(type), 'char\\((\\d+)\\)', 1), ''), '1') AS INT) <= 512))) = 1
 THEN 'cdc' ELSE 'schema_only' END AS class FROM cat GROUP BY tbl""", cat=fx.CATALOG)
def a6_key_classification(t):
    return scans.classify_keys(t.sql(fx.CATALOG))



@query("SELECT DISTINCT tbl FROM cat WHERE tbl NOT IN (SELECT child FROM fks) AND tbl NOT IN (SELECT parent FROM fks)", cat=fx.CATALOG, fks=fx.FKS)
def a7_related_exclusion(t):
    return scans.without_related(t.sql(fx.CATALOG).select("tbl").distinct(), t.sql(fx.FKS))


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_custkey < (SELECT max(c_custkey) - 20 FROM customer), c_custkey LIMIT 50")
def a8_wrap_sample(t):
    start = t.customer.agg(F.max("c_custkey")).first()[0] - 20
    return scans.wrap_sample(t.customer, "c_custkey", start, 50).select("c_custkey", "c_name")



@query("""SELECT tbl, idx, string_agg(coalesce("column", '?'), ',' ORDER BY seq) AS columns, max(CASE WHEN upper(kind) <> 'BTREE' THEN 'not a BTREE index' WHEN "column" IS NULL THEN 'expression index' WHEN prefix IS NOT NULL THEN 'prefix index' END) AS skip FROM ix GROUP BY tbl, idx""", ix=fx.INDEXES)
def a9_index_catalog(t):
    return scans.index_catalog(t.sql(fx.INDEXES))


@query("""SELECT child, name, parent, string_agg("column", ',' ORDER BY seq) AS columns, string_agg(parent_column, ',' ORDER BY seq) AS parents FROM fks WHERE child IN (SELECT tbl FROM cat) AND parent IN (SELECT tbl FROM cat) GROUP BY child, name, parent""", fks=fx.FKS, cat=fx.CATALOG)
def a10_fk_catalog(t):
    return scans.fk_catalog(t.sql(fx.FKS), t.sql(fx.CATALOG).select("tbl").distinct())


RULES = "SELECT child, name, 'CASCADE' AS on_delete, CASE WHEN length(child) % 2 = 0 THEN 'SET NULL' END AS on_update FROM ({fks}) k WHERE seq = 1 AND name LIKE 'fk%'".replace("{fks}", fx.FKS)


@query("""SELECT f.child, f.name, f.seq, f."column", coalesce(r.on_delete, 'NO ACTION') AS on_delete, coalesce(r.on_update, 'NO ACTION') AS on_update FROM fks f LEFT JOIN rules r ON f.child = r.child AND f.name = r.name""", fks=fx.FKS, rules=RULES)
def j6_referential_rules(t):
    return integrity.referential_rules(t.sql(fx.FKS), t.sql(RULES)).select("child", "name", "seq", "column", "on_delete", "on_update")


@query("""WITH f AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 50)
SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM f) THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders""")
def e17_update_first(t):
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return apply.update_first(o, F.col("o_orderstatus") == "F", [F.desc("o_totalprice"), F.asc("o_orderkey")], 50, {"o_orderstatus": F.lit("X")}, ["o_orderkey"])


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN concat(o_orderstatus, 'N') ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders
UNION ALL SELECT o_orderkey + 90000000, 'N', CAST(1 AS DOUBLE) FROM orders WHERE o_orderkey % 6 = 0""")
def e17_on_duplicate_key(t):
    o = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    new = lambda d: d.select("o_orderkey", F.lit("N").alias("status"), F.lit(1.0).alias("price"))
    rows = new(o.filter("o_orderkey % 4 = 0")).unionByName(new(o.filter("o_orderkey % 6 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 90000000)))
    return apply.insert_or_change(o, rows, ["o_orderkey"], {"status": F.concat("old.status", "new.status"), "price": F.col("old.price") + F.col("new.price")})


# ---------------------------------------------------------------- transforms

IN = ("project", "tenant"), ("1", "3", "7", "12")
B_KEEP = "(coalesce(CAST(b_project AS VARCHAR), CAST(b_tenant AS VARCHAR)) IS NULL OR coalesce(CAST(b_project AS VARCHAR), CAST(b_tenant AS VARCHAR)) IN ('1','3','7','12'))"
A_KEEP = B_KEEP.replace("b_", "a_")


@query(f"SELECT op, a_key, b_key, pos FROM feed WHERE CASE WHEN op = 'D' THEN {B_KEEP} ELSE {A_KEEP} END", feed=fx.TENANT_FEED)
def b1_column_in(t):
    return t.sql(fx.TENANT_FEED).transform(tr.column_in(list(IN[0]), list(IN[1]), exact=False)).select("op", "a_key", "b_key", "pos")


@query(f"""WITH x AS (SELECT *, CASE WHEN op = 'D' THEN CASE WHEN {B_KEEP} THEN 'D' END WHEN op <> 'U' THEN CASE WHEN {A_KEEP} THEN op END WHEN {B_KEEP} AND {A_KEEP} THEN 'U' WHEN {B_KEEP} THEN 'D' WHEN {A_KEEP} THEN 'I' END AS op2 FROM feed)
SELECT op2 AS op, CASE WHEN op2 <> 'D' THEN a_key END AS a_key, CASE WHEN op2 <> 'I' THEN b_key END AS b_key, pos FROM x WHERE op2 IS NOT NULL""", feed=fx.TENANT_FEED)
def b1x_column_in_exact(t):
    return t.sql(fx.TENANT_FEED).transform(tr.column_in(list(IN[0]), list(IN[1]))).select("op", "a_key", "b_key", "pos")


@query("SELECT op, a_key + 10000000000 AS a_key, b_key + 10000000000 AS b_key, pos FROM feed", feed=fx.ORDERS_FEED)
def b2_plus_offset(t):
    return feed(t).transform(tr.plus("ORDERS", "Key", 10_000_000_000)).select("op", "a_key", "b_key", "pos")


@query(f"WITH feed AS (SELECT op, src_db, tbl, b_key + 1000 AS b_key, b_status, b_price, a_key + 1000 AS a_key, a_status, a_price, bfile, pos, row_seq FROM raw WHERE CASE WHEN op = 'D' THEN b_status IN ('F','O') ELSE a_status IN ('F','O','U') OR a_status IS NULL END OR FALSE), x AS (SELECT * FROM feed) SELECT op, count(*) AS n, CAST(sum(coalesce(a_key, b_key)) AS BIGINT) AS keys FROM x GROUP BY op", raw=fx.ORDERS_FEED)
def b3_plugin_chain(t):
    steps = tr.build_chain([("ColumnIn", {"cols": ["status"], "values": ["F", "O", "U"], "exact": False}), ("Plus", {"table": "orders", "column": "key", "amount": 1000})])
    return feed(t).transform(steps).groupBy("op").agg(F.count(F.lit(1)).alias("n"), F.sum(tr.effective_key()).alias("keys"))


@query("SELECT op, coalesce(a_key, b_key) AS k, pos, row_seq FROM feed", feed=fx.ORDERS_FEED)
def b4_effective_key(t):
    return feed(t).select("op", tr.effective_key().alias("k"), "pos", "row_seq")


ROUTES = "SELECT * FROM (VALUES ('shard_a','merged'),('SHARD_B','merged'),('shard_c','nowhere')) AS t(src_db, tgt_db)"


@query("SELECT r.tgt_db, f.op, count(*) AS n FROM feed f LEFT JOIN routes r ON lower(f.src_db) = lower(r.src_db) GROUP BY ALL", feed=fx.TWO_SHARDS, routes=ROUTES)
def b5_database_routing(t):
    return tr.route(t.sql(fx.TWO_SHARDS), t.sql(ROUTES)).groupBy("tgt_db", "op").agg(F.count(F.lit(1)).alias("n"))


MANY_ROUTES = "SELECT concat(CASE WHEN c_custkey % 2 = 0 THEN 'Db' ELSE 'db' END, CAST(c_custkey AS VARCHAR(20))) AS src_db, concat('t', CAST(c_nationkey AS VARCHAR(20))) AS tgt_db FROM {customer} WHERE c_custkey % 9 <> 0 UNION ALL SELECT concat('DB', CAST(c_custkey AS VARCHAR(20))), 'T1' FROM {customer} WHERE c_custkey % 17 = 0"


@query("""WITH r AS (SELECT lower(src_db) AS name, lower(tgt_db) AS tgt FROM routes), s AS (SELECT DISTINCT concat('db', o_custkey) AS name FROM orders), g AS (SELECT concat('t', n_nationkey) AS name FROM nation WHERE n_nationkey % 4 <> 0)
SELECT name, 'duplicate route' AS error FROM r GROUP BY name HAVING count(*) > 1 UNION ALL SELECT DISTINCT name, 'unknown source' FROM r WHERE name NOT IN (SELECT name FROM s) UNION ALL SELECT name, 'no route' FROM s WHERE name NOT IN (SELECT name FROM r) UNION ALL SELECT DISTINCT tgt, 'undeclared target' FROM r WHERE tgt NOT IN (SELECT name FROM g)""", routes=MANY_ROUTES)
def b5_route_errors(t):
    sources = t.orders.select(F.concat(F.lit("DB"), "o_custkey").alias("db"))
    return tr.route_errors(t.sql(MANY_ROUTES), sources, t.nation.filter("n_nationkey % 4 <> 0").select(F.concat(F.lit("T"), "n_nationkey").alias("db")))


@query("SELECT src_db, tbl, op, a_key FROM feed WHERE lower(src_db) = 'shard_b' AND lower(tbl) = 'customer'", feed=fx.TWO_SHARDS)
def b6_event_dispatch(t):
    return tr.dispatch(t.sql(fx.TWO_SHARDS), t.spark.createDataFrame([("SHARD_B", "Customer")], "db string, tbl string")).select("src_db", "tbl", "op", "a_key")


@query("""SELECT DISTINCT s.tbl, lower(s."column") AS "column" FROM src s JOIN tgt g ON s.tbl = g.tbl AND lower(s."column") = lower(g."column") WHERE NOT s.generated""", src=fx.CATALOG, tgt=fx.CATALOG_TARGET)
def b7_write_projection(t):
    return tr.write_columns(t.sql(fx.CATALOG), t.sql(fx.CATALOG_TARGET), t.sql(fx.CATALOG).select("tbl", "column"))


@query("SELECT event_id, CASE WHEN lower(event_type) IN ('rowid','rownum','level','uid','trxid') THEN concat(event_type, '_') ELSE event_type END AS target FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'Level' ELSE event_type END AS event_type FROM events)")
def b8_reserved_rename(t):
    e = t.events.select("event_id", F.when(F.col("event_id") % 3 == 0, "Level").otherwise(F.col("event_type")).alias("event_type"))
    return e.select("event_id", tr.target_name("event_type").alias("target"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '0' ELSE NULL END AS qty, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderstatus END AS note FROM orders")
def b12_required_defaults(t):
    image = F.when(F.col("o_orderkey") % 2 == 0, F.create_map(F.lit("id"), F.lit("1"))).otherwise(F.create_map(F.lit("id"), F.lit("1"), F.lit("qty"), F.lit(None).cast("string"), F.lit("note"), F.col("o_orderstatus")))
    full = t.orders.withColumn("m", image).withColumn("m", tr.fill_required("m", {"qty": "int", "note": "varchar"}))
    return full.select("o_orderkey", F.col("m.qty").alias("qty"), F.col("m.note").alias("note"))


@query("SELECT o_orderkey, o_totalprice AS price, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey END AS n, CASE WHEN o_orderkey % 10 = 0 THEN 'n' ELSE '' END AS bad FROM orders")
def b13_typed_decode(t):
    m = F.create_map(F.lit("price"), F.col("o_totalprice").cast("string"), F.lit("n"), F.when(F.col("o_orderkey") % 10 == 0, "x1").otherwise(F.col("o_orderkey").cast("string")))
    return tr.typed(t.orders.withColumn("m", m), "m", {"price": "double", "n": "bigint"}).select("o_orderkey", "price", "n", F.array_join("_bad", ",").alias("bad"))


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey AS VARCHAR) END, 'null') AS k, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS d, lower(hex(encode(o_orderstatus))) AS h FROM orders")
def b14_canonical_text(t):
    d = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey")).alias("k"), F.col("o_orderdate").alias("d"), F.col("o_orderstatus").cast("binary").alias("h"))
    return d.select("o_orderkey", tr.canonical("k", "bigint").alias("k"), tr.canonical("d", "timestamp").alias("d"), tr.canonical("h", "binary").alias("h"))


# ---------------------------------------------------------------- apply


@query(f"WITH {CURRENT} {ALL}", feed=fx.ORDERS_FEED)
def e1_lww_apply(t):
    return current(t)


@query(f"WITH {CURRENT} SELECT o_orderkey AS \"key\", 'N' AS status, o_totalprice AS price FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT * FROM cur WHERE \"key\" NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0)", feed=fx.ORDERS_FEED)
def e2_batch_upsert(t):
    rows = t.orders.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("key"), F.lit("N").alias("status"), F.col("o_totalprice").alias("price"))
    return apply.upsert(current(t), rows, KEY)


@query(f"WITH {CURRENT} {ALL} WHERE \"key\" NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')", feed=fx.ORDERS_FEED)
def e3_batch_delete(t):
    gone = t.orders.select(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).alias("key"))
    return apply.delete_keys(current(t), gone, KEY)


@query(f"WITH {OPS} SELECT k AS \"key\", status, price, n AS _file, pos AS _pos, CAST(seq AS BIGINT) AS _seq, kind = 'D' AS _deleted FROM r WHERE rn = 1", feed=fx.ORDERS_FEED)
def e4_merge_state(t):
    f = feed(t)
    latest = lambda df: apply.compact(apply.key_ops(df, KEY, VALUES), KEY, VALUES)
    state = apply.to_state(latest(f.filter("op = 'S'")), KEY, VALUES)
    return apply.merge(state, latest(f.filter("op <> 'S'")), KEY, VALUES)


@query(f"WITH {CURRENT} SELECT count(*) FILTER (o_orderkey IN (SELECT \"key\" FROM cur)) AS updated, count(*) FILTER (o_orderkey NOT IN (SELECT \"key\" FROM cur)) AS inserted FROM orders WHERE o_orderkey % 3 = 0", feed=fx.ORDERS_FEED)
def e5_update_else_insert(t):
    return apply.upsert_counts(current(t), t.orders.filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("key")), KEY)


@query("SELECT DISTINCT o_custkey AS k FROM orders")
def e6_key_only_insert(t):
    half = lambda r: t.orders.filter(f"o_orderkey % 2 = {r}").select(F.col("o_custkey").alias("k"))
    return apply.upsert(half(0), half(1), ["k"])


@query(f"""WITH e AS (SELECT *, {ORD} * 1000000000000 + pos * 10 + row_seq AS o FROM p),
s AS (SELECT k, arg_max(op, o) AS last FROM e GROUP BY k),
a AS (SELECT k, arg_max({{'v': status}}, o) AS x FROM e WHERE has_status GROUP BY k), b AS (SELECT k, arg_max({{'v': price}}, o) AS x FROM e WHERE has_price GROUP BY k)
SELECT k, a.x.v AS status, b.x.v AS price FROM s JOIN a USING (k) JOIN b USING (k) WHERE last <> 'D'""", p=fx.PATCH_FEED)
def e7_partial_update(t):
    kind = F.when(F.col("op") == "U", "P").when(F.col("op") == "D", "D").otherwise("U")
    ops = t.sql(fx.PATCH_FEED).select("k", kind.alias("kind"), "status", "price", "has_status", "has_price", apply.file_number("bfile").alias("_file"), F.col("pos").alias("_pos"), F.col("row_seq").alias("_seq"))
    return apply.apply_flagged(ops, ["k"], ["status", "price"])


@query("SELECT b_key AS \"key\", 'D' AS kind FROM feed WHERE op = 'U' AND b_key <> a_key UNION ALL SELECT a_key, 'U' FROM feed WHERE op = 'U' AND b_key <> a_key", feed=fx.ORDERS_FEED)
def e8_key_change(t):
    return apply.key_ops(feed(t).filter("op = 'U' AND b_key <> a_key"), KEY, VALUES).select("key", "kind")


@query(f"WITH {CURRENT} {ALL} WHERE \"key\" NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey <= 1000) UNION ALL SELECT o_orderkey, 'L', 0.0 FROM orders WHERE o_orderkey <= 1000", feed=fx.ORDERS_FEED)
def e9_replace_on_load(t):
    rows = t.orders.filter("o_orderkey <= 1000").select(F.col("o_orderkey").alias("key"), F.lit("L").alias("status"), F.lit(0.0).alias("price"))
    return apply.replace_rows(current(t), rows, KEY)


@query("SELECT coalesce(CASE WHEN op = 'D' THEN b_key END, a_key, b_key) AS \"key\", CASE WHEN op <> 'D' THEN a_status END AS status, CASE WHEN op <> 'D' THEN a_price END AS price, CASE WHEN op = 'D' THEN 1 ELSE 0 END AS __op FROM feed", feed=fx.ORDERS_FEED)
def e10_op_coded(t):
    return apply.op_coded(feed(t), KEY, VALUES)


@query(f"WITH {OPS} SELECT k AS \"key\", kind, CASE WHEN kind = 'U' THEN concat('{{\"key\":', k, ',\"status\":\"', status, '\"}}') END AS doc FROM r WHERE rn = 1", feed=fx.ORDERS_FEED)
def e11_documents(t):
    return apply.documents(apply.compact(apply.key_ops(feed(t), KEY, VALUES), KEY, VALUES), KEY, ["status"])


@query("SELECT 'merged' AS tgt_db, tbl, count(*) AS n FROM feed GROUP BY tbl", feed=fx.TWO_SHARDS)
def e14_partition_by_target(t):
    return tr.route(t.sql(fx.TWO_SHARDS), t.sql(ROUTES)).groupBy("tgt_db", "tbl").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {CURRENT} {ALL}", feed=fx.ORDERS_FEED)
def e15_replay_safety(t):
    f = cut(feed(t))
    live = f.filter("op <> 'S'")
    start = apply.to_state(apply.compact(apply.key_ops(f.filter("op = 'S'"), KEY, VALUES), KEY, VALUES), KEY, VALUES)
    return apply.alive(replication.in_batches(start, KEY, VALUES, [live.filter("bfile < 'binlog.000003'"), live, live.filter("bfile = 'binlog.000001'")]), KEY, VALUES)


@query("WITH r AS (SELECT a_key, a_name, row_number() OVER (PARTITION BY a_key ORDER BY bfile DESC, pos DESC) AS rn FROM feed) SELECT 'merged' AS tgt_db, a_key AS \"key\", a_name AS name FROM r WHERE rn = 1", feed=fx.TWO_SHARDS)
def e16_merge_shards(t):
    return replication.replicate_routed(t.sql(fx.TWO_SHARDS), t.sql(ROUTES), KEY, ["name"])


@query("SELECT a_key AS \"key\", count(DISTINCT lower(src_db)) AS n FROM feed GROUP BY a_key HAVING count(DISTINCT lower(src_db)) > 1", feed=fx.TWO_SHARDS)
def e16_shard_clashes(t):
    return metrics.repeated_keys(t.sql(fx.TWO_SHARDS).select(F.col("a_key").alias("key"), F.lower("src_db").alias("s")).distinct(), KEY)


@query(f"WITH {CURRENT} {ALL} UNION ALL SELECT o_orderkey, 'X', o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT \"key\" FROM cur)", feed=fx.ORDERS_FEED)
def e17_insert_ignore(t):
    return apply.insert_missing(current(t), t.orders.select(F.col("o_orderkey").alias("key"), F.lit("X").alias("status"), F.col("o_totalprice").alias("price")), KEY)


# ---------------------------------------------------------------- joins, windows, set operations


@query("SELECT o_orderkey, CASE WHEN c_custkey IS NOT NULL THEN c_mktsegment ELSE o_orderpriority END AS o_orderpriority FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey")
def j7_update_join(t):
    target = t.orders.select("o_orderkey", F.col("o_custkey").alias("c"), "o_orderpriority")
    source = t.customer.select(F.col("c_custkey").alias("c"), "c_mktsegment", "c_acctbal")
    return apply.update_from(target, source, ["c"], {"o_orderpriority": "c_mktsegment"}, F.col("c_acctbal") > 0).drop("c")


@query("SELECT count(*) AS n FROM (SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_nationkey END AS a FROM customer) x JOIN (SELECT n_nationkey AS b FROM nation UNION ALL SELECT NULL) y ON x.a IS NOT DISTINCT FROM y.b")
def j8_null_safe_join(t):
    a = t.customer.select(F.when(F.col("c_custkey") % 10 != 0, F.col("c_nationkey")).alias("a"))
    b = t.nation.select(F.col("n_nationkey").alias("b")).union(t.spark.createDataFrame([(None,)], "b int"))
    return a.join(b, fn.null_safe_equal(F.col("a"), F.col("b"))).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT coalesce(a_key, b_key) AS \"key\", op, lag(a_status) OVER (PARTITION BY coalesce(a_key, b_key) ORDER BY {ORD}, pos, row_seq) AS previous, pos FROM feed", feed=fx.ORDERS_FEED)
def w1_change_history(t):
    from pyspark.sql import Window

    w = Window.partitionBy("key").orderBy(apply.file_number("bfile"), "pos", "row_seq")
    return feed(t).withColumn("key", tr.effective_key()).select("key", "op", F.lag("a_status").over(w).alias("previous"), "pos")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def w3_top_k(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("""WITH a AS (SELECT tbl, list(DISTINCT lower("column")) AS c FROM src GROUP BY tbl), b AS (SELECT tbl, list(DISTINCT lower("column")) AS d FROM tgt GROUP BY tbl)
SELECT coalesce(a.tbl, b.tbl) AS tbl, list_sort(list_distinct(list_concat(coalesce(c, []), coalesce(d, [])))) AS columns, list_sort(list_filter(coalesce(c, []), lambda x: list_contains(coalesce(d, []), x))) AS common,
list_sort(list_filter(coalesce(c, []), lambda x: NOT list_contains(coalesce(d, []), x))) AS only_source, list_sort(list_filter(coalesce(d, []), lambda x: NOT list_contains(coalesce(c, []), x))) AS only_target FROM a FULL JOIN b ON a.tbl = b.tbl""", src=fx.CATALOG, tgt=fx.CATALOG_TARGET)
def w7_column_sets(t):
    return drift.column_sets(t.sql(fx.CATALOG), t.sql(fx.CATALOG_TARGET))


# ---------------------------------------------------------------- aggregates


@query("SELECT tbl, op, count(*) AS events FROM feed GROUP BY tbl, op", feed=fx.ORDERS_FEED)
def g1_events_read(t):
    return metrics.events_by_op(feed(t))


@query(f"SELECT tbl, op, count(*) AS events FROM feed WHERE CASE WHEN op = 'D' THEN {B_KEEP} ELSE {A_KEEP} END GROUP BY tbl, op", feed=fx.TENANT_FEED)
def g2_events_written(t):
    return metrics.events_by_op(t.sql(fx.TENANT_FEED).transform(tr.column_in(list(IN[0]), list(IN[1]), exact=False)))


def kept(t) -> Column:
    return F.when(F.col("op") == "D", tr.keeps("b", *map(list, IN))).otherwise(tr.keeps("a", *map(list, IN)))


@query(f"WITH x AS (SELECT *, CASE WHEN op = 'D' THEN {B_KEEP} ELSE {A_KEEP} END AS ok FROM feed) SELECT tbl, count(*) AS read, count(*) FILTER (ok) AS synced, count(*) FILTER (NOT ok) AS filtered, arg_max(coalesce(a_key, b_key), {ORD} * 1000000000 + pos) FILTER ({ORD} > 0) AS last_key, max(pos) AS last_pos FROM x GROUP BY tbl", feed=fx.TENANT_FEED)
def g3_progress(t):
    return metrics.progress(t.sql(fx.TENANT_FEED), kept(t), tr.effective_key())


@query(f"WITH x AS (SELECT *, CASE WHEN op = 'D' THEN {B_KEEP} ELSE {A_KEEP} END AS ok, CASE WHEN op = 'D' THEN CASE WHEN b_project IS NOT NULL THEN 'project' WHEN b_tenant IS NOT NULL THEN 'tenant' END ELSE CASE WHEN a_project IS NOT NULL THEN 'project' WHEN a_tenant IS NOT NULL THEN 'tenant' END END AS c FROM feed) SELECT 'ColumnIn' AS plugin, tbl, coalesce(c, '(no column)') AS \"column\", count(*) AS seen, count(*) FILTER (ok) AS passed, count(*) FILTER (NOT ok) AS filtered FROM x GROUP BY ALL", feed=fx.TENANT_FEED)
def g4_filter_statistics(t):
    return metrics.filter_statistics(t.sql(fx.TENANT_FEED), "ColumnIn", list(IN[0]), kept(t))


@query(f"SELECT tbl, arg_max(bfile, {ORD} * 1000000000 + pos) AS bfile, arg_max(pos, {ORD} * 1000000000 + pos) AS pos FROM feed GROUP BY tbl", feed=fx.ORDERS_FEED)
def g5_highest_place(t):
    return metrics.highest_place(feed(t))


CLEAN = {"orders": ("orders", "o_orderstatus"), "customer": ("customer", "c_mktsegment")}


@query("WITH x AS (SELECT 'orders' AS tbl, count(*) AS rows FROM orders WHERE lower(o_orderstatus) IN ('f','building') UNION ALL SELECT 'customer', count(*) FROM customer WHERE lower(c_mktsegment) IN ('f','building')) SELECT * FROM x UNION ALL SELECT '(total)', CAST(sum(rows) AS BIGINT) FROM x")
def g6_cleanup_count(t):
    return split.dry_run({n: (getattr(t, n), c) for n, c in CLEAN.values()}, ["F", "BUILDING"])


@query("SELECT min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders")
def g7_key_range(t):
    return metrics.key_range(t.orders, "o_orderkey")


@query("SELECT c_custkey AS o_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def g8_rows_per_key(t):
    return metrics.rows_per_key(t.customer.select(F.col("c_custkey").alias("o_custkey")), t.orders, "o_custkey")


@query("SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def g9_repeated_keys(t):
    return metrics.repeated_keys(t.lineitem, ["l_orderkey"])


@query("SELECT o_custkey, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS joined FROM orders GROUP BY o_custkey")
def g10_group_concat(t):
    return metrics.joined_text(t.orders, "o_custkey", "o_orderstatus")


@query("WITH r AS (SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS k FROM orders) SELECT o_orderstatus, count(*) AS n, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) FILTER (k <= 5) AS samples FROM r GROUP BY o_orderstatus")
def g11_first_samples(t):
    return metrics.first_samples(t.orders, "o_orderstatus", "o_orderkey", 5)


# ---------------------------------------------------------------- reconciliation

PLAN = [("o_orderstatus", "char"), ("o_totalprice", "float")]
FOUND = """
j AS (SELECT coalesce(s.o_orderkey, d.o_orderkey) AS k, s.o_orderkey AS sk, d.o_orderkey AS dk, s.o_orderstatus AS s1, d.o_orderstatus AS d1, s.o_totalprice AS s2, d.o_totalprice AS d2 FROM orders s FULL JOIN drifted d ON s.o_orderkey = d.o_orderkey),
found AS (SELECT 'orders' AS tbl, CAST(k AS VARCHAR) AS "key", NULL AS "column", 'target row not found' AS reason FROM j WHERE dk IS NULL
UNION ALL SELECT 'orders', CAST(k AS VARCHAR), NULL, 'source row not found' FROM j WHERE sk IS NULL
UNION ALL SELECT 'orders', CAST(k AS VARCHAR), 'o_orderstatus', CASE WHEN s1 IS NULL THEN 'source is NULL' WHEN d1 IS NULL THEN 'target is NULL' ELSE 'value differs' END FROM j WHERE sk IS NOT NULL AND dk IS NOT NULL AND rtrim(s1) IS DISTINCT FROM rtrim(d1)
UNION ALL SELECT 'orders', CAST(k AS VARCHAR), 'o_totalprice', 'value differs' FROM j WHERE sk IS NOT NULL AND dk IS NOT NULL AND abs(s2 - d2) > greatest(abs(s2), abs(d2), 1) * 1e-6)"""


def found(t):
    return reconcile.mismatches(t.orders, t.sql(fx.DRIFTED), "orders", "o_orderkey", PLAN)


@query("SELECT l_orderkey, l_linenumber, regexp_replace(concat('01:02:03.', CAST(l_linenumber AS VARCHAR), '00'), '(\\.\\d*[1-9])0+$', '\\1') AS t, rtrim(concat(l_returnflag, '   ')) AS c, upper(hex(encode(l_linestatus))) AS b FROM lineitem")
def r2_normalise(t):
    d = t.lineitem.select("l_orderkey", "l_linenumber", F.concat(F.lit("01:02:03."), F.col("l_linenumber").cast("string"), F.lit("00")).alias("t"), F.concat("l_returnflag", F.lit("   ")).alias("c"), F.col("l_linestatus").cast("binary").alias("b"))
    return d.select("l_orderkey", "l_linenumber", *[reconcile.normalised(F.col(c), k).alias(c) for c, k in (("t", "time"), ("c", "char"), ("b", "binary"))])


@query("SELECT l_orderkey, l_linenumber, abs(l_extendedprice - l_extendedprice * (1 + l_discount * 2e-5)) <= greatest(abs(l_extendedprice), abs(l_extendedprice * (1 + l_discount * 2e-5)), 1) * 1e-6 AS same FROM lineitem")
def r3_float_equality(t):
    a = F.col("l_extendedprice")
    return t.lineitem.select("l_orderkey", "l_linenumber", reconcile.equal(a, a * (1 + F.col("l_discount") * 2e-5), "float").alias("same"))


@query("""SELECT l_orderkey, l_linenumber, l_linenumber % 2 = 0 AS long_integer, l_linenumber % 3 = 0 AS small_decimal, TRUE AS other_writing, l_linenumber % 2 = 0 AS not_a_number, l_linenumber % 3 <> 1 AS document FROM lineitem""")
def r3_exact_equality(t):
    """Integers of 30 digits, decimals that differ in the twelfth place, other writings of a number, texts, JSON."""
    key, n = F.col("l_orderkey").cast("string"), F.col("l_linenumber")
    pick = lambda m, a, b: F.when(n % m == 0, F.lit(a)).otherwise(F.lit(b))
    cases = {
        "long_integer": (F.concat(key, F.lit("0" * 24 + "1")), F.concat(key, F.lit("0" * 24), pick(2, "1", "2")), "integer"),
        "small_decimal": (F.concat(key, F.lit(".000000000001")), F.concat(key, F.lit("."), pick(3, "000000000001", "000000000002")), "decimal"),
        "other_writing": (F.concat(F.lit("+00"), key, F.lit(".50")), F.concat(key, F.lit("5e-1")), "decimal"),
        "not_a_number": (F.concat(key, F.lit("x")), F.concat(key, pick(2, "x", "y")), "decimal"),
        "document": (F.concat(F.lit('{"a": '), key, F.when(n % 3 == 2, "").otherwise("}")), F.concat(F.lit('{"a":'), F.when(n % 3 == 2, " ").otherwise(""), F.when(n % 3 == 1, "1.5").otherwise(key), F.when(n % 3 == 2, "").otherwise("}")), "json"),
    }
    return t.lineitem.select("l_orderkey", "l_linenumber", *[reconcile.equal(a, b, kind).alias(c) for c, (a, b, kind) in cases.items()])


@query(f'WITH {FOUND} SELECT tbl, "key", "column", reason FROM found', drifted=fx.DRIFTED)
def r4_mismatch_report(t):
    return found(t).select("tbl", "key", "column", "reason")


@query(f'WITH {FOUND} SELECT tbl, "key", "column", reason FROM found WHERE CAST("key" AS BIGINT) IN (SELECT o_orderkey FROM orders ORDER BY o_orderkey < 700, o_orderkey LIMIT 300)', drifted=fx.DRIFTED)
def r5_sampled_reconcile(t):
    sample = scans.wrap_sample(t.orders, "o_orderkey", 700, 300)
    return reconcile.sampled(t.orders, t.sql(fx.DRIFTED), sample, "orders", "o_orderkey", PLAN).select("tbl", "key", "column", "reason")


@query(f'WITH {FOUND} SELECT tbl, count(*) AS mismatches, count(DISTINCT "key") AS keys FROM found GROUP BY tbl', drifted=fx.DRIFTED)
def r6_reconcile_summary(t):
    return reconcile.summary(found(t))


@query(f"""WITH {FOUND} SELECT 'orders' AS tbl, (SELECT count(*) FROM orders) AS rows, count(*) AS mismatches, count(DISTINCT "key") AS keys, 'mismatch' AS state FROM found
UNION ALL SELECT 'customer', count(*), 0, 0, 'clean' FROM customer UNION ALL SELECT 'nation', count(*), 0, 0, 'error' FROM nation""", drifted=fx.DRIFTED)
def r6_checked_tables(t):
    return reconcile.checked({"orders": (t.orders, t.sql(fx.DRIFTED), "o_orderkey", PLAN), "customer": (t.customer, t.customer, "c_custkey", [("c_name", "text")]), "nation": (t.nation, t.region, "n_nationkey", [("n_name", "text")])})


@query("""WITH v AS (SELECT event_id, repeat(props, CAST(event_id % 40 + 1 AS BIGINT)) AS s FROM events), d AS (SELECT *, CASE WHEN event_id % 50 = 0 THEN concat(s, '!') WHEN event_id % 50 = 7 THEN concat(substr(s, 1, CAST(event_id % 30 AS BIGINT) * length(props_) ), '#', substr(s, CAST(event_id % 30 AS BIGINT) * length(props_) + 2)) END AS t FROM (SELECT v.*, e.props AS props_ FROM v JOIN events e USING (event_id)) x)
SELECT event_id, CAST(strlen(s) AS INTEGER) AS source_bytes, CAST(strlen(t) AS INTEGER) AS target_bytes, CAST(floor(place / 200) AS INTEGER) AS chunk, place FROM (SELECT *, CASE WHEN event_id % 50 = 0 THEN length(s) ELSE least(CAST(event_id % 30 AS BIGINT) * length(props_), length(s)) END AS place FROM d WHERE t IS NOT NULL) y""")
def r7_large_values(t):
    """Long values, of which some have one more character at their end and some another one inside."""
    n, k, size = F.col("event_id"), F.col("event_id") % 30, F.length("props")
    long = t.events.select("event_id", "props", F.repeat("props", (n % 40 + 1).cast("int")).alias("s"))
    inside = F.concat(F.substring("s", F.lit(1), (k * size).cast("int")), F.lit("#"), F.substring("s", (k * size + 2).cast("int"), F.length("s")))
    target = long.select("event_id", F.when(n % 50 == 0, F.concat("s", F.lit("!"))).when(n % 50 == 7, inside).otherwise(F.col("s")).alias("s"))
    return reconcile.large_differences(long.select("event_id", "s"), target, "event_id", "s")


@query("SELECT event_id, concat('len=', CAST(length(props) AS VARCHAR), ' value=', substr(props, 1, 20)) AS preview FROM events")
def r8_value_preview(t):
    return t.events.select("event_id", reconcile.preview("props", 20).alias("preview"))


@query(f'WITH {FOUND} SELECT tbl, "key", "column", reason FROM found', drifted=fx.DRIFTED)
def r9_digest_drill(t):
    return reconcile.drill(t.orders, t.sql(fx.DRIFTED), "orders", "o_orderkey", PLAN).select("tbl", "key", "column", "reason")


NODE = "CAST(floor(k / (64 * power(32, lvl))) AS BIGINT)"


@query(f"""WITH x AS (SELECT coalesce(s.o_orderkey, d.o_orderkey) AS k, s.o_orderkey IS NULL OR d.o_orderkey IS NULL OR s.o_orderstatus IS DISTINCT FROM d.o_orderstatus OR s.o_totalprice IS DISTINCT FROM d.o_totalprice AS bad FROM orders s FULL JOIN drifted d ON s.o_orderkey = d.o_orderkey),
n AS (SELECT lvl, {NODE} AS node, CAST(floor({NODE} / 32) AS BIGINT) AS up, bool_or(bad) AS bad FROM x, range(6) r(lvl) GROUP BY ALL), h AS (SELECT min(lvl) AS top FROM (SELECT lvl FROM (SELECT DISTINCT lvl, CAST(floor(o_orderkey / (64 * power(32, lvl))) AS BIGINT) AS node FROM orders, range(6) r(lvl)) GROUP BY lvl HAVING count(*) <= 32))
SELECT CAST(n.lvl AS INTEGER) AS level, count(*) AS looked_at, count(*) FILTER (n.bad) AS unequal FROM n CROSS JOIN h LEFT JOIN n p ON p.lvl = n.lvl + 1 AND p.node = n.up WHERE n.lvl = top OR (n.lvl < top AND p.bad) GROUP BY n.lvl""", drifted=fx.DRIFTED)
def r9_tree_levels(t):
    """How many nodes of the digest trees are read and how many differ, level by level."""
    one, two = reconcile.trees(t.orders, t.sql(fx.DRIFTED), "o_orderkey", [("o_orderstatus", "text"), ("o_totalprice", "float")], shared_path(t.spark, "digests"))
    return t.spark.createDataFrame(one.unequal(two)[1], "level int, looked_at long, unequal long")


# ---------------------------------------------------------------- drift


@query("""SELECT tbl, "column", CASE WHEN type LIKE '%unsigned%' THEN CASE WHEN type LIKE 'int%' THEN 'bigint' ELSE 'int' END WHEN lower(type) LIKE 'bigint%' THEN 'bigint' WHEN type LIKE 'int%' THEN 'int' WHEN type LIKE 'decimal%' THEN type ELSE 'string' END AS spark_type,
CASE WHEN type LIKE 'varchar%' OR type LIKE 'decimal%' THEN upper(type) WHEN lower(type) LIKE 'bigint%' THEN 'BIGINT' WHEN type LIKE 'smallint%' THEN 'SMALLINT' WHEN type LIKE 'int%' THEN 'INT' ELSE 'STRING' END AS store_type FROM cat""", cat=fx.CATALOG)
def f1_type_mappings(t):
    return t.sql(fx.CATALOG).select("tbl", "column", drift.spark_type("type").alias("spark_type"), drift.store_type("type").alias("store_type"))


TOKEN = "regexp_replace(lower(%s), '(tinyint|smallint|mediumint|bigint|int)\\(\\d+\\)', '\\1')"
WIDTH = "CASE WHEN starts_with(%s, 'tinyint') THEN 0 WHEN starts_with(%s, 'smallint') THEN 2 WHEN starts_with(%s, 'mediumint') THEN 4 WHEN starts_with(%s, 'int') THEN 6 WHEN starts_with(%s, 'bigint') THEN 8 END + CASE WHEN contains(%s, 'unsigned') THEN 1 ELSE 0 END"
LONG = "CASE WHEN starts_with(%s, 'varchar') THEN CASE WHEN CAST(regexp_extract(%s, '(\\d+)', 1) AS INT) <= 512 THEN CAST(regexp_extract(%s, '(\\d+)', 1) AS INT) ELSE 1073741824 END WHEN %s = 'text' THEN 1073741824 END"
WHOLE = "CASE WHEN starts_with(%s, 'decimal') THEN CAST(regexp_extract(%s, '(\\d+)', 1) AS INT) END"


def of(expression: str, name: str) -> str:
    return expression.replace("%s", name)


@query(f"""WITH j AS (SELECT s.tbl, s."column", s.nullable, s.is_pk, s.generated, {of(TOKEN, 's.type')} AS a, {of(TOKEN, 'g.type')} AS b, g.nullable AS n2 FROM src s LEFT JOIN tgt g ON s.tbl = g.tbl AND lower(s."column") = lower(g."column")),
w AS (SELECT *, a <> b AND coalesce(CASE WHEN {of(LONG, 'a')} IS NOT NULL THEN {of(LONG, 'b')} IS NULL OR {of(LONG, 'a')} > {of(LONG, 'b')} WHEN {of(WIDTH, 'a')} IS NOT NULL THEN CASE WHEN {of(WIDTH, 'b')} IS NOT NULL THEN {of(WIDTH, 'a')} > {of(WIDTH, 'b')} ELSE NOT starts_with(b, 'decimal') END WHEN {of(WHOLE, 'a')} IS NOT NULL THEN coalesce({of(WHOLE, 'a')} > {of(WHOLE, 'b')}, TRUE) END, FALSE) AS wider FROM j)
SELECT tbl, "column", CASE WHEN generated THEN 'SKIP' WHEN b IS NULL THEN 'ADD' WHEN wider THEN CASE WHEN is_pk THEN 'BLOCKED' ELSE 'MODIFY' END WHEN nullable AND NOT n2 THEN CASE WHEN is_pk THEN 'BLOCKED' ELSE 'RELAX_NULL' END ELSE 'KEEP' END AS action FROM w""", src=fx.CATALOG, tgt=fx.CATALOG_TARGET)
def f3_schema_diff(t):
    return drift.diff_plan(t.sql(fx.CATALOG), t.sql(fx.CATALOG_TARGET))


@query("SELECT o_orderkey, CAST(NULL AS VARCHAR) AS note, CAST(o_totalprice AS DECIMAL(18,2)) AS O_TOTALPRICE FROM orders")
def f5_align(t):
    return drift.align(t.orders, {"o_orderkey": "bigint", "note": "string", "O_TOTALPRICE": "decimal(18,2)"})


SHARD_CATALOG = f"SELECT 'merged' AS tgt_db, s.src_db, c.tbl, c.\"column\", CASE WHEN s.src_db = 'b' AND c.\"column\" = 'status' AND c.tbl LIKE '%4' THEN 'varchar(30)' ELSE c.type END AS type, c.is_pk FROM ({fx.CATALOG}) c CROSS JOIN (VALUES ('a'), ('b')) AS s(src_db)"


@query("SELECT tgt_db, tbl, count(DISTINCT sig) AS versions FROM (SELECT tgt_db, tbl, src_db, string_agg(concat(\"column\", type), ',' ORDER BY \"column\") AS sig FROM cat GROUP BY ALL) GROUP BY ALL HAVING count(DISTINCT sig) > 1", cat=SHARD_CATALOG)
def f7_merged_target_check(t):
    return drift.merged_conflicts(t.sql(SHARD_CATALOG))


# ---------------------------------------------------------------- integrity, split


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 200 <> 0)")
def i1_orphans(t):
    return integrity.orphans(t.lineitem, t.orders.filter("o_orderkey % 200 <> 0"), ["l_orderkey"], ["o_orderkey"]).select("l_orderkey", "l_linenumber")


@query("SELECT o_custkey, o_orderdate, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1")
def i2_unique_violations(t):
    return integrity.duplicates(t.orders, ["o_custkey", "o_orderdate"])


@query("SELECT DISTINCT 'customer' AS tbl, c_custkey AS \"key\", 'CASCADE' AS action FROM customer WHERE c_nationkey IN (1, 2) UNION ALL SELECT 'orders', o_orderkey, 'SET NULL' FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey IN (1, 2))")
def i3_cascade(t):
    gone = t.nation.filter("n_nationkey in (1, 2)").select("n_nationkey")
    return integrity.cascade(gone, [("nation", t.customer, "customer", "c_nationkey", "c_custkey", "CASCADE"), ("customer", t.orders, "orders", "o_custkey", "o_orderkey", "SET NULL")], "nation")


@query("""WITH x AS (SELECT tbl, count(*) FILTER ("column" IN ('tenant_id','project_id')) AS n, max(CASE WHEN "column" IN ('tenant_id','project_id') THEN "column" END) AS c, count(*) FILTER (is_pk) AS k FROM cat GROUP BY tbl)
SELECT tbl, CASE WHEN n = 1 AND k > 0 THEN c END AS "column", CASE WHEN n = 0 THEN 'no filter column' WHEN n > 1 THEN 'matched multiple filter columns' WHEN k = 0 THEN 'no primary key' END AS reason FROM x""", cat=fx.CATALOG)
def c1_cleanup_targets(t):
    return split.cleanup_targets(t.sql(fx.CATALOG), ["TENANT_ID", "project_id"])


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey")
def c3_key_list(t):
    return split.key_list(t.orders, "o_orderstatus", ["f"], "o_orderkey")


@query("WITH k AS (SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 100) AS BIGINT) AS batch FROM orders WHERE o_orderstatus = 'F') SELECT batch, concat('DELETE FROM orders WHERE o_orderkey IN (', string_agg(concat('''', o_orderkey, ''''), ', ' ORDER BY o_orderkey), ');') AS sql FROM k GROUP BY batch")
def c4_delete_script(t):
    return split.delete_script(split.matching(t.orders, "o_orderstatus", ["F"]), "o_orderkey", "orders", 100)


@query(f"WITH r AS (SELECT coalesce(a_key, b_key) AS k, op, a_tenant, a_project, row_number() OVER (PARTITION BY coalesce(a_key, b_key) ORDER BY {ORD} DESC, pos DESC) AS rn FROM feed) SELECT k AS \"key\", a_tenant AS tenant FROM r WHERE rn = 1 AND op <> 'D' AND {A_KEEP}", feed=fx.TENANT_FEED)
def c6_split_apply(t):
    return replication.replicate(t.sql(fx.TENANT_FEED), KEY, ["tenant"], tr.column_in(list(IN[0]), list(IN[1])))


# ---------------------------------------------------------------- positions

NUM = ORD
LATEST = f'v AS (SELECT *, {NUM} AS n FROM p WHERE trim(bfile) <> \'\' AND pos > 0), l AS (SELECT kind, "key", arg_max(bfile, n * 1000000000 + pos) AS bfile, arg_max(pos, n * 1000000000 + pos) AS pos, arg_max(updated_at, n * 1000000000 + pos) AS updated_at FROM v GROUP BY kind, "key")'


@query(f'WITH {LATEST} SELECT kind, "key", bfile, pos, updated_at FROM l', p=fx.POSITIONS)
def p1_positions(t):
    return positions.latest(t.sql(fx.POSITIONS))


@query("SELECT kind, arg_max(bfile, updated_at) AS bfile, arg_max(pos, updated_at) AS pos FROM p WHERE kind = 'table' AND lower(\"key\") = 'customer' GROUP BY kind", p=fx.POSITIONS)
def p2_lookup(t):
    return positions.lookup(t.sql(fx.POSITIONS), "table", "CUSTOMER")


@query(f"WITH {LATEST} SELECT bfile, pos FROM l WHERE kind = 'table' ORDER BY {NUM}, pos LIMIT 1", p=fx.POSITIONS)
def p3_resume_point(t):
    return positions.resume_point(t.sql(fx.POSITIONS))


@query(f"SELECT op, count(*) AS n, min(pos) AS low FROM feed WHERE op = 'S' OR {ORD} > 2 OR ({ORD} = 2 AND pos > 500) GROUP BY op", feed=fx.ORDERS_FEED)
def p4_skip_applied(t):
    return positions.skip_applied(feed(t), t.sql(fx.POSITIONS)).groupBy("op").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("low"))


@query("SELECT \"key\", bfile, CASE WHEN bfile = 'binlog.000001' THEN least(pos, 100) ELSE pos END AS pos FROM p", p=fx.POSITIONS)
def p5_clamp(t):
    return positions.clamp(t.sql(fx.POSITIONS), "binlog.000001", 100).select("key", "bfile", F.col("pos").cast("long").alias("pos"))


@query("SELECT \"key\", pos FROM p WHERE trim(bfile) <> '' AND pos > 0", p=fx.POSITIONS)
def p6_valid_positions(t):
    return positions.is_valid(t.sql(fx.POSITIONS)).select("key", "pos")


@query(f"SELECT 'orders' AS tbl, max(pos) - 500 AS lag FROM feed WHERE {ORD} = 2", feed=fx.ORDERS_FEED)
def p7_lag(t):
    return positions.lag(feed(t).filter("bfile <= 'binlog.000002'"), t.sql(fx.POSITIONS))


# ---------------------------------------------------------------- functions


@query("SELECT id, strftime(d, '%Y/%m/%d %H:%M:%S') AS a, strftime(d, '%y-%j') AS b, concat(strftime(d, '%Y'), 'T', strftime(d, '%d')) AS c FROM x", x=fx.DATES)
def s1_date_format(t):
    d = F.col("d")
    return t.sql(fx.DATES).select("id", fn.date_format(d, "%Y/%m/%d %T").alias("a"), fn.date_format(d, "%y-%j").alias("b"), fn.date_format(d, "%YT%d").alias("c"))


@query("SELECT id, CASE WHEN id % 10 <> 0 THEN date_trunc('day', d) END AS d FROM x", x=fx.DATES)
def s2_str_to_date(t):
    s = F.when(F.col("id") % 10 == 0, "2024-02-30").otherwise(F.date_format("d", "yyyy-MM-dd"))
    return t.sql(fx.DATES).select("id", fn.str_to_date(s, "%Y-%m-%d").cast("timestamp").alias("d"))


@query("SELECT id, d + INTERVAL 1 MONTH AS m, d - INTERVAL 1 YEAR AS y, d + INTERVAL 36 HOUR AS h FROM x", x=fx.DATES)
def s3_date_add(t):
    d = F.col("d")
    return t.sql(fx.DATES).select("id", fn.date_add(d, 1, "month").alias("m"), fn.date_sub(d, 1, "YEAR").alias("y"), fn.date_add(d, 36, "hour").alias("h"))


@query("SELECT id, d + INTERVAL 3723 SECOND AS d FROM x", x=fx.DATES)
def s4_hour_second(t):
    return t.sql(fx.DATES).select("id", (F.col("d") + fn.hour_second(F.lit("1:2:3"))).alias("d"))


@query("SELECT id, strftime(d + INTERVAL 1 DAY, '%Y%m%d') AS d FROM x", x=fx.DATES)
def s5_shifted_format(t):
    return t.sql(fx.DATES).select("id", fn.shifted_format(F.col("d"), "%Y%m%d", 1, "day").alias("d"))


@query("SELECT id, CAST((year(d) * 12 + month(d)) - (2020 * 12 + 3) AS BIGINT) AS n FROM x", x=fx.DATES)
def s7_period_diff(t):
    p = F.date_format("d", "yyyyMM").cast("int")
    return t.sql(fx.DATES).select("id", fn.period_diff(p, F.lit(202003)).alias("n"))


@query("SELECT id, CASE WHEN id % 300 > 0 THEN make_date(2023, 1, 1) + CAST(id % 300 - 1 AS INTEGER) END AS d FROM x", x=fx.DATES)
def s8_makedate(t):
    return t.sql(fx.DATES).select("id", fn.makedate(F.lit(2023), F.col("id") % 300).alias("d"))


@query("SELECT id, CAST(strlen(s) AS INTEGER) AS bytes, CAST(length(s) AS INTEGER) AS chars FROM x", x=fx.TEXTS)
def s9_lengths(t):
    return t.sql(fx.TEXTS).select("id", fn.length(F.col("s")).alias("bytes"), fn.char_length(F.col("s")).alias("chars"))


@query("SELECT id, CAST(id AS VARCHAR) AS t, CAST(id AS VARCHAR) = s AS same, CAST(id AS VARCHAR) = CAST(id AS VARCHAR) AS own, TRUE AS past FROM x", x=fx.TEXTS)
def s6_text_and_now(t):
    i = F.col("id")
    return t.sql(fx.TEXTS).select("id", fn.as_text(i).alias("t"), fn.text_equal(i, F.col("s")).alias("same"), fn.text_equal(i, fn.as_text(i)).alias("own"), (fn.now() > F.lit("2000-01-01").cast("timestamp")).alias("past"))


@query("SELECT id, CASE WHEN s = '' THEN 'empty' ELSE 'other' END AS v, CAST(s = '' AS INTEGER) AS b FROM x", x=fx.TEXTS)
def s10_if_and_boolean(t):
    c = F.col("s") == ""
    return t.sql(fx.TEXTS).select("id", fn.if_(c, F.lit("empty"), F.lit("other")).alias("v"), fn.as_int(c).alias("b"))


@query("SELECT id, CASE WHEN s IS NULL THEN NULL ELSE string_split(s, ',')[1] END AS a, CASE WHEN s IS NULL THEN NULL ELSE string_split(s, ',')[-1] END AS z FROM x", x=fx.TEXTS)
def s11_substring_index(t):
    return t.sql(fx.TEXTS).select("id", fn.substring_index(F.col("s"), ",", 1).alias("a"), fn.substring_index(F.col("s"), ",", -1).alias("z"))


@query("SELECT id, regexp_matches(s, '(?i)CUSTOMER#?0*[1-5]') AS y, NOT regexp_matches(s, '[0-9]') AS n FROM x", x=fx.TEXTS)
def s12_regexp(t):
    return t.sql(fx.TEXTS).select("id", fn.regexp(F.col("s"), "CUSTOMER#?0*[1-5]").alias("y"), fn.not_regexp(F.col("s"), "[0-9]").alias("n"))


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS HUGEINT) ELSE 18446744073709551616 - o_orderkey END AS DECIMAL(20,0)) AS u, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS c FROM orders")
def s14_unsigned_and_convert(t):
    k = F.col("o_orderkey")
    return t.orders.select(k, fn.unsigned(F.when(k % 2 == 0, k).otherwise(-k)).alias("u"), fn.convert(F.when(k % 3 == 0, "x").otherwise(k.cast("string")), "bigint").alias("c"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def s17_not_exists(t):
    return fn.not_exists(t.customer.select("c_custkey"), t.orders.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("SELECT id, upper(hex(encode(s))) AS h, CASE WHEN s = '' THEN [] ELSE list_transform(range(CAST(ceil(length(s) / 4.0) AS BIGINT)), lambda i: substr(s, i * 4 + 1, 4)) END AS parts, list_filter(list_transform(string_split(s, ','), lambda v: trim(v)), lambda v: v <> '') AS list FROM x WHERE s IS NOT NULL", x=fx.TEXTS)
def s20_hex_chunks_lists(t):
    s = F.col("s")
    return t.sql(fx.TEXTS).filter("s is not null").select("id", fn.hex_text(s.cast("binary")).alias("h"), fn.chunks(s, 4).alias("parts"), fn.csv_list(s).alias("list"))


# ---------------------------------------------------------------- streaming semantics on batches


@query(f"WITH feed AS (SELECT DISTINCT * FROM (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE coalesce(a_key, b_key) % 10 = 0 AND op <> 'S')), {CURRENT} SELECT count(*) AS events, (SELECT count(*) FROM cur) AS rows FROM feed WHERE op <> 'S'", raw=fx.ORDERS_FEED)
def t4_duplicate_suppression(t):
    f = feed(t).filter("op <> 'S'")
    once = apply.drop_duplicates(f.unionByName(f.filter(tr.effective_key() % 10 == 0)))
    rows = replication.replicate(feed(t).filter("op = 'S'").unionByName(once), KEY, VALUES).agg(F.count(F.lit(1)).alias("rows"))
    return once.agg(F.count(F.lit(1)).alias("events")).join(rows)


@query("SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS start, event_type, count(*) AS events FROM events GROUP BY ALL")
def t7_change_rates(t):
    from ..streaming.stream import change_rates

    return change_rates(t.events, by="event_type").select(F.col("window.start").alias("start"), "event_type", "events")


# ---------------------------------------------------------------- keys between tables, layouts, DDL


@query("""WITH RECURSIVE c AS (SELECT tbl, "key", action FROM e WHERE ptbl = 'part' AND pkey BETWEEN 1 AND 5 UNION SELECT e.tbl, e."key", e.action FROM c JOIN e ON e.ptbl = c.tbl AND e.pkey = c."key" WHERE c.action = 'CASCADE') SELECT DISTINCT tbl, "key", action FROM c""", e=fx.PART_LINKS)
def i3_cascade_closure(t):
    """Deletes of five parts through a table that refers to itself, circles included, and on to the lines."""
    links = t.sql(fx.PART_LINKS)
    each = [("part", links.filter(f"tbl = '{n}' and action = '{a}'"), n, "pkey", "key", a) for n, a in (("part", "CASCADE"), ("part", "SET NULL"), ("line", "CASCADE"))]
    return integrity.cascade(t.spark.range(1, 6).toDF("key"), each, "part")


@query("""WITH RECURSIVE b AS (SELECT o.tbl, o."key", o.kind, p.tbl AS up_tbl, p."key" AS up FROM o LEFT JOIN o p ON p.tbl = o.ptbl AND p."key" = o.pkey AND p.kind = o.kind AND NOT (p.tbl = o.tbl AND p."key" = o."key")),
d AS (SELECT tbl, "key", kind, 0 AS depth FROM b WHERE up IS NULL UNION ALL SELECT b.tbl, b."key", b.kind, d.depth + 1 FROM d JOIN b ON b.up_tbl = d.tbl AND b.up = d."key" AND b.kind = d.kind)
SELECT tbl, "key", kind, CAST(CASE WHEN kind = 'U' THEN depth ELSE (SELECT max(depth) + 1 FROM d WHERE kind = 'U') + (SELECT max(depth) FROM d WHERE kind = 'D') - depth END AS INTEGER) AS wave FROM d""", o=fx.WAVE_ROWS)
def e13_row_waves(t):
    """A batch over two tables in waves: chains of parts, and lines after their parts."""
    rows = cut(t.sql(fx.WAVE_ROWS))
    return integrity.waves(rows.select("tbl", "key", "kind"), rows.select("tbl", "key", "ptbl", "pkey"))


@query("""WITH g AS (SELECT lower(tbl) AS tbl, CAST(regexp_extract(bfile, '([0-9]+)$', 1) AS BIGINT) * 1000000000000 + pos AS at_, max({'n1': n1, 'n2': n2, 'n3': coalesce(n3, '')}) AS l FROM lay GROUP BY ALL), r AS (SELECT *, lower(tbl) AS low, CAST(regexp_extract(bfile, '([0-9]+)$', 1) AS BIGINT) * 1000000000000 + pos AS at_ FROM f)
SELECT r.tbl, r.bfile, r.pos, g.l.n1 AS first, CASE WHEN g.l.n1 = 'id' THEN v1 END AS id, CASE WHEN g.l.n2 = 'state' THEN v2 END AS state, CASE WHEN g.l.n3 = 'customer' THEN v3 END AS customer FROM r ASOF LEFT JOIN g ON r.low = g.tbl AND r.at_ >= g.at_""", f=fx.LAYOUT_FEED, lay=fx.LAYOUTS)
def b10_layout_at_position(t):
    """Positional rows under the names that their table had at their place in the log."""
    lay = t.sql(fx.LAYOUTS).select("tbl", "bfile", "pos", F.struct("n1", "n2", F.coalesce("n3", F.lit(""))).alias("order"), F.when(F.col("n3").isNull(), F.array("n1", "n2")).otherwise(F.array("n1", "n2", "n3")).alias("names"), F.when(F.col("n2") == "hidden", F.array(F.lit(2))).otherwise(F.array().cast("array<int>")).alias("hidden"))
    got = layouts.named(t.sql(fx.LAYOUT_FEED).withColumn("values", F.array("v1", "v2", "v3")), lay, "values", segment=1 << 14)
    return got.select("tbl", "bfile", "pos", F.when(F.map_contains_key("image", F.lit("id")), "id").when(F.col("image").isNotNull(), "key").alias("first"), *[F.col("image")[c].alias(c) for c in ("id", "state", "customer")])


@query("SELECT * FROM c", c=fx.DDL_COLUMNS)
def a12_ddl_columns(t):
    return ddl.columns(t.sql(fx.DDL))


@query("""SELECT tbl, 'kind' AS "column", 'z' AS source, 'y' AS target FROM d WHERE "column" = 'kind' AND length(tbl) % 2 <> 0""", d=fx.DDL_COLUMNS)
def f8_default_drift(t):
    """Defaults as the DDL declares them against those of the target."""
    return drift.changed(ddl.columns(t.sql(fx.DDL)).filter("not generated"), t.sql(fx.DDL_STORED), "default", drift.plain_default)


@query("""SELECT tbl, 'no`te' AS "column", comment AS source, concat(comment, '!') AS target FROM d WHERE "column" = 'no`te' AND length(tbl) % 3 = 0""", d=fx.DDL_COLUMNS)
def f9_comment_drift(t):
    return drift.changed(ddl.columns(t.sql(fx.DDL)), t.sql(fx.DDL_STORED), "comment")


# ---------------------------------------------------------------- logs, streams, targets


def log_of(t, rows: DataFrame) -> str:
    """A feed written as a change log, for the queries that read one."""
    path = shared_path(t.spark, "log")
    changelog.write_log(rows, path)
    return path


TYPED = "src_db string, tbl string, op string, b_key long, b_status string, b_price double, a_key long, a_status string, a_price double, bfile string, pos long, row_seq int"


@query("SELECT op, coalesce(a_key, b_key) AS k, a_status AS status, bfile, pos, row_seq FROM feed", feed=fx.ORDERS_FEED)
def a3_change_log(t):
    """The feed, read back from the files of a log."""
    got = changelog.change_log(t.spark, log_of(t, feed(t)), TYPED)
    return got.select("op", tr.effective_key().alias("k"), F.col("a_status").alias("status"), "bfile", "pos", "row_seq")


@query(f"WITH {CURRENT} {ALL}", feed=fx.ORDERS_FEED)
def t2_stream_state(t):
    """A log read as a stream, its latest rows in the state store; what takes effect is written once and read back."""
    out, place = shared_path(t.spark, "changes"), shared_path(t.spark, "stream")
    events = changelog.change_log_stream(t.spark, log_of(t, feed(t)), TYPED)
    latest.apply_stream(events, KEY, VALUES, out, place, trigger={"availableNow": True}).awaitTermination()
    return latest.current_rows(t.spark, out, KEY, VALUES)


@query(f"SELECT lower(tbl) AS tbl, op, count(*) AS read, count(*) FILTER (ok) AS kept, count(*) FILTER (NOT ok) AS filtered FROM (SELECT *, CASE WHEN op = 'D' THEN {B_KEEP} ELSE {A_KEEP} END AS ok FROM feed) GROUP BY ALL", feed=fx.TENANT_FEED)
def t6_live_counters(t):
    """Counters of a stream while it runs, from what its batches observe."""
    path = shared_path(t.spark, "feed")
    t.sql(fx.TENANT_FEED).write.parquet(path)
    events = t.spark.readStream.schema(t.spark.read.parquet(path).schema).parquet(path)
    count = counters.LiveCounters("tenants")
    t.spark.streams.addListener(count)
    try:
        run = counters.observed(events, "tenants", kept(t), ("customer",)).writeStream.format("noop").option("checkpointLocation", shared_path(t.spark, "stream")).trigger(availableNow=True).start()
        run.awaitTermination()
        count.wait(run)
    finally:
        t.spark.streams.removeListener(count)
    return count.frame(t.spark)


MANY = """SELECT 'orders' AS tbl, CASE WHEN o_orderkey % 2 = 0 THEN 'East' ELSE 'west' END AS tgt_db, o_orderkey AS id, CAST(o_totalprice AS VARCHAR(30)) AS price, CASE WHEN o_orderkey % 50 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR(20)) END AS who FROM {orders}
UNION ALL SELECT 'Customer', 'east', c_custkey, CAST(c_acctbal AS VARCHAR(30)), CAST(c_nationkey AS VARCHAR(20)) FROM {customer} UNION ALL SELECT 'part', 'nowhere', p_partkey, '1', '1' FROM {part}"""
MANY_COLUMNS = [("east", "ORDERS", 1, "ID", "bigint"), ("east", "ORDERS", 2, "Who", "int"), ("east", "ORDERS", 3, "added", "varchar(9)"), ("west", "orders", 1, "id", "bigint"), ("west", "orders", 2, "price", "decimal(20,2)"), ("East", "customer", 1, "id", "int"), ("East", "customer", 2, "price", "double"), ("East", "customer", 3, "who", "text")]


@query("""SELECT 'east.orders' AS target, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids, CAST(sum(CAST(who AS BIGINT)) AS VARCHAR) AS total FROM f WHERE tbl = 'orders' AND tgt_db = 'East' AND who <> 'x'
UNION ALL SELECT 'west.orders', count(*), CAST(sum(id) AS BIGINT), CAST(sum(CAST(price AS DECIMAL(20,2))) AS VARCHAR) FROM f WHERE tgt_db = 'west' UNION ALL SELECT 'east.customer', count(*), CAST(sum(id) AS BIGINT), CAST(count(DISTINCT who) AS VARCHAR) FROM f WHERE tbl = 'Customer'
UNION ALL SELECT 'rejects: unknown target', count(*), CAST(sum(id) AS BIGINT), NULL FROM f WHERE tgt_db = 'nowhere' UNION ALL SELECT 'rejects: does not fit: Who', count(*), CAST(sum(id) AS BIGINT), NULL FROM f WHERE who = 'x' AND tgt_db = 'East'""", f=MANY)
def e14_written_targets(t):
    """A batch of many targets written in one pass and read back, each under its own columns, with what was refused."""
    rows = t.sql(MANY).select("tbl", "tgt_db", F.create_map(F.lit("Id"), F.col("id").cast("string"), F.lit("price"), F.col("price"), F.lit("WHO"), F.col("who")).alias("after"))
    path = shared_path(t.spark, "targets")
    targets.write_targets(rows, t.spark.createDataFrame(MANY_COLUMNS, "tgt_db string, tbl string, ordinal int, column string, type string"), path)
    sums = lambda df, name, ids, total: df.agg(F.lit(name).alias("target"), F.count(F.lit(1)).alias("n"), F.sum(ids).alias("ids"), total.cast("string").alias("total"))
    read = lambda db, tbl, schema: targets.read_target(t.spark, path, db, tbl, schema)
    out = sums(read("east", "orders", "ID long, Who int, added string"), "east.orders", "ID", F.sum("Who"))
    out = out.unionByName(sums(read("west", "orders", "id long, price decimal(20,2)"), "west.orders", "id", F.sum("price")))
    out = out.unionByName(sums(read("east", "customer", "id int, price double, who string"), "east.customer", "id", F.count_distinct("who")))
    bad = targets.read_rejects(t.spark, path).select(F.concat(F.lit("rejects: "), "reason").alias("target"), F.get_json_object("value", "$.after.Id").cast("long").alias("id"))
    return out.unionByName(bad.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"), F.lit(None).cast("string").alias("total")))


@query("""WITH x AS (SELECT CAST(power(o_orderkey % 1000, 3) AS BIGINT) * 100000 + o_orderkey AS k, concat(CASE WHEN o_orderkey % 4 = 0 THEN 'customer/' ELSE 'customer/of/the/long/way/' END, o_orderkey) AS s FROM orders)
SELECT 'number' AS keys, count(*) AS rows, min(k)::VARCHAR AS low, max(k)::VARCHAR AS high, TRUE AS even, TRUE AS apart FROM x UNION ALL SELECT 'text', count(*), min(s), max(s), TRUE, TRUE FROM x""")
def a1_equal_ranges(t):
    """Ranges of skewed numbers and of texts that are long alike: all rows once, none with over twice its share, none that meet."""
    o = t.orders.select(((F.col("o_orderkey") % 1000).cast("long") ** 3).cast("long").alias("c"), "o_orderkey")
    x = o.select((F.col("c") * 100_000 + F.col("o_orderkey")).alias("k"), F.concat(F.when(F.col("o_orderkey") % 4 == 0, "customer/").otherwise("customer/of/the/long/way/"), "o_orderkey").alias("s"))
    out = None
    for name, key in (("number", "k"), ("text", "s")):
        r = ranges.equi_depth(x, key, 16)
        after = F.lead("low").over(Window.orderBy("part"))  # a row per range
        r = r.withColumn("apart", F.coalesce(after > F.col("high"), F.lit(True)))
        part = r.agg(F.lit(name).alias("keys"), F.sum("rows").alias("rows"), F.min("low").cast("string").alias("low"), F.max("high").cast("string").alias("high"), (F.max("rows") <= 2 * F.ceil(F.sum("rows") / 16)).alias("even"), F.bool_and("apart").alias("apart"))
        out = part if out is None else out.unionByName(part)
    return out


def priced(b):
    """Example of a row transform: a tax on the price, no orders below 1000 and none of status P."""
    import pyarrow as pa
    import pyarrow.compute as pc

    low, status = pc.less(b.column("o_totalprice"), 1000.0), pc.equal(b.column("o_orderstatus"), "P")
    reason = pc.if_else(low, "too small", pc.if_else(status, "still open", pa.nulls(len(b), pa.string())))
    return pa.RecordBatch.from_arrays([b.column("o_orderkey"), pc.multiply(b.column("o_totalprice"), 1.25)], ["id", "price"]), reason


@query("""SELECT CASE WHEN o_totalprice < 1000 THEN 'too small' WHEN o_orderstatus = 'P' THEN 'still open' ELSE 'accepted' END AS side, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS ids, round(sum(CASE WHEN o_totalprice >= 1000 AND o_orderstatus <> 'P' THEN o_totalprice * 1.25 END), 2) AS price FROM orders GROUP BY ALL""")
def u1_reject_output(t):
    """Rows and rejections of a row transform, from one pass."""
    got = cut(reject.judged(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), priced, "id long, price double"))
    rows, refused = reject.split(got)
    both = rows.select(F.lit("accepted").alias("side"), "id", "price").unionByName(refused.select(F.col("reason").alias("side"), F.get_json_object("original", "$.o_orderkey").cast("long").alias("id"), F.lit(None).cast("double").alias("price")))
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"), F.round(F.sum("price"), 2).alias("price"))


@query("""SELECT tbl, lower(CASE WHEN lower("column") = 'level' THEN 'level_' ELSE "column" END) AS target, count(*) AS n FROM (SELECT tbl, "column" FROM c UNION ALL SELECT tbl, 'Level' FROM c WHERE "column" = 'Id' AND length(tbl) % 2 = 0 UNION ALL SELECT tbl, 'LEVEL_' FROM c WHERE "column" = 'Id' AND length(tbl) % 4 = 0) GROUP BY ALL HAVING count(*) > 1""", c=fx.CATALOG)
def b8_name_clashes(t):
    """Columns of a table that would get one name in the target."""
    c = t.sql(fx.CATALOG).select("tbl", "column")
    more = lambda name, n: c.filter((F.col("column") == "Id") & (F.length("tbl") % n == 0)).select("tbl", F.lit(name).alias("column"))
    return tr.name_clashes(c.unionByName(more("Level", 2)).unionByName(more("LEVEL_", 4)))


@query("SELECT tbl, coalesce(note, '') AS comment FROM (SELECT tbl, max(CASE WHEN generated THEN type END) AS note FROM c GROUP BY tbl) WHERE regexp_matches(tbl, 's$')", c=fx.CATALOG)
def a11_table_comments(t):
    c = t.sql(fx.CATALOG).groupBy("tbl").agg(F.max(F.when(F.col("generated"), F.col("type"))).alias("comment"))
    return scans.comments(c, scans.select_tables(c, include="s$"))
