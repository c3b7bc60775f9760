"""Literal cases and properties of the change-data-capture operators."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cdcspark.functions import mysqlfn as fn
from cdcspark.operators import apply, drift, integrity, positions, reconcile, split
from cdcspark.operators import transforms as tr
from cdcspark.plans import fixtures as fx
from cdcspark.plans import replication
from cdcspark.plans.queries import Tables
from cdcspark.sources import scans, sinks
from cdcspark.streaming import stream

SF = "/root/testdata/sf0.001"
KEY, VALUES = ["key"], ["status", "price"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def feed(spark):
    return Tables(spark, SF).sql(fx.ORDERS_FEED).persist()


def test_order_of_files_is_numeric(spark):
    df = spark.createDataFrame([("log.999999",), ("log.1000000",), ("",), (None,)], "f string")
    assert [r[0] for r in df.select(apply.file_number("f")).collect()] == [999999, 1000000, 0, 0]


def test_shuffled_and_split_input_gives_the_same_state(spark, feed):
    want = rows(replication.replicate(feed, KEY, VALUES))
    assert rows(replication.replicate(feed.orderBy(F.rand(3)).repartition(7), KEY, VALUES)) == want
    empty = apply.to_state(apply.compact(apply.key_ops(feed.limit(0), KEY, VALUES), KEY, VALUES), KEY, VALUES)
    parts = [feed.filter(F.pmod(F.xxhash64("pos", "op"), F.lit(4)) == i) for i in range(4)]
    assert rows(apply.alive(replication.in_batches(empty, KEY, VALUES, [*parts, parts[0]]), KEY, VALUES)) == want


def test_partial_updates_against_a_simulation(spark):
    rng, events, state = random.Random(5), [], {}
    for i in range(600):
        k, op = str(rng.randint(1, 25)), rng.choice("IUUUUD")
        image = {c: rng.choice([None, str(i)]) for c in "xy" if op != "U" or rng.random() < 0.6}
        before = {"id": k} if op != "I" else None
        after = None if op == "D" else {"id": k, **image}
        new = k
        if op == "U" and k in state and rng.random() < 0.1:
            new = str(rng.randint(100, 120))
            before = {"id": k, **state[k]}
            after = {"id": new, **image}
        events.append((op, before, after, "log.000001", i, 0))
        if op == "D":
            state.pop(k, None)
        elif new != k:
            old = state.pop(k)
            state[new] = {"x": None, "y": None} | old | image
        else:
            state[k] = ({"x": None, "y": None} if op == "I" else state.get(k, {"x": None, "y": None})) | image
    rng.shuffle(events)
    df = spark.createDataFrame(events, "op string, before map<string,string>, after map<string,string>, bfile string, pos long, row_seq int")
    got = rows(apply.apply_partial(apply.partial_ops(df, ["id"]), ["id"], ["x", "y"]))
    assert got == sorted(((k, v["x"], v["y"]) for k, v in state.items()), key=str)


def test_update_from_two_partners_is_an_error(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(1, "x"), (1, "y")], "k int, w string")
    with pytest.raises(Exception, match="more than one row"):
        apply.update_from(t, s, ["k"], {"v": "w"}).collect()


def test_column_in_literals(spark):
    df = spark.createDataFrame([("U", None, "20001", None), ("U", None, "10001", None), ("I", None, None, None), ("U", None, None, "10002")], "op string, b_project_id string, a_project_id string, a_tenant_id string").withColumn("b_tenant_id", F.lit(None).cast("string"))
    keep = tr.column_in(["project_id", "tenant_id"], ["10001", "10002"], exact=False)
    assert df.transform(keep).count() == 3


def test_positional_names_and_hidden_places(spark):
    df = spark.createDataFrame([(["7", "", "2026-06-16"], ["id", "hidden", "settleDate"], [2]), (["7"], ["id", "a"], None), (["1", "2", "3"], ["id"], [])], "v array<string>, n array<string>, h array<int>")
    assert [r[0] for r in df.select(tr.name_values("v", "n", "h")).collect()] == [{"id": "7", "settleDate": "2026-06-16"}, {"id": "7", "a": None}, {"id": "1"}]
    lay = spark.createDataFrame([("t", ["int", "datetime", "varchar", "decimal", "date"], ["int", "datetime", "varchar", "int", "decimal", "date"]), ("u", ["int"], ["int", "int"]), ("w", ["int"], ["int"])], "tbl string, types array<string>, wire array<string>")
    assert rows(tr.hidden_place(lay)) == [("t", 4), ("u", None)]


def test_lower_keys_last_wins(spark):
    df = spark.sql("SELECT map('Ab', '1', 'x', '2', 'AB', '3') AS m")
    assert df.select(tr.lower_keys("m")).first()[0] == {"ab": "3", "x": "2"}


def test_render_json(spark):
    df = spark.sql("SELECT 1 AS a, X'01ff' AS b, CAST(NULL AS STRING) AS c, TIMESTAMP '1970-01-01 00:00:01' AS d")
    assert df.select(tr.render_json(["a", "b", "c", "d"], ("b",), ("d",))).first()[0] == '{"a":1,"b":"01ff","c":null,"d":1000000}'


def test_types_and_widening(spark):
    df = spark.createDataFrame([("INT(11) unsigned", "int", True), ("tinyint", "bigint", False), ("decimal(12,2)", "decimal(10,0)", True), ("varchar(600)", "varchar(20)", True), ("varchar(20)", "text", False), ("date", "int", False), ("tinyint(1)", "bit", True), ("int", "varchar(9)", True), ("int", "decimal(10,0)", False), ("decimal(9,2)", "bigint", True), ("text", "varchar(20)", True), ("blob", "varchar(20)", True), ("blob", "longblob", False), ("datetime", "date", True), ("timestamp", "datetime", False), ("char(3)", "varchar(9)", True), ("varchar(5)", "varchar(9)", False)], "s string, t string, w boolean")
    assert all(r[0] == r[1] for r in df.select(drift.widens(F.col("s"), F.col("t")), "w").collect())
    assert [r[0] for r in df.limit(6).select(drift.spark_type("s")).collect()] == ["bigint", "tinyint", "decimal(12,2)", "string", "string", "date"]
    d = spark.createDataFrame([(x,) for x in ("tinyint(1)", "TINYINT(4)", "mediumint", "bigint(20) unsigned", "decimal(10,2)", "varchar(30)", "time", "timestamp", "longtext", "json")], "s string")
    assert [r[0] for r in d.select(drift.store_type("s")).collect()] == ["BOOLEAN", "TINYINT", "INT", "BIGINT", "DECIMAL(10,2)", "VARCHAR(30)", "VARCHAR(32)", "DATETIME", "STRING", "STRING"]


def test_late_types_and_defaults(spark):
    df = spark.createDataFrame([({"a": None, "N": "x"}, 1), ({"a": "5", "n": "2"}, 2), ({"d": "2024-01-02"}, 3)], "after map<string,string>, at int")
    assert rows(drift.late_types(df, ["id"], F.col("at"))) == [("a", "bigint"), ("d", "date"), ("n", "string")]
    d = spark.createDataFrame([("'x'",), ("(0)",), ("NULL",), ("NOW()",), ("CURRENT_TIMESTAMP(3)",)], "d string")
    assert [r[0] for r in d.select(drift.plain_default("d")).collect()] == ["x", "0", None, "current_timestamp", "current_timestamp"]


def test_compare_kinds(spark):
    cases = [("decimal", "0.00", "0", True), ("float", "98.00", "9.8E1", True), ("integer", "2", "2", True), ("integer", "0", "1", False), ("json", '{ "b": 1 }', '{"b":1}', True), ("datetime", "2026-06-27 12:13:14.120000000", "2026-06-27 12:13:14.12", True), ("time", "01:02:03.000000", "01:02:03", True), ("char", "abc   ", "abc", True), ("date", "2026-06-27 00:00:00", "2026-06-27", True), ("text", None, "", False), ("text", None, None, True)]
    for kind, a, b, want in cases:
        df = spark.createDataFrame([(a, b)], "a string, b string")
        assert df.select(reconcile.equal(F.col("a"), F.col("b"), kind)).first()[0] is want, (kind, a, b)
    assert reconcile.column_plan([("a", "int(11)", False), ("g", "int", True), ("c", "char(3)", False)]) == [("a", "integer"), ("c", "char")]


def test_positions_resume_at_the_least(spark):
    p = spark.createDataFrame([("table", "a", "mysql-bin.000010", 120, 1), ("table", "b", "mysql-bin.000011", 4, 2), ("stream", "s", "mysql-bin.000012", 4, 3)], "kind string, key string, bfile string, pos long, updated_at int")
    assert rows(positions.resume_point(p)) == [("mysql-bin.000010", 120)]
    assert rows(positions.resume_point(p, furthest=True)) == [("mysql-bin.000012", 4)]


def test_apply_order_and_cycles():
    assert integrity.apply_order(["l", "o", "c"], [("l", "o"), ("o", "c")]) == (["c", "o", "l"], [])
    assert integrity.apply_order(["a", "b", "c"], [("a", "b"), ("b", "a")]) == (["c"], ["a", "b"])


def test_delete_script_quotes_and_confirmation(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("x'y",), ("z",)], "id string")
    script = split.delete_script(df, "id", "t", 2)
    assert rows(script.orderBy("batch")) == [(0, "DELETE FROM t WHERE id IN ('a', 'x''y');"), (1, "DELETE FROM t WHERE id IN ('z');")]
    with pytest.raises(ValueError):
        split.write_script(script, str(tmp_path / "s"), "", "t")
    with pytest.raises(ValueError):
        split.check_plugins(["Plus", "Split"])


def test_function_literals(spark):
    df = spark.sql("SELECT '2024-01-31' AS d, ',a' AS s")
    r = df.select(fn.period_diff(F.lit(202607), F.lit(202601)), fn.makedate(F.lit(2026), F.lit(3)).cast("string"), fn.makedate(F.lit(2026), F.lit(0)), fn.date_add(F.to_timestamp("d"), 1, "month").cast("string"), fn.substring_index(F.col("s"), ",", 1), fn.length(F.lit("中")), fn.unsigned(F.lit(-1)).cast("string"), fn.str_to_date(F.lit("2024-02-30"), "%Y-%m-%d")).first()
    assert tuple(r) == (6, "2026-01-03", None, "2024-02-29 00:00:00", "", 3, "18446744073709551615", None)
    with pytest.raises(ValueError):
        fn.pattern("%Q")


def test_registry(spark):
    tr.register_transform("Upper", lambda column: lambda df: df.withColumn(column, F.upper(column)))
    df = spark.createDataFrame([("a",)], "x string").transform(tr.build_chain([("Upper", {"column": "x"})]))
    assert df.first()[0] == "A"


def test_file_sinks(spark, feed, tmp_path):
    sinks.op_coded_json(feed, KEY, VALUES, str(tmp_path / "op"))
    back = spark.read.json(str(tmp_path / "op"))
    assert back.count() == feed.count() and back.filter("__op = 1 and status is not null").count() == 0
    latest = apply.compact(apply.key_ops(feed, KEY, VALUES), KEY, VALUES)
    sinks.search_index(latest, KEY, VALUES, str(tmp_path / "idx"))
    assert spark.read.text(str(tmp_path / "idx/documents")).count() == latest.filter("kind = 'U'").count()
    assert spark.read.text(str(tmp_path / "idx/deleted")).count() == latest.filter("kind = 'D'").count()


def test_windowed_rates_stream(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("ts", F.col("event_type").alias("op"))
    ev.repartition(2).write.parquet(str(tmp_path / "ev"))
    s = spark.readStream.schema(ev.schema).parquet(str(tmp_path / "ev"))
    q = stream.change_rates(s).writeStream.format("memory").queryName("rates").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert rows(spark.table("rates")) == rows(stream.change_rates(ev))


def test_retry():
    seen = []

    def sink(df, batch):
        seen.append(batch)
        if len(seen) < 3:
            raise OSError("busy")

    stream.with_retry(sink, 5, 0.001)(None, 7)
    assert seen == [7, 7, 7]


def test_compare_long_numbers_and_broken_json(spark):
    cases = [("decimal", "1e-11", "2e-11", False), ("decimal", "0.00000000001", "1e-11", True), ("integer", "9" * 32, "9" * 32, True), ("integer", "9" * 32, "9" * 31 + "8", False), ("decimal", "-0.0", "0", True), ("decimal", "1.50e3", "1500", True), ("decimal", "NaN", "NaN", True), ("decimal", "abc", "abd", False), ("json", "{broken", "{broken", True), ("json", "{broken", "{}", False), ("json", '{"a":[1, 2]}', '{ "a" : [1,2] }', True)]
    df = spark.createDataFrame([(k, a, b) for k, a, b, _ in cases], "k string, a string, b string")
    for kind, a, b, want in cases:
        got = df.filter((F.col("k") == kind) & (F.col("a") == a) & (F.col("b") == b)).select(reconcile.equal(F.col("a"), F.col("b"), kind)).first()[0]
        assert got is want, (kind, a, b)


@pytest.mark.parametrize("worth", [0.0, 0.5, 1.0])
def test_digests_tell_rows_with_separators_and_nulls(spark, worth):
    s = spark.createDataFrame([(1, "a|b", "c"), (2, None, "x"), (3, "y", "z"), (None, "n", "n")], "k long, a string, b string")
    t = spark.createDataFrame([(1, "a", "b|c"), (2, "~", "x"), (3, "y", "z"), (None, "n", "n")], "k long, a string, b string")
    plan = [("a", "text"), ("b", "text")]
    got = reconcile.drill(s, t, "t", "k", plan, leaf=1, worth=worth)
    assert rows(got) == rows(reconcile.mismatches(s, t, "t", "k", plan)) and got.count() == 5
    assert reconcile.drill(s.dropna(subset=["k"]), s.dropna(subset=["k"]), "t", "k", plan, worth=worth).count() == 0


def test_digests_see_what_wider_types_hold(spark):
    cases = [("k long, v long", (1, 7), "k long, v double", (1, 7.4), "decimal", 1), ("k long, v decimal(10,2)", (1, Decimal("7.00")), "k long, v decimal(20,4)", (1, Decimal("7.0004")), "decimal", 1), ("k long, v decimal(10,2)", (1, Decimal("7.00")), "k long, v decimal(20,4)", (1, Decimal("7.0000")), "decimal", 0), ("k long, v long", (1, 7), "k long, v string", (1, "x"), "integer", 1), ("k long, v double", (1, 7.0), "k long, v string", (1, "x"), "float", 1), ("k long, v long", (1, 7), "k long, v string", (1, "7.0"), "integer", 0), ("k long, v double", (1, 7.0), "k long, v double", (1, 7.000001), "float", 0), ("k long, v string", (1, "2026-06-27 00:00:00.10"), "k long, v string", (1, "2026-06-27 00:00:00.1"), "datetime", 0), ("k int, v string", (1, "a"), "k decimal(9,1), v string", (Decimal("1.0"), "a "), "char", 0), ("k string, v string", ("a", "x"), "k string, v string", ("a", "y"), "text", 1)]
    for schema, row, other, partner, kind, n in cases:
        s, t = spark.createDataFrame([row], schema), spark.createDataFrame([partner], other)
        assert reconcile.drill(s, t, "t", "k", [("v", kind)], worth=1.0).count() == reconcile.mismatches(s, t, "t", "k", [("v", kind)]).count() == n, (row, partner)


def test_tree_reads_only_below_unequal_nodes(spark, tmp_path):
    s = spark.range(40_000).select(F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id") % 97).alias("v"))
    t = s.withColumn("v", F.when(F.col("k").isin(5, 6, 33_333), "w").otherwise(F.col("v"))).filter("k <> 12345")
    both = reconcile.trees(s, t, "k", [("v", "text")], str(tmp_path / "d"))
    bad, report = both[0].unequal(both[1])
    assert report == [(1, 20, 3), (0, 96, 3)] and rows(bad) == [(0,), (192,), (520,)]
    assert rows(reconcile.drill(s, t, "t", "k", [("v", "text")], both=both)) == rows(reconcile.mismatches(s, t, "t", "k", [("v", "text")]))
    one = reconcile.DigestTree(spark, str(tmp_path / "d/source"), 2)
    assert one.unequal(both[0])[1] == [(1, 20, 0)]


def test_first_unequal_chunk_of_large_values(spark):
    long = "é" * 450
    s = spark.createDataFrame([(1, long), (2, long), (3, long), (4, "a"), (5, ""), (6, None), (7, long)], "k long, v string")
    t = spark.createDataFrame([(1, long[:399] + "e" + long[400:]), (2, long + "x"), (3, long), (4, "b"), (5, "x"), (6, "x"), (7, long[:200])], "k long, v string")
    assert rows(reconcile.large_differences(s, t, "k", "v")) == [(1, 900, 899, 1, 399), (2, 900, 901, 2, 450), (4, 1, 1, 0, 0), (5, 0, 1, 0, 0), (7, 900, 400, 1, 200)]
    b, c = (df.select("k", F.col("v").cast("binary").alias("v")) for df in (s, t))
    assert rows(reconcile.large_differences(b, c, "k", "v"))[0] == (1, 900, 899, 0, 798)


def test_zero_of_types_by_containment():
    assert [tr.zero_of(k) for k in ("bit(1)", "bool", "longtext", "real", "BIGINT(20) unsigned", "datetime(3)", "json", "mediumblob")] == ["0", "0", "", "0.0", "0", "1970-01-01 00:00:00", "{}", ""]


def test_upserts_leave_out_null_keys(spark):
    t = spark.createDataFrame([(1, "a")], "k long, v string")
    r = spark.createDataFrame([(None, "x"), (1, "b"), (2, "c")], "k long, v string")
    once = apply.upsert(t, r, ["k"])
    assert rows(once) == rows(apply.upsert(once, r, ["k"])) == [(1, "b"), (2, "c")]


def test_cascade_lists_a_row_once_and_order_of_applies(spark):
    p = spark.createDataFrame([(1,), (2,)], "k long")
    c = spark.createDataFrame([(10, 1, 2)], "k long, a long, b long")
    got = integrity.cascade(p, [("p", c, "c", "a", "k", "CASCADE"), ("p", c, "c", "b", "k", "CASCADE")], "p")
    assert rows(got) == [("c", 10, "CASCADE")]
    done = []
    d = {n: None for n in ("orders", "lines")}
    order = integrity.in_order(d, d | {"customer": None}, [("lines", "orders"), ("orders", "customer")], lambda a, t, _: done.append((a, t)))
    assert order == done == [("delete", "lines"), ("delete", "orders"), ("upsert", "customer"), ("upsert", "orders"), ("upsert", "lines")]


def test_compare_reads_a_number_once_and_casts_no_other_text(spark):
    """Trailing text behind JSON is no JSON; the plan of a comparison has each regular expression a few times, not hundreds."""
    df = spark.createDataFrame([("5", "5.0\n"), ("{}x", "{}"), ("0x1p3", "8.0")], "a string, b string")
    got = df.select(reconcile.equal(F.col("a"), F.col("b"), "decimal"), reconcile.equal(F.col("a"), F.col("b"), "json")).collect()
    assert [tuple(r) for r in got] == [(True, True), (False, False), (True, False)]
    plan = df.select(reconcile.equal(F.col("a"), F.col("b"), "decimal").alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 6000


def test_skipped_events_come_once_and_without_an_exchange_by_table(spark, monkeypatch):
    """Many positions of other tables do not send the feed to one task; a table stored in two writings counts once."""
    monkeypatch.setattr("cdcspark.scratch.SMALL", 5)
    p = spark.range(50).selectExpr("'table' as kind", "concat('other', id) as key", "'log.1' as bfile", "id + 1 as pos", "1 as updated_at")
    p = p.union(spark.createDataFrame([("table", "T", "log.2", 7, 1), ("table", "t", "log.1", 9, 2)], "kind string, key string, bfile string, pos long, updated_at int"))
    feed = spark.createDataFrame([("t", "U", "log.1", 9), ("T", "U", "log.2", 8), ("t", "S", "", 0), ("u", "U", "log.1", 1)], "tbl string, op string, bfile string, pos long")
    got = positions.skip_applied(feed, p)
    assert rows(got) == [("T", "U", "log.2", 8), ("t", "S", "", 0), ("u", "U", "log.1", 1)]
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
