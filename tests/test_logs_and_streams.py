"""Change logs, keyed stream state, counters, targets, layouts, key graphs, DDL, ranges: literal cases and failures."""

import json
import time

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cdcspark.operators import apply, integrity, layouts, reject
from cdcspark.plans import fixtures as fx
from cdcspark.plans import replication
from cdcspark.plans.queries import TYPED, Tables
from cdcspark.sources import changelog, ddl, ranges, statements, targets
from cdcspark.streaming import counters, latest

SF = "/root/testdata/sf0.001"
KEY, VALUES = ["key"], ["status", "price"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---------------------------------------------------------------- logs


def event(key, op="U", pos=0, status="a", bfile="log.000001"):
    one = {"src_db": "s", "tbl": "orders", "op": op, "bfile": bfile, "pos": pos, "row_seq": 0}
    return one | ({} if op == "I" else {"b_key": key}) | ({} if op == "D" else {"a_key": key, "a_status": status, "a_price": 1.0})


def append(path, events, end="\n"):
    with open(path, "a", encoding="utf-8") as f:
        f.write("".join(json.dumps(e, ensure_ascii=False) + end for e in events))


def test_log_is_read_in_stretches_that_end_at_lines(spark, tmp_path, monkeypatch):
    append(tmp_path / "log.000009", [event(k, pos=k, status="é" * (k % 50)) for k in range(300)])
    append(tmp_path / "log.000010", [event(900)])
    append(tmp_path / "log.000010", [event(901)], end="")  # still being written
    (tmp_path / "_other").write_text("no log\n")
    (tmp_path / "log.000011").write_text("")
    monkeypatch.setattr(changelog, "SPLIT", 700)
    log = changelog.Log(str(tmp_path))
    assert [n for n, _ in log.files()] == ["log.000009", "log.000010", "log.000011"]
    parts = changelog.LogReader(str(tmp_path)).partitions()
    got = [json.loads(x)["pos" if "9" in p.path[-3:] else "a_key"] for p in parts for b in changelog.lines(log, p) for x in b.column("line").to_pylist()]
    assert len(parts) > 20 and got == [*range(300), 900]
    for p in parts:
        for b in changelog.lines(log, p):
            raw = open(p.path, "rb").read()
            assert all(raw[at : at + len(x.encode())] == x.encode() for x, at in zip(b.column("line").to_pylist(), b.column("at").to_pylist()))
    assert changelog.change_log(spark, str(tmp_path), TYPED).count() == 301
    assert changelog.change_log(spark, str(tmp_path / "none"), TYPED).count() == 0


def test_offsets_move_by_the_limit_and_never_back(tmp_path):
    path, place = tmp_path / "logs", str(tmp_path / "place" / "at")
    path.mkdir()
    append(path / "log.1", [event(k, pos=k) for k in range(100)])
    append(path / "log.2", [event(k, pos=k) for k in range(100, 130)])
    seen, start = [], {"file": "", "at": 0}
    for turn in range(200):
        reader = changelog.LogStreamReader(str(path), 1500, place)  # each time anew, as after a stop
        end = reader.latestOffset()
        if end == start:
            break
        parts = reader.partitions(start, end)
        assert sum(p.end - p.begin for p in parts) <= 1500 + 200
        seen += [json.loads(x)["pos"] for p in parts for b in reader.read(p) for x in b.column("line").to_pylist()]
        assert changelog.LogStreamReader(str(path), 1500, place).latestOffset() == end  # not yet committed: the same again
        reader.commit(end)
        start = end
    assert seen == list(range(130)) and turn > 5
    with pytest.raises(ValueError):
        changelog.LogStreamReader(str(path), 10, None)


def test_stream_that_stops_goes_on_without_loss_or_repeats(spark, tmp_path):
    """Batches by limit, a failure in between, lines and files added later: the table is that of the whole feed."""
    feed = Tables(spark, SF).sql(fx.ORDERS_FEED).filter("coalesce(a_key, b_key) % 10 = 0")
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    changelog.write_log(feed.filter("bfile < 'binlog.000003'"), path)
    failed = []

    def once_failing(df):
        if len(failed) == 1:
            failed.append(1)
            return df.withColumn("op", F.expr("if(op = 'D', raise_error('lost'), op)"))
        failed.append(1)
        return df

    def start():
        events = changelog.change_log_stream(spark, path, TYPED, limit=12_000, progress=str(tmp_path / "place"))
        return latest.apply_stream(events, KEY, VALUES, out, str(tmp_path / "cp"), once_failing, {"availableNow": True})

    start().awaitTermination()
    with pytest.raises(Exception, match="lost"):
        for _ in range(10):
            start().awaitTermination()
            failed[:] = [1]
    changelog.write_log(feed.filter("bfile = 'binlog.000003'"), str(tmp_path / "more"))
    (tmp_path / "more" / "bfile=binlog.000003").rename(tmp_path / "log" / "bfile=binlog.000003")
    assert latest.drain(start) > 1
    assert rows(latest.current_rows(spark, out, KEY, VALUES)) == rows(replication.replicate(feed, KEY, VALUES))
    changes = spark.read.parquet(out)
    assert changes.count() == changes.select("key", *apply.PLACE).distinct().count()  # each once


def test_late_rows_and_expired_tombstones(spark, tmp_path):
    path, out = tmp_path / "log", str(tmp_path / "out")
    path.mkdir()

    def run(retention=None):
        events = changelog.change_log_stream(spark, str(path), TYPED)
        latest.apply_stream(events, KEY, VALUES, out, str(tmp_path / "cp"), trigger={"availableNow": True}, retention=retention).awaitTermination()
        return rows(latest.current_rows(spark, out, KEY, ["status"]))

    append(path / "log.1", [event(1, "I", 10), event(2, "I", 11), event(2, "D", 30), event(1, "U", 20, "b"), event(3, "I", 12, None)])
    assert run(1500) == [(1, "b"), (3, None)]
    append(path / "log.1", [event(2, "U", 25, "late"), event(1, "U", 15, "late")])
    assert run(1500) == [(1, "b"), (3, None)] and spark.read.parquet(out).count() == 3
    time.sleep(2)
    append(path / "log.1", [event(4, "I", 40)])
    run(1500)  # timers run after a batch's rows
    append(path / "log.1", [event(2, "I", 26, "back")])  # its delete is forgotten
    run(1500)
    assert (2, 26) in rows(spark.read.parquet(out).select("key", "_pos"))


def test_counters_count_a_batch_once(spark, tmp_path):
    feed = Tables(spark, SF).sql(fx.TWO_SHARDS)
    feed.repartition(4).write.parquet(str(tmp_path / "in"))
    listener = counters.LiveCounters("c")
    spark.streams.addListener(listener)
    lose = []

    def sink(df, batch):
        df.count()
        if batch == 1 and not lose:
            lose.append(1)
            raise OSError("lost")

    def start():
        s = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        return counters.observed(s, "c", F.col("a_key") % 2 == 0).writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()

    try:
        with pytest.raises(Exception, match="lost"):
            start().awaitTermination()
        run = start()
        run.awaitTermination()
        listener.wait(run)
        again = start()  # nothing new
        again.awaitTermination()
    finally:
        spark.streams.removeListener(listener)
    want = [("", r.op, r.n, r.even, r.n - r.even) for r in feed.groupBy("op").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("a_key") % 2 == 0).alias("even")).collect()]
    assert listener.totals() == sorted(want) == rows(listener.frame(spark))


# ---------------------------------------------------------------- targets and statements


def test_targets_keep_their_own_columns_and_what_is_refused(spark, tmp_path):
    feed = spark.createDataFrame([("A", "T", {"id": "1", "N": 'q"\\é', "x": "9"}), ("a", "t", {"ID": "x1", "n": "b"}), ("b", "t", {"id": "2"}), ("c", "t", {"id": "3"}), ("a", "t", None), ("b", "t", {"id": "4", "d": "2024-02-30"})], "tgt_db string, tbl string, after map<string,string>")
    cols = spark.createDataFrame([("a", "t", 2, "n", "varchar(9)"), ("a", "t", 1, "id", "int"), ("b", "T", 1, "id", "decimal(9,2)"), ("b", "T", 2, "d", "date")], "tgt_db string, tbl string, ordinal int, column string, type string")
    targets.write_targets(feed, cols, str(tmp_path))
    assert rows(targets.read_target(spark, str(tmp_path), "A", "t", "id int, n string")) == [(1, 'q"\\é'), (None, None)]
    assert [(float(a), b) for a, b in rows(targets.read_target(spark, str(tmp_path), "b", "t", "id decimal(9,2), d date"))] == [(2.0, None)]
    bad = targets.read_rejects(spark, str(tmp_path))
    assert sorted(r.reason for r in bad.collect()) == ["does not fit: d", "does not fit: id", "unknown target"]


def test_statements_on_staged_rows():
    con = duckdb.connect()
    con.execute('CREATE TABLE "t q" (k INT, a VARCHAR, "b""c" INT); INSERT INTO "t q" VALUES (1, \'x\', 1), (2, \'y\', 2), (3, \'z\', 3)')
    con.execute('CREATE TABLE st (k INT, a VARCHAR, "b""c" INT, a_has BOOLEAN, "b""c_has" BOOLEAN); INSERT INTO st VALUES (1, NULL, 9, TRUE, FALSE), (4, \'n\', 4, TRUE, TRUE)')
    con.execute(statements.upsert("st", "t q", ["k"], ["a", 'b"c'], has="_has"))
    assert con.sql('SELECT * FROM "t q" ORDER BY k').fetchall() == [(1, None, 1), (2, "y", 2), (3, "z", 3), (4, "n", 4)]
    con.execute(statements.upsert("st", "t q", ["k"], ["a", 'b"c']))
    assert con.sql('SELECT * FROM "t q" WHERE k = 1').fetchall() == [(1, None, 9)]
    con.execute(statements.delete("st", "t q", ["k"]))
    assert con.sql('SELECT k FROM "t q" ORDER BY k').fetchall() == [(2,), (3,)]
    con.execute(statements.insert("st", "t q", ["k", "a"]))
    con.execute("CREATE TABLE k (k INT); CREATE TABLE ks AS SELECT 1 AS k UNION ALL SELECT 2")
    for _ in range(2):
        con.execute(statements.upsert("ks", "k", ["k"], []))
    assert con.sql('SELECT count(*) FROM "t q"').fetchall() == [(4,)] and con.sql("SELECT count(*) FROM k").fetchall() == [(2,)]
    assert statements.upsert("d.st", "d.t", ["id"], ["v"], "mysql") == "INSERT INTO `d`.`t` AS t (`id`, `v`) SELECT s.`id`, s.`v` FROM `d`.`st` AS s ON DUPLICATE KEY UPDATE `v` = s.`v`"
    assert statements.delete("st", "t", ["id"], "mysql") == "DELETE t FROM `t` AS t JOIN `st` AS s ON t.`id` = s.`id`"


def test_rejects_of_a_transform_that_raises(spark):
    def halves(b):
        if 13 in b.column("x").to_pylist():
            raise ValueError("no thirteen")
        reason = pa.array([None if (v or 0) % 2 == 0 else "odd" for v in b.column("x").to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([pa.array([v // 2 if v is not None else None for v in b.column("x").to_pylist()], pa.int64())], ["half"]), reason

    df = spark.createDataFrame([(x, "t") for x in (1, 2, 13, 4, None)], "x long, s string").coalesce(1)
    ok, bad = reject.split(reject.judged(df, halves, "half long"))
    assert rows(ok) == [(1,), (2,), (None,)]
    assert rows(bad) == [("ValueError: no thirteen", '{"x":13,"s":"t"}'), ("odd", '{"x":1,"s":"t"}')]
    assert reject.judged(df.limit(0), halves, "half long").count() == 0


# ---------------------------------------------------------------- layouts, keys, DDL, ranges


def test_layouts_before_at_and_after_a_place(spark):
    lay = spark.createDataFrame([("T", "log.9", 100, ["a"], []), ("t", "log.10", 50, ["b", "h"], [2]), ("t", "log.10", 50, ["a", "h"], [2]), ("u", "log.9", 1, ["z"], None)], "tbl string, bfile string, pos long, names array<string>, hidden array<int>")
    feed = spark.createDataFrame([("t", "log.9", p, ["1", "2"]) for p in (99, 100, 5000)] + [("t", "log.10", p, ["1", "2"]) for p in (1, 49, 50, 900)] + [("t", "log.12", 3, ["1", "2"]), ("U", "log.9", 7, ["1", "2"]), ("v", "log.9", 7, ["1"])], "tbl string, bfile string, pos long, v array<string>")
    a, b = {"a": "1"}, {"b": "1"}
    want = {("t", "log.9", 99): None, ("t", "log.9", 100): a, ("t", "log.9", 5000): a, ("t", "log.10", 1): a, ("t", "log.10", 49): a, ("t", "log.10", 50): b, ("t", "log.10", 900): b, ("t", "log.12", 3): b, ("U", "log.9", 7): {"z": "1"}, ("v", "log.9", 7): None}
    for segment in (10, 64, 1 << 26):
        got = layouts.named(feed, lay, "v", segment)
        assert {(r.tbl, r.bfile, r.pos): r.image for r in got.collect()} == want
    assert layouts.named(feed.limit(0), lay, "v").count() == 0 and layouts.named(feed, lay.limit(0), "v").filter("image is not null").count() == 0


def test_cascade_goes_round_circles_and_stops_at_set_null(spark):
    t = spark.createDataFrame([(2, 1), (3, 2), (1, 3), (4, None), (5, 9), (6, 6)], "k long, up long")
    c = spark.createDataFrame([(20, 2), (21, 4)], "k long, ref long")
    d = spark.createDataFrame([(30, 20)], "k long, ref long")
    links = [("t", t, "t", "up", "k", "CASCADE"), ("t", c, "c", "ref", "k", "SET NULL"), ("c", d, "d", "ref", "k", "CASCADE")]
    start = spark.createDataFrame([(1,)], "k long")
    assert rows(integrity.cascade(start, links, "t")) == [("c", 20, "SET NULL"), ("t", 1, "CASCADE"), ("t", 2, "CASCADE"), ("t", 3, "CASCADE")]
    assert integrity.cascade(start.limit(0), links, "t").count() == 0


def test_depths_of_chains_circles_and_several_parents(spark):
    node = lambda *ks: spark.createDataFrame([("t", k) for k in ks], "tbl string, key long")
    ref = lambda *es: spark.createDataFrame([("t", a, "t", b) for a, b in es], "tbl string, key long, ptbl string, pkey long")
    chain = integrity.depths(node(*range(40)), ref(*((k, k - 1) for k in range(40)), (5, 5), (7, None)))
    assert rows(chain) == sorted((("t", k, k) for k in range(40)), key=str)
    circle = integrity.depths(node(1, 2, 3, 4, 8, 9), ref((1, 2), (2, 1), (3, 2), (9, 8), (8, 77)))
    assert {r.key: r.depth for r in circle.collect()} == {1: None, 2: None, 3: None, 4: 0, 8: 0, 9: 1}
    several = integrity.depths(node(*range(1, 9)), ref((2, 1), (3, 1), (3, 2), (4, 3), (4, 1), (5, 6), (6, 5), (7, 5), (7, 1)))
    assert {r.key: r.depth for r in several.collect()} == {1: 0, 2: 1, 3: 2, 4: 3, 5: None, 6: None, 7: None, 8: 0}


def test_waves_never_break_a_key(spark):
    ops = spark.createDataFrame([("o", 1, "U"), ("l", 10, "U"), ("c", 5, "U"), ("c", 6, "D"), ("o", 2, "D"), ("l", 20, "D")], "tbl string, key long, kind string")
    refs = spark.createDataFrame([("l", 10, "o", 1), ("o", 1, "c", 5), ("o", 2, "c", 6), ("l", 20, "o", 2)], "tbl string, key long, ptbl string, pkey long")
    assert {(r.tbl, r.key): r.wave for r in integrity.waves(ops, refs).collect()} == {("c", 5): 0, ("o", 1): 1, ("l", 10): 2, ("l", 20): 3, ("o", 2): 4, ("c", 6): 5}


def test_ddl_columns(spark):
    texts = {
        "t": "CREATE TABLE `t` (\n  `id` bigint(20) unsigned NOT NULL AUTO_INCREMENT,\n  `name` varchar(255) NULL,\n  `g` int GENERATED ALWAYS AS (id+1) STORED,\n  PRIMARY KEY (`id`)\n)",
        "one": "create table x(a int primary key, b text comment 'not null, generated always', c decimal(10,2) default '1,5' not null, d int as (a * (2)) virtual, e varchar(3) default \"x)\" -- d\n, f bit(1) default b'0', # g\n /* h int, */ i datetime default current_timestamp on update now())",
        "none": "DROP TABLE x", "nil": None, "empty": "",
        "keys": "CREATE TABLE k (A int, b int, KEY (b), CONSTRAINT c PRIMARY KEY USING BTREE (a, `B`(3)), FOREIGN KEY (b) REFERENCES o (id) ON DELETE SET NULL)",
    }
    got = ddl.columns(spark.createDataFrame(list(texts.items()), "tbl string, ddl string"))
    assert rows(got) == sorted([
        ("t", 1, "id", "bigint(20) unsigned", False, True, False, True, None, None), ("t", 2, "name", "varchar(255)", True, False, False, False, None, None), ("t", 3, "g", "int", True, False, True, False, None, None),
        ("one", 1, "a", "int", False, False, False, True, None, None), ("one", 2, "b", "text", True, False, False, False, None, "not null, generated always"), ("one", 3, "c", "decimal(10,2)", False, False, False, False, "'1,5'", None), ("one", 4, "d", "int", True, False, True, False, None, None),
        ("one", 5, "e", "varchar(3)", True, False, False, False, '"x)"', None), ("one", 6, "f", "bit(1)", True, False, False, False, "b '0'", None), ("one", 7, "i", "datetime", True, False, False, False, "current_timestamp", None),
        ("keys", 1, "A", "int", False, False, False, True, None, None), ("keys", 2, "b", "int", False, False, False, True, None, None),
    ], key=str)


def test_ranges_of_skewed_keys(spark):
    keys = [*range(2000), *[7] * 900, *range(10**15, 10**15 + 500), -(2**63), 2**63 - 1]
    r = ranges.equi_depth(spark.createDataFrame([(k,) for k in keys] + [(None,)], "k long"), "k", 10).orderBy("part").collect()
    assert sum(x.rows for x in r) == len(keys) and all(a.high < b.low for a, b in zip(r, r[1:]))
    assert all(x.rows <= 2 * -(-len(keys) // 10) or x.low == x.high for x in r) and any(x.low == x.high == 7 for x in r)
    words = [f"a long way in front {k:05d}" for k in range(600)] + ["", "b", "é", "a long way in front é"] + ["same"] * 300
    df = spark.createDataFrame([(k,) for k in words], "k string")
    r = ranges.equi_depth(df, "k", 8)
    assert sum(x.rows for x in r.collect()) == len(words) and all(x.rows <= 2 * -(-len(words) // 8) or x.low == x.high for x in r.collect())
    parts = ranges.predicates(r, "k")
    assert sum(df.filter(p).count() for p in parts) == len(words)
    assert ranges.equi_depth(df.limit(0), "k", 8).count() == 0


def test_ddl_texts_of_one_name_and_items_in_brackets(spark):
    """Two texts of one name are read each by itself, and an item without a word outside its brackets is no error."""
    texts = [("t", "create table t (a int, b int, primary key (a))"), ("t", "create table t (c int)"), ("odd", "create table o (a int, (x), b int)")]
    got = ddl.columns(spark.createDataFrame(texts, "tbl string, ddl string"))
    assert rows(got.select("tbl", "ordinal", "column", "is_pk")) == [("odd", 1, "a", False), ("odd", 2, "(", False), ("odd", 3, "b", False), ("t", 1, "a", True), ("t", 1, "c", False), ("t", 2, "b", False)]


def test_ddl_texts_are_read_once_and_fast(spark):
    """A query over many texts, whose columns are filtered as well, does not read a text again for every use of a column."""
    many = spark.range(3000).selectExpr("cast(id as string) as tbl", "concat('create table t (', array_join(transform(sequence(1, 12), i -> concat('c', i, ' decimal(10,2) not null default (', id, ') comment ''n''')), ', '), ', primary key (c1))') as ddl")
    start = time.time()
    assert ddl.columns(many).filter("not generated and default is not null and comment = 'n'").count() == 36_000
    assert time.time() - start < 20


def test_late_and_repeated_changes_without_retention(spark, tmp_path):
    """What came before is neither undone by late rows nor written again by repeated ones, without a call to Python for each key."""
    path, out, place = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "cp")
    path.mkdir()
    seen = []

    def run():
        events = changelog.change_log_stream(spark, str(path), TYPED)
        query = latest.apply_stream(events, KEY, VALUES, out, place, trigger={"availableNow": True})
        query.awaitTermination()
        seen.append(query.lastProgress.stateOperators[0].operatorName)
        return rows(latest.current_rows(spark, out, KEY, ["status"]))

    append(path / "log.1", [event(1, "I", 10), event(2, "I", 11), event(2, "D", 30), event(1, "U", 20, "b"), event(3, "I", 12, None)])
    assert run() == [(1, "b"), (3, None)]
    append(path / "log.1", [event(2, "U", 25, "late"), event(1, "U", 20, "b"), event(3, "U", 40, "c")])
    assert run() == [(1, "b"), (3, "c")]
    assert spark.read.parquet(out).count() == 4 and set(seen) == {"stateStoreSave"}


def test_events_of_one_place_are_dealt_over_tasks(spark, tmp_path):
    """A snapshot, whose events all have one place, is written by many tasks, and the log still holds every event once."""
    feed = spark.range(4000).selectExpr("'s' as src_db", "id as a_key", "'' as bfile", "0L as pos", "0 as row_seq")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        changelog.write_log(feed, str(tmp_path / "log"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [n for n, _ in changelog.Log(str(tmp_path / "log")).files() if "part-" in n]
    assert len(files) > 1
    got = changelog.change_log(spark, str(tmp_path / "log"), "src_db string, a_key long, bfile string, pos long, row_seq int")
    assert got.count() == got.select("a_key").distinct().count() == 4000


def test_rows_that_nobody_refers_to_take_no_part_in_the_rounds(spark, monkeypatch):
    kept = []
    real = integrity.cut
    monkeypatch.setattr(integrity, "cut", lambda df: kept.append(real(df)) or kept[-1])
    links = spark.createDataFrame([("t", k, "t", k - 1) for k in range(1, 20)] + [("leaf", k, "t", k % 20) for k in range(500)], "tbl string, key long, ptbl string, pkey long")
    nodes = spark.range(20).selectExpr("'t' as tbl", "id as key").union(spark.range(500).selectExpr("'leaf' as tbl", "id as key"))
    got = {(r.tbl, r.key): r.depth for r in integrity.depths(nodes, links).collect()}
    assert got == {**{("t", k): k for k in range(20)}, **{("leaf", k): k % 20 + 1 for k in range(500)}}
    assert max(d.count() for d in kept[2:]) <= 20
