"""Warehouse, bulk loads, streaming, control."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from driftwell.operators.envelope import envelope_schema
from driftwell.plans.ddl import parse
from driftwell.plans.settings import Settings
from driftwell.plans.store import Files
from driftwell.plans.tables import Warehouse
from driftwell.sources import dumps
from driftwell.sources.change_log import snapshot_events, stream_log
from driftwell.streaming.apply import Applier, start
from driftwell.streaming.listener import Metrics
from driftwell.streaming.offsets import OffsetStore, SchemaHistory, lsn_number, parse_lsn, patch_binlog, patch_lsn
from driftwell.streaming.replicator import Replicator

ROW = "id long, name string, score int"


def event(offset, op, before, after, ddl=None, table="users"):
    value = None if op is None and ddl is None else {"before": before, "after": after, "op": op, "ts_ms": 5, "source": {"ts_ms": 1000 + offset, "db": "shop", "table": table, "snapshot": "false", "gtid": None}}
    key = (before or after or {}).get("id")
    return {"topic": f"s.shop.{table}", "partition": 0, "offset": offset, "timestamp_ms": 1, "key": key and {"id": key}, "value": value, "ddl": ddl}


def frame(spark, events):
    schema = envelope_schema("id long", ROW)
    return spark.createDataFrame([(json.dumps(e),) for e in events], "value string").select(F.from_json("value", schema).alias("e")).select("e.*")


def rows_of(warehouse, name="users", db="shop"):
    return sorted(tuple(r) for r in warehouse.state(warehouse.load(db, name)).collect())


CREATE = "CREATE TABLE shop.users (id BIGINT PRIMARY KEY, name VARCHAR(20), score INT)"


def image(i, name, score=None):
    return {"id": i, "name": name, "score": score}


def test_schema_changes_between_rows(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    log = [
        event(1, None, None, None, CREATE),
        event(2, "c", None, image(1, "a", 7)),
        event(3, "c", None, image(2, "b", 8)),
        event(4, None, None, None, "ALTER TABLE users ADD COLUMN extra DATE FIRST"),
        event(5, "u", image(1, "a", 7), image(1, "c", 9)),
        event(6, None, None, None, "ALTER TABLE users MODIFY COLUMN score BIGINT"),
        event(7, "c", None, image(3, "d", 10)),
        event(8, None, None, None, "ALTER TABLE users DROP COLUMN name"),
        event(9, "d", image(2, "b", 8), None),
    ]
    applier = Applier(w)
    applier(frame(spark, log), 0)
    assert w.load("shop", "users").columns == ["extra", "id", "score"]
    assert rows_of(w) == [(None, 1, 9), (None, 3, 10)]
    applier(frame(spark, log), 0)  # again: the same state
    assert rows_of(w) == [(None, 1, 9), (None, 3, 10)] and not applier.failed
    applier(frame(spark, [event(20, None, None, None, "TRUNCATE TABLE users"), event(21, "c", None, image(9, "z", 1))]), 1)
    assert rows_of(w) == [(None, 9, 1)]
    w.compact("shop", "users")
    assert rows_of(w) == [(None, 9, 1)] and w.load("shop", "users").data == "data-1"
    Applier(w)(frame(spark, [event(10, "c", None, image(4, "late"))]), 2)  # from before the truncate
    assert rows_of(w) == [(None, 9, 1)]


def test_a_repeated_batch_keeps_renamed_columns(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    log = [event(1, None, None, None, CREATE), event(2, "c", None, image(1, "a", 7)), event(3, None, None, None, "ALTER TABLE users CHANGE COLUMN name title VARCHAR(20) NULL")]
    for n in range(3):
        Applier(w)(frame(spark, log), n)
    assert rows_of(w) == [(1, "a", 7)] and w.load("shop", "users").columns == ["id", "title", "score"]


def test_table_changes(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    Applier(w)(frame(spark, [event(1, None, None, None, CREATE), event(2, "c", None, image(1, "a")), event(3, None, None, None, "CREATE TABLE copy LIKE users"), event(4, None, None, None, "RENAME TABLE users TO people")]), 0)
    assert w.tables("shop") == ["copy", "people"] and rows_of(w, "people") == [(1, "a", None)] and rows_of(w, "copy") == []
    Applier(w)(frame(spark, [event(5, None, None, None, "DROP TABLE people")]), 1)
    assert w.tables("shop") == ["copy"]


def test_gates_and_failures(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    a = Applier(w, Settings(disable_drop_truncate=True))
    a(frame(spark, [event(1, None, None, None, CREATE), event(2, "c", None, image(1, "a")), event(3, None, None, None, "TRUNCATE users"), event(4, None, None, None, "ALTER TABLE nowhere ADD x INT"), event(5, None, None, None, "CREATE TABLE t (")]), 0)
    assert rows_of(w) == [(1, "a", None)] and [f[0] for f in a.failed] == [4, 5]
    Applier(w, Settings(disable_ddl=True))(frame(spark, [event(6, None, None, None, "DROP TABLE users")]), 1)
    assert w.exists("shop", "users")


def test_the_pool_of_deduplication_holds_distinct_keys(spark, tmp_path):
    """Policy old: a key that came often takes one place; the keys that came longest ago leave first."""
    w = Warehouse(spark, str(tmp_path))
    a = Applier(w, Settings(auto_create=True, deduplication_policy="old", buffer_count=3))
    a(frame(spark, [event(1, "c", None, image(1, "a")), event(2, "c", None, image(2, "b")), *[event(n, "u", None, image(3, "c")) for n in range(3, 9)]]), 0)
    a(frame(spark, [event(10 + i, "u", None, image(i, "late")) for i in (1, 2, 3)]), 1)
    assert rows_of(w) == [(1, "a", None), (2, "b", None), (3, "c", None)]
    a(frame(spark, [event(20, "c", None, image(4, "d"))]), 2)  # 1 came longest ago
    a(frame(spark, [event(30 + i, "u", None, image(i, "later")) for i in (1, 2, 3, 4)]), 3)
    assert rows_of(w) == [(1, "later", None), (2, "b", None), (3, "c", None), (4, "d", None)]


def test_auto_create_evolve_and_options(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    Applier(w)(frame(spark, [event(1, "c", None, image(1, "a"))]), 0)
    assert not w.exists("shop", "users")
    s = Settings(auto_create=True, ignore_delete=True, databases={"shop": "mart"}, topics={"s.shop.users": "people"})
    Applier(w, s)(frame(spark, [event(1, "c", None, image(1, "a")), event(2, "d", image(1, "a"), None)]), 0)
    assert rows_of(w, "people", "mart") == [(1, "a", None)]
    w.execute(parse("CREATE TABLE shop.small (id BIGINT PRIMARY KEY)"))
    Applier(w, Settings(evolve=True))(frame(spark, [event(1, "c", None, image(1, "a", 3), table="small")]), 0)
    assert rows_of(w, "small") == [(1, "a", 3)]
    w.execute(parse("CREATE TABLE shop.raw (id BIGINT PRIMARY KEY, doc TEXT, `_offset` BIGINT)"))
    Applier(w, Settings(store_raw=True, raw_column="doc", store_metadata=True))(frame(spark, [event(6, "c", None, image(1, "a", 3), table="raw")]), 0)
    assert rows_of(w, "raw") == [(1, '{"id":1,"name":"a","score":3}', 6)]
    Applier(w, Settings(auto_create=True), include=[r"shop\.k.*"])(frame(spark, [event(1, "c", None, image(1, "a"), table="kept"), event(2, "c", None, image(1, "a"), table="left")]), 0)
    assert w.exists("shop", "kept") and not w.exists("shop", "left")


def test_many_updates_of_one_key(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.execute(parse(CREATE))
    log = [event(0, "c", None, image(1, "v0", 0))] + [event(i, "u", image(1, f"v{i - 1}", i - 1), image(1, f"v{i}", i)) for i in range(1, 3000)]
    for e in log:
        e["value"]["source"]["ts_ms"] = 77  # one transaction
    Applier(w)(frame(spark, log), 0)
    assert rows_of(w) == [(1, "v2999", 2999)]


def test_computed_and_collapsing_tables(spark, tmp_path):
    from dataclasses import replace

    w = Warehouse(spark, str(tmp_path))
    w.execute(parse("CREATE TABLE shop.users (id BIGINT PRIMARY KEY, name VARCHAR(9), twice BIGINT AS (id * 2))"))
    Applier(w)(frame(spark, [event(1, "c", None, image(4, "a"))]), 0)
    assert rows_of(w) == [(4, "a", 8)]
    w.execute(parse("CREATE TABLE shop.folded (id BIGINT PRIMARY KEY, name VARCHAR(9))"))
    w.save(replace(w.load("shop", "folded"), engine="collapsing"))
    Applier(w)(frame(spark, [event(1, "c", None, image(1, "a"), table="folded"), event(2, "u", image(1, "a"), image(1, "b"), table="folded"), event(3, "c", None, image(2, "x"), table="folded"), event(4, "d", image(2, "x"), None, table="folded")]), 0)
    assert rows_of(w, "folded") == [(1, "b")]
    w.compact("shop", "folded")
    assert rows_of(w, "folded") == [(1, "b")]


def test_dumps(spark, tmp_path):
    folder = tmp_path / "dump"
    folder.mkdir()
    with gzip.open(folder / "shop.items-schema.sql.gz", "wt") as f:
        f.write("/*!40101 SET NAMES binary*/;\nCREATE TABLE `items` (`id` int NOT NULL, `label` varchar(20), `raw` blob, `price` decimal(8,2), `at` datetime(3), PRIMARY KEY (`id`));\n")
    with gzip.open(folder / "shop.items.00000.dat.gz", "wt") as f:
        f.write('"1","it \\"is\\", so","YWI=","1.50","2020-01-02 03:04:05.678"\n"2",\\N,\\N,\\N,\\N\n')
    (folder / "shop@tabs.sql").write_text("CREATE TABLE IF NOT EXISTS `tabs` (`id` int NOT NULL, `label` text, `flag` bool, PRIMARY KEY (`id`)) ENGINE=InnoDB")
    (folder / "shop@tabs@@0.tsv").write_text("1\ta\\tb\\\\n\t1\n2\t\\N\t0\n3\t\t\\N\n")
    w = Warehouse(spark, str(tmp_path / "w"))
    assert dumps.load_folder(w, str(folder)) == [("shop", "items"), ("shop", "tabs")]
    got = rows_of(w, "items")
    assert got[0][:3] == (1, 'it "is", so', "6162") and str(got[0][3]) == "1.50" and str(got[0][4]) == "2020-01-02 03:04:05.678000" and got[1] == (2, None, None, None, None)
    assert rows_of(w, "tabs") == [(1, "a\tb\\n", True), (2, None, False), (3, "", None)]
    dumps.load_folder(w, str(folder), include="tabs")  # emptied, then loaded again
    assert len(rows_of(w, "tabs")) == 3
    d = w.load("shop", "tabs")
    assert dumps.integer_key(d) == "id"
    assert [c.count() for c in dumps.chunked(w.state(d), "id", 2)] == [2, 1]


def test_snapshot_then_changes(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], ROW)
    snapshot = snapshot_events(rows, "s.shop.users", ["id"], "shop", "users", 5)
    applier = Applier(w, Settings(auto_create=True))
    applier(snapshot, 0)
    applier(frame(spark, [event(1, "d", image(1, "a", 1), None)]), 1)
    assert rows_of(w) == [(2, "b", 2)]


def write_log(folder, name, events):
    with open(os.path.join(folder, name), "w") as f:
        f.writelines(json.dumps(e) + "\n" for e in events)


def test_stream_and_control(spark, tmp_path):
    folder = str(tmp_path / "log")
    os.mkdir(folder)
    write_log(folder, "1.json", [event(1, None, None, None, CREATE), event(2, "c", None, image(1, "a"))])
    w = Warehouse(spark, str(tmp_path / "w"))
    r = Replicator(lambda position: stream_log(spark, folder, "id long", ROW), Applier(w, Settings(autostart=False)), str(tmp_path / "home"))
    assert not r.running and r.status()["batch"] is None
    r.start()
    r.caught_up()
    assert rows_of(w) == [(1, "a", None)]
    with pytest.raises(RuntimeError):
        r.set_position(pos="4")
    write_log(folder, "2.json", [event(3, "u", image(1, "a"), image(1, "b"))])
    r.caught_up()
    assert rows_of(w) == [(1, "b", None)] and r.status()["running"] and r.status()["error"] is None
    r.restart()
    r.caught_up()
    r.stop()
    r.set_position(file="log.2", pos="9")
    assert json.loads(r.offsets.get("replication"))["file"] == "log.2"
    r.set_position(lsn="1/AF00")
    assert json.loads(r.offsets.get("replication"))["lsn"] == 0xAF00
    r.reset_offsets()
    assert r.offsets.get("replication") is None
    start(stream_log(spark, folder, "id long", ROW, 1), r.applier, str(tmp_path / "again"), once=True).awaitTermination()
    assert rows_of(w) == [(1, "b", None)]


def test_offsets(spark, tmp_path):
    store = OffsetStore(spark, str(tmp_path / "o"))
    assert store.get("a") is None and store.rows().count() == 0
    store.put("a", "{}", 1)
    store.put("b", "1", 2)
    store.put("a", '{"x":1}', 3)
    assert store.get("a") == '{"x":1}' and store.rows().count() == 2 and store.last_insert().first()["last"] is not None
    store.delete("a", 4)
    assert store.get("a") is None
    assert json.loads(patch_binlog('{"file": "x", "row": 1}', pos="7")) == {"file": "x", "row": 1, "pos": "7"}
    assert json.loads(patch_binlog(None, file="f", now_s=3)) == {"ts_sec": 3, "transaction_id": None, "file": "f"}
    assert json.loads(patch_lsn('{"lsn": 1}', "27485360")) == {"lsn": 27485360, "lsn_proc": 27485360}
    assert parse_lsn("1/AF00") == 0xAF00
    got = spark.createDataFrame([("1/AF00",), ("12",), ("x",), ("1/zz",), (None,)], "l string").select(lsn_number(F.col("l"))).collect()
    assert [r[0] for r in got] == [0xAF00, 12, None, None, None]


def test_files(spark, tmp_path):
    f = Files(spark)
    path = str(tmp_path / "a" / "b.txt")
    f.write(path, "one")
    f.write(path, "zwölf")
    assert f.read(path) == "zwölf" and f.exists(path) and f.names(str(tmp_path / "a")) == ["b.txt"]
    f.rename(path, str(tmp_path / "c" / "d.txt"))
    assert not f.exists(path) and f.names(str(tmp_path / "none")) == []


def test_schema_history(spark, tmp_path):
    w, h = Warehouse(spark, str(tmp_path / "w")), SchemaHistory(spark, str(tmp_path / "h"))
    assert h.rows().count() == 0
    a = Applier(w, Settings(single_threaded=True), history=h)
    for _ in range(2):
        a(frame(spark, [event(1, None, None, None, CREATE), event(2, "c", None, image(1, "a")), event(3, None, None, None, "ALTER TABLE users ADD COLUMN x INT")]), 0)
    assert [(r.history_data_seq, r.ddl) for r in h.rows().collect()] == [(1, CREATE), (3, "ALTER TABLE users ADD COLUMN x INT")]
    h.delete()
    assert h.rows().count() == 0 and rows_of(w) == [(1, "a", None, None)]


def test_metrics(spark):
    from driftwell.operators.envelope import decode

    m, log = Metrics(), frame(spark, [event(1, "c", None, image(1, "a")), event(2, "x", None, image(2, "b"))])
    for _ in range(2):
        m.observe(log, decode(log), F.lit(5000))
    text = m.text()
    assert 'records_total{topic="s.shop.users"} 2' in text and 'errors_total{topic="s.shop.users"} 2' in text and 'source_lag_ms{topic="s.shop.users"} 3999' in text
    assert 'partition_offset{partition="0",topic="s.shop.users"} 1' in text and "uptime_seconds" in text


def test_estimates_and_partitions(spark):
    assert dumps.estimated_rows(spark.range(1000)) == 1000
    assert sorted(r.partition for r in dumps.partitions(spark.range(30), F.col("id") % 12, "^1").collect()) == ["1", "10", "11"]


def partitioned(offset, partition, ts, op, before, after):
    e = event(offset, op, before, after)
    e["partition"] = partition
    e["value"]["source"]["ts_ms"] = ts
    return e


def test_truncates_cut_by_partition(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.execute(parse(CREATE))
    log = [partitioned(100, 0, 10, "c", None, image(1, "old")), partitioned(101, 0, 20, "t", None, None), partitioned(5, 1, 30, "c", None, image(2, "later")), partitioned(4, 1, 15, "c", None, image(3, "before")), partitioned(102, 0, 19, "c", None, image(4, "next"))]
    for _ in range(2):
        Applier(w)(frame(spark, log), 0)
        assert rows_of(w) == [(2, "later", None), (4, "next", None)]
    w.compact("shop", "users")
    Applier(w)(frame(spark, [partitioned(3, 1, 14, "c", None, image(5, "late"))]), 1)
    assert rows_of(w) == [(2, "later", None), (4, "next", None)]


def test_ties_are_ordered_by_offset(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.execute(parse(CREATE))
    Applier(w)(frame(spark, [partitioned(999_999, 0, 7, "c", None, image(1, "a")), partitioned(1_000_000, 0, 7, "u", image(1, "a"), image(1, "b"))]), 0)
    assert rows_of(w) == [(1, "b", None)]


def test_deletes_survive_compaction(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.execute(parse(CREATE))
    a = Applier(w, Settings(compact_after=3))
    for n in range(8):
        a(frame(spark, [event(10 * n + 1, "c", None, image(n, "x")), event(10 * n + 2, "d", image(n - 1, "x"), None)]), n)
    assert rows_of(w) == [(7, "x", None)] and w.load("shop", "users").data != "data-0"
    a(frame(spark, [event(5, "c", None, image(0, "late"))]), 9)
    assert rows_of(w) == [(7, "x", None)]


def test_excluded_tables_have_no_schema_changes(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    Applier(w, include=[r"shop\.u.*"])(frame(spark, [event(1, None, None, None, CREATE), event(2, None, None, None, "CREATE TABLE other (id INT PRIMARY KEY)"), event(3, None, None, None, "CREATE DATABASE more")]), 0)
    assert w.tables("shop") == ["users"] and "more" in w.databases()


def test_values_that_do_not_fit_are_counted(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.execute(parse("CREATE TABLE shop.users (id BIGINT PRIMARY KEY, name INT, score DATE)"))
    Applier(w)(frame(spark, [event(1, "c", None, image(1, "12", 3)), event(2, "c", None, image(2, "x", 4))]), 0)
    assert w.lost["shop", "users"] == 1
    assert [(r[0], r[1], str(r[2])) for r in rows_of(w)] == [(1, 12, "1970-01-04"), (2, None, "1970-01-05")]


def test_delete_column_and_replicated_tables(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    s = Settings.of({"replacingmergetree.delete.column": "gone", "auto.create.tables": "true", "auto.create.tables.replicated": "true"})
    Applier(w, s)(frame(spark, [event(1, "c", None, image(1, "a")), event(2, "d", image(1, "a"), None), event(3, "c", None, image(2, "b"))]), 0)
    d = w.load("shop", "users")
    assert d.deleted == "gone" and d.replicated and "gone" in w.log(d).columns and rows_of(w) == [(2, "b", None)]


def test_control_verbs(spark, tmp_path):
    from driftwell.streaming.control import command, main

    folder = str(tmp_path / "log")
    os.mkdir(folder)
    write_log(folder, "1.json", [event(1, None, None, None, CREATE), event(2, "c", None, image(1, "a"))])
    w = Warehouse(spark, str(tmp_path / "w"))
    r = Replicator(lambda position: stream_log(spark, folder, "id long", ROW), Applier(w, Settings(autostart=False), history=SchemaHistory(spark, str(tmp_path / "h"))), str(tmp_path / "home"))
    assert command(r, "start_replica")[0] == 200
    r.caught_up()
    assert command(r, "lsn", lsn="1/A")[0] == 400 and command(r, "fly")[0] == 404 and command(r, "restart", x="1")[0] == 400
    status, text = command(r, "show_replica_status")
    assert status == 200 and json.loads(text)["running"]
    assert r.supervise(idle_s=0.1, checks=3, retries=1) == 1  # nothing new comes: it is started again
    assert command(r, "stop_replica")[0] == 200 and main(r, ["change_replication_source", "binlog_file=log.9", "binlog_position=4"]) == 0
    assert json.loads(r.offsets.get("replication"))["file"] == "log.9"
    assert command(r, "delete_schema_history")[0] == 200 and r.applier.history.rows().count() == 0
    assert command(r, "delete_offsets")[0] == 200 and r.offsets.get("replication") is None


def test_bytes_of_dumps(spark, tmp_path):
    from pyspark.sql import types as T

    texts = ["\x01", "a\x01b", "\\", "\\\\n", "\\t", "tab\there", "line\nend\\", "\\N", "\x00", "n\\\\\\t"]
    kind = T.StructType.fromDDL("i string, t string")
    dumps.write_tsv(spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], kind), str(tmp_path / "d"))
    assert {int(r.i): r.t for r in dumps.read_tsv(spark, str(tmp_path / "d"), kind).collect()} == dict(enumerate(texts))


def batch_sizes(spark, w, name="users"):
    """Rows of each batch of a table."""
    d = w.load("shop", name)
    return {n: spark.read.schema(d.stored_schema()).parquet(f"{w.folder('shop', name)}/{d.data}/{n}").count() for n in w.runs(d)}


def test_a_snapshot_above_the_limit_is_cut(spark, tmp_path):
    """All its rows have one offset; a second one of as many rows is not taken for the first, and the first again changes nothing."""
    rows = spark.range(95).select("id", F.concat(F.lit("n"), "id").alias("name"), F.lit(1).alias("score"))
    other = rows.withColumn("id", F.col("id") + 1000)
    for buckets in (0, 2):
        w = Warehouse(spark, str(tmp_path / f"w{buckets}"))
        for ts, part in ((5, rows), (5, other), (5, rows)):
            Applier(w, Settings(auto_create=True, max_records=20, compact_after=0, buckets=buckets))(snapshot_events(part, "s.shop.users", ["id"], "shop", "users", ts), 0)
        sizes = batch_sizes(spark, w)
        assert len(rows_of(w)) == 190 and sum(sizes.values()) == 190 and max(sizes.values()) <= 20 and len(sizes) >= 10


@pytest.mark.parametrize("policy", ["off", "old", "new"])
def test_parts_of_a_batch_take_no_jobs_of_their_own(spark, tmp_path, policy):
    """What a batch of many parts takes does not grow with their number; a part that is missing is written again."""
    log = frame(spark, [event(i, "u", None, image(i % 150 + 1, f"v{i}", i)) for i in range(400)])
    jobs = []
    for most in (200, 10):
        w = Warehouse(spark, str(tmp_path / f"w{most}"))
        spark.sparkContext.setJobGroup(f"parts-{policy}-{most}", "")
        for _ in range(2):
            Applier(w, Settings(auto_create=True, max_records=most, compact_after=0, deduplication_policy=policy, buffer_count=1000))(log, 0)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"parts-{policy}-{most}")))
        want = {i: (i + 1, f"v{i}", i) for i in range(150)} if policy == "old" else {i % 150: (i % 150 + 1, f"v{i}", i) for i in range(400)}
        assert rows_of(w) == [want[i] for i in range(150)]
    spark.sparkContext.setJobGroup("", "")
    assert jobs[1] <= jobs[0] + 6
    sizes = batch_sizes(spark, w)
    assert max(sizes.values()) <= 10 and sum(sizes.values()) == (400 if policy == "off" else 150)
    if policy == "off":
        w.files.delete(f"{w.folder('shop', 'users')}/data-0/{min(sizes)}")
        Applier(w, Settings(max_records=10, compact_after=0))(log, 0)
        assert batch_sizes(spark, w) == sizes


def test_figures_of_an_earlier_batch_do_not_go_back(spark):
    """The greatest offset, transaction number and position count, also where the last batch has smaller ones."""
    from driftwell.operators.envelope import decode

    m = Metrics()
    for offset in (9, 4):
        e = event(offset, "c", None, image(1, "a"))
        e["value"]["source"] |= {"gtid": f"u:{offset}", "file": "log.1", "pos": offset * 10}
        m.observe(frame(spark, [e]), decode(frame(spark, [e])), F.lit(2000))
    figure = lambda name: next(v for (n, _), v in m.values.items() if n == name)
    assert (figure("partition_offset"), figure("max_gtid"), figure("binlog_position"), figure("source_lag_ms")) == (9, 9, 90, 996)


def test_capped_batches_of_offsets_that_come_again_and_of_no_partition(spark, tmp_path):
    """A batch above the limit of a snapshot, offsets that come twice and more, and records without a partition: all rows are there, in parts that keep to the limit, and again they change nothing."""
    changes = frame(spark, [event(3 if i < 45 else i, "u", None, image(i + 1, f"v{i}", i)) for i in range(100)]).withColumn("partition", F.when(F.col("key.id") % 4 > 0, F.col("partition")))
    snapshot = snapshot_events(spark.range(1, 61).select((F.col("id") + 1000).alias("id"), F.lit("s").alias("name"), F.lit(1).alias("score")), "s.shop.users", ["id"], "shop", "users", 5)
    w, both = Warehouse(spark, str(tmp_path / "w")), changes.unionByName(snapshot)
    for _ in range(2):
        Applier(w, Settings(auto_create=True, max_records=20, compact_after=0))(both, 0)
    sizes = batch_sizes(spark, w)
    assert sum(sizes.values()) == 160 == len(rows_of(w)) and max(sizes.values()) <= 20


def test_one_look_at_a_capped_batch_tells_its_parts(spark, tmp_path):
    """A batch above the limit takes two jobs more over its rows than one below it: one that counts stretches, and one that deals them out."""
    log = frame(spark, [event(i, "u", None, image(i + 1, f"v{i}", i)) for i in range(200)])
    seen = spark.sparkContext.accumulator(0)

    def counted(rows):
        for r in rows:
            seen.add(r.num_rows)
            yield r

    passes = []
    for most in (0, 40):
        seen.value = 0
        w = Warehouse(spark, str(tmp_path / f"w{most}"))
        a = Applier(w, Settings(auto_create=True, max_records=most, compact_after=0))
        plain = a.placed
        a.placed = lambda events: plain(events).mapInArrow(counted, plain(events).schema)  # below the cut, above what is persisted
        a(log, 0)
        assert len(rows_of(w)) == 200
        passes.append(seen.value // 200)
    assert passes[1] <= passes[0] + 1


@pytest.mark.parametrize("buckets", [0, 2])
def test_transaction_numbers_of_one_time_beyond_the_versions_bits(spark, tmp_path, buckets):
    """Of two changes of one millisecond the one of the greater number is later, though its low 22 bits are smaller and its offset too; also after compaction."""
    least = (1 << 22) - 1
    log = frame(spark, [event(9 - i, "u", None, image(1, f"v{i}", i)) for i in range(3)] + [event(20, "u", None, image(2, "w", 0))])
    number = F.coalesce(9 - F.when(F.col("key.id") == 1, F.col("offset")), F.lit(0)) + least
    value = F.col("value").withField("source.gtid", F.concat(F.lit("0-1-"), number.cast("string"))).withField("source.ts_ms", F.lit(1_700_000_000_000).cast("long"))
    w = Warehouse(spark, str(tmp_path / "w"))
    a = Applier(w, Settings.of({"auto.create.tables": "true", "source.dialect": "mariadb", "cluster.buckets": buckets, "compact.after.batches": 0}))
    for n in (2, 0, 1):
        a(log.withColumn("value", value).where(F.col("offset") % 3 == n), n)
    assert rows_of(w) == [(1, "v2", 2), (2, "w", 0)]
    w.compact("shop", "users")
    assert rows_of(w) == [(1, "v2", 2), (2, "w", 0)]


def test_a_capped_batch_takes_no_look_of_its_own(spark, tmp_path):
    """Above the limit or below it, rows are looked at once and written once, truncates among them."""
    log = frame(spark, [event(i, "u", None, image(i + 1, f"v{i}", i)) for i in range(200)])
    seen = spark.sparkContext.accumulator(0)

    def counted(rows):
        for r in rows:
            seen.add(r.num_rows)
            yield r

    for most, buckets in ((0, 0), (40, 0), (40, 2)):
        seen.value = 0
        w = Warehouse(spark, str(tmp_path / f"w{most}-{buckets}"))
        a = Applier(w, Settings(auto_create=True, max_records=most, compact_after=0, buckets=buckets))
        plain = a.placed
        a.placed = lambda events: plain(events).mapInArrow(counted, plain(events).schema)
        a(log, 0)
        assert len(rows_of(w)) == 200 and seen.value == 400


def test_offsets_far_apart_are_cut_by_longer_stretches(spark, tmp_path, monkeypatch):
    """The number of stretches that come to the driver has a limit; stretches that then hold too much are cut by what they hold."""
    monkeypatch.setattr("driftwell.streaming.apply.SENT", 8)
    log = frame(spark, [event((i if i < 60 else i * 1000), "u", None, image(i + 1, f"v{i}", i)) for i in range(100)])
    snapshot = snapshot_events(spark.range(1, 61).select((F.col("id") + 1000).alias("id"), F.lit("s").alias("name"), F.lit(1).alias("score")), "s.shop.users", ["id"], "shop", "users", 5)
    w = Warehouse(spark, str(tmp_path / "w"))
    for _ in range(2):
        Applier(w, Settings(auto_create=True, max_records=20, compact_after=0))(log.unionByName(snapshot), 0)
    sizes = batch_sizes(spark, w)
    assert sum(sizes.values()) == 160 == len(rows_of(w)) and max(sizes.values()) <= 20


def test_log_files_make_the_log_once(spark, tmp_path, monkeypatch):
    """In ten files of log order, about equally long, also where numbers are far apart."""
    from driftwell import queries

    rows = spark.range(1000).select((F.col("id") * F.when(F.col("id") < 500, 1).otherwise(10_000)).alias("event_id"), (F.col("id") % 50).alias("user_id"), F.lit("view").alias("event_type"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ts"))
    rows.write.parquet(str(tmp_path / "events.parquet"))
    seen, plain = spark.sparkContext.accumulator(0), queries.events_log

    def counted(batches):
        for r in batches:
            seen.add(r.num_rows)
            yield r

    monkeypatch.setattr(queries, "events_log", lambda *a: (log := plain(*a)).mapInArrow(counted, log.schema))
    files = spark.read.text(queries.log_files(spark, str(tmp_path))).select(F.input_file_name().alias("f"), F.get_json_object("value", "$.offset").cast("long").alias("o"))
    found = files.groupBy("f").agg(F.min("o").alias("lo"), F.max("o").alias("hi"), F.count("*").alias("n")).orderBy("lo").collect()
    assert seen.value == 1000 == sum(r.n for r in found) and len(found) == 10 and max(r.n for r in found) <= 110
    assert all(a.hi < b.lo for a, b in zip(found, found[1:]))
