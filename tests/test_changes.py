"""Envelopes, versions, state, dedup, metrics, alignment, verification."""

import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.operators import align, dedup, envelope, metrics, state, verify, versions
from driftwell.plans import routing
from driftwell.plans.settings import Settings

ROW = "id long, name string"


def events(spark, rows):
    """rows: (offset, op, before, after) with images as (id, name) or None; op None is a tombstone."""
    source = (1000, "false", "shop", "users", 1, "log.1", 4, 0, 7, "u:5", None)
    return spark.createDataFrame([("s.shop.users", 0, o, 9, (((b or a) or (0,))[0],), None if op is None else (b, a, source, op, 1005), None) for o, op, b, a in rows], envelope.envelope_schema("id long", ROW))


def test_operations_and_sections(spark):
    log = events(spark, [(1, "c", None, (1, "a")), (2, "R", None, (2, "b")), (3, "u", (1, "a"), (1, "c")), (4, "D", (2, "b"), None), (5, None, None, None), (6, "t", None, None), (7, "d", None, (1, "c")), (8, "u", (1, "c"), None), (9, "x", None, (1, "z"))])
    got = {r.offset: (r.operation, r.state, r.row and r.row.name) for r in envelope.decode(log).collect()}
    assert got == {1: ("CREATE", "AFTER", "a"), 2: ("CREATE", "AFTER", "b"), 3: ("UPDATE", "BOTH", "c"), 4: ("DELETE", "BEFORE", "b"), 6: ("TRUNCATE", "AFTER", None)}
    r = envelope.with_metadata(envelope.decode(log)).where("offset = 1").first()
    assert (r.gtid, r.pos, r._key, r._timestamp, r._binlog_file) == (5, 4, '{"id":1}', "1970-01-01 00:00:00", "log.1")
    assert metrics.topic_counts(log).first()[1:] == (7, 1, 0)


@pytest.mark.parametrize(("gtid", "n"), [("u:5", 5), ("u:1-5", None), ("u", None), ("a:b:3", None), (None, None)])
def test_gtid(spark, gtid, n):
    assert spark.range(1).select(envelope.gtid_number(F.lit(gtid).cast("string"))).first()[0] == n


def test_snowflake(spark):
    f = lambda ts: spark.range(1).select(versions.snowflake(F.lit(ts), F.lit(1666735042727620291))).first()[0]
    assert f(1666717042727) == 1584952269638053571 and f(1666735042727) == 1585027767110053571


def test_sequence_numbers():
    t = 1_700_000_000_000
    out, start, count = versions.sequence_numbers([t, t, t + 1999, t + 2000, t + 2001, t + 4000])
    base = versions.SEQUENCE_START
    assert [x - y * 1_000_000 for x, y in zip(out, [t, t, t + 1999, t + 2000, t + 2001, t + 4000])] == [base + 1, base + 2, base + 3, base, base + 1, base]
    more, _, _ = versions.sequence_numbers([t + 4001], start, count)
    assert more == [(t + 4001) * 1_000_000 + base + 1] and out == sorted(out)


def test_sequence_of_streams(spark):
    rng = random.Random(1)
    rows = [(p, o, 1_700_000_000_000 + o * rng.randrange(1, 900)) for p in range(3) for o in range(40)]
    got = versions.with_sequence(spark.createDataFrame(rows, "partition int, offset long, cdc_ts_ms long").repartition(5), ["partition"], "offset", block=50).collect()
    for p in range(3):
        own = [r for r in rows if r[0] == p]
        assert [r.sequence for r in sorted(got) if r.partition == p] == versions.sequence_numbers([r[2] for r in own])[0]


def replay(rows):
    """The table after plain application of the changes in order."""
    table = {}
    for _, op, b, a in rows:
        if op == "t":
            table.clear()
        elif op == "d":
            table.pop(b[0], None)
        elif op is not None:
            table[a[0]] = a[1]
    return table


def random_log(seed, n=200):
    rng, table, rows = random.Random(seed), {}, []
    for o in range(n):
        k = rng.randrange(12)
        if rng.random() < 0.02:
            rows.append((o, "t", None, None))
            table.clear()
        elif k in table and rng.random() < 0.3:
            rows += [(o, "d", (k, table.pop(k)), None)]
        else:
            new = (k, f"v{o}")
            rows.append((o, "u" if k in table else rng.choice("cr"), (k, table[k]) if k in table else None, new))
            table[k] = new[1]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_state_equals_plain_replay(spark, seed):
    rows = random_log(seed)
    records = envelope.decode(events(spark, rows))
    v = versions.time_version(F.col("ts_ms"))
    log = state.replacing_rows(records, v, F.col("offset")).select(F.col("row.id").alias("id"), F.col("row.name").alias("name"), "operation", state.VERSION, state.SEQ, state.DELETED)
    got = {r.id: r["name"] for r in state.final(state.truncate_cut(log), ["id"]).collect()}
    assert got == replay(rows)
    twice = log.unionByName(log)  # delivered again
    assert {r.id: r["name"] for r in state.final(state.truncate_cut(twice), ["id"]).collect()} == got


def test_collapsing_equals_replacing(spark):
    rows = [r for r in random_log(7) if r[1] != "t"]
    table, clean = {}, []
    for o, op, b, a in rows:  # a log without truncates has other images before
        k = (b or a)[0]
        if op == "d" and k not in table:
            continue
        before = (k, table[k]) if k in table else None
        clean.append((o, op if op == "d" else "u" if before else "c", before, a))
        table.pop(k, None) if op == "d" else table.update({k: a[1]})
    records = envelope.decode(events(spark, clean))
    rows = state.collapsing_rows(records, F.col("offset"), F.col("offset")).select("row.id", "row.name", state.SIGN, state.VERSION, state.SEQ)
    assert rows.where("_sign = -1").count() == sum(r[1] in "ud" for r in clean)
    assert {r.id: r["name"] for r in state.collapse(rows, ["id"], [state.VERSION, state.SEQ]).collect()} == table


def test_late_versions_lose(spark):
    log = spark.createDataFrame([(1, "new", 20, 1, 0), (1, "late", 10, 2, 0), (2, "tie", 5, 1, 0), (2, "wins", 5, 2, 0)], "id long, name string, _version long, _seq long, is_deleted int")
    assert {r["name"] for r in state.final(log, ["id"]).collect()} == {"new", "wins"}
    assert state.final(log, []).count() == 4


def test_final_combines_before_the_shuffle(spark):
    log = spark.range(100).selectExpr("id % 3 AS id", "id AS _version", "id AS _seq", "0 AS is_deleted")
    plan = state.final(log, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange") == 1 and "partial_max_by" in plan


@pytest.mark.parametrize(("policy", "kept"), [("off", [0, 1, 2, 3]), ("old", [0, 3]), ("new", [2, 3])])
def test_dedup(spark, policy, kept):
    rows = spark.createDataFrame([("t", "a", 0), ("t", "a", 1), ("t", "a", 2), ("t", "b", 3)], "topic string, key string, offset long")
    assert sorted(r.offset for r in dedup.deduplicate(rows, policy, ["topic", "key"], ["offset"]).collect()) == kept


def test_dedup_policy_is_checked(spark):
    with pytest.raises(ValueError):
        dedup.deduplicate(spark.range(1), "some", ["id"], ["id"])


def test_record_key_falls_back_to_the_value(spark):
    row = spark.createDataFrame([(None, ("x",)), (("k",), ("x",))], "key struct<a: string>, value struct<b: string>")
    assert [r[0] for r in row.select(dedup.record_key()).collect()] == ['{"b":"x"}', '{"a":"k"}']


def test_align(spark):
    rows = spark.createDataFrame([("7", "x", 1)], "a string, B string, extra int")
    got = align.align(rows, T.StructType.fromDDL("b string, a int, c double, g string"), {"g": "concat(a, '!')"})
    assert got.columns == ["b", "a", "c", "g"]
    assert tuple(got.first()) == (None, 7, None, "7!")  # names are looked up case-sensitively
    assert tuple(align.align(rows, T.StructType.fromDDL("B string, extra date")).first()) == ("x", datetime.date(1970, 1, 2))  # whole numbers are days
    assert tuple(align.align(rows, T.StructType.fromDDL("B string, extra array<int>")).first()) == ("x", None)
    lost = align.unfit(rows, T.StructType.fromDDL("a int, B int, extra array<int>, new int"))
    assert rows.select(lost).first()[0] == 2 and align.unfit(rows, T.StructType.fromDDL("a string, z int")) is None


def test_evolved():
    old, new = T.StructType.fromDDL("a int, b string"), T.StructType.fromDDL("b string, c date, a int")
    assert align.evolved(new, old).names == ["a", "b", "c"]
    assert [f.name for f in align.missing_columns(new, old)] == ["c"]


def test_checksum_ignores_order_and_chunks(spark):
    rows = spark.range(500).selectExpr("id", "if(id % 7 = 0, null, concat('n', id)) AS name", "cast(id / 3 AS decimal(10,2)) AS d", "id % 2 = 0 AS b")
    whole = verify.checksum(rows).first()
    assert verify.checksum(rows.repartition(7).orderBy(F.desc("id"))).first() == whole
    assert verify.merged_sums(verify.chunked_sums(rows, "id", 37)).first() == whole
    assert whole.checksum == verify.digest(*whole[:5])
    changed = rows.withColumn("name", F.when(F.col("id") == 3, "n4").otherwise(F.col("name")))
    assert verify.checksum(changed).first().checksum != whole.checksum
    assert verify.checksum(changed, exclude=("name",)).first() == verify.checksum(rows, exclude=("name",)).first()
    assert verify.checksum(rows, where="id < 0").first()[:5] == (0, 0, 0, 0, 0)


def test_canonical_row_tells_null_from_empty(spark):
    rows = spark.createDataFrame([(1, None), (1, "")], "a int, b string")
    assert [r[0] for r in rows.select(verify.canonical_row(rows.schema)).collect()] == ["1#01", "1##00"]


def test_canonical_values(spark):
    rows = spark.sql("SELECT true AS t, date'1800-01-01' AS d, timestamp_ntz'2022-01-01 11:50:00.100' AS x, timestamp_ntz'2400-01-01 00:00:00' AS y, cast('a' AS binary) AS z, 1.50BD AS e")
    flags = "0" * sum(f.nullable for f in rows.schema.fields)
    line = rows.select(verify.canonical_row(rows.schema)).first()[0]
    assert line == "1#1900-01-01#2022-01-01 11:50:00.1#2299-12-31 23:59:59#61#1.50" + ("#" + flags if flags else "")


@pytest.mark.parametrize("size", [1, 7, 100])
def test_key_chunks_cover_the_keys(spark, size):
    rows = spark.range(3, 58)
    got = sorted((r.lo, r.hi) for r in verify.key_chunks(rows, "id", size).collect())
    assert got[0][0] == 3 and got[-1][1] == 57 and all(b[0] == a[1] + 1 for a, b in itertools.pairwise(got))
    assert sum(verify.chunk(rows, "id", *c).count() for c in got) == 55
    assert verify.key_chunks(rows.where("id < 0"), "id", size).count() == 0


def test_differences(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, x string")
    b = spark.createDataFrame([(1, "a"), (2, "c"), (4, "d")], "id long, x string")
    assert {(r.id, r.status) for r in verify.differences(a, b, ["id"]).collect()} == {(2, "changed"), (3, "missing"), (4, "extra")}
    assert verify.differences(a, a, ["id"]).count() == 0


def test_lag_is_zero_without_a_time(spark):
    assert [r[0] for r in spark.createDataFrame([(5,), (0,), (None,)], "t long").select(metrics.lag_ms(F.lit(9), F.col("t"))).collect()] == [4, 0, 0]


def test_batches_overlap():
    assert metrics.overlapping([(5, 9)], (7, 12)) and not metrics.overlapping([(8, 9)], (7, 12)) and not metrics.overlapping([], (1, 2))


def test_maps():
    assert routing.parse_map(" a:b, c : d ,") == {"a": "b", "c": "d"} and routing.parse_map(None) == {}
    for bad in ("a", "a:b:c", ":b", "a:b,a:c"):
        with pytest.raises(ValueError):
            routing.parse_map(bad)
    with pytest.raises(ValueError):
        routing.parse_map("a:1b", check_values=True)


def test_patterns(spark):
    got = spark.createDataFrame([("shop.a",), ("shop.ab",), ("x.a",)], "n string").where(routing.included(F.col("n"), [r"shop\.a.*"], [r".*b"])).collect()
    assert [r.n for r in got] == ["shop.a"]
    assert routing.chosen_tables(["a1", "b1", "a2"], "^a", "2$") == ["a1"]


def test_settings():
    s = Settings.of({"ignore_delete": "true", "deduplication.policy": "NEW", "database.override.map": "a:b", "unknown": 1, "target.topic2table.map": "a.b.c:t", "skip_replica_start": True, "buffer.max.records": "5"})
    assert s.ignore_delete and s.deduplication_policy == "new" and s.databases == {"a": "b"} and s.topics == {"a.b.c": "t"} and not s.autostart and s.max_records == 5
    for bad in ({"deduplication.policy": "x"}, {"datetime.timezone": "Mars/One"}, {"topic2table.map": "x"}, {"buffer.flush.time.ms": -1}):
        with pytest.raises(Exception):
            Settings.of(bad)
