"""Clustered tables, parallel sequence numbers, ranges, checksum trees, dialects and documents."""

import json
import random

import pytest
from pyspark.sql import functions as F

from driftwell.functions import sql as plain_sql
from driftwell.operators import compare, documents, state, versions
from driftwell.operators.envelope import gtid_number
from driftwell.operators.verify import differences
from driftwell.plans.ddl import DdlError, parse
from driftwell.plans.settings import Settings
from driftwell.plans.tables import Warehouse
from driftwell.streaming.apply import Applier

from .test_tables import CREATE, event, frame, image, rows_of


def numbered(spark, rows, block):
    frame_ = spark.createDataFrame(rows, "topic string, part int, offset long, t long").repartition(3)
    got = versions.with_sequence(frame_, ["topic", "part"], "offset", "t", block=block).collect()
    return {(r.topic, r.part, r.offset): r.sequence for r in got}


@pytest.mark.parametrize("seed", range(4))
def test_sequences_of_unsorted_times(spark, seed):
    rng = random.Random(seed)
    rows = []
    for stream in range(3):
        t, at = 1_700_000_000_000, rng.randrange(1000)
        for _ in range(rng.choice([1, 60, 200])):
            at += rng.choice([1, 1, 2, 50])
            t += rng.choice([0, 1, 300, 900, -1500, 2100, 9000] if seed else [0, 40, 700])
            rows.append(("a", stream, at, t))
    expected = {}
    for stream in range(3):
        own = [r for r in rows if r[1] == stream]
        expected |= dict(zip([r[:3] for r in own], versions.sequence_numbers([r[3] for r in own])[0]))
    assert numbered(spark, rows, rng.choice([7, 64, 1 << 17])) == expected


def test_a_record_without_a_time_has_no_number(spark):
    got = numbered(spark, [("a", 0, 1, None), ("a", 0, 2, 5), ("a", 0, 3, None), ("a", 0, 4, 6)], 2)
    assert [got["a", 0, n] for n in (1, 2, 3, 4)] == [None, 5_000_000 + 1_000_000_001, None, 6_000_000 + 1_000_000_002]


def clustered(spark, path, **settings):
    w = Warehouse(spark, str(path))
    w.execute(parse(CREATE), buckets=4)
    return w, Applier(w, Settings(compact_after=0, **settings))


def test_a_clustered_table_is_read_without_a_shuffle(spark, tmp_path):
    w, applier = clustered(spark, tmp_path)
    for n in range(10):
        applier(frame(spark, [event(100 * n + i, "c", None, image(i % 13, f"{n}-{i}", n)) for i in range(20)]), n)
    want = rows_of(w)
    assert {r[0] for r in want} == set(range(13))
    plan = w.state(w.load("shop", "users"))._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "hashpartitioning(id" not in plan
    files = lambda: set(w.runs(w.load("shop", "users")))
    assert w.merge("shop", "users", 4) == 10 and len(files()) == 1 and rows_of(w) == want
    first = files()
    for n in range(10, 15):
        applier(frame(spark, [event(100 * n + i, "c", None, image(i, f"{n}-{i}", n)) for i in range(3)]), n)
    want = rows_of(w)
    assert w.merge("shop", "users", 4) == 5 and len(files()) == 2 and first < files() and rows_of(w) == want  # what was merged before is not read again
    applier(frame(spark, [event(100 * 3 + i, "c", None, image(i % 13, f"3-{i}", 3)) for i in range(20)]), 3)  # a batch that was merged comes again
    assert len(files()) == 2 and rows_of(w) == want


def test_late_rows_lose_to_merged_deletes(spark, tmp_path):
    w, applier = clustered(spark, tmp_path)
    applier(frame(spark, [event(50, "d", image(1, "x"), None), event(51, "t", None, None)]), 0)
    applier(frame(spark, [event(60, "c", None, image(2, "new")), event(61, "d", image(3, "y"), None)]), 1)
    assert w.merge("shop", "users", 2) == 2
    applier(frame(spark, [event(40, "c", None, image(1, "late")), event(45, "c", None, image(4, "cut")), event(55, "c", None, image(3, "gone"))]), 2)
    assert rows_of(w) == [(2, "new", None)]
    w.compact("shop", "users", buckets=0)
    assert rows_of(w) == [(2, "new", None)] and w.load("shop", "users").buckets == 0
    w.compact("shop", "users", buckets=3)
    assert rows_of(w) == [(2, "new", None)] and w.load("shop", "users").buckets == 3


def test_an_unfinished_merge_counts_for_nothing(spark, tmp_path):
    w, applier = clustered(spark, tmp_path)
    for n in range(3):
        applier(frame(spark, [event(n, "c", None, image(n, "a"))]), n)
    d, want = w.load("shop", "users"), rows_of(w)
    path = f"{w.folder('shop', 'users')}/{d.data}"
    w.files.write(f"{path}/inputs/batch=tier1-x.json", json.dumps(w.runs(d)))
    w.files.write(f"{path}/batch=tier1-x/part-0.parquet", "not whole")
    assert rows_of(w) == want and len(w.runs(d)) == 3


def test_renames_are_made_together_or_not(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    for t in "abc":
        w.execute(parse(f"CREATE TABLE shop.{t} ({t} INT PRIMARY KEY)"))
    with pytest.raises(DdlError):
        w.execute(parse("RENAME TABLE shop.a TO shop.d, shop.b TO shop.c"))
    assert w.tables("shop") == ["a", "b", "c"]
    w.execute(parse("RENAME TABLE shop.a TO shop.x, shop.b TO shop.a, shop.x TO shop.b"))
    assert [w.load("shop", t).columns for t in "abc"] == [["b"], ["a"], ["c"]]
    with pytest.raises(OSError):
        w.files.rename(w.folder("shop", "a"), w.folder("shop", "c"))


@pytest.mark.parametrize(("leaf", "bits"), [(1, 21), (5, 8), (10**6, 8)])
def test_trees_find_what_a_join_finds(spark, leaf, bits):
    rng = random.Random(leaf)
    rows = [(k, k % 3, f"v{k}") for k in rng.sample([*range(-40, 400), *range(10**12, 10**12 + 60)], 300)] + [(None, 1, "n"), (-(2**62), 0, "least")]
    other = [(k, g, "?" if k and k % 11 == 0 else v) for k, g, v in rows if k is None or k % 17] + [(5_000_000, 1, "more")]
    a, b = (spark.createDataFrame(x, "k long, g int, v string") for x in (rows, other))
    want = sorted(map(repr, map(tuple, differences(a.where("k IS NOT NULL"), b.where("k IS NOT NULL"), ["k"]).collect())))
    got, shipped = compare.tree_differences(a, b, ["k"], leaf_rows=leaf, bits=bits)
    assert sorted(map(repr, map(tuple, got.collect()))) == want and len(want) > 20
    assert shipped.total == len(rows) + len(other) and shipped.rows <= shipped.total
    two, _ = compare.tree_differences(a.where("k IS NOT NULL"), b.where("k IS NOT NULL"), ["k", "g"], leaf_rows=leaf, bits=bits)
    assert sorted(repr((r.k, r.status)) for r in two.collect()) == want
    same, none = compare.tree_differences(a, a, ["k"])
    assert same.count() == 0 and none.rows == 0
    empty, _ = compare.tree_differences(a.limit(0), a.limit(0), ["k"])
    assert empty.count() == 0


def test_ranges_hold_equal_counts(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), int(1.5**rng.uniform(0, 60)), i) for i in range(1000)]
    frame_ = spark.createDataFrame(rows, "a string, b long, i int")
    for key, tasks in ((["a", "b", "i"], 5), (["b", "i"], None)):
        found = compare.equal_ranges(frame_, key, 64, tasks).orderBy("place").collect()
        sizes = [frame_.where(compare.within(key, r.lo, r.hi)).count() for r in (found[0], found[7], found[-1])]
        assert len(found) == 16 and sizes == [64, 64, 1000 - 15 * 64]
    # of a key that repeats, all rows are in one range
    found = compare.equal_ranges(frame_, ["a"], 64).orderBy("place").collect()
    assert [r.lo.a for r in found] == ["a", "b", "c"] and sum(frame_.where(compare.within(["a"], r.lo, r.hi)).count() for r in found) == 1000
    assert compare.equal_ranges(frame_.limit(0), ["b"], 64).count() == 0


def test_transaction_numbers_of_dialects(spark):
    texts = ["3e11fa47-71ca-11e1:23", "0-101-42", "0-101", "a-b-c", "1:2:3", "x:y", None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in texts], "g string").select(gtid_number(F.col("g"))).collect()]
    assert got == [23, 42, None, None, None, None, None]


def test_texts_left_out_come_from_the_last_image_that_has_them(spark):
    gone = state.UNAVAILABLE
    log = spark.createDataFrame([(1, "a", "x", 1, 0), (1, gone, "y", 2, 0), (1, "b", gone, 3, 0), (2, gone, gone, 1, 0), (3, None, "z", 1, 0), (3, gone, gone, 2, 1)], "id int, p string, q string, _version long, _seq long")
    want = [(1, "b", "y", 3, 0), (2, None, None, 1, 0), (3, None, "z", 2, 1)]
    assert sorted(map(tuple, state.latest_by_column(log, ["id"], ["_version", "_seq"]).collect())) == want
    part = state.needed_by_column(log.where("_version < 3"), ["id"], ["_version", "_seq"])
    assert part.count() == 5
    assert sorted(map(tuple, state.latest_by_column(part.unionByName(log.where("_version = 3")), ["id"], ["_version", "_seq"]).collect())) == want


def test_documents_of_any_shape(spark):
    rows = spark.createDataFrame([("1", '{"a": 1, "b": {"c": [1, 2]}}'), ("2", '{"a": "1.5"}'), ("3", "[7]"), ("4", "not json"), ("5", None)], "id string, t string").select("id", F.try_parse_json("t").alias("doc"))
    got = documents.typed_documents(rows, {"a": ("$.a", "int", "double"), "c": ("$.b.c[1]", "int"), "first": ("$[0]", "int")}).orderBy("id").collect()
    assert [tuple(r)[1:] for r in got] == [(1.0, 2, None), (1.5, None, None), (None, None, 7), (None, None, None), (None, None, None)]


def test_functions_of_plain_sql(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.execute(parse(CREATE))
    Applier(w)(frame(spark, [event(1, "c", None, image(1, "a", 7))]), 0)
    names = plain_sql.register(spark, w, prefix="dw_")
    assert "dw_shop_users" in names and "dw_format_decimal" in names
    row = spark.sql("SELECT dw_format_decimal(-1.005, 2) AS a, dw_format_decimal(12, 0) AS b, dw_format_decimal(NULL, 3) AS c, dw_transaction_number('u:9') AS d, score FROM dw_shop_users").first()
    assert tuple(row) == ("-1.01", "12", None, 9, 7)


def test_settings_of_dialects():
    assert Settings.of({"source.dialect": "postgres"}).dialect == "postgres"
    with pytest.raises(ValueError):
        Settings.of({"source.dialect": "other"})


def test_partition_filters_reach_the_folders(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.execute(parse("CREATE TABLE shop.users (id BIGINT, name VARCHAR(20), score INT, PRIMARY KEY (id, score)) PARTITION BY KEY (score)"), folders=True)
    applier = Applier(w, Settings())
    for n in range(2):
        applier(frame(spark, [event(10 * n + i, "c", None, image(i, f"{n}/{i}", i % 3 if i else None)) for i in range(9)]), n)
    rows = w.state(w.load("shop", "users")).where("score = 2")
    assert "PartitionFilters: [isnotnull(score" in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, rows.collect())) == [(2, "1/2", 2), (5, "1/5", 2), (8, "1/8", 2)] and w.state(w.load("shop", "users")).count() == 9


def test_offsets_of_many_batches_are_put_together(spark, tmp_path, monkeypatch):
    from driftwell.plans.store import Files
    from driftwell.streaming.offsets import TopicOffsets

    monkeypatch.setattr(TopicOffsets, "MOST", 3)
    store = TopicOffsets(spark, str(tmp_path / "o"))
    for n in range(8):
        store.put(frame(spark, [event(n, "c", None, image(1, "a")), event(n * 2 % 7, "c", None, image(1, "a"))]), n)
    assert [tuple(r) for r in store.rows().collect()] == [("s.shop.users", 0, 7)] and len(Files(spark).names(str(tmp_path / "o"))) <= 4


def test_rows_of_ranges_are_counted_by_ranks(spark):
    """As a look at the rows would count them, also of keys that repeat; without a join on the range."""
    rows = spark.range(1000).select((F.col("id") % 7).alias("a"), F.when(F.col("id") % 10 > 0, F.col("id")).alias("b"))
    for key in (["a"], ["b"], ["a", "b"]):
        want = [(r.place, r.lo, rows.where(compare.within(key, r.lo, r.hi) if None not in tuple(r.lo) else (F.col("b").isNull() | (F.col("b") < r.hi.b))).count()) for r in compare.equal_ranges(rows, key, 150).collect()] if key != ["a", "b"] else None
        found = compare.range_counts(rows, key, 150)
        got = [(r.place, r.lo, r.n) for r in found.collect()]
        assert sum(n for *_, n in got) == 1000 and (want is None or sorted(got, key=str) == sorted(want, key=str))
        assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_cubes_that_no_bigint_holds(spark, tmp_path):
    """Keys above 2,097,151: their cubes overflowed."""
    from driftwell.queries_sources import equal_ranges_skewed

    spark.range(2_097_000, 2_099_100).select(F.col("id").alias("o_orderkey")).write.parquet(str(tmp_path / "orders.parquet"))
    got = sorted(tuple(map(int, r)) for r in equal_ranges_skewed(spark, str(tmp_path)).collect())
    assert got == [(i, (2_097_000 + 700 * i) ** 3, 700) for i in range(3)]
