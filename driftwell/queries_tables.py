"""The rest of the catalogue: schema changes as they reach tables, order over partitions, typed streams, catalogs, loads."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import temporal, values
from .operators import align, compare, dedup, envelope, metrics, state, verify, versions
from .plans import routing
from .plans.ddl import parse
from .plans.scratch import folder
from .plans.settings import Settings
from .plans.store import Files
from .plans.tables import Warehouse
from .plans.types import Wire
from .queries import FINAL, LOG, NOW_MS, SEQUENCE, micros, query, table
from .sources import dumps
from .sources.change_log import KEY, ROW, TOPIC, events_log, incremental_snapshot, snapshot_events, stream_log
from .streaming.apply import Applier, start
from .streaming.listener import Metrics
from .streaming.offsets import OffsetStore, TopicOffsets

# schema changes

NATION = "CREATE TABLE shop.nation (n_nationkey INT NOT NULL, n_name VARCHAR(25), n_regionkey INT, PRIMARY KEY (n_nationkey))"


def ddl_events(spark: SparkSession, like: DataFrame, changes: list[str], first: int) -> DataFrame:
    """Schema changes at offsets from `first` on, in the topic of the rows."""
    source = {"ts_ms": 1, "snapshot": "false", "db": "shop"}
    lines = [(json.dumps({"topic": "srv.shop.nation", "partition": 0, "offset": first + i, "value": {"source": source}, "ddl": x}),) for i, x in enumerate(changes)]
    return spark.createDataFrame(lines, "value string").select(F.from_json("value", like.schema).alias("e")).select("e.*")


def changed(spark: SparkSession, d: str, changes: list[str], create: str = NATION, settings: Settings | None = None, again: str | None = None, name: str = "nation", key: tuple[str, ...] = ("n_nationkey",)) -> Warehouse:
    """A warehouse after CREATE TABLE, the rows of nation, the changes, and, if asked, the rows that `again` chooses with names in lower case."""
    nation = table(spark, d, "nation")
    rows = snapshot_events(nation, f"srv.shop.{name}", list(key), "shop", name, 1).withColumn("offset", F.col("key.n_nationkey") + 100)
    log = ddl_events(spark, rows, [create], 0).unionByName(rows).unionByName(ddl_events(spark, rows, changes, 1000))
    warehouse = Warehouse(spark, folder(spark, "warehouse"))
    Applier(warehouse, settings)(log, 0)
    if again is not None:
        later = nation.where(again).withColumn("n_name", F.lower("n_name"))
        Applier(warehouse, settings)(snapshot_events(later, f"srv.shop.{name}", list(key), "shop", name, 2).withColumn("offset", F.col("key.n_nationkey") + 5000), 1)
    return warehouse


def state_of(warehouse: Warehouse, name: str = "nation", db: str = "shop") -> DataFrame:
    return warehouse.state(warehouse.load(db, name))


def listed(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "name string")


def columns_of(warehouse: Warehouse, name: str, db: str = "shop") -> DataFrame:
    """The column catalog of a table."""
    d = warehouse.load(db, name)
    return warehouse.spark.createDataFrame([(i, f.name, f.kind, f.nullable) for i, f in enumerate(d.fields)], "place int, name string, kind string, nullable boolean")


def literal(rows: list[tuple], names: str) -> str:
    return f"SELECT * FROM (VALUES {', '.join(str(r) for r in rows)}) AS t({names})"


PLAIN = "SELECT n_nationkey, n_name, n_regionkey FROM nation"


@query("SELECT 'mart' AS name, 0::BIGINT AS tables, 0::BIGINT AS n UNION ALL SELECT 'r' || n_regionkey, 1, count(*) FROM nation GROUP BY n_regionkey")
def ddl_create_database(spark, d):
    """Databases by statements, and one for each region with the nations in it."""
    w = Warehouse(spark, folder(spark, "warehouse"))
    regions = [r["r_regionkey"] for r in table(spark, d, "region").collect()]  # five
    for sql in ("CREATE SCHEMA src", *(f"CREATE DATABASE IF NOT EXISTS r{r}" for r in regions)):
        w.execute(parse(sql), override={"src": "mart"})
    rows = snapshot_events(table(spark, d, "nation"), "", ["n_nationkey"], "", "nation", 1)
    db = F.concat(F.lit("r"), F.col("value.after.n_regionkey"))
    Applier(w, Settings(auto_create=True))(rows.withColumns({"topic": F.concat(F.lit("srv."), db, F.lit(".nation")), "value": F.col("value").withField("source.db", db)}), 0)
    each = [state_of(w, t, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), F.lit(1).cast("long").alias("tables"), "n") for n in w.databases() for t in w.tables(n)]
    empty = [(n, 0, 0) for n in w.databases() if not w.tables(n)]
    return reduce(DataFrame.unionByName, each, spark.createDataFrame(empty, "name string, tables long, n long"))


@query(PLAIN)
def ddl_create_table(spark, d):
    return state_of(changed(spark, d, []))


@query("SELECT n_nationkey, lower(n_name) AS n_name, n_regionkey FROM nation WHERE n_nationkey < 5")
def ddl_create_like(spark, d):
    """Rows go to the copy only."""
    w = changed(spark, d, ["CREATE TABLE twin LIKE nation"])
    later = table(spark, d, "nation").where("n_nationkey < 5").withColumn("n_name", F.lower("n_name"))
    Applier(w)(snapshot_events(later, "srv.shop.twin", ["n_nationkey"], "shop", "twin", 2), 1)
    return state_of(w, "twin")


TYPES = (
    ("id", "BIGINT UNSIGNED NOT NULL", "decimal(20,0)", False), ("a", "TINYINT", "smallint", True), ("b", "MEDIUMINT NOT NULL", "int", False), ("c", "INT UNSIGNED", "bigint", True),
    ("e", "FLOAT", "float", True), ("f", "DOUBLE PRECISION", "double", True), ("g", "NUMERIC(12,4)", "decimal(12,4)", True), ("h", "DECIMAL", "decimal(10,0)", True), ("i", "DECIMAL(65,30)", "string", True),
    ("j", "BOOL DEFAULT 0", "boolean", True), ("k", "DATE", "date", True), ("l", "DATETIME(3)", "timestamp_ntz", True), ("m", "TIMESTAMP(6) NULL", "timestamp", True), ("n", "TIME", "string", True),
    ("o", "YEAR", "int", True), ("p", "VARBINARY(20)", "string", True), ("q", "ENUM('x','y')", "string", True), ("r", "JSON", "string", True), ("s", "POINT", "struct<x:double,y:double>", True), ("t", "BIT(1)", "boolean", True),
)


@query(literal([(i, n, k, o) for i, (n, _, k, o) in enumerate(TYPES)], "place, name, kind, nullable").replace("SELECT *", "SELECT *, (SELECT count(*) FROM events) AS n"))
def ddl_column_types(spark, d):
    """Types of a table's columns, and its rows once the keys of events are loaded."""
    w = Warehouse(spark, folder(spark, "warehouse"))
    w.execute(parse(f"CREATE TABLE shop.types ({', '.join(f'`{n}` {t}' for n, t, *_ in TYPES)}, PRIMARY KEY (id, b))"))
    keys = table(spark, d, "events").select(F.col("event_id").alias("id"), F.lit(3).alias("b"))
    Applier(w)(snapshot_events(keys, "srv.shop.types", ["id", "b"], "shop", "types", 1), 0)
    return columns_of(w, "types").join(F.broadcast(state_of(w, "types").agg(F.count("*").alias("n"))))  # one row


@query("SELECT n_nationkey, n_name, n_nationkey * 2 AS twice FROM nation")
def ddl_generated_column(spark, d):
    return state_of(changed(spark, d, [], "CREATE TABLE shop.nation (n_nationkey INT PRIMARY KEY, n_name VARCHAR(25), twice INT GENERATED ALWAYS AS (n_nationkey * 2) STORED)"))


@query("SELECT 'n_regionkey,n_nationkey' AS parts, count(*) AS n FROM nation")
def ddl_partition_by(spark, d):
    w = changed(spark, d, [], "CREATE TABLE shop.nation (n_nationkey INT, n_name VARCHAR(25), n_regionkey INT, PRIMARY KEY (n_nationkey)) PARTITION BY RANGE COLUMNS(n_regionkey, n_nationkey) (PARTITION p0 VALUES LESS THAN (3, 9))")
    return state_of(w).agg(F.count("*").alias("n")).select(F.lit(",".join(w.load("shop", "nation").partition)).alias("parts"), "n")


PARTITIONED = "CREATE TABLE shop.nation (n_nationkey INT, n_name VARCHAR(25), n_regionkey INT, PRIMARY KEY (n_nationkey, n_regionkey)) PARTITION BY KEY (n_regionkey) PARTITIONS 5"


@query("SELECT n_nationkey, CASE WHEN n_nationkey < 9 THEN lower(n_name) ELSE n_name END AS n_name, n_regionkey, 2 AS folders FROM nation WHERE n_regionkey IN (1, 3)")
def partition_folders(spark, d):
    """A folder for each region: rows of two regions come from two of them."""
    w = changed(spark, d, [], PARTITIONED, Settings(folders=True), again="n_nationkey < 9", key=("n_nationkey", "n_regionkey"))
    rows = w.log(w.load("shop", "nation")).where("n_regionkey IN (1, 3)")
    read = rows.select(F.regexp_extract(F.input_file_name(), "n_regionkey=([^/]*)/", 1).alias("folder")).distinct()
    return state_of(w).where("n_regionkey IN (1, 3)").join(F.broadcast(read.agg(F.count("*").cast("int").alias("folders"))))  # one row


@query("SELECT n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey, false AS folders FROM nation WHERE n_nationkey >= 4")
def partition_column_changed(spark, d):
    """A new type of the partition column: the folders give way to files that hold it; deletes stay."""
    w = changed(spark, d, [], PARTITIONED, Settings(folders=True), key=("n_nationkey", "n_regionkey"))
    gone = snapshot_events(table(spark, d, "nation").where("n_nationkey < 4"), "srv.shop.nation", ["n_nationkey", "n_regionkey"], "shop", "nation", 3)
    value = F.col("value").withField("op", F.lit("d")).withField("before", F.col("value.after"))
    Applier(w)(gone.withColumns({"offset": F.col("key.n_nationkey") + 3000, "value": value}), 1)
    Applier(w)(ddl_events(spark, gone, ["ALTER TABLE nation MODIFY n_regionkey BIGINT NOT NULL"], 4000), 2)
    return state_of(w).withColumn("folders", F.lit(w.load("shop", "nation").folders))


@query("SELECT CAST(NULL AS VARCHAR) AS a, n_nationkey, CAST(NULL AS DATE) AS b, n_name, n_regionkey, CAST(0 AS BIGINT) AS c FROM nation")
def ddl_add_column(spark, d):
    return state_of(changed(spark, d, ["ALTER TABLE nation ADD COLUMN a VARCHAR(9) FIRST, ADD b DATE AFTER n_nationkey", "ALTER TABLE nation ADD COLUMN c BIGINT DEFAULT 0 NULL"]))


@query("SELECT n_nationkey, CASE WHEN n_nationkey < 9 THEN lower(n_name) ELSE n_name END AS n_name, n_regionkey, CASE WHEN n_nationkey < 9 THEN 7 ELSE 5 END AS n, 'it''s' AS s, 0 AS z, true AS b, 1::BIGINT AS at, CAST(NULL AS VARCHAR) AS none FROM nation")
def ddl_add_default(spark, d):
    """Earlier rows show the default of the time when the column was added; later ones without the column take the default of theirs."""
    changes = ["ALTER TABLE nation ADD COLUMN n INT NOT NULL DEFAULT 5, ADD s VARCHAR(9) DEFAULT 'it''s', ADD z INT NOT NULL, ADD b BOOL DEFAULT b'1'", "ALTER TABLE nation ADD COLUMN at TIMESTAMP(3) NOT NULL DEFAULT CURRENT_TIMESTAMP(3), ADD none TEXT DEFAULT NULL", "ALTER TABLE nation MODIFY n INT NOT NULL DEFAULT 7"]
    w = changed(spark, d, changes, again="n_nationkey < 9")
    return state_of(w).withColumn("at", F.when(F.col("n_nationkey") >= 9, F.unix_millis("at")).otherwise(F.when(F.col("at") > F.lit("2024-01-01").cast("timestamp"), 1)))


@query("SELECT 'low' AS name, count(*) AS n FROM nation WHERE n_nationkey % 2 = 0 AND n_nationkey >= 20 UNION ALL SELECT 'odd', 0")
def constraint_violations(spark, d):
    """Rows that come after a constraint and break it are counted and stay."""
    changes = ["ALTER TABLE nation ADD CONSTRAINT low CHECK (n_nationkey < 20)", "ALTER TABLE nation ADD CONSTRAINT odd CHECK (n_name IS NULL OR n_name = lower(n_name))"]
    w = changed(spark, d, changes, again="n_nationkey % 2 = 0")
    return spark.createDataFrame([(n, w.broken["shop", "nation", n]) for n in w.load("shop", "nation").constraints], "name string, n long")


@query("SELECT n_nationkey, CASE WHEN n_nationkey < 9 THEN lower(n_name) ELSE n_name END AS n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation")
def ddl_modify_column(spark, d):
    """Old files are read by a cast, new ones hold the new type."""
    return state_of(changed(spark, d, ["ALTER TABLE nation MODIFY COLUMN n_regionkey BIGINT"], again="n_nationkey < 9"))


@query("SELECT n_nationkey, CAST(n_regionkey AS VARCHAR) AS region, n_name FROM nation")
def ddl_change_column(spark, d):
    return state_of(changed(spark, d, ["ALTER TABLE nation CHANGE COLUMN n_regionkey region VARCHAR(9) NULL AFTER n_nationkey"]))


@query("SELECT n_nationkey, n_name AS n_regionkey, n_regionkey AS n_name FROM nation")
def ddl_rename_column(spark, d):
    return state_of(changed(spark, d, ["ALTER TABLE nation RENAME COLUMN n_name TO x, RENAME COLUMN n_regionkey TO n_name, RENAME COLUMN x TO n_regionkey"]))


@query("SELECT n_nationkey, n_regionkey, CAST(NULL AS VARCHAR) AS n_name FROM nation")
def ddl_drop_column(spark, d):
    """A column of the same name that comes later does not show the old values."""
    return state_of(changed(spark, d, ["ALTER TABLE nation DROP COLUMN n_name", "ALTER TABLE nation ADD COLUMN n_name VARCHAR(25)"]))


@query(PLAIN)
def ddl_add_primary_key(spark, d):
    """Not an action on a log that is keyed already."""
    return state_of(changed(spark, d, ["ALTER TABLE nation ADD PRIMARY KEY (n_nationkey, n_name)"]))


@query(PLAIN)
def ddl_add_index(spark, d):
    return state_of(changed(spark, d, ["ALTER TABLE nation ADD INDEX by_name (n_name(10) DESC), ADD UNIQUE KEY u (n_regionkey)"]))


@query("SELECT 'small' AS name, 'n_nationkey < 100' AS rule, count(*) AS n FROM nation")
def ddl_constraints(spark, d):
    w = changed(spark, d, ["ALTER TABLE nation ADD CONSTRAINT small CHECK (n_nationkey < 100)", "ALTER TABLE nation ADD CONSTRAINT gone CHECK (n_regionkey > 0)", "ALTER TABLE nation DROP CONSTRAINT gone"])
    rules = spark.createDataFrame(list(w.load("shop", "nation").constraints.items()), "name string, rule string")
    return rules.join(F.broadcast(state_of(w).agg(F.count("*").alias("n"))))  # one row


@query("SELECT n_nationkey, n_name, n_regionkey, CAST(NULL AS INTEGER) AS extra FROM nation")
def ddl_algorithm(spark, d):
    return state_of(changed(spark, d, ["ALTER TABLE nation ADD COLUMN extra INT, ALGORITHM=INPLACE, LOCK=NONE", "ALTER TABLE nation ALGORITHM=INSTANT"]))


@query(PLAIN)
def ddl_alter_rename(spark, d):
    return state_of(changed(spark, d, ["ALTER TABLE nation RENAME TO countries"]), "countries")


@query("SELECT n_nationkey, n_name, n_regionkey, 'b' AS name FROM nation")
def ddl_rename_table(spark, d):
    w = changed(spark, d, ["RENAME TABLE nation TO a, a TO b"])
    return state_of(w, "b").withColumn("name", F.lit(",".join(w.tables("shop"))))


@query("SELECT n_nationkey, n_name, n_regionkey, 'nation,other' AS tables, 1 AS failed FROM nation")
def ddl_rename_onto(spark, d):
    """A table isn't renamed onto another, and of a statement that would nothing is done; two tables can change their names in one."""
    w = changed(spark, d, ["CREATE TABLE other LIKE nation"])
    rows = snapshot_events(table(spark, d, "nation"), "srv.shop.nation", ["n_nationkey"], "shop", "nation", 1)
    applier = Applier(w)
    applier(ddl_events(spark, rows, ["RENAME TABLE nation TO third, other TO third", "RENAME TABLE nation TO aside, other TO nation, aside TO other"], 2000), 2)
    return state_of(w, "other").withColumns({"tables": F.lit(",".join(w.tables("shop"))), "failed": F.lit(len(applier.failed))})


@query(literal([("kept",)], "name"))
def ddl_drop_table(spark, d):
    w = changed(spark, d, ["CREATE TABLE kept (id INT PRIMARY KEY)", "CREATE TABLE gone (id INT PRIMARY KEY)", "DROP TABLE IF EXISTS nation, gone"])
    return listed(spark, w.tables("shop"))


@query("SELECT n_nationkey, lower(n_name) AS n_name, n_regionkey FROM nation WHERE n_nationkey % 3 = 0")
def ddl_truncate(spark, d):
    return state_of(changed(spark, d, ["TRUNCATE TABLE nation"], again="n_nationkey % 3 = 0"))


@query("SELECT n_nationkey, CAST(NULL AS INTEGER) AS size, n_name AS label, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation")
def ddl_several(spark, d):
    return state_of(changed(spark, d, ["ALTER TABLE nation ADD COLUMN size INT AFTER n_nationkey, CHANGE n_name label VARCHAR(40), MODIFY n_regionkey BIGINT NULL, ADD COLUMN x INT, DROP COLUMN x"]))


@query(PLAIN)
def ddl_gates(spark, d):
    """Drops and truncates are turned off, other changes of excluded tables too."""
    return state_of(changed(spark, d, ["TRUNCATE TABLE nation", "DROP TABLE nation", "ALTER TABLE nation DROP COLUMN n_name"], settings=Settings(disable_drop_truncate=True)))


@query("SELECT 'off' AS gate, n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT 'snapshot', n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT 'open', n_nationkey, n_name, NULL FROM nation")
def ddl_gate_kinds(spark, d):
    """Schema changes turned off; those of a snapshot, which are passed over unless they are asked for."""
    out = []
    for gate, settings in (("off", Settings(auto_create=True, disable_ddl=True)), ("snapshot", Settings(auto_create=True)), ("open", Settings(auto_create=True, snapshot_ddl=True))):
        rows = snapshot_events(table(spark, d, "nation"), "srv.shop.nation", ["n_nationkey"], "shop", "nation", 1)
        ddl = ddl_events(spark, rows, ["ALTER TABLE nation DROP COLUMN n_regionkey"], 1000).withColumn("value", F.col("value").withField("source.snapshot", F.lit("true")))
        w = Warehouse(spark, folder(spark, "warehouse"))
        Applier(w, settings)(rows.unionByName(ddl), 0)
        out.append(state_of(w).withColumn("gate", F.lit(gate)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)


@query(literal([("nation",)], "name"))
def ddl_include(spark, d):
    """Schema changes of tables that the include list leaves out."""
    nation = table(spark, d, "nation")
    rows = snapshot_events(nation, "srv.shop.nation", ["n_nationkey"], "shop", "nation", 1)
    w = Warehouse(spark, folder(spark, "warehouse"))
    Applier(w, include=[r"shop\.nat.*"])(ddl_events(spark, rows, [NATION, "CREATE TABLE secret (id INT PRIMARY KEY)"], 0), 0)
    return listed(spark, w.tables("shop"))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def ddl_retry_repeated(spark, d):
    """The whole log, changes included, applied three times."""
    w = changed(spark, d, ["ALTER TABLE nation ADD COLUMN x INT", "ALTER TABLE nation CHANGE COLUMN x y INT", "ALTER TABLE nation DROP COLUMN y"])
    nation = table(spark, d, "nation")
    rows = snapshot_events(nation, "srv.shop.nation", ["n_nationkey"], "shop", "nation", 1).withColumn("offset", F.col("key.n_nationkey") + 100)
    for n in range(2):
        Applier(w)(rows.unionByName(ddl_events(spark, rows, ["ALTER TABLE nation ADD COLUMN x INT", "ALTER TABLE nation CHANGE COLUMN x y INT", "ALTER TABLE nation DROP COLUMN y"], 1000)), n)
    return state_of(w)


# order

LAST_BY_USER = "SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM {}) WHERE rn = 1 AND event_type <> 'error'"


def partitioned_log(spark: SparkSession, d: str, first: int, ts_ms, gap: int = 0) -> DataFrame:
    """events in six partitions by user, errors being deletes; offsets from `first` on, partitions `gap` apart; no transaction numbers."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", F.pmod("user_id", F.lit(6)).cast("int").alias("p"))
    schema = envelope.envelope_schema(KEY, ROW)
    body = schema["value"].dataType
    image = F.struct("user_id", "event_type")
    gone = F.col("event_type") == "error"
    source = {"ts_ms": ts_ms, "snapshot": F.lit("false"), "db": F.lit("shop"), "table": F.lit("user_state")}
    fields = [source.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in body["source"].dataType.fields]
    value = F.struct(F.when(gone, image).alias("before"), F.when(~gone, image).alias("after"), F.struct(*fields).alias("source"), F.when(gone, "d").otherwise("u").alias("op"), ts_ms.cast("long").alias("ts_ms"))
    offset = F.lit(first) + F.col("event_id") * 2 + F.col("p") * gap
    return e.select(F.lit(TOPIC).alias("topic"), F.col("p").alias("partition"), offset.cast("long").alias("offset"), F.lit(0).cast("long").alias("timestamp_ms"), F.struct("user_id").alias("key"), value.cast(body).alias("value"), F.lit(None).cast("string").alias("ddl"))


@query(LAST_BY_USER.format("events"))
def ties_across_a_million(spark, d):
    """Many changes of one time at offsets below and above a million: the place in the log decides."""
    w = Warehouse(spark, folder(spark, "warehouse"))
    Applier(w, Settings(auto_create=True))(partitioned_log(spark, d, 999_000, F.floor(F.col("event_id") / 4000)), 0)
    return state_of(w, "user_state")


@query("WITH m AS (SELECT max(event_id) // 2 AS m FROM events) " + LAST_BY_USER.format("(SELECT events.* FROM events, m WHERE event_id > m OR event_id = m AND user_id % 6 <> 0)"))
def truncate_in_one_partition(spark, d):
    """A truncate in the first of six partitions, whose offsets are far apart: the others are cut by time."""
    log = partitioned_log(spark, d, 0, F.col("event_id"), 10_000_000)
    middle = table(spark, d, "events").agg(F.expr("max(event_id) div 2").alias("m")).first()["m"]
    cut = json.dumps({"topic": TOPIC, "partition": 0, "offset": 2 * middle + 1, "value": {"op": "t", "ts_ms": middle, "source": {"ts_ms": middle, "db": "shop", "table": "user_state", "snapshot": "false"}}})
    marker = spark.createDataFrame([(cut,)], "value string").select(F.from_json("value", log.schema).alias("e")).select("e.*")
    w = Warehouse(spark, folder(spark, "warehouse"))
    Applier(w, Settings(auto_create=True))(log.unionByName(marker), 0)
    return state_of(w, "user_state")


@query("WITH m AS (SELECT max(event_id) // 2 AS m FROM events) SELECT user_id, kind FROM (SELECT user_id, event_type, CASE WHEN event_id > m OR event_id = m AND user_id % 6 <> 0 THEN event_type END AS kind, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events, m) WHERE rn = 1 AND event_type <> 'error'")
def change_between_partitions(spark, d):
    """A column is dropped and added again in the middle of one batch of six partitions: earlier values are gone."""
    log = partitioned_log(spark, d, 0, F.col("event_id"), 10_000_000)
    middle = table(spark, d, "events").agg(F.expr("max(event_id) div 2").alias("m")).first()["m"]
    lines = [(json.dumps({"topic": TOPIC, "partition": 0, "offset": 2 * middle + 1, "value": {"source": {"ts_ms": middle, "db": "shop", "snapshot": "false"}}, "ddl": "ALTER TABLE user_state DROP COLUMN event_type, ADD COLUMN event_type VARCHAR(20)"}),)]
    ddl = spark.createDataFrame(lines, "value string").select(F.from_json("value", log.schema).alias("e")).select("e.*")
    w = Warehouse(spark, folder(spark, "warehouse"))
    w.execute(parse("CREATE TABLE shop.user_state (user_id BIGINT PRIMARY KEY, event_type VARCHAR(20))"))
    Applier(w)(log.unionByName(ddl), 0)
    return state_of(w, "user_state").select("user_id", F.col("event_type").alias("kind"))


@query(FINAL)
def late_data(spark, d):
    """Batches out of order: older versions that come later lose."""
    w, log = Warehouse(spark, folder(spark, "warehouse")), events_log(spark, d)
    applier = Applier(w, Settings(auto_create=True))
    for n, part in enumerate((2, 0, 1)):
        applier(log.where(F.col("offset") % 3 == part), n)
    return state_of(w, "user_state")


@query(FINAL)
def clustered_final(spark, d):
    """A table of eight buckets after eight batches, newest first, with merges in between: late rows lose, also against deletes in merged runs."""
    w, log = Warehouse(spark, folder(spark, "warehouse")), events_log(spark, d)
    applier = Applier(w, Settings(auto_create=True, buckets=8, compact_after=3))
    last = table(spark, d, "events").agg(F.max("event_id").alias("m")).first()["m"]
    for n in range(8):
        applier(log.where(F.floor(F.col("offset") * 8 / (last + 1)) == 7 - n), n)
    return state_of(w, "user_state")


@query(LAST_BY_USER.format("(SELECT * FROM events WHERE event_id > (SELECT max(event_id) // 2 FROM events))").replace("SELECT user_id, event_type FROM (SELECT *,", "SELECT user_id, event_type AS kind, 1 AS n FROM (SELECT *,", 1))
def clustered_changes(spark, d):
    """Truncate, new columns and a renamed key of a clustered table, before and after a merge."""
    log = partitioned_log(spark, d, 0, F.col("event_id"))
    middle = table(spark, d, "events").agg(F.expr("max(event_id) div 2").alias("m")).first()["m"]
    w = Warehouse(spark, folder(spark, "warehouse"))
    w.execute(parse("CREATE TABLE shop.user_state (user_id BIGINT PRIMARY KEY, event_type VARCHAR(20))"), buckets=6)
    applier = Applier(w, Settings(compact_after=3))
    for n in range(4):
        applier(log.where((F.col("offset") <= 2 * middle) & (F.col("partition") % 4 == n)), n)
    for p in range(6):
        w.truncate(w.load("shop", "user_state"), 2 * middle, f"{TOPIC}/{p}", middle)
    w.execute(parse("ALTER TABLE shop.user_state ADD COLUMN n INT NOT NULL DEFAULT 1"))
    for n in range(4):
        applier(log.where((F.col("offset") > 2 * middle) & (F.col("partition") % 4 == n)), 4 + n)
    w.execute(parse("ALTER TABLE shop.user_state CHANGE event_type kind VARCHAR(20)"))
    return state_of(w, "user_state")


@query(SEQUENCE.format(part="event_id % 6"))
def stream_sequence(spark, d):
    """Sequence numbers of six partitions whose log comes in four micro-batches; the count goes on between them."""
    out, path, whole = folder(spark, "sequence"), folder(spark, "change-log"), events_log(spark, d)
    last = table(spark, d, "events").agg(F.max("event_id").alias("m")).first()["m"]
    lines = compare.kept(whole.select("offset", F.to_json(F.struct("*")).alias("value")), "sequence-log")
    for n in range(4):  # files are read in the order in which they were written
        part = lines.where(F.floor(F.col("offset") * 4 / (last + 1)) == n)
        part.repartitionByRange(1, "offset").select("value").write.mode("append").text(path)
    log = stream_log(spark, path, KEY, ROW, 1)
    records_ = envelope.decode(log).select("topic", F.pmod("offset", F.lit(6)).cast("int").alias("partition"), "offset", "cdc_ts_ms")
    numbered = versions.sequence_stream(records_, ["topic", "partition"], ["offset"])
    numbered.writeStream.format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(numbered.schema).parquet(f"{out}/data").select(F.col("offset").alias("event_id"), "sequence")


# typed streams

WIRES = [
    Wire("user_id", "INT64", optional=False), Wire("day", "INT32", "io.time.Date"), Wire("at", "INT64", "io.time.MicroTimestamp"), Wire("ms", "INT64", "io.time.Timestamp"), Wire("clock", "INT64", "io.time.MicroTime"),
    Wire("zoned", "STRING", "io.time.ZonedTimestamp"), Wire("amount", "STRUCT", "io.data.VariableScaleDecimal"), Wire("raw", "BYTES"), Wire("kind", "STRING", "io.data.Enum"), Wire("ok", "BOOLEAN"), Wire("spot", "STRUCT", "io.data.geometry.Point"),
]
RAW = "user_id long, day int, at long, ms long, clock long, zoned string, amount struct<scale: int, value: binary>, raw binary, kind string, ok boolean, spot struct<x: double, y: double>"


@query("SELECT user_id, strftime(DATE '1970-01-01' + CAST(greatest(least(event_id * 37 - 60000, 120529), -25567) AS INTEGER), '%Y-%m-%d') AS day, strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS at, strftime(make_timestamp(epoch_us(ts) // 1000 * 1000) - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS ms, strftime(ts, '%H:%M:%S.%f') AS clock, epoch_us(ts) AS zoned, CAST((event_id * 7001 - 5000000) / 1000.0 AS DECIMAL(18,3)) AS amount, event_type AS raw, event_type AS kind, event_id % 2 = 0 AS ok, CAST(event_id AS DOUBLE) AS x FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'")
def stream_typed_final(spark, d):
    """Days, micro- and milliseconds, ISO times, unscaled decimals and bytes, as a capture engine sends them; zoneless times are shown five hours west."""
    iso = F.concat(F.translate(temporal.seconds_text(temporal.whole_seconds(micros())), " ", "T"), F.lit("."), temporal.fraction(micros()), F.lit("Z"))
    millis = F.expr("CAST((u - pmod(u, 1000)) / 1000 AS BIGINT)")
    e = table(spark, d, "events").withColumn("u", micros())
    image = F.struct(
        "user_id", (F.col("event_id") * 37 - 60000).cast("int").alias("day"), F.col("u").alias("at"), millis.alias("ms"), F.col("u").alias("clock"), iso.alias("zoned"),
        F.struct(F.lit(3).alias("scale"), F.unhex(F.lpad(F.hex(F.col("event_id") * 7001 - 5000000), 16, "0")).alias("value")).alias("amount"),
        F.col("event_type").cast("binary").alias("raw"), F.col("event_type").alias("kind"), (F.col("event_id") % 2 == 0).alias("ok"), F.struct(F.col("event_id").cast("double").alias("x"), F.lit(0.0).alias("y")).alias("spot"),
    )
    schema = envelope.envelope_schema("user_id long", RAW)
    body = schema["value"].dataType
    gone = F.col("event_type") == "error"
    source = {"ts_ms": F.col("event_id"), "snapshot": F.lit("false"), "db": F.lit("shop"), "lsn": F.col("event_id") * 64}
    fields = [source.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in body["source"].dataType.fields]
    value = F.struct(F.when(gone, image).alias("before"), F.when(~gone, image).alias("after"), F.struct(*fields).alias("source"), F.when(gone, "d").otherwise("u").alias("op"), F.col("event_id").cast("long").alias("ts_ms"))
    log = e.select(F.lit("srv.shop.typed").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").cast("long").alias("offset"), F.lit(0).cast("long").alias("timestamp_ms"), F.struct("user_id").alias("key"), value.cast(body).alias("value"), F.lit(None).cast("string").alias("ddl"))
    w, path = Warehouse(spark, folder(spark, "warehouse")), folder(spark, "typed-log")
    log.repartitionByRange(4, "offset").select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    applier = Applier(w, Settings(auto_create=True, zone="Etc/GMT+5"), wires={"typed": WIRES})
    start(stream_log(spark, path, "user_id long", RAW, 1), applier, folder(spark, "checkpoint"), once=True).awaitTermination()
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return state_of(w, "typed").select("user_id", F.col("day").cast("string").alias("day"), text("at").alias("at"), text("ms").alias("ms"), "clock", F.unix_micros("zoned").alias("zoned"), F.col("amount").cast("decimal(18,3)").alias("amount"), "raw", "kind", "ok", "spot.x")


@query(LOG + "SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM cl WHERE op <> 'r') WHERE rn = 1 AND op <> 'd'")
def schema_only_start(spark, d):
    """Rows of the snapshot are left out, changes are applied."""
    w = Warehouse(spark, folder(spark, "warehouse"))
    Applier(w, Settings.of({"auto.create.tables": "true", "snapshot.mode": "schema_only"}))(events_log(spark, d), 0)
    return state_of(w, "user_state")


@query("SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'")
def dedup_pool(spark, d):
    """Policy old: later records of a key are dropped, in the batch and in batches after it."""
    w, log = Warehouse(spark, folder(spark, "warehouse")), partitioned_log(spark, d, 0, F.col("event_id"))
    applier = Applier(w, Settings(auto_create=True, deduplication_policy="old", buffer_count=1_000_000))
    middle = table(spark, d, "events").agg(F.expr("max(event_id) div 2").alias("m")).first()["m"]
    for n, part in enumerate((F.col("offset") <= 2 * middle, F.col("offset") > 2 * middle)):
        applier(log.where(part), n)
    return state_of(w, "user_state")


@query("SELECT user_id, event_type FROM events WHERE event_type <> 'error'")
def dedup_null_keys(spark, d):
    """Records without a key are told apart by their value; a new applier knows what one before it has seen."""
    log = partitioned_log(spark, d, 0, F.col("event_id")).where("value.op = 'u'")
    log = log.withColumn("key", F.lit(None).cast(log.schema["key"].dataType))
    first, again = F.col("offset") % 4 == 0, log.withColumn("offset", F.col("offset") + 1_000_000_000)
    w, settings = Warehouse(spark, folder(spark, "warehouse")), Settings(auto_create=True, deduplication_policy="old", buffer_count=1_000_000_000)
    for n, part in enumerate((log.where(first), log.where(~first).unionByName(again))):
        Applier(w, settings, keys={"user_state": ()})(part, n)
    return state_of(w, "user_state")


@query("WITH m AS (SELECT max(event_id) // 2 + 0.5 AS m FROM events), s AS (SELECT c_custkey AS user_id, c_mktsegment AS event_type, m FROM customer, m) SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t DESC) AS rn FROM (SELECT user_id, event_type, event_id AS t FROM events UNION ALL SELECT * FROM s)) WHERE rn = 1 AND event_type <> 'error'")
def snapshot_beside_gtids(spark, d):
    """An incremental snapshot in the middle of changes with transaction numbers: earlier changes lose, later ones win, in 2022 and in 2026."""
    starts = {0: 1_654_041_600_000, 1: 1_780_272_000_000}
    start_ms = F.when(F.col("user_id") % 2 == 0, starts[0]).otherwise(starts[1])
    log = partitioned_log(spark, d, 0, start_ms + F.col("event_id") * 1000)
    log = log.withColumn("value", F.col("value").withField("source.gtid", F.concat(F.lit("u:"), F.col("offset").cast("string"))))
    middle = table(spark, d, "events").agg(F.expr("max(event_id) div 2").alias("m")).first()["m"]
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("event_type"))
    part = lambda n: snapshot_events(rows.where(F.col("user_id") % 2 == n), TOPIC, ["user_id"], "shop", "user_state", starts[n] + middle * 1000 + 500)
    w = Warehouse(spark, folder(spark, "warehouse"))
    applier = Applier(w, Settings(auto_create=True))
    for n, events in enumerate((log.where(F.col("offset") % 3 == 0), part(0).unionByName(part(1)), log.where(F.col("offset") % 3 != 0))):
        applier(events, n)
    return state_of(w, "user_state")


@query(LOG + ", w AS (SELECT max(event_id) // 2 AS m FROM events), s AS (SELECT c_custkey AS user_id, c_mktsegment AS event_type FROM customer WHERE c_nationkey < 9) SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t DESC) AS rn FROM (SELECT user_id, event_type, 0 AS t, 'r' AS op FROM s UNION ALL SELECT user_id, event_type, event_id + 1, op FROM cl)) WHERE rn = 1 AND op <> 'd'")
def incremental_snapshot_signal(spark, d):
    """A row of the signal table asks for some rows of a table while changes arrive; changes are newer."""
    signals = spark.createDataFrame([("1", "log", "{}"), ("2", "execute-snapshot", '{"data-collections": ["shop.user_state", "shop.unknown"], "type": "incremental", "additional-condition": "nation < 9"}')], "id string, type string, data string")
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("event_type"), F.col("c_nationkey").alias("nation"))
    w = Warehouse(spark, folder(spark, "warehouse"))
    applier = Applier(w, Settings(auto_create=True))
    applier(events_log(spark, d), 0)
    for n, part in enumerate(incremental_snapshot(signals, {"shop.user_state": rows}, {"shop.user_state": ["user_id"]}, "srv", 1), 1):
        applier(part, n)
    return state_of(w, "user_state").select("user_id", "event_type")


@query("SELECT event_id, user_id AS u, event_type AS kind, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def documents_inferred(spark, d):
    """Documents whose fields are found in them; nested ones stay texts."""
    doc = F.concat(F.lit('{"_id": '), F.col("event_id"), F.lit(', "u": '), F.col("user_id"), F.lit(', "kind": "'), F.col("event_type"), F.lit('", "doc": '), F.col("props"), F.lit("}"))
    docs = table(spark, d, "events").select(doc.alias("after"))
    rows = docs.select(envelope.document_rows(F.col("after"), envelope.document_schema(docs, "after")).alias("r")).select("r.*")
    return rows.select(F.col("_id").cast("long").alias("event_id"), F.col("u").cast("long").alias("u"), "kind", values.json_field(F.col("doc"), "$.k").try_cast("long").alias("k"))


#: Texts of one time in all forms, with an offset (Z, with and without a colon) and zero to seven fraction digits, and without; with what they are in a zone five hours west.
FRACTIONS = ["", *(f".{'1234567'[:n]}" for n in range(1, 8))]
FORMS = [(f"2021-12-31T19:01:00{x}{o}", f"2021-12-31 {h}:01:00.{x[1:7]:0<6}") for x in FRACTIONS for o, h in (("Z", "14"), ("+03:00", "11"), ("+0300", "11"), ("", "19")) if o or not x]
FORMS += [("2338-01-19T03:14:07Z", "2299-12-31 18:59:59.000000"), ("1800-01-01T00:00:00+01:00", "1899-12-31 19:00:00.000000"), ("31.12.2021", ""), ("", "")]


@query(f"SELECT event_id, iso, t FROM events JOIN ({literal([(i, *f) for i, f in enumerate(FORMS)], 'i, iso, t')}) AS f ON event_id % {len(FORMS)} = i")
def zoned_forms(spark, d):
    """Each event has one of the forms."""
    iso = F.get(F.array(*[F.lit(x) for x, _ in FORMS]), (F.col("event_id") % len(FORMS)).cast("int"))
    return table(spark, d, "events").select("event_id", iso.alias("iso")).withColumn("t", temporal.zoned_timestamp(F.col("iso"), "Etc/GMT+5"))


# positions, figures, catalogs

@query(LOG + "SELECT 'srv.shop.user_state' AS topic, CAST(event_id % 6 AS INTEGER) AS \"partition\", max(event_id) AS max_offset FROM cl GROUP BY 2")
def topic_offsets(spark, d):
    """The table of greatest offsets after three batches."""
    store = TopicOffsets(spark, folder(spark, "offsets"))
    log = events_log(spark, d).withColumn("partition", (F.col("offset") % 6).cast("int"))
    applier = Applier(Warehouse(spark, folder(spark, "warehouse")), Settings(auto_create=True, store_offsets=True), offsets=store)
    for n in range(3):
        applier(log.where(F.col("user_id" if "user_id" in log.columns else "key.user_id") % 3 == n), n)
    return store.rows()


@query("SELECT 'u' || user_id AS offset_key, CAST(event_id AS VARCHAR) AS offset_val FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error' UNION ALL SELECT 'z', 'end'")
def offset_read(spark, d):
    """A position for each user, many times overwritten, and deleted by errors."""
    store, e = OffsetStore(spark, folder(spark, "offsets")), table(spark, d, "events")
    value = F.when(F.col("event_type") != "error", F.col("event_id").cast("string"))
    rows = e.select(F.concat(F.lit("u"), "user_id").alias("offset_key"), value.alias("offset_val"), F.col("event_id").alias("version"))
    for part in (1, 0):
        store.put_all(rows.where(F.col("version") % 2 == part))
    store.put("y", "1", 1)
    store.put("z", "end", 1)
    store.delete("y", 2)
    return store.rows().select("offset_key", "offset_val")


@query(LOG + f"SELECT count(*) AS records, 0::BIGINT AS errors, {NOW_MS} - min(ms) AS lag, max(event_id) AS pos FROM cl")
def metrics_text(spark, d):
    """Figures as the endpoint shows them."""
    m, log = Metrics(), events_log(spark, d)
    m.observe(log, envelope.decode(log), F.lit(NOW_MS))
    pick = lambda name: next(int(x.rpartition(" ")[2]) for x in m.text().splitlines() if x.startswith(name))
    return spark.createDataFrame([(pick("records_total"), pick("errors_total"), pick("source_lag_ms"), pick("binlog_position"))], "records long, errors long, lag long, pos long")


@query(LOG + "SELECT count(*) AS records, 1 AS ddl, max(event_id) FILTER (WHERE event_id % 3 = 1) AS offset_1, max(event_id) AS pos, max(event_id) + 1 AS gtid, 0 AS errors FROM cl")
def metrics_of_batches(spark, d):
    """Figures of two batches of three partitions, gathered by the job that looks at a batch before it is written."""
    m, log = Metrics(), events_log(spark, d).withColumn("partition", (F.col("offset") % 3).cast("int"))
    ddl = ddl_events(spark, log, ["CREATE TABLE shop.other (id INT PRIMARY KEY)"], 0).withColumn("topic", F.lit(TOPIC))
    applier = Applier(Warehouse(spark, folder(spark, "warehouse")), Settings(auto_create=True), metrics=m)
    applier(log.where("offset % 2 = 0").unionByName(ddl), 0)
    applier(log.where("offset % 2 = 1"), 1)
    pick = lambda name, **labels: int(m.values[name, tuple(sorted((k, str(v)) for k, v in {"topic": TOPIC, **labels}.items()))])
    pos = max(int(v) for (name, _), v in m.values.items() if name == "binlog_position")
    return spark.createDataFrame([(pick("records_total"), pick("ddl_total"), pick("partition_offset", partition=1), pos, pick("max_gtid"), pick("errors_total"))], "records long, ddl int, offset_1 long, pos long, gtid long, errors int")


@query("SELECT 'nation' AS name, 'n_nationkey' AS integer_key, 'n_nationkey' AS required, 3 AS columns, count(*) AS n FROM nation UNION ALL SELECT 'plain', NULL, '', 5, count(*) FROM customer")
def table_catalog(spark, d):
    """Tables of a pattern with their integer key, columns that can't be null, number of columns, and rows."""
    w = Warehouse(spark, folder(spark, "warehouse"))
    for sql in (NATION, "CREATE TABLE shop.plain (c_custkey BIGINT, c_name TEXT, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment TEXT)", "CREATE TABLE shop.other (id INT PRIMARY KEY)"):
        w.execute(parse(sql))
    for name, rows in (("nation", table(spark, d, "nation")), ("plain", table(spark, d, "customer"))):
        Applier(w)(snapshot_events(rows, f"srv.shop.{name}", rows.columns[:1], "shop", name, 1), 0)
    found = [w.load("shop", n) for n in routing.chosen_tables(w.tables("shop"), exclude="^oth")]
    rows = spark.createDataFrame([(t.name, dumps.integer_key(t), ",".join(align.not_null_columns(t.schema())), len(t.columns)) for t in found], "name string, integer_key string, required string, columns int")
    return rows.join(verify.counts({t.name: w.state(t) for t in found}).select(F.col("table").alias("name"), F.col("cnt").alias("n")), "name")



@query("SELECT o_orderkey FROM orders WHERE o_orderkey BETWEEN 100 AND 899")
def key_between(spark, d):
    return verify.chunk(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 100, 899)


@query("SELECT o_orderkey, concat_ws('#', o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END, strftime(greatest(least(DATE '1800-01-01' + CAST(o_orderkey % 250000 AS INTEGER), DATE '2299-12-31'), DATE '1900-01-01'), '%Y-%m-%d'), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), lower(hex(encode(o_orderstatus))), to_base64(encode(o_orderstatus)), CAST(o_totalprice AS DECIMAL(18,2))) AS line FROM orders")
def canonical_types(spark, d):
    """The text that is hashed, by type; bytes both ways."""
    o = table(spark, d, "orders")
    rows = o.select("o_orderkey", (F.col("o_orderkey") % 2 == 0).alias("even"), F.date_add(F.lit("1800-01-01").cast("date"), (F.col("o_orderkey") % 250000).cast("int")).alias("day"), F.date_trunc("SECOND", F.col("o_orderdate")).cast("timestamp_ntz").alias("at"), F.col("o_orderstatus").cast("binary").alias("b"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    text = lambda name, **how: verify.canonical(rows.schema[name], **how)
    return rows.select("o_orderkey", F.concat_ws("#", text("o_orderkey"), text("even"), text("day"), text("at"), text("b"), text("b", base64=True), text("price")).alias("line"))


@query("SELECT n_nationkey || '#' || n_name || '#00' AS line FROM nation ORDER BY n_nationkey LIMIT 7")
def debug_dump(spark, d):
    """The first rows of a dump, without a column that is left out."""
    return verify.ordered_dump(table(spark, d, "nation"), ["n_nationkey"], exclude=("n_regionkey",), limit=7)


@query("SELECT n_nationkey, CASE WHEN n_nationkey = 12 THEN 'UTC' WHEN n_nationkey = 24 THEN 'Asia/Calcutta' WHEN n_nationkey < 12 THEN 'Etc/GMT+' || (12 - n_nationkey) ELSE 'Etc/GMT-' || (n_nationkey - 12) END AS zone FROM nation")
def zone_names(spark, d):
    """A zone for an offset of each nation: hours about 0, and one of half an hour."""
    n = F.col("n_nationkey") - 12
    offset = F.when(n == 12, "+05:30").otherwise(F.concat(F.when(n < 0, "-").otherwise("+"), F.lpad(F.abs(n).cast("string"), 2, "0"), F.lit(":00")))
    return table(spark, d, "nation").select("n_nationkey", F.udf(values.zone_of_offset, "string", useArrow=False)(offset).alias("zone"))



@query("SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'replacing' WHEN 1 THEN 'collapsing' ELSE 'append' END AS kind, CASE n_nationkey % 3 WHEN 0 THEN 'v' || n_nationkey WHEN 1 THEN 'sign' || n_nationkey END AS version, CASE WHEN n_nationkey % 3 = 0 THEN 'is_deleted' END AS deleted FROM nation")
def engine_texts(spark, d):
    """What texts of engines say, with names that differ by nation."""
    key = F.col("n_nationkey").cast("string")
    replacing = F.concat(F.lit("ReplicatedReplacingMergeTree('/x/{shard}', '{r}', v"), key, F.lit(", is_deleted)"))
    text = F.when(key % 3 == 0, replacing).when(key % 3 == 1, F.concat(F.lit("CollapsingMergeTree(sign"), key, F.lit(") ORDER BY a"))).otherwise(F.lit("MergeTree"))
    parts = F.udf(values.parse_engine, "kind string, version string, deleted string", useArrow=False)(text)
    return table(spark, d, "nation").select("n_nationkey", parts.alias("p")).select("n_nationkey", "p.*")



@query("SELECT s_suppkey AS id, s_name AS label, lower(hex(encode(s_name))) AS raw, CAST(s_acctbal AS DECIMAL(12,2)) AS bal, s_suppkey % 2 = 0 AS flag FROM supplier UNION ALL SELECT -s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE chr(1) || 'say \"' || s_name || '\", ok' END, NULL, NULL, NULL FROM supplier")
def bulk_folder_load(spark, d):
    """A folder of gzipped dumps, tab-separated and quoted, with their schema files; bytes in base64, bits, byte 1 in texts."""
    home = folder(spark, "dump")
    files, s = Files(spark), table(spark, d, "supplier")
    for name in ("a", "b"):
        files.write(f"{home}/shop.{name}-schema.sql", f"/* dump */;\nCREATE TABLE `{name}` (`id` int NOT NULL, `label` varchar(60), `raw` blob, `bal` decimal(12,2), `flag` bit(1), PRIMARY KEY (`id`));\n")
    flag = F.when(F.col("s_suppkey") % 2 == 0, F.lit("\u0001")).otherwise(F.lit("\u0000"))
    tsv = F.concat_ws("\t", F.col("s_suppkey"), "s_name", F.base64(F.col("s_name").cast("binary")), F.col("s_acctbal").cast("decimal(12,2)").cast("string"), F.replace(flag, F.lit("\0"), F.lit("\\0")))
    quoted = F.when(F.col("s_suppkey") % 3 == 0, F.lit("\\N")).otherwise(F.concat(F.lit('"\u0001say \\"'), "s_name", F.lit('\\", ok"')))
    dat = F.concat_ws(",", F.concat(F.lit('"-'), F.col("s_suppkey"), F.lit('"')), quoted, F.lit("\\N"), F.lit("\\N"), F.lit("\\N"))
    for name, lines, ending in (("a", tsv, "tsv.gz"), ("b", dat, "dat.gz")):
        s.coalesce(1).select(lines.alias("value")).write.option("compression", "gzip").text(f"{home}/{name}.out")
        part = next(n for n in files.names(f"{home}/{name}.out") if n.startswith("part-"))
        files.rename(f"{home}/{name}.out/{part}", f"{home}/shop.{name}.00000.{ending}")
    w = Warehouse(spark, folder(spark, "warehouse"))
    dumps.load_folder(w, home)
    return state_of(w, "a").unionByName(state_of(w, "b"))
