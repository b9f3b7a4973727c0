"""The catalogue: a query for each operator, and the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import temporal, values
from .operators import align, dedup, envelope, metrics, state, verify, versions
from .plans import routing
from .plans import types as wire
from .plans.ddl import parse
from .plans.scratch import folder
from .plans.settings import Settings
from .plans.tables import Warehouse
from .sources import dumps
from .sources.change_log import KEY, ROW, TOPIC, events_log, read_log, snapshot_events, stream_log
from .streaming.apply import Applier, start
from .streaming.offsets import lsn_number, patched, status

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The change log over `events` that events_log() makes, as common table expressions.
LOG = """WITH e AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM events),
f AS (SELECT *, coalesce(previous <> 'error', false) AS live FROM e),
g AS (SELECT event_id, user_id, event_type, previous, live, epoch_us(ts) // 1000 AS ms,
 CASE WHEN event_type = 'error' THEN CASE WHEN live THEN 'd' END WHEN live THEN 'u' WHEN event_id % 50 = 0 THEN 'r' ELSE 'c' END AS op FROM f),
cl AS (SELECT * FROM g WHERE op IS NOT NULL)
"""
NOW_MS = 1_800_000_000_000


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def records(spark: SparkSession, d: str) -> DataFrame:
    return envelope.decode(events_log(spark, d))


def versioned(spark: SparkSession, d: str, **options) -> DataFrame:
    r = records(spark, d)
    number = versions.version(F.col("ts_ms"), F.col("gtid"), versions.time_version(F.col("ts_ms")))
    return state.replacing_rows(r, number, F.col("offset"), **options).select("key.user_id", "row.event_type", "operation", state.VERSION, state.SEQ, state.SIGN if options.get("signed") else state.DELETED)


def micros(column: str = "ts"):
    return temporal.epoch_micros(F.col(column).cast("timestamp_ntz"))


# envelope and routing


@query(LOG + "SELECT event_id, CASE op WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' ELSE 'CREATE' END AS operation FROM cl")
def decode_ops(spark, d):
    return records(spark, d).select(F.col("offset").alias("event_id"), "operation")


@query(LOG + "SELECT event_id, user_id, CASE WHEN live THEN previous END AS before_type, CASE WHEN op <> 'd' THEN event_type END AS after_type, CASE WHEN op = 'd' THEN previous ELSE event_type END AS row_type FROM cl")
def section_select(spark, d):
    return records(spark, d).select(F.col("offset").alias("event_id"), "key.user_id", F.col("before.event_type").alias("before_type"), F.col("after.event_type").alias("after_type"), F.col("row.event_type").alias("row_type"))


@query(LOG + "SELECT CASE op WHEN 'u' THEN 'BOTH' WHEN 'd' THEN 'BEFORE' ELSE 'AFTER' END AS state, count(*) AS n FROM cl GROUP BY 1")
def cdc_state(spark, d):
    return records(spark, d).groupBy("state").agg(F.count("*").alias("n"))


@query(LOG + "SELECT event_id, ms AS ts_ms, ms + 5 AS cdc_ts_ms, CASE WHEN op = 'r' THEN 'true' ELSE 'false' END AS snapshot, 'shop' AS db, 'log.' || lpad(CAST(event_id // 4096 AS VARCHAR), 6, '0') AS file, event_id AS pos, event_id + 1 AS gtid FROM cl")
def source_metadata(spark, d):
    return records(spark, d).select(F.col("offset").alias("event_id"), "ts_ms", "cdc_ts_ms", "snapshot", "db", "file", "pos", "gtid")


@query("SELECT n_nationkey AS id, CASE n_nationkey % 3 WHEN 0 THEN n_name WHEN 1 THEN NULL ELSE 'people' END AS target FROM nation")
def topic_to_table(spark, d):
    topic = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("srv.shop."), F.col("n_name"))).when(F.col("n_nationkey") % 3 == 1, F.lit("srv.short")).otherwise(F.lit("srv.shop.users"))
    names = routing.parse_map("srv.shop.users:people, srv.shop.none:other")
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), routing.table_of_topic(topic, names).alias("target"))


@query("SELECT r_regionkey AS id, CASE r_name WHEN 'AFRICA' THEN 'af_1' WHEN 'ASIA' THEN 'as_2' ELSE r_name END AS db FROM region")
def database_override(spark, d):
    names = routing.parse_map("AFRICA:af_1,ASIA:as_2", check_values=True)
    return table(spark, d, "region").select(F.col("r_regionkey").alias("id"), routing.database_of(F.col("r_name"), names).alias("db"))


@query(LOG + "SELECT count(*) AS n, (SELECT count(*) FROM cl WHERE op = 'd') AS tombstones FROM cl")
def tombstone_filter(spark, d):
    log = events_log(spark, d)
    tombs = log.where("value.op = 'd'").withColumn("value", F.lit(None).cast(log.schema["value"].dataType))
    both = log.unionByName(tombs)
    every = both.agg(F.count("*").alias("all_events"))
    return envelope.changes(both).agg(F.count("*").alias("n")).join(F.broadcast(every)).select("n", (F.col("all_events") - F.col("n")).alias("tombstones"))


@query("SELECT p_partkey, p_brand FROM part WHERE regexp_full_match(p_brand, 'Brand#[1-3]|.*[05]') AND NOT regexp_full_match(p_brand, '.*3')")
def include_regex(spark, d):
    return table(spark, d, "part").where(routing.included(F.col("p_brand"), ["Brand#[1-3]", ".*[05]"], [".*3"])).select("p_partkey", "p_brand")


@query(LOG + "SELECT event_id, CASE WHEN op = 'd' THEN '' ELSE 'user_id,event_type' END AS fields FROM cl")
def present_fields(spark, d):
    names = F.array_join(envelope.present_fields(F.col("after"), ["user_id", "event_type"]), ",")
    return records(spark, d).select(F.col("offset").alias("event_id"), F.coalesce(names, F.lit("")).alias("fields"))


# converters

WIDE = "(event_id % 9 - 3) * epoch_us(ts)"
TEXT = "strftime(make_timestamp(CAST({} AS BIGINT)), '%Y-%m-%d %H:%M:%S')"


def spread_micros():
    return ((F.col("event_id") % 9) - 3) * micros()


@query("SELECT event_id, strftime(ts, '%H:%M:%S.%f') AS t FROM events")
def micro_time(spark, d):
    return table(spark, d, "events").select("event_id", temporal.micro_time(micros()).alias("t"))


@query(f"SELECT event_id, CASE WHEN v > 10413791999999999 THEN '2299-12-31 23:59:59.99999999' WHEN v < -2208988800000000 THEN '1900-01-01 00:00:00.00000000' ELSE strftime(make_timestamp(v), '%Y-%m-%d %H:%M:%S.%f') || '00' END AS t FROM (SELECT event_id, {WIDE} AS v FROM events)")
def micro_timestamp(spark, d):
    return table(spark, d, "events").select("event_id", temporal.micro_timestamp(spread_micros()).alias("t"))


@query(f"SELECT event_id, CASE WHEN v > 10413791999999 THEN '2299-12-31 23:59:59.999' WHEN v < -2208988800000 THEN '1900-01-01 00:00:00.000' ELSE substr(strftime(make_timestamp(v * 1000), '%Y-%m-%d %H:%M:%S.%f'), 1, 23) END AS t FROM (SELECT event_id, (w - (w % 1000 + 1000) % 1000) // 1000 AS v FROM (SELECT event_id, {WIDE} AS w FROM events))")
def timestamp_ms(spark, d):
    millis = F.expr("(v - pmod(v, 1000)) div 1000")
    return table(spark, d, "events").select("event_id", spread_micros().alias("v")).select("event_id", temporal.milli_timestamp(millis).alias("t"))


@query(f"SELECT event_id, {TEXT.format('greatest(least(v, 4294967295000000), 0) // 1000000 * 1000000')} AS t FROM (SELECT event_id, {WIDE} AS v FROM events)")
def datetime32_clamp(spark, d):
    return table(spark, d, "events").select("event_id", temporal.micro_timestamp(spread_micros(), wide=False).alias("t"))


@query(f"SELECT event_id, {TEXT.format('greatest(least(v, 10413791999), -2208988800) * 1000000')} AS t FROM (SELECT event_id, (event_id % 9 - 3) * (epoch_us(ts) // 1000000) AS v FROM events)")
def datetime64_clamp(spark, d):
    seconds = (F.col("event_id") % 9 - 3) * temporal.whole_seconds(micros())
    return table(spark, d, "events").select("event_id", temporal.seconds_text(temporal.clamped(seconds, temporal.DATETIME64)).alias("t"))


@query("SELECT event_id, strftime(DATE '1970-01-01' + CAST(greatest(least(v, 120529), -25567) AS INTEGER), '%Y-%m-%d') AS wide, strftime(DATE '1970-01-01' + CAST(greatest(least(v, 65535), 0) AS INTEGER), '%Y-%m-%d') AS narrow FROM (SELECT event_id, event_id * 37 - 60000 AS v FROM events)")
def date_clamp(spark, d):
    days = F.col("event_id") * 37 - 60000
    return table(spark, d, "events").select("event_id", temporal.date32(days).cast("string").alias("wide"), temporal.date16(days).cast("string").alias("narrow"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.000000') WHEN 2 THEN strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S.%f') ELSE '2299-12-31 23:59:59.000000' END AS t FROM events")
def zoned_timestamp(spark, d):
    text = temporal.seconds_text(temporal.whole_seconds(micros()))
    whole = F.translate(text, " ", "T")
    exact = F.concat(whole, F.lit("."), temporal.fraction(micros()))
    iso = F.when(F.col("event_id") % 4 == 0, F.lit("not a time")).when(F.col("event_id") % 4 == 1, F.concat(whole, F.lit("Z"))).when(F.col("event_id") % 4 == 2, F.concat(exact, F.lit("+02:00"))).otherwise(F.lit("2338-01-19T03:14:07Z"))
    return table(spark, d, "events").select("event_id", temporal.zoned_timestamp(iso).alias("t"))


@query("SELECT o_orderkey, o_custkey, rtrim(rtrim(CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS VARCHAR), '0'), '.') AS t FROM orders")
def trim_zeros(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", temporal.strip_zeros(F.col("o_totalprice").cast("decimal(18,4)").cast("string")).alias("t"))


@query("SELECT c_custkey, lower(hex(encode(c_name))) AS h FROM customer")
def bytes_hex(spark, d):
    return table(spark, d, "customer").select("c_custkey", values.bytes_hex(F.col("c_name").cast("binary")).alias("h"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract_props(spark, d):
    return table(spark, d, "events").select("event_id", values.json_field(F.col("props"), "$.k").try_cast("bigint").alias("k"))


@query("""SELECT r_regionkey, '{"r_regionkey":' || r_regionkey || CASE WHEN r_regionkey % 2 = 0 THEN ',"r_name":"' || r_name || '"' ELSE '' END || '}' AS doc FROM region""")
def raw_json(spark, d):
    r = table(spark, d, "region").withColumn("r_name", F.when(F.col("r_regionkey") % 2 == 0, F.col("r_name")))
    return r.select("r_regionkey", values.raw_json("r_regionkey", "r_name").alias("doc"))


@query(LOG + """SELECT event_id AS "_offset", '{"user_id":' || user_id || '}' AS "_key", 'srv.shop.user_state' AS "_topic", ms + 9 AS "_timestamp_ms", strftime(make_timestamp(((ms + 9) // 1000) * 1000000), '%Y-%m-%d %H:%M:%S') AS "_timestamp", event_id + 1 AS "_gtid", event_id AS "_binlog_pos" FROM cl""")
def kafka_metadata(spark, d):
    return envelope.with_metadata(records(spark, d)).select("_offset", "_key", "_topic", "_timestamp_ms", "_timestamp", "_gtid", "_binlog_pos")


@query("SELECT c_custkey, CAST((c_custkey * 7001 - 5000000) / 1000.0 AS DECIMAL(18,3)) AS v FROM customer")
def variable_decimal(spark, d):
    raw = F.unhex(F.lpad(F.hex(F.col("c_custkey") * 7001 - 5000000), 16, "0"))
    return table(spark, d, "customer").select("c_custkey", values.variable_decimal(raw, F.lit(3)).cast("decimal(18,3)").alias("v"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 0.0 ELSE CAST(s_suppkey AS DOUBLE) END AS x, CASE WHEN s_suppkey % 3 = 0 THEN 0.0 ELSE s_acctbal END AS y FROM supplier")
def point_struct(spark, d):
    p = F.when(F.col("s_suppkey") % 3 != 0, F.struct(F.col("s_suppkey").alias("x"), F.col("s_acctbal").alias("y")))
    return table(spark, d, "supplier").select("s_suppkey", values.point(p).alias("p")).select("s_suppkey", "p.x", "p.y")


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN 0 ELSE 1 END AS rings, CASE WHEN n_nationkey % 5 = 0 THEN 0.0 ELSE CAST(4 * n_nationkey AS DOUBLE) END AS total FROM nation")
def polygon_wkb(spark, d):
    """Squares as WKB: little-endian doubles made by hand; every fifth isn't a polygon."""
    little = {0: "0000000000000000", **{i: f"{__import__('struct').pack('<d', float(i)).hex()}" for i in range(1, 30)}}
    side = F.get(F.array(*[F.lit(little[i]) for i in range(30)]), F.col("n_nationkey"))
    zero = F.lit(little[0])
    kind = F.when(F.col("n_nationkey") % 5 == 0, F.lit("01000000")).otherwise(F.lit("03000000"))
    corners = [zero, zero, side, zero, side, side, zero, side, zero, zero]
    wkb = F.unhex(F.concat(F.lit("01"), kind, F.lit("0100000005000000"), *corners))
    rings = table(spark, d, "nation").select("n_nationkey", values.polygon(wkb).alias("rings"))
    total = F.expr("aggregate(flatten(rings), 0D, (s, p) -> s + p.x + p.y)")
    return rings.select("n_nationkey", F.size("rings").alias("rings"), total.alias("total"))


@query("SELECT vec_id, len(embedding) AS n, CAST(round(CAST(embedding[1] AS DOUBLE) * 1000) AS BIGINT) AS head FROM embeddings")
def arrays(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.size("embedding").cast("long").alias("n"), F.round(F.get("embedding", F.lit(0)).cast("double") * 1000).cast("long").alias("head"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, '{\"k\":' || json_extract_string(props, '$.k') || '}' AS inner_doc FROM events")
def mongo_json_after(spark, d):
    after = F.concat(F.lit('{"_id": '), F.col("event_id"), F.lit(', "doc": '), F.col("props"), F.lit("}"))
    doc = table(spark, d, "events").select("event_id", envelope.document_rows(after, "_id long, doc string").alias("r"))
    return doc.select("event_id", values.json_field(F.col("r.doc"), "$.k").try_cast("long").alias("k"), F.regexp_replace("r.doc", " ", "").alias("inner_doc"))


@query("SELECT event_id, strftime(DATE '1970-01-01' + CAST(greatest(least(event_id * 37 - 60000, 120529), -25567) AS INTEGER), '%Y-%m-%d') AS d, strftime(ts, '%H:%M:%S.%f') AS t, CASE WHEN event_id % 4 = 3 THEN NULL ELSE epoch_us(ts) END AS z, CAST(user_id AS INTEGER) AS y, event_type AS u, CAST(round(value * 100) AS DECIMAL(12,2)) AS n, CASE WHEN event_id % 2 = 0 THEN true ELSE false END AS b FROM events")
def wire_types(spark, d):
    """Values as a capture engine sends them, by their logical types."""
    iso = F.concat(F.translate(temporal.seconds_text(temporal.whole_seconds(micros())), " ", "T"), F.lit("."), temporal.fraction(micros()), F.lit("Z"))
    e = table(spark, d, "events").select(
        "event_id", (F.col("event_id") * 37 - 60000).alias("d"), micros().alias("t"), F.when(F.col("event_id") % 4 == 3, "never").otherwise(iso).alias("z"), F.col("user_id").alias("y"),
        F.col("event_type").alias("u"), F.round(F.col("value") * 100).alias("n"), (F.col("event_id") % 2 == 0).cast("string").alias("b"),
    )
    kinds = [("event_id", "INT64", ""), ("d", "INT32", "x.time.Date"), ("t", "INT64", "x.time.MicroTime"), ("z", "STRING", "x.time.ZonedTimestamp"), ("y", "INT32", "x.time.Year"), ("u", "STRING", "x.data.Enum"), ("n", "BYTES", "x.data.Decimal"), ("b", "BOOLEAN", "")]
    got = wire.typed_rows(e, [wire.Wire(n, p, l, precision=12) for n, p, l in kinds])
    return got.withColumns({"d": F.col("d").cast("string"), "z": F.unix_micros("z")})


@query("SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS \"partition\" FROM orders WHERE strftime(o_orderdate, '%Y-%m') LIKE '%-0%'")
def partition_regex(spark, d):
    return dumps.partitions(table(spark, d, "orders"), F.date_format("o_orderdate", "yyyy-MM"), "-0")


@query("SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(38,4)) AS VARCHAR) AS t FROM orders")
def decimal_text(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", values.format_decimal(F.col("o_totalprice"), 4).alias("t"))


@query("SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment || chr(9) || chr(10) || '\\' END AS note FROM customer")
def dump_roundtrip(spark, d):
    """Rows written as a dump and read again."""
    from pyspark.sql import types as T

    note = F.when(F.col("c_custkey") % 5 != 0, F.concat(F.col("c_mktsegment"), F.lit("\t\n\\")))
    path = folder(spark, "dump")
    dumps.write_tsv(table(spark, d, "customer").select("c_custkey", "c_name", note.alias("note")), path)
    read = dumps.read_tsv(spark, path, T.StructType.fromDDL("c_custkey string, c_name string, note string"))
    return read.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


# versions and state

SNOWFLAKE = "(((ms - 1288834974657) & 2199023255551)::BIGINT << 22) | ((event_id + 1) & 4194303)"


@query(LOG + f"SELECT event_id, {SNOWFLAKE} AS version FROM cl")
def snowflake_version(spark, d):
    return records(spark, d).select(F.col("offset").alias("event_id"), versions.snowflake(F.col("ts_ms"), F.col("gtid")).alias("version"))


@query(LOG + f"SELECT event_id, CASE WHEN event_id % 3 = 0 THEN ms * 1000000 WHEN event_id % 3 = 1 THEN event_id + 1 ELSE {SNOWFLAKE} END AS version FROM cl")
def version_choice(spark, d):
    gtid = F.when(F.col("offset") % 3 == 0, F.lit(-1)).otherwise(F.col("gtid"))
    seq = versions.time_version(F.col("ts_ms"))
    number = F.when(F.col("offset") % 3 == 1, versions.version(F.col("ts_ms"), gtid, seq, use_snowflake=False)).otherwise(versions.version(F.col("ts_ms"), gtid, seq))
    return records(spark, d).select(F.col("offset").alias("event_id"), number.alias("version"))


#: The count begins again two seconds or more after the first record since it last did, so it is carried from record to record.
SEQUENCE = LOG.replace("WITH e AS", "WITH RECURSIVE e AS") + """, o AS (SELECT event_id, ms + 5 AS t, row_number() OVER (PARTITION BY {part} ORDER BY event_id) AS i, {part} AS p FROM cl),
s AS (SELECT p, event_id, i, t, t AS start, 1000000001 AS n FROM o WHERE i = 1
 UNION ALL SELECT o.p, o.event_id, o.i, o.t, CASE WHEN o.t - s.start >= 2000 THEN o.t ELSE s.start END, CASE WHEN o.t - s.start >= 2000 THEN 1000000000 ELSE s.n + 1 END FROM s JOIN o ON o.i = s.i + 1 AND o.p = s.p)
SELECT event_id, t * 1000000 + n AS sequence FROM s"""


@query(SEQUENCE.format(part="0"))
def sequence_version(spark, d):
    out = versions.with_sequence(records(spark, d).select("topic", "partition", "offset", "cdc_ts_ms"), ["topic", "partition"], "offset")
    return out.select(F.col("offset").alias("event_id"), "sequence")


FINAL = LOG + "SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM cl) WHERE rn = 1 AND op <> 'd'"


@query(FINAL)
def rmt_final(spark, d):
    return state.final(versioned(spark, d), ["user_id"]).select("user_id", "event_type")


@query(FINAL)
def rmt_final_sign(spark, d):
    return state.live_by_sign(versioned(spark, d, signed=True), ["user_id"]).select("user_id", "event_type")


@query(LOG + "SELECT event_id, user_id FROM cl WHERE op <> 'd'")
def row_policy(spark, d):
    return state.visible(versioned(spark, d, signed=True)).select(F.col(state.SEQ).alias("event_id"), "user_id")


@query(FINAL)
def collapsing_final(spark, d):
    number = versions.time_version(F.col("ts_ms"))
    rows = state.collapsing_rows(records(spark, d), number, F.col("offset")).select("key.user_id", "row.event_type", state.SIGN, state.VERSION, state.SEQ)
    return state.collapse(rows, ["user_id"], [state.VERSION, state.SEQ]).select("user_id", "event_type")


@query(LOG + "SELECT user_id, count(*) AS changes, sum(CASE WHEN op IN ('c', 'r') THEN 1 WHEN op = 'd' THEN -1 ELSE 0 END)::BIGINT AS sign FROM cl GROUP BY user_id")
def collapsing_signs(spark, d):
    r = records(spark, d)
    rows = state.collapsing_rows(r, F.col("offset"), F.col("offset")).select("key.user_id", state.SIGN, state.SEQ, "operation")
    first_part = (F.col("operation") != "UPDATE") | (F.col(state.SIGN) > 0)  # an update gives two rows
    return rows.groupBy("user_id").agg(F.count(F.when(first_part, True)).alias("changes"), F.sum(state.SIGN).alias("sign"))


@query(LOG + "SELECT user_id, event_type, event_id FROM cl WHERE op <> 'd'")
def append_only(spark, d):
    return state.final(versioned(spark, d), []).select("user_id", "event_type", F.col(state.SEQ).alias("event_id"))


@query(LOG + "SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM cl WHERE op <> 'd') WHERE rn = 1")
def ignore_delete(spark, d):
    return state.final(versioned(spark, d, ignore_delete=True), ["user_id"]).select("user_id", "event_type")


@query(LOG + ", cut AS (SELECT max(event_id) AS c FROM cl WHERE event_id % 4000 = 0 AND op <> 'd') SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM cl, cut WHERE event_id > coalesce(c, -1)) WHERE rn = 1 AND op <> 'd'")
def truncate_cut(spark, d):
    rows = versioned(spark, d)
    cut = F.when((F.col(state.SEQ) % 4000 == 0) & (F.col("operation") != "DELETE"), "TRUNCATE").otherwise(F.col("operation"))
    kept = state.truncate_cut(rows.withColumn("operation", cut))
    return state.final(kept, ["user_id"]).select("user_id", "event_type")


@query(LOG + ", r AS (SELECT user_id * 10 AS k, event_id * 2 AS s, CASE WHEN op = 'd' THEN 1 ELSE 0 END AS gone FROM cl UNION ALL SELECT user_id * 10, event_id * 2 + 1, 1 FROM cl WHERE event_type = 'purchase' UNION ALL SELECT user_id * 10 + 1, event_id * 2 + 1, 0 FROM cl WHERE event_type = 'purchase') SELECT k, s FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY s DESC, gone) AS rn FROM r) WHERE rn = 1 AND gone = 0")
def pk_update(spark, d):
    """A purchase changes the user's key: a delete of the old key, then a create of the new one."""
    rows = versioned(spark, d).select((F.col("user_id") * 10).alias("k"), (F.col(state.SEQ) * 2).alias("s"), state.DELETED, "event_type")
    moved = rows.where("event_type = 'purchase' AND is_deleted = 0").withColumn("s", F.col("s") + 1)
    log = rows.unionByName(moved.withColumn(state.DELETED, F.lit(1))).unionByName(moved.withColumn("k", F.col("k") + 1))
    return state.final(log, ["k"], version="s", seq="s").select("k", "s")


@query("SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem) WHERE rn = 1")
def lineitem_final(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey", "l_shipdate", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    return state.latest(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]).drop("l_shipdate")


@query("SELECT event_id, user_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before_type FROM events")
def previous_image(spark, d):
    rows = state.previous_image(table(spark, d, "events"), ["user_id"], ["event_id"], ["event_type"])
    return rows.select("event_id", "user_id", F.col("before.event_type").alias("before_type"))


@query("SELECT event_id, event_id // 2048 AS batch FROM (SELECT event_id, row_number() OVER (PARTITION BY event_id // 2048 ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1")
def last_of_batch(spark, d):
    rows = table(spark, d, "events").select("event_id", F.floor(F.col("event_id") / 2048).alias("batch"))
    return state.last_of_batch(rows, ["batch"], ["event_id"]).where("is_last").drop("is_last")


# alignment


@query("SELECT c_custkey, CAST(NULL AS VARCHAR) AS phone, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer")
def align_missing_extra(spark, d):
    from pyspark.sql import types as T

    target = T.StructType.fromDDL("c_custkey bigint, phone string, c_name string, c_nationkey string")
    return align.align(table(spark, d, "customer"), target)


@query("SELECT n_nationkey, n_name, CAST(NULL AS INTEGER) AS n_regionkey FROM nation WHERE n_nationkey < 10 UNION ALL SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_nationkey >= 10")
def schema_evolution_add(spark, d):
    nation = table(spark, d, "nation")
    old, new = nation.where("n_nationkey < 10").drop("n_regionkey"), nation.where("n_nationkey >= 10")
    target = align.evolved(new.schema, old.schema)
    return align.align(old, target).unionByName(align.align(new, target))


@query("SELECT s_suppkey, s_name, upper(s_name) || '-' || s_suppkey AS label FROM supplier")
def generated_column(spark, d):
    from pyspark.sql import types as T

    return align.align(table(spark, d, "supplier"), T.StructType.fromDDL("s_suppkey bigint, s_name string, label string"), {"label": "concat(upper(s_name), '-', s_suppkey)"})


# verification


def order_rows(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    status_ = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus"))
    return o.select("o_orderkey", "o_custkey", status_.alias("status"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"), F.col("o_orderdate").cast("date").alias("day"))


ROWS = "SELECT o_orderkey, concat_ws('#', o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END, CAST(o_totalprice AS DECIMAL(18,2)), strftime(o_orderdate, '%Y-%m-%d'), '00' || CASE WHEN o_orderkey % 7 = 0 THEN '1' ELSE '0' END || '00') AS line FROM orders"
SUMS = "count(*) AS cnt, " + ", ".join(f"CAST(coalesce(sum(CAST('0x' || substr(md5(line), {1 + 8 * i}, 8) AS BIGINT)), 0) AS BIGINT) AS {n}" for i, n in enumerate("abcd"))
DIGEST = "md5(cnt || '#' || a || '#' || b || '#' || c || '#' || d || '#') AS checksum"


@query(ROWS)
def row_canonical(spark, d):
    rows = order_rows(spark, d)
    return rows.select("o_orderkey", verify.canonical_row(rows.schema).alias("line"))


@query(f"SELECT *, {DIGEST} FROM (SELECT {SUMS} FROM ({ROWS}))")
def table_checksum(spark, d):
    return verify.checksum(order_rows(spark, d))


LINES = "SELECT concat_ws('#', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS DECIMAL(18,2)), CAST(l_extendedprice AS DECIMAL(18,2)), l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d'), '000000000') AS line FROM lineitem"


@query(f"SELECT *, {DIGEST} FROM (SELECT {SUMS} FROM ({LINES}))")
def lineitem_checksum(spark, d):
    money = lambda c: F.col(c).cast("decimal(18,2)").alias(c)
    return verify.checksum(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", money("l_quantity"), money("l_extendedprice"), "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").alias("day")))


@query(f"SELECT *, {DIGEST} FROM (SELECT {SUMS} FROM ({ROWS}))")
def chunked_checksum(spark, d):
    return verify.merged_sums(verify.chunked_sums(order_rows(spark, d), "o_orderkey", 1000))


@query(f"SELECT o_orderkey // 1000 AS chunk, {SUMS} FROM ({ROWS}) GROUP BY 1")
def checksum_chunks(spark, d):
    return verify.chunked_sums(order_rows(spark, d), "o_orderkey", 1000)


@query(f"SELECT *, {DIGEST} FROM (SELECT {SUMS} FROM (SELECT concat_ws('#', user_id, event_type, '00') AS line FROM ({FINAL})))")
def final_checksum(spark, d):
    return verify.checksum(rmt_final(spark, d))


@query("SELECT 'orders' AS \"table\", count(*) AS cnt FROM orders WHERE 1 = 1 UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events")
def table_count(spark, d):
    return verify.counts({n: table(spark, d, n) for n in ("orders", "lineitem", "events")})


@query("SELECT CAST(strftime(l_shipdate, '%Y%m') AS VARCHAR) AS \"partition\", count(*) AS cnt FROM lineitem WHERE l_quantity > 10 GROUP BY 1")
def partition_count(spark, d):
    return verify.partition_counts(table(spark, d, "lineitem"), F.date_format("l_shipdate", "yyyyMM"), "l_quantity > 10")


@query("SELECT min(o_orderkey) AS least, max(o_orderkey) AS most FROM orders")
def min_max_pk(spark, d):
    return table(spark, d, "orders").agg(F.min("o_orderkey").alias("least"), F.max("o_orderkey").alias("most"))


@query("WITH m AS (SELECT min(o_orderkey) AS a, max(o_orderkey) AS b FROM orders) SELECT lo, least(lo + 999, b) AS hi FROM (SELECT unnest(range(a, b + 1, 1000)) AS lo, b FROM m)")
def pk_chunks(spark, d):
    return verify.key_chunks(table(spark, d, "orders"), "o_orderkey", 1000)


@query("SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'missing' ELSE 'changed' END AS status FROM customer WHERE c_custkey % 10 = 0 OR c_custkey % 13 = 0 UNION ALL SELECT -1 - c_custkey, 'extra' FROM customer WHERE c_custkey % 50 = 1")
def table_diff(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    copy = c.where("c_custkey % 10 <> 0").withColumn("c_name", F.when(F.col("c_custkey") % 13 == 0, "?").otherwise(F.col("c_name")))
    extra = c.where("c_custkey % 50 = 1").withColumn("c_custkey", -1 - F.col("c_custkey"))
    return verify.differences(c, copy.unionByName(extra), ["c_custkey"])


@query("SELECT p_partkey, p_name, 'source' AS side FROM part WHERE p_partkey % 11 = 0 UNION ALL SELECT p_partkey, 'x', 'target' FROM part WHERE p_partkey % 11 = 0")
def set_diff(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name")
    return verify.set_differences(p, p.withColumn("p_name", F.when(F.col("p_partkey") % 11 == 0, "x").otherwise(F.col("p_name"))))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE (o_orderstatus, o_custkey) IN (SELECT o_orderstatus, o_custkey FROM orders WHERE o_totalprice > 450000)")
def semi_join_partitions(spark, d):
    o = table(spark, d, "orders")
    return o.join(o.where("o_totalprice > 450000").select("o_orderstatus", "o_custkey"), ["o_orderstatus", "o_custkey"], "left_semi").select("o_orderkey", "o_custkey")


@query("SELECT n_nationkey || '#' || n_name || '#' || n_regionkey || '#000' AS line FROM nation ORDER BY n_nationkey")
def ordered_dump(spark, d):
    return verify.ordered_dump(table(spark, d, "nation"), ["n_nationkey"])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey > 700 ORDER BY o_orderkey LIMIT 1")
def limit_probe(spark, d):
    return table(spark, d, "orders").where("o_orderkey > 700").orderBy("o_orderkey").select("o_orderkey").limit(1)


@query("SELECT DISTINCT o_orderstatus, CAST(strftime(o_orderdate, '%Y') AS INTEGER) AS y FROM orders")
def distinct_partitions(spark, d):
    return table(spark, d, "orders").select("o_orderstatus", F.year("o_orderdate").alias("y")).distinct()


# dedup, offsets, metrics


@query(LOG + "SELECT user_id, min(event_id) AS event_id FROM cl GROUP BY user_id")
def dedup_old(spark, d):
    return dedup.deduplicate(records(spark, d).select("topic", "key", "offset"), "old", ["topic", "key"], ["offset"]).select("key.user_id", F.col("offset").alias("event_id"))


@query(LOG + "SELECT user_id, max(event_id) AS event_id FROM cl GROUP BY user_id")
def dedup_new(spark, d):
    return dedup.deduplicate(records(spark, d).select("topic", "key", "offset"), "new", ["topic", "key"], ["offset"]).select("key.user_id", F.col("offset").alias("event_id"))


@query(LOG + "SELECT 'srv.shop.user_state' AS topic, CAST(event_id % 6 AS INTEGER) AS \"partition\", max(event_id) AS max_offset FROM cl GROUP BY 2")
def max_offset(spark, d):
    return metrics.max_offsets(records(spark, d).withColumn("partition", (F.col("offset") % 6).cast("int")))


@query(LOG + "SELECT event_id // 1000 AS batch, min(ms + 5) AS min_ts, max(ms + 5) AS max_ts, count(*) AS records FROM cl GROUP BY 1")
def batch_min_max(spark, d):
    return metrics.batch_bounds(records(spark, d), F.floor(F.col("offset") / 1000))


@query(LOG + f"SELECT 'srv.shop.user_state' AS topic, {NOW_MS} - min(ms) AS source_lag_ms, {NOW_MS} - min(ms + 5) AS cdc_lag_ms, max(event_id + 1) AS max_gtid, max(event_id) AS max_pos, max(event_id) AS max_offset, 'log.' || lpad(CAST(arg_max(event_id, (ms, event_id)) // 4096 AS VARCHAR), 6, '0') AS last_file, arg_max(CAST(event_id % 6 AS INTEGER), event_id) AS partition_at_max FROM cl")
def lag_by_topic(spark, d):
    r = records(spark, d).withColumn("partition", (F.col("offset") % 6).cast("int"))
    return metrics.topic_lag(r, F.lit(NOW_MS))


@query(LOG + "SELECT 'srv.shop.user_state' AS topic, count(*) AS records, 0::BIGINT AS errors, 0::BIGINT AS ddl FROM cl")
def records_by_topic(spark, d):
    return metrics.topic_counts(events_log(spark, d))


@query("SELECT bucket, count(*) AS blocks, CAST(round(avg(n)) AS BIGINT) AS avg_rows, CAST(sum(n) AS BIGINT) AS \"rows\" FROM (SELECT (epoch_us(ts) // 1000000) // 3600 * 3600 AS bucket, epoch_us(ts) // 1000000 AS s, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1")
def insert_log(spark, d):
    parts = table(spark, d, "events").groupBy(temporal.whole_seconds(micros()).alias("ts_s")).agg(F.count("*").alias("rows"))
    return metrics.insert_log(parts, 3600)


@query("SELECT o_orderkey, 'log.' || (o_orderkey % 7) AS file, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE o_orderkey END AS pos, o_orderkey AS ts_sec FROM orders")
def offset_patch(spark, d):
    record = F.concat(F.lit('{"transaction_id":null,"ts_sec":'), F.col("o_orderkey"), F.lit(',"file":"old","pos":'), F.col("o_orderkey"), F.lit("}"))
    new = patched(record, F.concat(F.lit("log."), F.col("o_orderkey") % 7), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")))
    field = lambda n: values.json_field(new, f"$.{n}")
    return table(spark, d, "orders").select("o_orderkey", field("file").alias("file"), field("pos").cast("long").alias("pos"), field("ts_sec").cast("long").alias("ts_sec"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_custkey * 4097 WHEN 1 THEN c_custkey END AS lsn FROM customer")
def lsn_parse(spark, d):
    text = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("16/"), F.hex(F.col("c_custkey") * 4097))).when(F.col("c_custkey") % 3 == 1, F.col("c_custkey").cast("string")).otherwise(F.lit("none"))
    return table(spark, d, "customer").select("c_custkey", lsn_number(text).alias("lsn"))


@query("SELECT s_name AS offset_key, 1800000000 - (1700000000 + s_suppkey * 1000) AS seconds_behind_source, strftime(make_timestamp((1700000000 + s_suppkey * 1000) * 1000000), '%Y-%m-%d %H:%M:%S') AS utc_time, 'f' AS file, s_suppkey AS pos FROM supplier")
def replica_status(spark, d):
    value = F.concat(F.lit('{"ts_sec":'), F.lit(1_700_000_000) + F.col("s_suppkey") * 1000, F.lit(',"file":"f","pos":'), F.col("s_suppkey"), F.lit("}"))
    return status(table(spark, d, "supplier").select(F.col("s_name").alias("offset_key"), value.alias("offset_val")), F.lit(1_800_000_000).cast("long"))


# streams and bulk loads


def log_files(spark: SparkSession, d: str, files: int = 10) -> str:
    """The change log as JSON-lines files in log order, about equally long. The cuts come from the events, so the log is made once."""
    path, log = folder(spark, "change-log"), events_log(spark, d)
    cuts = table(spark, d, "events").agg(F.percentile_approx("event_id", [n / files for n in range(1, files)])).first()[0] if files > 1 else []
    at = reduce(add, [(F.col("offset") > c).cast("int") for c in sorted(set(cuts or []))], F.lit(0))
    log.repartitionById(files, at).sortWithinPartitions("offset").select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    return path


def streamed(spark: SparkSession, d: str, settings: Settings | None = None, replay: bool = False, files: int = 10) -> DataFrame:
    """The state of user_state after its log has been streamed into a warehouse."""
    home = folder(spark, "warehouse")
    path, warehouse = log_files(spark, d, files), Warehouse(spark, f"{home}/tables")
    applier = Applier(warehouse, settings or Settings(auto_create=True))
    for n in range(2 if replay else 1):  # a new checkpoint reads everything again
        start(stream_log(spark, path, KEY, ROW, 1), applier, f"{home}/checkpoint-{n}", once=True).awaitTermination()
    return warehouse.state(warehouse.load("shop", "user_state")).select("user_id", "event_type")


@query(FINAL)
def stream_apply_final(spark, d):
    return streamed(spark, d)


@query(FINAL)
def stream_replay_idempotent(spark, d):
    return streamed(spark, d, replay=True)


@query(LOG + "SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM cl WHERE op <> 'd') WHERE rn = 1")
def stream_ignore_delete(spark, d):
    return streamed(spark, d, Settings(auto_create=True, ignore_delete=True))


@query(LOG + ", h AS (SELECT max(event_id) // 2 AS m FROM events) SELECT user_id, event_type AS kind, CAST(NULL AS INTEGER) AS score FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM cl, h WHERE event_id > m) WHERE rn = 1 AND op <> 'd'")
def stream_ddl_barrier(spark, d):
    """One batch with data, then a truncate, an added column and a rename in the middle of it, then data."""
    log = events_log(spark, d)
    middle = spark.read.parquet(f"{d}/events.parquet").agg(F.expr("max(event_id) div 2").alias("m")).first()["m"]
    changes = ["TRUNCATE TABLE user_state", "ALTER TABLE user_state ADD COLUMN score INT AFTER user_id", "ALTER TABLE user_state CHANGE COLUMN event_type kind VARCHAR(20) NULL"]
    spaced = log.withColumn("offset", F.col("offset") * 10)
    one = log.limit(1).drop("ddl", "offset")
    ddl = one.withColumn("x", F.explode(F.array(*[F.struct(F.lit(middle * 10 + 1 + i).cast("long").alias("offset"), F.lit(t).alias("ddl")) for i, t in enumerate(changes)]))).select(*[F.col("x.offset").alias("offset") if c == "offset" else F.col("x.ddl").alias("ddl") if c == "ddl" else F.col(c) for c in log.columns])
    ddl = ddl.withColumn("value", F.struct(F.lit(None).cast(log.schema["value"].dataType["before"].dataType).alias("before"), F.lit(None).cast(log.schema["value"].dataType["after"].dataType).alias("after"), F.col("value.source").alias("source"), F.lit(None).cast("string").alias("op"), F.col("value.ts_ms").alias("ts_ms")))
    warehouse = Warehouse(spark, folder(spark, "warehouse"))
    warehouse.execute(parse("CREATE TABLE shop.user_state (user_id BIGINT PRIMARY KEY, event_type VARCHAR(20))"))
    body = log.schema["value"].dataType
    late = spaced.where(F.col("offset") > middle * 10)
    early = spaced.where(F.col("offset") <= middle * 10)
    Applier(warehouse)(early.unionByName(ddl), 0)
    renamed = F.transform(F.array("value"), lambda v: v)[0]
    image = lambda s: F.when(renamed[s].isNotNull(), F.struct(renamed[s]["user_id"].alias("user_id"), renamed[s]["event_type"].alias("kind")))
    new = F.struct(*[image(n).alias(n) if n in ("before", "after") else renamed[n].alias(n) for n in body.names])
    Applier(warehouse)(late.withColumn("value", new), 1)
    return warehouse.state(warehouse.load("shop", "user_state")).select("user_id", "kind", "score")


@query("SELECT user_id, count(*) AS n FROM (SELECT user_id, event_type FROM events GROUP BY user_id, event_type) GROUP BY user_id")
def stream_dedup(spark, d):
    """Every event delivered twice; the stream keeps the first of each user and type."""
    path, out = folder(spark, "twice"), folder(spark, "once")
    e = table(spark, d, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    e.unionByName(e).write.parquet(path)
    kept = dedup.deduplicate_stream(spark.readStream.schema(e.schema).parquet(path), ["user_id", "event_type"], "ts", "3650 days")
    kept.writeStream.format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(e.schema).parquet(f"{out}/data").groupBy("user_id").agg(F.count("*").alias("n"))


DUMP = "CREATE TABLE parts.part (p_partkey BIGINT NOT NULL, p_name VARCHAR(55), p_brand VARCHAR(10), p_size INT, p_retailprice DECIMAL(12,2), PRIMARY KEY (p_partkey))"


@query("SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_name || chr(9) || '\\' END AS p_name, p_brand, p_size, CAST(p_retailprice AS DECIMAL(12,2)) AS p_retailprice FROM part")
def bulk_tsv_load(spark, d):
    """part as a gzipped dump with \\N for null and escaped tabs, loaded through its schema."""
    path = folder(spark, "dump")
    name = F.when(F.col("p_partkey") % 9 == 0, F.lit("\\N")).otherwise(F.concat(F.col("p_name"), F.lit("\\t\\\\")))
    lines = table(spark, d, "part").select(F.concat_ws("\t", F.col("p_partkey"), name, "p_brand", F.col("p_size"), F.col("p_retailprice").cast("decimal(12,2)").cast("string")).alias("value"))
    lines.write.option("compression", "gzip").text(path)
    warehouse, a = Warehouse(spark, folder(spark, "warehouse")), parse(DUMP)[0]
    loaded = dumps.load_dump(warehouse, a, dumps.read_tsv(spark, path, dumps.text_schema(a)))
    return warehouse.state(loaded)


@query(LOG + ", s AS (SELECT c_custkey AS user_id, c_mktsegment AS event_type FROM customer) SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s DESC) AS rn FROM (SELECT user_id, event_type, -1 AS s, 'r' AS op FROM s UNION ALL SELECT user_id, event_type, event_id, op FROM cl)) WHERE rn = 1 AND op <> 'd'")
def snapshot_union_stream(spark, d):
    """A snapshot of customers as read events ahead of the change log."""
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("event_type"))
    log = align.snapshot_and_stream(snapshot_events(rows, TOPIC, ["user_id"], "shop", "user_state", 1), events_log(spark, d))
    r = envelope.decode(log)
    number = versions.time_version(F.col("ts_ms"))
    return state.final(state.replacing_rows(r, number, F.col("offset")).select("key.user_id", "row.event_type", state.VERSION, state.SEQ, state.DELETED), ["user_id"]).select("user_id", "event_type")


@query(LOG + "SELECT op, count(*) AS n FROM cl GROUP BY op")
def json_log_roundtrip(spark, d):
    return read_log(spark, log_files(spark, d), KEY, ROW).groupBy(F.col("value.op").alias("op")).agg(F.count("*").alias("n"))


@query(FINAL)
def compaction(spark, d):
    """The state after the log has been compacted to its live rows."""
    warehouse = Warehouse(spark, folder(spark, "warehouse"))
    Applier(warehouse, Settings(auto_create=True))(events_log(spark, d), 0)
    warehouse.compact("shop", "user_state")
    return warehouse.state(warehouse.load("shop", "user_state")).select("user_id", "event_type")


def entry(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: the current state of every user from a change log."""
    return rmt_final(spark, d)
