"""Change logs as batches or streams, and a made-up log for queries and tests."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.temporal import epoch_micros
from ..operators.envelope import envelope_schema, from_json_log

KEY = "user_id long"
ROW = "user_id long, event_type string"
TOPIC = "srv.shop.user_state"


def read_log(spark: SparkSession, path: str, key: str, row: str) -> DataFrame:
    """Envelopes from JSON lines."""
    return from_json_log(spark.read.text(path), key, row)


def stream_log(spark: SparkSession, path: str, key: str, row: str, files_a_batch: int | None = None) -> DataFrame:
    """Envelopes from a folder that JSON-lines files arrive in."""
    reader = spark.readStream if files_a_batch is None else spark.readStream.option("maxFilesPerTrigger", files_a_batch)
    return from_json_log(reader.text(path), key, row)


def stream_topic(spark: SparkSession, servers: str, pattern: str, key: str, row: str, records_a_batch: int, start: str = "earliest") -> DataFrame:
    """Envelopes from message-queue topics; needs Spark's Kafka package on the class path. start: latest skips the snapshot."""
    raw = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribePattern", pattern)
        .option("maxOffsetsPerTrigger", records_a_batch).option("startingOffsets", start).load()
    )
    schema = envelope_schema(key, row)
    body = F.from_json(F.col("value").cast("string"), schema["value"].dataType)
    ddl = F.get_json_object(F.col("value").cast("string"), "$.ddl")
    return raw.select("topic", "partition", "offset", F.unix_millis("timestamp").alias("timestamp_ms"), F.from_json(F.col("key").cast("string"), schema["key"].dataType).alias("key"), body.alias("value"), ddl.alias("ddl"))


def snapshot_events(rows: DataFrame, topic: str, key: list[str], db: str, table: str, ts_ms: int) -> DataFrame:
    """The rows of a table as snapshot reads, to be put ahead of a stream of changes."""
    schema = envelope_schema(", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in key), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields))
    body = schema["value"].dataType
    source = F.struct(*[{"ts_ms": F.lit(ts_ms).cast("long"), "snapshot": F.lit("true"), "db": F.lit(db), "table": F.lit(table)}.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in body["source"].dataType.fields])
    image = F.struct(*rows.columns)
    value = F.struct(F.lit(None).cast(body["before"].dataType).alias("before"), image.alias("after"), source.alias("source"), F.lit("r").alias("op"), F.lit(ts_ms).cast("long").alias("ts_ms"))
    return rows.select(F.lit(topic).alias("topic"), F.lit(0).alias("partition"), F.lit(-1).cast("long").alias("offset"), F.lit(ts_ms).cast("long").alias("timestamp_ms"), F.struct(*key).alias("key"), value.alias("value"), F.lit(None).cast("string").alias("ddl"))


def backfill(rows: DataFrame, signal: str, **names) -> DataFrame:
    """An incremental snapshot: rows that the signal's condition chooses, as snapshot events."""
    return snapshot_events(rows.where(signal), **names)


def signalled(data: str) -> list[tuple[str, str | None]]:
    """(database.table, condition) of the data of a signal that asks for an incremental snapshot, a JSON text."""
    asked = json.loads(data)
    conditions = {c["data-collection"]: c["filter"] for c in asked.get("additional-conditions", [])}
    common = asked.get("additional-condition")
    return [(name, conditions.get(name, common)) for name in asked.get("data-collections", [])]


def incremental_snapshot(signals: DataFrame, tables: dict[str, DataFrame], keys: dict[str, list[str]], prefix: str, ts_ms: int) -> list[DataFrame]:
    """Snapshot events of the tables (database.table) that rows of the signal table ask for, in the order of the signals.

    signals: (id, type, data); types other than execute-snapshot are passed over, tables that aren't known too.
    The events have the time of the signal: a change that came later wins over them.
    """
    out = []
    for r in signals.where("type = 'execute-snapshot'").orderBy("id").select("data").toLocalIterator():
        for name, condition in signalled(r["data"]):
            if name in tables:
                db, _, table = name.rpartition(".")
                out.append(backfill(tables[name], condition or "true", topic=f"{prefix}.{name}", key=keys[name], db=db, table=table, ts_ms=ts_ms))
    return out


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A valid change log over the table events: each user's state is the type of the last event; an error deletes it.

    A delete of an absent user is no change. Every fiftieth create is a snapshot read.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", "ts")
    w = Window.partitionBy("user_id").orderBy("event_id")
    before = F.lag("event_type").over(w)
    e = events.withColumn("previous", before).withColumn("live", F.coalesce(F.col("previous") != "error", F.lit(False)))
    op = F.when(F.col("event_type") == "error", F.when(F.col("live"), "d")).when(F.col("live"), "u").when(F.col("event_id") % 50 == 0, "r").otherwise("c")
    e = e.withColumn("op", op).where("op IS NOT NULL")
    millis = (epoch_micros(F.col("ts").cast("timestamp_ntz")) - F.pmod(epoch_micros(F.col("ts").cast("timestamp_ntz")), F.lit(1000)))
    millis = (millis / 1000).cast("long")
    body = envelope_schema(KEY, ROW)["value"].dataType
    image = lambda kind: F.struct("user_id", F.col(kind).alias("event_type"))
    source = {"ts_ms": millis, "snapshot": F.when(F.col("op") == "r", "true").otherwise("false"), "db": F.lit("shop"), "table": F.lit("user_state"), "server_id": F.lit(1).cast("long"), "file": F.concat(F.lit("log."), F.lpad((F.floor(F.col("event_id") / 4096)).cast("string"), 6, "0")), "pos": F.col("event_id"), "row": F.lit(0), "thread": F.lit(7).cast("long"), "gtid": F.concat(F.lit("3e11fa47:"), (F.col("event_id") + 1).cast("string"))}
    fields = [source.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in body["source"].dataType.fields]
    value = F.struct(F.when(F.col("live"), image("previous")).alias("before"), F.when(F.col("op") != "d", image("event_type")).alias("after"), F.struct(*fields).alias("source"), F.col("op"), (millis + 5).alias("ts_ms"))
    return e.select(F.lit(TOPIC).alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), (millis + 9).alias("timestamp_ms"), F.struct("user_id").alias("key"), value.alias("value"), F.lit(None).cast("string").alias("ddl"))


def nullable(schema: T.StructType) -> T.StructType:
    """The schema with every field nullable."""
    return T.StructType([T.StructField(f.name, nullable(f.dataType) if isinstance(f.dataType, T.StructType) else f.dataType, True) for f in schema.fields])
