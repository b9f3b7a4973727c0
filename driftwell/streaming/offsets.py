"""Positions of a replication: patches of stored offsets, a state table, the status view."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.metrics import max_offsets
from ..operators.state import latest

STATE = "id string, offset_key string, offset_val string, record_insert_ts timestamp, record_insert_seq long, _version long"


def lsn_number(lsn: Column) -> Column:
    """'X/HEX' as the number after the slash; a plain number as itself; null for anything else."""
    after = F.element_at(F.split(lsn, "/"), 2)
    return F.when(F.contains(lsn, F.lit("/")), F.when(after.rlike("^[0-9A-Fa-f]{1,15}$"), F.conv(after, 16, 10).cast("long"))).otherwise(lsn.try_cast("long"))


def parse_lsn(lsn: str) -> int:
    return int(lsn.split("/")[1], 16) if "/" in lsn else int(lsn)


def patch_binlog(record: str | None, file: str | None = None, pos: str | None = None, gtids: str | None = None, now_s: int = 0) -> str:
    """A stored log offset with what is given put in; without a record, a new one of now."""
    out = json.loads(record) if record else {"ts_sec": now_s, "transaction_id": None}
    out |= {k: v for k, v in (("file", file), ("pos", pos), ("gtids", gtids)) if v}
    return json.dumps(out)


def patch_lsn(record: str | None, lsn: str) -> str:
    """A stored log sequence number, and the processed one, replaced."""
    n = parse_lsn(lsn)
    return json.dumps((json.loads(record) if record else {}) | {"lsn_proc": n, "lsn": n})


def patched(record: Column, file: Column, pos: Column) -> Column:
    """file and pos put into a column of stored log offsets."""
    kind = "struct<transaction_id: string, ts_sec: long, file: string, pos: long, gtids: string, row: int, server_id: long, event: int>"
    old = F.from_json(record, kind)
    return F.to_json(old.withField("file", F.coalesce(file, old["file"])).withField("pos", F.coalesce(pos, old["pos"])))


class OffsetStore:
    """One row a key, the last written one; kept as an append-only table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        from ..plans.store import Files

        if not Files(self.spark).exists(self.path):
            return self.spark.createDataFrame([], STATE)
        found = latest(self.spark.read.schema(STATE).parquet(self.path), ["offset_key"], ["_version", "record_insert_seq"])
        return found.where("offset_val IS NOT NULL").orderBy("record_insert_ts", "record_insert_seq")

    def get(self, key: str) -> str | None:
        row = self.rows().where(F.col("offset_key") == key).select("offset_val").first()
        return row and row[0]

    def put(self, key: str, value: str | None, version: int) -> None:
        """value None: the key is deleted."""
        self.put_all(self.spark.range(1).select(F.lit(key).alias("offset_key"), F.lit(value).cast("string").alias("offset_val"), F.lit(version).alias("version")))

    def put_all(self, rows: DataFrame) -> None:
        """Many at once: (offset_key, offset_val, version)."""
        version = F.col("version").cast("long")
        rows.select(F.expr("uuid()").alias("id"), "offset_key", "offset_val", F.current_timestamp().alias("record_insert_ts"), version.alias("record_insert_seq"), version.alias("_version")).write.mode("append").parquet(self.path)

    def delete(self, key: str, version: int) -> None:
        self.put(key, None, version)

    def last_insert(self) -> DataFrame:
        return self.rows().agg(F.max("record_insert_ts").alias("last"))


def status(states: DataFrame, now_s: Column) -> DataFrame:
    """Seconds behind the source of each stored offset, from its ts_sec, with its times in UTC."""
    ts = F.get_json_object("offset_val", "$.ts_sec").cast("long")
    from ..functions.temporal import seconds_text

    return states.select("offset_key", (now_s - ts).alias("seconds_behind_source"), seconds_text(ts).alias("utc_time"), F.get_json_object("offset_val", "$.file").alias("file"), F.get_json_object("offset_val", "$.pos").cast("long").alias("pos"))


class TopicOffsets:
    """The greatest offset applied of each topic and partition; each batch adds its own, the greatest counts."""

    KIND = "topic string, partition int, max_offset long"
    MOST = 100

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def put(self, events: DataFrame, batch: int) -> None:
        """Of more than MOST batches the greatest offsets are written as one, and the batches deleted."""
        from ..plans.store import Files

        max_offsets(events).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        files = Files(self.spark)
        if len(older := [n for n in files.names(self.path) if n.startswith("batch=")]) > self.MOST:
            self.rows().coalesce(1).write.parquet(f"{self.path}/batch=up-to-{batch}-{uuid.uuid4().hex}")
            for n in older:
                files.delete(f"{self.path}/{n}")

    def rows(self) -> DataFrame:
        from ..plans.store import Files

        found = [f"{self.path}/{n}" for n in Files(self.spark).names(self.path) if n.startswith("batch=")]
        return max_offsets(self.spark.read.schema(self.KIND).parquet(*found).withColumnRenamed("max_offset", "offset")) if found else self.spark.createDataFrame([], self.KIND)


class SchemaHistory:
    """Schema changes as they were applied, in order; append-only text lines of JSON."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def append(self, seq: int, database: str, ddl: str) -> None:
        line = json.dumps({"history_data_seq": seq, "database": database, "ddl": ddl})
        self.spark.range(1).select(F.lit(line).alias("value")).write.mode("append").text(self.path)

    def rows(self) -> DataFrame:
        from ..plans.store import Files

        kind = "history_data_seq long, database string, ddl string"
        if not Files(self.spark).exists(self.path):
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).json(self.path).distinct().orderBy("history_data_seq")

    def delete(self) -> None:
        from ..plans.store import Files

        Files(self.spark).delete(self.path)
