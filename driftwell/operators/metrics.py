"""Figures of batches and topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lag_ms(now_ms: Column, ts_ms: Column) -> Column:
    """Now less the event's time; 0 where that is not known."""
    return F.when(F.coalesce(ts_ms, F.lit(0)) > 0, now_ms - ts_ms).otherwise(F.lit(0))


def topic_lag(records: DataFrame, now_ms: Column) -> DataFrame:
    """Per topic: greatest lags against the source's and the capture's time, greatest transaction and position, last file, last offset and its partition."""
    return records.groupBy("topic").agg(
        F.max(lag_ms(now_ms, F.col("ts_ms"))).alias("source_lag_ms"), F.max(lag_ms(now_ms, F.col("cdc_ts_ms"))).alias("cdc_lag_ms"),
        F.max("gtid").alias("max_gtid"), F.max("pos").alias("max_pos"), F.max_by("file", F.struct("ts_ms", "offset", "partition")).alias("last_file"),
        F.max("offset").alias("max_offset"), F.max_by("partition", F.struct("offset", "partition")).alias("partition_at_max"),
    )


def max_offsets(records: DataFrame) -> DataFrame:
    """Greatest offset of each topic and partition."""
    return records.groupBy("topic", "partition").agg(F.max("offset").alias("max_offset"))


def batch_bounds(records: DataFrame, batch: Column, ts_ms: str = "cdc_ts_ms") -> DataFrame:
    """Least and greatest event time of each batch."""
    return records.groupBy(batch.alias("batch")).agg(F.min(ts_ms).alias("min_ts"), F.max(ts_ms).alias("max_ts"), F.count("*").alias("records"))


def topic_counts(events: DataFrame) -> DataFrame:
    """Per topic: row changes, records that can't be read, schema changes."""
    from .envelope import operation

    good = F.col("value").isNotNull() & operation(F.col("value.op")).isNotNull()
    n = lambda c: F.sum(c.cast("long"))
    return events.groupBy("topic").agg(n(good & F.col("ddl").isNull()).alias("records"), n(F.col("value").isNotNull() & ~good).alias("errors"), n(F.col("ddl").isNotNull()).alias("ddl"))


def insert_log(parts: DataFrame, seconds: int = 60) -> DataFrame:
    """Inserted blocks by time bucket: count, rounded average and sum of rows. parts: (ts_s, rows)."""
    bucket = (F.col("ts_s") - F.pmod("ts_s", F.lit(seconds))).alias("bucket")
    return parts.groupBy(bucket).agg(F.count("*").alias("blocks"), F.round(F.avg("rows")).cast("long").alias("avg_rows"), F.sum("rows").alias("rows"))


def figures(now_ms: Column, names: dict[str, Column] | None = None) -> list[Column]:
    """Aggregates of a topic partition that Metrics.take() reads; names: where a record's fields are, if not at the top."""
    at = lambda c: (names or {}).get(c, F.col(c))
    place = F.struct(at("ts_ms").alias("ts_ms"), at("offset").alias("offset"))
    return [
        F.max(lag_ms(now_ms, at("ts_ms"))).alias("source_lag_ms"), F.max(lag_ms(now_ms, at("cdc_ts_ms"))).alias("cdc_lag_ms"), F.max(at("gtid")).alias("max_gtid"), F.max(at("pos")).alias("max_pos"),
        F.max_by(at("file"), place).alias("last_file"), F.max(place).alias("at"), F.max(at("offset")).alias("max_offset"),
    ]


def overlapping(in_flight: list[tuple[int, int]], batch: tuple[int, int]) -> bool:
    """Whether an unfinished batch holds events older than this one's first: then its position can't be committed yet."""
    return any(lo < batch[0] for lo, _ in in_flight)
