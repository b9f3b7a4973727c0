"""Change envelopes: decode, choose the row section, source metadata, filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE = "ts_ms long, snapshot string, db string, table string, server_id long, file string, pos long, row int, thread long, gtid string, lsn long"
#: Letters of the envelope and what they do; r (a snapshot read) counts as a create.
OPERATIONS = {"c": "CREATE", "r": "CREATE", "u": "UPDATE", "d": "DELETE", "t": "TRUNCATE"}
#: Which image of the row an operation carries on; anything else carries the image after.
STATES = {"DELETE": "BEFORE", "UPDATE": "BOTH"}
METADATA = ("_offset", "_key", "_topic", "_partition", "_timestamp", "_timestamp_ms", "_ts_ms", "_server_id", "_gtid", "_binlog_file", "_binlog_pos", "_binlog_row", "_server_thread")
#: The part of a batch that a record is written with, where a batch is cut.
PART = "__part"


def envelope_schema(key: str, row: str) -> T.StructType:
    """Schema of a topic with the given key and row fields (DDL strings)."""
    names = "topic string, partition int, offset long, timestamp_ms long"
    value = f"struct<before: struct<{colons(row)}>, after: struct<{colons(row)}>, source: struct<{colons(SOURCE)}>, op: string, ts_ms: long>"
    return T.StructType.fromDDL(f"{names}, key struct<{colons(key)}>, value {value}, ddl string")


def colons(fields: str) -> str:
    """'a int, b decimal(10,2)' as the inside of a struct type."""
    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in T.StructType.fromDDL(fields))


def operation(op: Column) -> Column:
    """CREATE, UPDATE, DELETE, TRUNCATE; null for letters that aren't known."""
    out = F.lit(None).cast("string")
    for letter, name in OPERATIONS.items():
        out = F.when(F.lower(op) == letter, name).otherwise(out)
    return out


def state(name: Column) -> Column:
    """BEFORE, AFTER or BOTH for an operation's name."""
    out = F.lit("AFTER")
    for known, image in STATES.items():
        out = F.when(name == known, image).otherwise(out)
    return out


def section(name: Column, before: Column, after: Column) -> Column:
    """The row of an event: the image before a delete, else the image after."""
    return F.when(name == "DELETE", before).otherwise(after)


def without_tombstones(events: DataFrame) -> DataFrame:
    """Events with a value or a schema change."""
    return events.where("value IS NOT NULL OR ddl IS NOT NULL")


def changes(events: DataFrame) -> DataFrame:
    """Row changes: no tombstones, no schema changes, and the section that the operation needs is there."""
    name = operation(F.col("value.op"))
    row = section(name, F.col("value.before"), F.col("value.after"))
    return without_tombstones(events).where(F.col("ddl").isNull() & name.isNotNull() & ((name == "TRUNCATE") | row.isNotNull()))


def schema_changes(events: DataFrame) -> DataFrame:
    return events.where(F.col("ddl").isNotNull())


def gtid_number(gtid: Column) -> Column:
    """n of 'uuid:n' and of 'domain-server-n'; null for other texts, and unless n is a number."""
    parts, triple = F.split(gtid, ":"), F.regexp_extract(gtid, r"^\d+-\d+-(\d+)$", 1)
    return F.when(F.size(parts) == 2, F.get(parts, F.lit(1)).try_cast("long")).when(triple != "", triple.try_cast("long"))


def decode(events: DataFrame) -> DataFrame:
    """One flat record a change: place, key, operation, state, row images, source metadata; the part of a batch, if there is one."""
    name = operation(F.col("value.op"))
    source = F.col("value.source")
    return changes(events).select(
        "topic", "partition", "offset", "timestamp_ms", "key", name.alias("operation"), state(name).alias("state"),
        F.col("value.before").alias("before"), F.col("value.after").alias("after"), section(name, F.col("value.before"), F.col("value.after")).alias("row"),
        F.col("value.ts_ms").alias("cdc_ts_ms"), *[source[f].alias(a) for f, a in (("ts_ms", "ts_ms"), ("snapshot", "snapshot"), ("db", "db"), ("table", "source_table"), ("server_id", "server_id"), ("file", "file"), ("pos", "pos"), ("row", "binlog_row"), ("thread", "thread"), ("lsn", "lsn"))],
        gtid_number(source["gtid"]).alias("gtid"), *[c for c in events.columns if c == PART],
    )


def present_fields(row: Column, names: list[str]) -> Column:
    """Names of the fields of a row image that are not null."""
    return F.array_compact(F.array(*[F.when(row[n].isNotNull(), F.lit(n)) for n in names]))


def with_metadata(records: DataFrame) -> DataFrame:
    """Transport metadata columns beside the record."""
    from ..functions.temporal import millis_text

    values = ("offset", F.to_json("key"), "topic", "partition", millis_text(F.col("timestamp_ms")), "timestamp_ms", "ts_ms", "server_id", "gtid", "file", "pos", "binlog_row", "thread")
    return records.withColumns({n: F.col(v) if isinstance(v, str) else v for n, v in zip(METADATA, values)})


def from_json_log(lines: DataFrame, key: str, row: str) -> DataFrame:
    """Envelopes from a column `value` of JSON lines that hold the whole envelope."""
    return lines.select(F.from_json("value", envelope_schema(key, row)).alias("e")).select("e.*")


def document_schema(documents: DataFrame, column: str) -> str:
    """Fields of JSON documents as a DDL string, merged over all of them by one aggregate; nested documents are texts."""
    found = documents.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("s")).first()["s"]
    if not found or not found.startswith("OBJECT<"):
        return ""
    fields, depth, start = [], 0, 0
    inside = found[len("OBJECT<") : -1]
    for i, c in enumerate(inside + ","):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            fields.append(inside[start:i].strip().partition(": "))
            start = i + 1
    plain = lambda kind: "string" if kind.startswith("OBJECT") or kind in ("VOID", "VARIANT") else kind
    return ", ".join(f"`{name.strip('`')}` {plain(kind)}" for name, _, kind in fields)


def document_rows(after: Column, schema: str) -> Column:
    """A document store's image, which is JSON text, as a struct; nested documents may be kept as text fields."""
    return F.from_json(after, schema)
