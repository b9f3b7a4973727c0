"""Applying a change log to tables, batch by batch."""

from __future__ import annotations

import re
import time
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.dedup import deduplicate, record_key
from ..operators.envelope import PART, changes, decode, gtid_number, operation, with_metadata
from ..operators.metrics import figures
from ..operators.state import DELETED, SEQ, VERSION, collapsing_rows
from ..operators.versions import time_among_snowflakes, time_version, version
from ..plans.ddl import Action, DdlError, drops_or_truncates, parse, unquoted
from ..plans.routing import database_of, included, table_of_topic
from ..plans.settings import Settings
from ..plans.store import Files
from ..plans.tables import COLLAPSING, NUMBER, PLACE, TIME, TRUNCATE, Descriptor, Warehouse, described_by_schema
from ..plans.types import Wire, typed_records
from ..functions.values import raw_json, resolve_zone
from .listener import Metrics
from .offsets import SchemaHistory, TopicOffsets


#: Tables that are written at the same time.
WRITERS = 8
#: Stretches of offsets that come to the driver at most; pieces that what has no offset of its own is cut into, and a stretch that is too large for each half of a part.
SENT, HELD_PIECES, PIECES = 100_000, 1024, 16
#: Keys that deduplication remembers.
POOL = "topic string, __k string, came struct<turn: int, partition: int, offset: bigint>"
#: A hash of what a record without an offset of its own holds, such as one of a snapshot.
HELD = "__held"


class Applier:
    """Writes envelopes into the warehouse's tables.

    A batch is cut at its schema changes, which are few and come to the driver; the data between two of
    them is written, then the change is made. Events are before or after a change by offset if they come
    from its topic and partition, else by the source's time. What is written is named by the log positions
    it holds, so a batch that comes again finds it there; versions come from the log, so events that come
    again in other batches lose nothing and change nothing in replacing tables either. Append tables would
    hold their rows twice, collapsing tables would count their signs twice.

    The keys that deduplication remembers are a table below the warehouse, so a new applier goes on with them.

    include: patterns of database.table, for rows and for schema changes. wires: by table, how the
    capture engine sends its values. offsets: where the greatest offsets are kept, if the settings ask. metrics: takes the figures of
    each batch from the job that looks at it.
    """

    def __init__(self, warehouse: Warehouse, settings: Settings | None = None, include: list[str] | None = None, keys: dict[str, tuple[str, ...]] | None = None, history: SchemaHistory | None = None, wires: dict[str, list[Wire]] | None = None, offsets: TopicOffsets | None = None, metrics: Metrics | None = None):
        self.warehouse, self.settings, self.include, self.keys = warehouse, settings or Settings(), include, keys or {}
        self.history, self.wires, self.offsets, self.metrics = history, wires or {}, offsets, metrics
        self.failed: list[tuple[int, str, str]] = []
        self.pool = f"{warehouse.root}/_pool"
        self.zone = resolve_zone(self.settings.zone)
        self.mark = "" if self.settings.delete_column == "sign" else self.settings.delete_column

    def __call__(self, events: DataFrame, batch: int) -> None:
        events = events.withColumn(HELD, F.when(F.col("offset") < 0, content())).persist()
        try:
            placed = self.placed(events)
            tables, ddl = self.found(placed, self.metrics is not None)
            if not ddl:
                self.rows(placed, tables)
            else:
                staged = placed.withColumn("__stage", stage(ddl))
                full = {r["__stage"] for r in staged.where("ddl IS NULL").select("__stage").distinct().collect()}
                for i, change in enumerate([None, *ddl]):
                    if change is not None:
                        self.change(change)
                    if i in full:
                        part = staged.where(F.col("__stage") == i).drop("__stage")
                        self.rows(part, self.found(part)[0])
            if self.offsets is not None and self.settings.store_offsets:
                self.offsets.put(events, batch)
        finally:
            events.unpersist()

    def wanted(self, action: Action, db: str) -> bool:
        """Whether the include patterns let a schema change through."""
        if not self.include or not action.table:
            return True
        db = unquoted(action.database or db)
        name = f"{self.settings.databases.get(db, db)}.{unquoted(action.table)}"
        return any(re.fullmatch(p, name) for p in self.include)

    def change(self, row) -> None:
        s = self.settings
        for attempt in range(10 if s.ddl_retry else 1):
            try:
                if not (s.disable_drop_truncate and drops_or_truncates(row.ddl)):
                    actions = [a for a in parse(row.ddl) if self.wanted(a, row.db or "")]
                    self.warehouse.execute(actions, row.db or "", s.databases, row.offset, f"{row.topic}/{row.partition}", row.ts_ms, self.mark, s.buckets, s.folders)
                    if self.history is not None:
                        self.history.append(row.offset, row.db or "", row.ddl)
                return
            except (DdlError, KeyError, OSError) as e:
                problem = e
                if s.ddl_retry and attempt < 9:
                    time.sleep(10)
        self.failed.append((row.offset, row.ddl, str(problem)))

    def placed(self, events: DataFrame) -> DataFrame:
        """Row changes of the tables that are wanted, with __db and __table, and all schema changes."""
        s = self.settings
        placed = events.withColumn("__table", table_of_topic(F.col("topic"), s.topics)).withColumn("__db", database_of(F.coalesce(F.col("value.source.db"), F.element_at(F.split("topic", r"\."), -2)), s.databases))
        if s.snapshot_mode in ("schema_only", "no_data"):
            placed = placed.where(F.col("ddl").isNotNull() | (F.lower("value.op") != "r"))
        if self.include:
            placed = placed.where(F.col("ddl").isNotNull() | included(F.concat_ws(".", "__db", "__table"), self.include))
        return placed.where("ddl IS NOT NULL OR __table IS NOT NULL AND value IS NOT NULL")

    def found(self, placed: DataFrame, watch: bool = False) -> tuple[list, list]:
        """In one job: for each table the stretches of the log that its changes lie in; in another, if there are any, the schema changes that are to be made, in order. watch: figures for the metrics too."""
        value, source = F.col("value"), F.col("value.source")
        by = [F.when(F.col("ddl").isNull(), F.col(c)).alias(c) for c in ("__db", "__table")]
        each = [*extent(), F.count("ddl").alias("ddl"), F.count(HELD).alias("held")]
        if watch:
            names = {"ts_ms": source["ts_ms"], "cdc_ts_ms": value["ts_ms"], "gtid": gtid_number(source["gtid"]), "pos": source["pos"], "file": source["file"]}
            each += [*figures(F.unix_millis(F.current_timestamp()), names), F.sum(operation(value["op"]).isNull().cast("long")).alias("errors")]
        look = lambda step, pieces: placed.groupBy(*by, *stretch(step, pieces)).agg(*each)
        step, pieces = max(1, self.settings.max_records // 4) if self.settings.max_records else 0, HELD_PIECES
        rows = look(step, pieces).limit(SENT + 1).collect() if step else look(0, 0).collect()
        if len(rows) > SENT:  # offsets far apart: as long stretches as keep their number down
            whole = look(0, 0).collect()  # a row a table, topic and partition
            step = max(step, -(-sum(r["hi"] - r["lo"] + 1 for r in whole if r["hi"] is not None) * 2 // SENT))
            pieces = max(1, min(pieces, SENT // 2 // len(whole)), sum(r["held"] for r in whole) * 4 // self.settings.max_records)
            rows = look(step, pieces).collect()
        if watch:
            self.metrics.take([r for r in rows if not r["ddl"]])
            for r in rows:
                for name, n in (("ddl_total", r["ddl"]), ("records_total", 0 if r["ddl"] else r["n"] - r["errors"]), ("errors_total", 0 if r["ddl"] else r["errors"])):
                    self.metrics.add(name, n, topic=r["topic"])
        tables: dict[tuple[str, str], dict] = {}
        for r in (r for r in rows if not r["ddl"]):
            t = tables.setdefault((r["__db"], r["__table"]), {"__db": r["__db"], "__table": r["__table"], "cut": (step, pieces), "cells": []})
            t["cells"].append(r)
        for t in tables.values():
            t |= together(t["cells"])
        change = ("topic", "partition", "offset", "ddl", source["db"].alias("db"), source["snapshot"].alias("snapshot"), source["ts_ms"].alias("ts_ms"))
        made = placed.where("ddl IS NOT NULL").select(*change).collect() if any(r["ddl"] for r in rows) else []  # few
        ddl = [x for x in made if not self.settings.disable_ddl and (x.snapshot != "true" or self.settings.snapshot_ddl)]
        return list(tables.values()), sorted(ddl, key=lambda r: (r.ts_ms or 0, r.topic, r.partition, r.offset))

    def rows(self, placed: DataFrame, tables: list) -> None:
        """Row changes of one stretch without schema changes, each table's by itself; more than `max_records` are written in several parts, by one job a table."""
        s = self.settings
        placed = placed.where("ddl IS NULL")
        named = lambda r: f"{r['lo']}-{r['hi']}-{r['sum']}"
        batches = {(r["__db"], r["__table"]): (named(r), 0) for r in tables}

        def write(table) -> None:
            own = placed.where((F.col("__db") == table[0]) & (F.col("__table") == table[1])).drop("__db", "__table", HELD)
            self.table_rows(own.coalesce(1) if s.single_threaded else own, *table, *batches[table])

        if s.max_records and sum(r["n"] for r in tables) > s.max_records:
            placed, cut = self.parted(placed, tables)
            batches = {t: ({n: named(r) for n, r in own.items()}, max(r["n"] for r in own.values())) for t, own in cut.items()}
        if s.single_threaded or len(batches) < 2:
            for table in batches:
                write(table)
        else:
            with ThreadPoolExecutor(min(WRITERS, len(batches))) as pool:
                list(pool.map(inheritable_thread_target(self.warehouse.spark)(write), batches))
        if s.deduplication_policy == "old" and s.buffer_count:
            self.remember(placed)

    def parted(self, placed: DataFrame, tables: list) -> tuple[DataFrame, dict[tuple[str, str], dict[int, dict]]]:
        """Row changes with the number of their part, of `max_records` at most; and what each table has of each part.

        The look at the batch has told how many records lie in each stretch of offsets of a topic partition; these are few
        beside records. Offsets of a topic partition differ, so a stretch holds no more records than offsets; stretches
        are put together up to the limit. Rows of a snapshot all have one offset: they are cut
        by a hash of what they hold, and so is a stretch that holds more than the limit all the same, which takes another look. Where the cuts lie
        follows from the batch alone, so one that comes again is cut alike. Records that are alike in all they hold stay together.
        """
        most, (step, pieces) = self.settings.max_records, tables[0]["cut"]
        place = ["__topic", "__partition", "__at", "__piece"]
        named = [c.alias(n) for c, n in zip(stretch(step, pieces), place)]
        numbered = placed.select("*", *named).withColumn("__finer", F.lit(0).cast("long"))
        cells = [(*(r[n] for n in ("__db", "__table", "topic", "partition", *place[2:])), 0, r) for t in tables for r in t["cells"]]
        sizes = Counter()
        for c in cells:
            sizes[c[2:6]] += c[-1]["n"]
        large = {k: -(-n * PIECES * 2 // most) for k, n in sizes.items() if n > most}
        if large:
            more = self.sent([(*k, n) for k, n in large.items()], [*place, "__pieces"])
            finer = F.when(F.col("__pieces").isNotNull(), F.pmod(F.xxhash64(F.coalesce(HELD, content())), "__pieces"))
            numbered = alike(numbered.drop("__finer"), more, place, "left").withColumn("__finer", F.coalesce(finer, F.lit(0)).cast("long")).drop("__pieces")
            again = alike(numbered, more.drop("__pieces"), place, "inner").groupBy("__db", "__table", *place, "__finer").agg(*extent()).collect()
            cells = [c for c in cells if c[2:6] not in large] + [(*(r[n] for n in ("__db", "__table", *place, "__finer")), r) for r in again]
        sizes = Counter()
        for c in cells:
            sizes[c[2:7]] += c[-1]["n"]
        part, held, parts = 0, 0, {}
        for k in sorted(sizes, key=lambda k: (k[2], k[3], k[4], k[0] or "", -1 if k[1] is None else k[1])):
            if held and held + sizes[k] > most:
                part, held = part + 1, 0
            parts[k], held = part, held + sizes[k]
        found: dict[tuple[str, str], dict[int, list]] = {}
        for c in cells:
            found.setdefault(c[:2], {}).setdefault(parts[c[2:7]], []).append(c[-1])
        dealt = self.sent([(*k, n) for k, n in parts.items()], [*place, "__finer", PART])
        out = alike(numbered, dealt, [*place, "__finer"], "inner").select(*placed.columns, PART)
        return out, {t: {n: together(own) for n, own in by.items()} for t, by in found.items()}

    def sent(self, rows: list[tuple], names: list[str]) -> DataFrame:
        """A small table of topics, partitions and whole numbers, for every task."""
        kinds = {"__topic": pa.string(), "__partition": pa.int32(), PART: pa.int32()}
        columns = [pa.array(list(c), kinds.get(n, pa.int64())) for c, n in zip(zip(*rows), names)]
        return F.broadcast(self.warehouse.spark.createDataFrame(pa.table(columns, names=names)))

    def remembered(self) -> tuple[int, DataFrame] | None:
        """The last keys of each topic, and how often keys were remembered."""
        whole = [n for n in self.warehouse.files.names(self.pool) if self.warehouse.files.exists(f"{self.pool}/{n}/_SUCCESS")]
        return (int(whole[-1].rstrip("ab")), self.warehouse.spark.read.schema(POOL).parquet(f"{self.pool}/{whole[-1]}")) if whole else None

    def remember(self, events: DataFrame) -> None:
        """Keep the `buffer_count` distinct keys of each topic that came last, one row a key."""
        files, most, before = self.warehouse.files, self.settings.buffer_count, self.remembered()
        turn, older = before[0] + 1 if before else 1, files.names(self.pool)
        came = F.struct(F.lit(turn).alias("turn"), "partition", "offset").alias("came")
        keys = events.select("topic", record_key().alias("__k"), came).where("__k IS NOT NULL")
        if before:
            keys = keys.unionByName(before[1])
        names = [f"{turn:012}{x}" for x in "ab"]
        keys.groupBy("topic", "__k").agg(F.max("came").alias("came")).write.mode("overwrite").parquet(f"{self.pool}/{names[0]}")
        now = self.remembered()[1]
        if (now.groupBy("topic").count().agg(F.max("count")).first()[0] or 0) > most:
            last = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("came")))
            now.withColumn("n", last).where(F.col("n") <= most).drop("n").write.mode("overwrite").parquet(f"{self.pool}/{names[1]}")
            older.append(names[0])
        for n in older:
            files.delete(f"{self.pool}/{n}")

    def distinct(self, events: DataFrame) -> DataFrame:
        """Row changes as the deduplication policy asks: none whose key is remembered, one of each key of the batch."""
        policy = self.settings.deduplication_policy
        if policy == "off":
            return events
        keyed = changes(events).withColumn("__k", record_key())  # a tombstone has the key of its delete
        if policy == "old" and (seen := self.remembered()):
            keyed = keyed.join(seen[1].select("topic", "__k"), ["topic", "__k"], "left_anti")
        return deduplicate(keyed, policy, ["topic", "__k"], ["partition", "offset"]).select(*events.columns)

    def table_rows(self, events: DataFrame, db: str, name: str, batch: str | dict[int, str], most: int = 0) -> None:
        s, w = self.settings, self.warehouse
        records = decode(self.distinct(events))
        if name in self.wires:
            records = typed_records(records, self.wires[name], self.zone, s.raw_bytes)
        image = records.schema["row"].dataType
        if not w.exists(db, name):
            if not s.auto_create:
                return
            w.save(described_by_schema(db, name, image, self.keys.get(name, tuple(records.schema["key"].dataType.names)), deleted=self.mark, replicated=s.replicated, buckets=s.buckets))
        d = w.load(db, name)
        if s.dialect == "postgres" and not d.partial:
            d = replace(d, partial=True)
            w.save(d)
        if s.evolve:
            d = w.evolve(d, image)
        w.append(d, target_rows(records, d, s), batch, most=most)
        if s.compact_after:
            w.tidy(db, name, s.compact_after)


def content() -> Column:
    """A hash of a record's key and value."""
    return F.xxhash64(F.to_json("key"), F.to_json("value"))


def extent() -> list[Column]:
    """Aggregates of records that name a batch: their least and greatest offset, a sum of hashes, and their number. Rows without an offset of their own, such as a snapshot's, count by what they hold."""
    spot = F.xxhash64("topic", "partition", "offset", HELD)
    return [F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.sum(F.pmod(spot, F.lit(1 << 31))).alias("sum"), F.count("*").alias("n")]


def stretch(step: int, pieces: int) -> list[Column]:
    """Where a record lies: its topic and partition, which stretch of `step` offsets (0: all), and which piece of what has no offset of its own."""
    at = F.expr(f"offset div {step}L") if step else F.lit(0)
    piece = F.coalesce(1 + F.pmod(HELD, F.lit(pieces)), F.lit(0)) if pieces else F.lit(0)
    return [F.col("topic"), F.col("partition"), at.cast("long").alias("__at"), piece.cast("long").alias("__piece")]


def together(rows: list) -> dict:
    """What several stretches come to."""
    known = lambda c: [r[c] for r in rows if r[c] is not None]
    return {"lo": min(known("lo"), default=None), "hi": max(known("hi"), default=None), "sum": sum(r["sum"] for r in rows), "n": sum(r["n"] for r in rows)}


def alike(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """left with the columns of the rows of right that are alike in `names`, nulls included."""
    r = right.toDF(*[f"__of{c}" if c in names else c for c in right.columns])
    on = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__of{c}")) for c in names])
    return left.join(F.broadcast(r), on, how).drop(*[f"__of{c}" for c in names])


def stage(changes: list) -> Column:
    """How many of the changes, sorted, an event comes after: the number of the last one that it is after."""
    out = F.lit(0)
    for i, c in enumerate(changes, 1):
        here = (F.col("topic") == c.topic) & (F.col("partition") == c.partition)
        later = F.coalesce(F.col("value.source.ts_ms") >= c.ts_ms, F.lit(True)) if c.ts_ms is not None else F.lit(True)
        out = F.when(F.when(here, F.col("offset") > c.offset).otherwise(later), F.lit(i)).otherwise(out)
    return out


def target_rows(records: DataFrame, d: Descriptor, s: Settings) -> DataFrame:
    """Log rows of a table: the image's columns, version, place and mark; truncates as markers."""
    seq = F.col("offset")
    # a row without a transaction number, such as one of a snapshot, is ordered among those with one by its time
    plain = time_among_snowflakes(F.col("ts_ms")) if s.snowflake else time_version(F.col("ts_ms"))
    number = version(F.col("ts_ms"), F.col("gtid"), plain, s.snowflake)
    if s.dialect == "postgres":
        number = F.coalesce("lsn", number)
    whole = F.col("gtid") if s.snowflake else F.lit(None)
    if s.dialect == "postgres":
        whole = F.when(F.col("lsn").isNull(), whole)
    whole = F.when(whole != -1, whole).cast("bigint").alias(NUMBER)
    spot = [F.concat_ws("/", "topic", "partition").alias(PLACE), F.col("ts_ms").alias(TIME), whole, *[c for c in records.columns if c == PART]]
    if s.ignore_delete:
        records = records.where("operation <> 'DELETE'")
    if s.store_metadata:
        records = with_metadata(records)
    extra = [c for c in records.columns if c.startswith("_") and c != PART] if s.store_metadata else []
    raw = raw_json(*records.schema["row"].dataType.names) if s.store_raw and s.raw_column else None
    if d.engine == COLLAPSING:
        cut = records.where("operation = 'TRUNCATE'").select(number.alias(VERSION), seq.alias(SEQ), F.lit(True).alias(TRUNCATE), *spot)
        marked = collapsing_rows(records.where("operation <> 'TRUNCATE'"), number, seq).select("row.*", VERSION, SEQ, "_sign", *spot, *extra)
        return (marked if raw is None else marked.withColumn(s.raw_column, raw)).unionByName(cut, allowMissingColumns=True)
    cut = F.col("operation") == "TRUNCATE"
    kept = lambda c: F.when(~cut, c)  # noqa: E731  a truncate has no image
    gone = kept((F.col("operation") == "DELETE").cast("int"))
    marked = records.withColumn("row", kept(F.col("row"))).select("row.*", number.alias(VERSION), seq.alias(SEQ), gone.alias(d.deleted or DELETED), F.when(cut, True).alias(TRUNCATE), *spot, *[kept(F.col(c)).alias(c) for c in extra])
    return marked if raw is None else marked.withColumn(s.raw_column, F.when(F.col(TRUNCATE).isNull(), raw))


def start(events: DataFrame, applier: Applier, checkpoint: str, once: bool = False):
    """The streaming query that feeds the applier; once: work off what is there and stop."""
    writer = events.writeStream.foreachBatch(lambda df, n: applier(df, n)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{max(1, applier.settings.flush_ms)} milliseconds")).start()


def apply_all(spark: SparkSession, events: DataFrame, applier: Applier) -> None:
    """A batch of events at once."""
    applier(events, 0)
