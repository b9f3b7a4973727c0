"""Versions of records: snowflake numbers, transaction numbers, sequence numbers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.scratch import folder
from ..plans.store import Files

#: Fixed values of the snowflake layout: epoch in ms, bits of the transaction number.
SNOWFLAKE_EPOCH = 1288834974657
GTID_BITS = 22
TIME_BITS = 41
#: Fixed values of sequence numbers: first one, and the ms after which the count begins again.
SEQUENCE_START = 1_000_000_000
SEQUENCE_RESET_MS = 2000
#: Values of the order column that are numbered in one task.
SEQUENCE_BLOCK = 1 << 17


def snowflake(ts_ms: Column, gtid: Column) -> Column:
    """Time in the high bits, the low bits of the transaction number below."""
    time = (ts_ms - F.lit(SNOWFLAKE_EPOCH)).bitwiseAND(F.lit((1 << TIME_BITS) - 1))
    return F.shiftleft(time, GTID_BITS).bitwiseOR(gtid.bitwiseAND(F.lit((1 << GTID_BITS) - 1)))


def time_among_snowflakes(ts_ms: Column) -> Column:
    """The version of a row without a transaction number, below all numbers of its millisecond; times before the epoch are negative."""
    return F.shiftleft(ts_ms - F.lit(SNOWFLAKE_EPOCH), GTID_BITS)


def version(ts_ms: Column, gtid: Column, sequence: Column, use_snowflake: bool = True) -> Column:
    """From the transaction number if there is one (-1 and null: none), else the sequence number."""
    has = F.coalesce(gtid, F.lit(-1)) != -1
    return F.when(has, snowflake(ts_ms, gtid) if use_snowflake else gtid).otherwise(sequence)


def sequence_numbers(times: list[int], start: int | None = None, count: int = SEQUENCE_START) -> tuple[list[int], int, int]:
    """ts_ms * 1e6 + count for each time in order; also the window start and count to go on with.

    The count grows by one a record and begins again when a record is two seconds or more after the
    start of the window.
    """
    out = []
    for t in times:
        if start is None:
            start = t
        if t - start >= SEQUENCE_RESET_MS:
            start, count = t, SEQUENCE_START
        else:
            count += 1
        out.append(t * 1_000_000 + count)
    return out, start, count


def with_sequence(records: DataFrame, stream: list[str], order: str, ts_ms: str = "cdc_ts_ms", name: str = "sequence", block: int = SEQUENCE_BLOCK) -> DataFrame:
    """Exact sequence numbers within each stream (such as topic and partition), in the order of a whole-number column.

    A count depends on all records before it, but a stream is worked on in blocks of `block` values of
    `order`, in many tasks: window_starts() finds where the count begins again, and a record's count is the number of
    records since then. Only one row a block, and one for every two seconds of the log, are
    ordered by stream. Order is unique within a stream; a record without a time gets null and isn't counted.
    """
    spark, mine = records.sparkSession, []
    times = records.where(F.col(ts_ms).isNotNull()).select(*stream, F.col(order).alias("__o"), F.col(ts_ms).alias("__t"))
    times = _kept(times.withColumn("__block", F.floor(F.col("__o") / block)), mine)
    starts = window_starts(times, stream, mine).withColumn("__start", F.lit(True))
    within = Window.partitionBy(*stream, "__block").orderBy("__o")
    placed = times.join(starts, [*stream, "__o"], "left").withColumn("__place", F.row_number().over(within))
    placed = _kept(placed.withColumn("__since", F.max(F.when(F.col("__start"), F.col("__place"))).over(within)))
    for path in mine:
        Files(spark).delete(path)
    earlier = Window.partitionBy(*stream).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = placed.groupBy(*stream, "__block").agg(F.count("*").alias("__n"), F.max("__since").alias("__last"))
    blocks = blocks.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    blocks = blocks.withColumn("__held", F.max(F.col("__before") + F.col("__last")).over(earlier))
    at, since = F.col("__before") + F.col("__place"), F.coalesce(F.col("__before") + F.col("__since"), F.col("__held"))
    number = F.col("__t") * 1_000_000 + SEQUENCE_START + at - since + F.when(since == 1, 1).otherwise(0)
    numbers = placed.join(blocks, [*stream, "__block"]).select(*stream, F.col("__o").alias(order), number.alias(name))
    return records.join(numbers, [*stream, order], "left").select(*records.columns, name)


def _kept(df: DataFrame, mine: list[str] | None = None) -> DataFrame:
    """df as a table in the scratch folder."""
    path = folder(df.sparkSession, "sequence")
    df.write.parquet(path)
    if mine is not None:
        mine.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def window_starts(times: DataFrame, stream: list[str], mine: list[str]) -> DataFrame:
    """Where the count of each stream begins again, as (stream, __o), of times(stream, __o, __t, __block).

    It begins at the first record, and then at the first one two seconds or more after where it last began. Such a record
    is later than all before it, so only these matter, and there is one a millisecond at most. Each points to
    the first of them two seconds on, which lies in the next span of two seconds or begins a later one. A record two
    seconds after all before it is a start whatever came before. From these the pointers are followed by doubling: a
    round takes twice as many steps as the one before.
    """
    reset = F.lit(SEQUENCE_RESET_MS)
    earlier = Window.partitionBy(*stream).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    highest = times.groupBy(*stream, "__block").agg(F.max("__t").alias("__m")).withColumn("__m", F.max("__m").over(earlier))
    within = Window.partitionBy(*stream, "__block").orderBy("__o").rowsBetween(Window.unboundedPreceding, -1)
    before = F.greatest(F.col("__m"), F.max("__t").over(within))  # nulls aside
    nodes = times.join(highest, [*stream, "__block"]).withColumn("__b", before).where("__b IS NULL OR __t > __b")
    nodes = _kept(nodes.select(*stream, "__o", F.col("__t").alias("__v"), (F.col("__b").isNull() | (F.col("__t") >= F.col("__b") + reset)).alias("__free")), mine)
    span = F.floor(F.col("__v") / reset)
    points = nodes.select(*stream, span.alias("__s"), "__v", F.lit(None).cast("long").alias("__a"), F.struct("__v", "__o", "__free").alias("__p"))
    asks = nodes.select(*stream, (span + 1).alias("__s"), (F.col("__v") + reset).alias("__v"), F.col("__o").alias("__a")).withColumn("__p", F.lit(None).cast(points.schema["__p"].dataType))
    both = points.unionByName(asks)
    later = Window.partitionBy(*stream, "__s").orderBy(F.desc("__v")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    spans = both.groupBy(*stream, "__s").agg(F.min("__p").alias("__f"))
    spans = spans.select(*stream, "__s", F.last("__f", True).over(Window.partitionBy(*stream).orderBy(F.desc("__s")).rowsBetween(Window.unboundedPreceding, -1)).alias("__f"))
    asked = both.withColumn("__hit", F.min("__p").over(later)).where("__a IS NOT NULL").join(spans, [*stream, "__s"])
    pointers = asked.withColumn("__hit", F.coalesce("__hit", "__f")).where("NOT __hit.__free").select(*stream, "__a", F.col("__hit.__o").alias("__o"))
    pointers, reached = _kept(pointers, mine), _kept(nodes.where("__free").select(*stream, "__o"), mine)
    while True:
        new = reached.withColumnRenamed("__o", "__a").join(pointers, [*stream, "__a"]).select(*stream, "__o").distinct()
        new = _kept(new.join(reached, [*stream, "__o"], "left_anti"), mine)
        if new.isEmpty():
            return reached
        reached = _kept(reached.unionByName(new), mine)
        pointers = _kept(pointers.withColumnRenamed("__o", "__n").join(pointers.withColumnRenamed("__a", "__n"), [*stream, "__n"]).select(*stream, "__a", "__o"), mine)


def time_version(ts_ms: Column) -> Column:
    """A version without state: the time alone. Rows of one time are told apart by their place in the log, which FINAL orders by next."""
    return ts_ms * 1_000_000


def sequence_stream(records: DataFrame, stream: list[str], order: list[str], ts_ms: str = "cdc_ts_ms", name: str = "sequence") -> DataFrame:
    """with_sequence() of a streaming DataFrame: the window start and the count go on from batch to batch, kept in Spark's state."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    fields = records.schema.fields
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{name}` long"

    def run(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches)).sort_values(order, kind="stable")  # rows of one stream and micro-batch
        start, count = state.get if state.exists else (None, SEQUENCE_START)
        numbers, start, count = sequence_numbers(pdf[ts_ms].tolist(), start, count)
        state.update((start, count))
        yield pdf[[f.name for f in fields]].assign(**{name: numbers})

    return records.groupBy(*stream).applyInPandasWithState(run, schema, "start long, count long", "append", GroupStateTimeout.NoTimeout)
