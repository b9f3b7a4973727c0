"""Shared helpers: scratch tables, text batches, connected components."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from functools import wraps

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Narrow rows that one file of a scratch table holds at least, and files that a table of known size has at least.
ROWS_A_FILE, LEAST_FILES = 100_000, 6


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for scratch tables: spark.checkpoint.dir, or one below /tmp where that is unset.

    Only a local master may leave it unset: the nodes of a cluster don't share /tmp.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        found = f"/tmp/checkpoints/{os.getpid()}"
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/driftwell"


#: Scratch tables of this thread of the driver, in the order in which they were begun.
_own: ContextVar[list[str]] = ContextVar("scratch tables")


def _tables() -> list[str]:
    try:
        return _own.get()
    except LookupError:
        _own.set([])
        return _own.get()


def few(df: DataFrame, rows: int, each: int = ROWS_A_FILE) -> DataFrame:
    """df in no more partitions than so many rows are worth, `each` or more in one; never in more than Spark chose.

    `rows` is what df has about or at most. Small tables are thus no crowd of small files.
    """
    return df.coalesce(max(LEAST_FILES, -(-rows // each)))


def written(df: DataFrame, tag: str, rows: int | None = None, each: int = ROWS_A_FILE) -> DataFrame:
    """df as a Parquet table in the shared scratch folder: cuts the lineage and survives lost executors.

    rows: about how many it has, if known; it is then written as few(). The table stays until
    drop_written() or drop_scratch(): what an operator returns may read it.
    """
    spark = df.sparkSession
    df = df if rows is None else few(df, rows, each)
    path = f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    _tables().append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_bits(rows: DataFrame, column: str) -> DataFrame:
    """(bucket, bits): a set of row numbers as bitmaps of 32,768 bits, a bit a row where numbers lie close."""
    return rows.groupBy(F.bitmap_bucket_number(column).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias("bits"))


def in_bits(df: DataFrame, column: str, bits: DataFrame) -> DataFrame:
    """Rows of df whose number is in the set: as long as its bitmaps are small, Spark sends them and leaves the rows where they are."""
    place = F.bitmap_bit_position(column)
    byte = F.conv(F.hex(F.substring(bits["bits"], F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.get(F.array(*[F.shiftright(byte, i).bitwiseAND(1) for i in range(8)]), place.bitwiseAND(7).cast("int"))
    return df.join(bits, F.bitmap_bucket_number(column) == bits["bucket"]).where(bit == 1).select(*df.columns)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of phases whose results are written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop_written(spark: SparkSession, df: DataFrame) -> None:
    """Delete a table of written() that nothing reads any more."""
    for path in {os.path.dirname(f) for f in df.inputFiles()}:
        _delete(spark, path)


def scratch_mark() -> int:
    """A place among the scratch tables of this thread, for drop_scratch()."""
    return len(_tables())


def drop_scratch(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Delete the scratch tables that this thread began after the mark, but for the last `keep`; nothing may read them any more."""
    tables = _tables()
    for path in tables[since : len(tables) - keep]:
        _delete(spark, path)
    del tables[since : len(tables) - keep]


def apart(keep: tuple[str, ...], *new: str) -> tuple[str, ...]:
    """The columns of `keep` whose names are not those of new columns; Spark tells no A from a."""
    taken = {n.lower() for n in new}
    return tuple(c for c in keep if c.lower() not in taken)


#: Rows of an Arrow batch that goes to a Python worker in the pipeline, and the setting for that.
BATCH_ROWS, BATCH_KEY = 1_000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_ROWS rows from now on, unless the session has a number of its own: the JVM holds several copies of a batch of whole texts beside its heap."""
    if spark.conf.get(BATCH_KEY) == "10000":  # Spark's default
        spark.conf.set(BATCH_KEY, str(BATCH_ROWS))


#: Bytes of a table that Spark sends to all tasks by itself, at most, while an operator works; the settings for that.
SENT_BYTES, SENT_KEYS = 1 << 20, ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


def sends_little(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator of many joins whose phases send tables of SENT_BYTES at most, or less if the session says so.

    Each table that is sent is built as a hash table on the driver, where it takes many times what it takes in files,
    and stays until the driver collects its garbage. The session's settings are as before when the operator returns.
    """

    @wraps(operator)
    def run(docs: DataFrame, *args, **names) -> DataFrame:
        spark = docs.sparkSession
        before = {k: spark.conf.get(k, None) for k in SENT_KEYS}  # None: not set
        for k in SENT_KEYS:
            if (now := spark.conf.get(k)) is not None and byte_count(now) > SENT_BYTES:
                spark.conf.set(k, str(SENT_BYTES))
        try:
            return operator(docs, *args, **names)
        finally:
            for k, given in before.items():
                spark.conf.unset(k) if given is None else spark.conf.set(k, given)

    return run


def byte_count(text: str) -> int:
    """A setting of bytes, such as 10m or 10485760b, as a number."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([kmgtp]?)b?\s*", text.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def give_back() -> None:
    """At the end of a task: free memory of the Python worker, which lives on beside the JVM, goes back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """The batches cut at rows into pieces of about `most` bytes of text, with the UTF-8 bytes of each; a longer text comes alone."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        lo = size = 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
            if i > lo and size + n + 1 > most:
                yield batch.slice(lo, i - lo), column.slice(lo, i - lo).to_pylist()
                lo, size = i, 0
            size += n + 1
        if lo < batch.num_rows:
            yield batch.slice(lo), column.slice(lo).to_pylist()
        del batch, column
    give_back()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of edges(a, b) of long nodes, as (node, root): root is the least node of the component.

    Alternating large-star and small-star rounds; each round's edges are written to the scratch folder.
    The number of rounds grows with the logarithm of the number of nodes. Only counts come to the driver.
    """
    spark = edges.sparkSession
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges", rows=edges.count())
    n = now.count()
    seen = None
    for _ in range(rounds):
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # every u now points down only, so small-star needs each u's least neighbour
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        after = written(small, "edges", rows=n)
        drop_written(spark, now)
        now = after
        check = now.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))), F.lit(0)).alias("h")).first()
        if seen == (check["n"], check["h"]):
            break
        seen, n = (check["n"], check["h"]), check["n"]
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
