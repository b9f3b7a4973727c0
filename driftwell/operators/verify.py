"""Comparing a table with its copy: canonical rows, checksums, counts, chunks, differences."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.temporal import strip_zeros

# Dates and times outside are clamped before they are hashed.
LEAST_DATE, MOST_DATE, MOST_DATETIME = "1900-01-01", "2299-12-31", "2299-12-31 23:59:59"


def canonical(field: T.StructField, base64: bool = False) -> Column:
    """The text of a value that both sides hash."""
    c, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("string")
    if isinstance(kind, T.DateType):
        lo, hi = F.lit(LEAST_DATE).cast("date"), F.lit(MOST_DATE).cast("date")
        return F.when(c < lo, lo).when(c > hi, hi).otherwise(c).cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        name = "timestamp_ntz" if isinstance(kind, T.TimestampNTZType) else "timestamp"
        lo, hi = F.lit(f"{LEAST_DATE} 00:00:00").cast(name), F.lit(MOST_DATETIME).cast(name)
        text = F.when(c < lo, lo).when(c > hi, hi).otherwise(c).cast("string")
        return F.when(F.contains(text, F.lit(".")), strip_zeros(text)).otherwise(text)
    if isinstance(kind, T.BinaryType):
        return F.base64(c) if base64 else F.lower(F.hex(c))
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")  # decimals keep their scale


def canonical_row(schema: T.StructType, exclude: tuple[str, ...] = (), base64: bool = False) -> Column:
    """Values joined by #, nulls left out, then a digit for each nullable column: 1 where it is null."""
    fields = [f for f in schema.fields if f.name not in exclude]
    flags = [F.col(f"`{f.name}`").isNull().cast("int").cast("string") for f in fields if f.nullable]
    return F.concat_ws("#", *[canonical(f, base64) for f in fields], *([F.concat(*flags)] if flags else []))


def row_hashes(rows: DataFrame, exclude: tuple[str, ...] = (), where: str | None = None) -> DataFrame:
    """hash: md5 of each canonical row."""
    kept = rows if where is None else rows.where(where)
    return kept.select(F.md5(canonical_row(kept.schema, exclude)).alias("hash"))


def hash_sums() -> list[Column]:
    """cnt, and a to d: sums of the four 32-bit slices of `hash`; partial sums add up, so chunks and order don't matter."""
    part = lambda at: F.coalesce(F.sum(F.conv(F.substring("hash", at, 8), 16, 10).cast("long")), F.lit(0).cast("long"))
    return [F.count("*").alias("cnt"), *[part(1 + 8 * i).alias(n) for i, n in enumerate("abcd")]]


def checksum(rows: DataFrame, exclude: tuple[str, ...] = (), where: str | None = None) -> DataFrame:
    """One row: cnt, a, b, c, d and checksum, the md5 of these joined with # behind each."""
    sums = row_hashes(rows, exclude, where).agg(*hash_sums())
    return with_digest(sums)


def with_digest(sums: DataFrame) -> DataFrame:
    return sums.withColumn("checksum", F.md5(F.concat(*[F.concat(F.col(c).cast("string"), F.lit("#")) for c in ("cnt", "a", "b", "c", "d")])))


def digest(cnt: int, *sums: int) -> str:
    """The same of numbers on the driver."""
    return hashlib.md5("".join(f"{x}#" for x in (cnt, *sums)).encode()).hexdigest()


def chunked_sums(rows: DataFrame, key: str, size: int, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Partial sums of each run of `size` values of an integer key."""
    hashed = rows.select(F.floor(F.col(key) / size).alias("chunk"), F.md5(canonical_row(rows.schema, exclude)).alias("hash"))
    return hashed.groupBy("chunk").agg(*hash_sums())


def merged_sums(parts: DataFrame) -> DataFrame:
    """Partial sums added up, with the digest."""
    return with_digest(parts.agg(*[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in ("cnt", "a", "b", "c", "d")]))


def key_chunks(rows: DataFrame, key: str, size: int) -> DataFrame:
    """(lo, hi) ranges of `size` key values that cover the least to the greatest key.

    Two numbers come to the driver; the ranges are made in parallel, however many there are.
    """
    least, most = rows.agg(F.min(key).cast("long"), F.max(key).cast("long")).first()
    found = rows.sparkSession.range(0 if least is None else least, 0 if least is None else most + 1, size).select(F.col("id").alias("lo"))
    return found.select("lo", F.least(F.col("lo") + (size - 1), F.lit(most).cast("long")).alias("hi"))


def chunk(rows: DataFrame, key: str, lo: int, hi: int) -> DataFrame:
    return rows.where(F.col(key).between(lo, hi))


def counts(tables: dict[str, DataFrame], where: str | None = None) -> DataFrame:
    """(table, cnt) of several tables."""
    each = [(t if where is None else t.where(where)).agg(F.count("*").alias("cnt")).select(F.lit(n).alias("table"), "cnt") for n, t in tables.items()]
    return reduce(DataFrame.unionByName, each)


def partition_counts(rows: DataFrame, partition: Column, where: str | None = None) -> DataFrame:
    return (rows if where is None else rows.where(where)).groupBy(partition.alias("partition")).agg(F.count("*").alias("cnt"))


def differences(source: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """(key, status) of keys whose rows differ: missing, extra or changed. One shuffle a side, of keys and hashes."""
    side = lambda df, name: df.select(*key, F.md5(canonical_row(df.schema)).alias(name))
    both = side(source, "__s").join(side(target.select(*source.columns), "__t"), key, "full_outer")
    status = F.when(F.col("__t").isNull(), "missing").when(F.col("__s").isNull(), "extra").when(F.col("__s") != F.col("__t"), "changed")
    return both.select(*key, status.alias("status")).where("status IS NOT NULL")


def set_differences(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, with side; repeated rows count."""
    return source.exceptAll(target).withColumn("side", F.lit("source")).unionByName(target.exceptAll(source).withColumn("side", F.lit("target")))


def ordered_dump(rows: DataFrame, key: list[str], exclude: tuple[str, ...] = (), limit: int | None = None) -> DataFrame:
    """Canonical rows in key order, for a text dump; limit: the first so many, to look at."""
    ordered = rows.orderBy(*key)
    return (ordered if limit is None else ordered.limit(limit)).select(canonical_row(rows.schema, exclude).alias("line"))
