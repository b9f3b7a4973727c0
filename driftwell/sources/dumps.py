"""Bulk loads: dump files with their schema files, and chunked reads of a table."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.state import SEQ, VERSION
from ..operators.verify import chunk, key_chunks
from ..plans.ddl import BYTES, Action, parse, unquoted
from ..plans.tables import TIME, Descriptor, Warehouse, described
from ..plans.store import Files

#: Versions of loaded rows: below any change that follows.
LOAD_VERSION = 0


def schema_file(spark: SparkSession, path: str) -> Action:
    """The CREATE TABLE of a schema file, gzipped or plain; settings and other statements in it are passed over."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    for sql in re.split(r";\s*(?:\n|$)", text):
        found = [a for a in parse(sql) if a.kind == "create_table"] if re.search(r"create\s+table", sql, re.I) else []
        if found:
            return found[0]
    raise ValueError(f"{path} creates no table")


def schema_files(spark: SparkSession, folder: str) -> dict[tuple[str, str], str]:
    """(database, table) of the schema files of a dump: db.table-schema.sql[.gz] or db@table.sql."""
    out = {}
    for name in Files(spark).names(folder):
        m = re.fullmatch(r"(.+)\.(.+)-schema\.sql(?:\.gz|\.zst)?", name) or re.fullmatch(r"(.+)@(.+)\.sql", name)
        if m and not name.endswith("-schema-create.sql.gz"):
            out[m[1], m[2]] = f"{folder}/{name}"
    return out


def text_schema(a: Action) -> T.StructType:
    return T.StructType([T.StructField(unquoted(c.name), T.StringType()) for c in a.columns if c.generated is None])


def read_tsv(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """Tab-separated rows with backslash escapes and \\N for null; compressed files by their ending."""
    lines = spark.read.option("lineSep", "\n").text(path)
    parts = F.split("value", "\t", -1)
    return lines.select(*[unescaped(F.get(parts, F.lit(i))).alias(f.name) for i, f in enumerate(columns.fields)])


def unescaped(text: Column) -> Column:
    """\\N as null; \\t, \\n, \\0 and doubled backslashes as what they stand for."""

    def plain(part: Column) -> Column:
        for mark, meant in (("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r"), ("\\0", "\0")):
            part = F.replace(part, F.lit(mark), F.lit(meant))
        return part

    # an escape begins at the first of a run of backslashes, so pairs from the left are doubled ones
    out = F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")
    return F.when(text == "\\N", F.lit(None).cast("string")).otherwise(out)


def read_quoted(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """Comma-separated rows in double quotes with backslash escapes, \\N for null."""
    return spark.read.csv(path, schema=columns, sep=",", quote='"', escape="\\", nullValue="\\N", multiLine=False)


def typed(rows: DataFrame, a: Action) -> DataFrame:
    """Texts of a dump as the table's types; bytes, which dumps hold in base64, as hex digits."""
    schema = described(a, "db").schema()

    def value(c) -> Column:
        name = unquoted(c.name)
        kind = schema[name].dataType
        text = F.col(f"`{name}`")
        if c.kind in BYTES:
            return F.lower(F.hex(F.try_to_binary(text, F.lit("base64")))).alias(name)
        if isinstance(kind, T.BooleanType):
            return text.isin("1", "\u0001", "true").alias(name)
        return (text if isinstance(kind, T.StringType) else text.try_cast(kind.simpleString())).alias(name)

    return rows.select(*[value(c) for c in a.columns if c.generated is None])


def load_dump(warehouse: Warehouse, a: Action, rows: DataFrame, database: str = "", truncate: bool = True) -> Descriptor:
    """Create the table, empty it if asked to, and append the typed rows as its first state."""
    warehouse.execute([a], database)
    d = warehouse.load(unquoted(a.database or database), unquoted(a.table))
    if truncate:
        warehouse.truncate(d, None)
        d = warehouse.load(d.database, d.name)
    loaded = typed(rows, a).withColumns({VERSION: F.lit(LOAD_VERSION).cast("bigint"), SEQ: F.lit(0).cast("bigint"), TIME: F.lit(0).cast("bigint"), d.deleted: F.lit(0)})
    warehouse.append(d, loaded, "load")
    return d


def load_folder(warehouse: Warehouse, folder: str, include: str | None = None) -> list[tuple[str, str]]:
    """Every table of a dump folder whose name matches: schema files, and data as .tsv.zst, .tsv.gz, .tsv or .dat.gz."""
    spark, out = warehouse.spark, []
    names = Files(spark).names(folder)
    for (db, table), path in sorted(schema_files(spark, folder).items()):
        if include is not None and not re.search(include, table):
            continue
        a = schema_file(spark, path)
        own = [n for n in names if re.match(rf"{re.escape(db)}[.@]{re.escape(table)}(?:@+\d+|\.\d+)?\.", n)]
        tsv = [f"{folder}/{n}" for n in own if re.search(r"\.tsv(\.zst|\.gz)?$", n)]
        dat = [f"{folder}/{n}" for n in own if re.search(r"\.(dat|csv)(\.gz)?$", n)]
        if tsv:
            load_dump(warehouse, a, read_tsv(spark, tsv, text_schema(a)), db)
        elif dat:
            load_dump(warehouse, a, read_quoted(spark, dat, text_schema(a)), db)
        else:
            warehouse.execute([a], db)
        out.append((db, table))
    return out


def integer_key(d: Descriptor) -> str | None:
    """The first key column if it is an integer."""
    kinds = {f.name: f.kind for f in d.fields}
    return next((k for k in d.key[:1] if kinds[k] in ("tinyint", "smallint", "int", "bigint")), None)


def chunked(rows: DataFrame, key: str, size: int) -> Iterator[DataFrame]:
    """The table in ranges of an integer key, as a reader of one chunk at a time takes it."""
    for r in key_chunks(rows, key, size).orderBy("lo").toLocalIterator():
        yield chunk(rows, key, r.lo, r.hi)


def database_chunks(spark: SparkSession, url: str, table: str, key: str, lo: int, hi: int, parts: int, properties: dict[str, str]) -> DataFrame:
    """The same over JDBC, where Spark reads the ranges in parallel."""
    return spark.read.jdbc(url, table, column=key, lowerBound=lo, upperBound=hi, numPartitions=parts, properties=properties)


def write_tsv(rows: DataFrame, path: str, compression: str = "gzip") -> None:
    """Rows as tab-separated text that read_tsv() reads."""

    def escaped(name: str) -> Column:
        out = F.col(f"`{name}`").cast("string")
        for mark, meant in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"), ("\0", "\\0")):
            out = F.replace(out, F.lit(mark), F.lit(meant))
        return F.coalesce(out, F.lit("\\N"))

    rows.select(F.concat_ws("\t", *map(escaped, rows.columns)).alias("value")).write.option("compression", compression).text(path)


def estimated_rows(rows: DataFrame) -> int | None:
    """The optimizer's row count, without a scan; None where it has none."""
    found = rows._jdf.queryExecution().optimizedPlan().stats().rowCount()
    return int(str(found.get())) if found.isDefined() else None


def partitions(rows: DataFrame, by: Column, pattern: str | None = None) -> DataFrame:
    """Distinct partition values that match the pattern."""
    found = rows.select(by.cast("string").alias("partition")).distinct()
    return found if pattern is None else found.where(F.col("partition").rlike(pattern))
