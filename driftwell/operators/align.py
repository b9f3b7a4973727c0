"""Fitting rows to a target's columns."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.temporal import date32


def fitted(rows: DataFrame, f: T.StructField) -> Column:
    """The column of rows that f names as f's type; null where it is missing or doesn't fit. Whole numbers are days of a date."""
    if f.name not in rows.columns:
        return F.lit(None).cast(f.dataType)
    have, kind = F.col(f"`{f.name}`"), rows.schema[f.name].dataType
    if kind == f.dataType:
        return have
    if isinstance(f.dataType, T.DateType) and isinstance(kind, T.IntegralType):
        return date32(have.cast("long"))
    cast = have.try_cast(f.dataType.simpleString())
    try:
        rows.select(cast)
    except AnalysisException:  # no cast between such types
        return F.lit(None).cast(f.dataType)
    return cast


def unfit(rows: DataFrame, target: T.StructType) -> Column | None:
    """How many values of a row fitted() loses; None if no column needs to be fitted."""
    each = [f for f in target.fields if f.name in rows.columns and rows.schema[f.name].dataType != f.dataType]
    lost = [(F.col(f"`{f.name}`").isNotNull() & fitted(rows, f).isNull()).cast("long") for f in each]
    return reduce(Column.__add__, lost) if lost else None


def align(rows: DataFrame, target: T.StructType, computed: dict[str, str] | None = None) -> DataFrame:
    """The target's columns in its order: missing ones null, others dropped, names case-sensitive.

    Values that don't fit the target's type become null; unfit() counts them. computed: SQL expressions
    of generated columns, which never come from the rows.
    """
    computed = computed or {}
    plain = rows.select(*[(F.lit(None).cast(f.dataType) if f.name in computed else fitted(rows, f)).alias(f.name) for f in target.fields])
    for name, expression in computed.items():
        kind = next((f.dataType for f in target.fields if f.name == name), None)
        filled = F.expr(expression)
        plain = plain.withColumn(name, filled.cast(kind) if kind is not None else filled)
    return plain


def missing_columns(source: T.StructType, target: T.StructType) -> list[T.StructField]:
    """Fields of the source that the target lacks, in the source's order."""
    have = set(target.names)
    return [f for f in source.fields if f.name not in have]


def evolved(source: T.StructType, target: T.StructType) -> T.StructType:
    """The target with the source's new fields added, nullable."""
    return T.StructType([*target.fields, *[T.StructField(f.name, f.dataType, True) for f in missing_columns(source, target)]])


def not_null_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def snapshot_and_stream(snapshot: DataFrame, stream: DataFrame) -> DataFrame:
    """Snapshot rows ahead of the stream's; columns that one side lacks are null."""
    return snapshot.unionByName(stream, allowMissingColumns=True)
