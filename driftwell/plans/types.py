"""Values as the capture sends them, by physical type and logical name, to Spark types.

Capture engines send a date as a number of days, a time as microseconds and so on; the schema beside the
value names the logical type. Logical names are matched by their last part, so any prefix will do.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import temporal as t
from ..functions import values as v

RINGS = v.RINGS
POINT = "struct<x:double,y:double>"
#: Spark type of physical types without a logical name. Fixed values.
PHYSICAL = {
    "INT8": "tinyint", "INT16": "smallint", "INT32": "int", "INT64": "bigint", "FLOAT32": "float", "FLOAT64": "double",
    "BOOLEAN": "boolean", "STRING": "string", "BYTES": "string", "ARRAY": "array<string>", "MAP": "map<string,string>",
}
#: Spark type of logical names. Fixed values.
LOGICAL = {
    "Date": "date", "Time": "string", "MicroTime": "string", "Timestamp": "timestamp_ntz", "MicroTimestamp": "timestamp_ntz",
    "ZonedTimestamp": "timestamp", "Bits": "string", "Enum": "string", "EnumSet": "string", "Json": "string", "Year": "int",
    "Geometry": RINGS, "Point": POINT, "Uuid": "string", "VariableScaleDecimal": "decimal(38,18)",
}
MOST_DIGITS = 38


@dataclass(frozen=True)
class Wire:
    """A field of a record's schema."""

    name: str
    physical: str
    logical: str = ""
    precision: int = 10
    scale: int = 2
    element: str = "STRING"
    optional: bool = True


def spark_type(f: Wire, raw_bytes: bool = False) -> str:
    """Type of the table's column; ValueError for a type that has no counterpart."""
    name = f.logical.rpartition(".")[2]
    if name == "Decimal":
        return f"decimal({f.precision},{f.scale})" if f.precision <= MOST_DIGITS else "string"
    if name:
        if name not in LOGICAL:
            raise ValueError(f"{f.name}: {f.logical} has no counterpart")
        return LOGICAL[name]
    if f.physical == "ARRAY":
        return f"array<{PHYSICAL[f.element]}>"
    if f.physical == "BYTES" and raw_bytes:
        return "binary"
    if f.physical not in PHYSICAL:
        raise ValueError(f"{f.name}: {f.physical} has no counterpart")
    return PHYSICAL[f.physical]


def typed(f: Wire, value: Column, zone: str = "UTC", raw_bytes: bool = False) -> Column:
    """The value as spark_type(); clamped where the target's range is narrower, null where it can't be read."""
    name = f.logical.rpartition(".")[2]
    shift = lambda ts: ts if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)
    if name == "Date":
        return t.date32(value)
    if name == "Time":
        return t.micro_time(value.cast("long") * 1000)
    if name == "MicroTime":
        return t.micro_time(value)
    if name == "Timestamp":
        return shift(t.zoneless(t.clamped(t.clamped(value.cast("long"), t.FAR_MILLIS) * 1000, t.DATETIME64, t.MILLION)))
    if name == "MicroTimestamp":
        return shift(t.zoneless(t.clamped(value, t.DATETIME64, t.MILLION)))
    if name == "ZonedTimestamp":
        return t.zoned_value(value)
    if name == "VariableScaleDecimal":
        return v.variable_decimal(value["value"], value["scale"])
    if name == "Point":
        return v.point(value)
    if name == "Geometry":
        return v.polygon(value["wkb"])
    if name == "Bits":
        return v.bytes_hex(value)
    if f.physical == "BYTES" and not name:
        return v.bytes_text(value, raw_bytes)
    return value.try_cast(spark_type(f, raw_bytes))


def typed_rows(rows: DataFrame, fields: list[Wire], zone: str = "UTC", raw_bytes: bool = False) -> DataFrame:
    return rows.select(*[typed(f, F.col(f"`{f.name}`"), zone, raw_bytes).alias(f.name) for f in fields])


def typed_image(image: Column, fields: list[Wire], zone: str = "UTC", raw_bytes: bool = False) -> Column:
    """A struct of values as sent as a struct of typed ones; fields that the struct lacks are null."""
    return F.when(image.isNotNull(), F.struct(*[typed(f, image[f.name], zone, raw_bytes).alias(f.name) for f in fields]))


def typed_records(records: DataFrame, fields: list[Wire], zone: str = "UTC", raw_bytes: bool = False) -> DataFrame:
    """Decoded records with typed images."""
    have = set(records.schema["row"].dataType.names)
    own = [f for f in fields if f.name in have]
    return records.withColumns({c: typed_image(F.col(c), own, zone, raw_bytes) for c in ("before", "after", "row")})


def row_fields(fields: list[Wire]) -> str:
    """The fields as a DDL string, for a descriptor or an envelope's row."""
    return ", ".join(f"`{f.name}` {spark_type(f)}{'' if f.optional else ' NOT NULL'}" for f in fields)


def from_avro(value: Column, schema: str) -> Column:
    """Avro values; Spark's Avro package must be on the class path."""
    from pyspark.sql.avro.functions import from_avro as read

    return read(value, schema)
