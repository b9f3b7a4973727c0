"""Bytes, decimals, geometry, JSON and identifiers."""

from __future__ import annotations

import re
import struct as binary
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

RINGS = "array<array<struct<x:double,y:double>>>"


def bytes_hex(value: Column) -> Column:
    """Lower-case hex digits of binary."""
    return F.lower(F.hex(value))


def bytes_text(value: Column, raw: bool = False) -> Column:
    """raw: the bytes themselves; else their UTF-8 text, or hex digits if they aren't UTF-8."""
    return value if raw else F.when(F.is_valid_utf8(value.cast("string")), value.cast("string")).otherwise(bytes_hex(value))


def variable_decimal(unscaled: Column, scale: Column, target: str = "decimal(38,18)") -> Column:
    """Big-endian two's complement of up to 20 bytes with a scale; null beyond the target's range, 0 for null bytes.

    The scale is the exponent of a number's text, so that the digits are made once; up to 8 bytes they are those of a bigint.
    """
    hexed, size = F.hex(unscaled), F.octet_length(unscaled)
    negative = F.substring(hexed, 1, 1).isin(*"89ABCDEF")
    small = F.conv(F.lpad(hexed, 16, F.when(negative, "F").otherwise("0")), 16, -10)
    # of a negative number the inverted bits are one less than its magnitude
    digits = F.lpad(F.when(negative, F.translate(hexed, "0123456789ABCDEF", "FEDCBA9876543210")).otherwise(hexed), 40, "0")
    whole = lambda c: c.cast("decimal(38,0)")
    part = lambda at: whole(F.conv(F.substring(digits, at, 10), 16, 10))
    magnitude = whole(F.when(negative, F.lit(1)).otherwise(F.lit(0)))
    for i in range(4):
        magnitude = F.try_add(magnitude, F.try_multiply(part(31 - 10 * i), whole(F.lit(str(2 ** (40 * i))))).try_cast("decimal(38,0)")).try_cast("decimal(38,0)")
    number = F.when(size <= 8, small).when(size <= 20, F.concat(F.when(negative, F.lit("-")).otherwise(F.lit("")), magnitude.cast("string")))
    signed = F.concat(number, F.lit("E"), (-scale).cast("string"))
    return F.when(unscaled.isNull() | (size == 0), F.lit(0).cast(target)).otherwise(signed.try_cast(target))


def point(value: Column) -> Column:
    """struct(x, y) of a point struct, the origin for null."""
    zero = F.lit(0.0)
    return F.struct(F.coalesce(value.getField("x").cast("double"), zero).alias("x"), F.coalesce(value.getField("y").cast("double"), zero).alias("y"))


def wkb_rings(raw: bytes | None) -> list[list[dict[str, float]]]:
    """Rings of a WKB polygon (with or without an SRID); [] for anything else."""
    try:
        order = "<" if raw[0] else ">"
        kind, at = binary.unpack_from(f"{order}I", raw, 1)[0], 5
        if kind & 0x20000000:
            at += 4
        if kind & 0xFF != 3:
            return []
        rings, at = binary.unpack_from(f"{order}I", raw, at)[0], at + 4
        out = []
        for _ in range(rings):
            n, at = binary.unpack_from(f"{order}I", raw, at)[0], at + 4
            flat = binary.unpack_from(f"{order}{2 * n}d", raw, at)
            at += 16 * n
            out.append([{"x": x, "y": y} for x, y in zip(flat[::2], flat[1::2])])
        return out
    except (TypeError, IndexError, binary.error):
        return []


def polygon(wkb: Column) -> Column:
    """Rings of WKB polygons; Spark has no WKB reader by default, so this is an Arrow-batched UDF."""

    def rings(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(wkb_rings)

    return F.pandas_udf(rings, RINGS)(wkb)


def json_field(value: Column, path: str) -> Column:
    return F.get_json_object(value, path)


def raw_json(*columns: str) -> Column:
    """The row as JSON, nulls left out."""
    return F.to_json(F.struct(*columns))


DATABASE_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.]{0,62}")


def valid_database(name: str) -> bool:
    """At most 63 characters: a letter or _, then letters, digits, _ or dots."""
    return DATABASE_NAME.fullmatch(name) is not None


def zone_of_offset(offset: str) -> str:
    """A zone of an offset such as +02:00: of whole hours the Etc one (its sign is reversed there), else the first by name that has it at the start of 2024."""
    from datetime import datetime, timedelta
    from zoneinfo import ZoneInfo, available_timezones

    m = re.fullmatch(r"([+-])(\d\d):(\d\d)", offset)
    if not m or int(m[2]) > 14 or int(m[3]) > 59:
        raise ValueError(f"not an offset: {offset}")
    hours = int(m[2])
    if m[3] != "00":
        wanted, at = timedelta(hours=hours, minutes=int(m[3])) * (1 if m[1] == "+" else -1), datetime(2024, 1, 1)
        found = next((z for z in sorted(available_timezones()) if ZoneInfo(z).utcoffset(at) == wanted), None)
        if found is None:
            raise ValueError(f"no zone has the offset {offset}")
        return found
    return "UTC" if not hours else f"Etc/GMT{'-' if m[1] == '+' else '+'}{hours}"


def server_at_least(version: str, least: tuple[int, int] = (23, 2)) -> bool:
    """Whether a dotted version is new enough for delete flags in the replacing engine."""
    parts = [int(x) for x in re.findall(r"\d+", version)[:2]]
    return tuple(parts) >= least


def resolve_zone(user: str | None, server: str = "UTC") -> str:
    """The user's zone if it is one, else the server's."""
    from zoneinfo import ZoneInfo

    try:
        return ZoneInfo(user).key if user else server
    except Exception:
        return server


def format_decimal(value: Column, scale: int) -> Column:
    """Text with exactly `scale` fraction digits."""
    return value.cast(f"decimal(38,{scale})").cast("string")


ENGINE = re.compile(r"(?:Replicated)?(Replacing|Collapsing|)MergeTree(?:\((.*)\))?", re.DOTALL)


def parse_engine(text: str) -> tuple[str, str | None, str | None]:
    """(engine, version or sign column, delete column) of an engine's text; paths and replica names are passed over."""
    m = ENGINE.match(text.strip())
    if not m:
        return "default", None, None
    depth, inside = 1, m[2] or ""
    for i, c in enumerate(inside):  # up to the parenthesis that closes the arguments
        depth += (c == "(") - (c == ")")
        if not depth:
            inside = inside[:i]
            break
    names = [x.strip(" `") for x in inside.split(",") if x.strip() and "'" not in x]
    kind = {"Replacing": "replacing", "Collapsing": "collapsing", "": "append"}[m[1]]
    return kind, names[0] if names else None, names[1] if len(names) > 1 else None
