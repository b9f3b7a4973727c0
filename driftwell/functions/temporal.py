"""Epoch numbers and ISO texts to clamped, zone-shifted texts.

Everything is computed on zoneless timestamps, so the session time zone plays no part. Values are
clamped before the zone shift. A null stays null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits of the target types, in seconds or days since 1970-01-01.
DATETIME32 = (0, 4294967295)  # to 2106-02-07 06:28:15
DATETIME64 = (-2208988800, 10413791999)  # 1900-01-01 00:00:00 to 2299-12-31 23:59:59
FAR_MILLIS = (-(10**15), 10**15)  # beyond every limit, and still safe to multiply
DATE16 = (0, 65535)  # to 2149-06-06
DATE32 = (-25567, 120529)  # 1900-01-01 to 2299-12-31

MILLION = 1_000_000
DAY_MICROS = 86_400 * MILLION
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def zoneless(micros: Column) -> Column:
    """Microseconds since the epoch as TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", micros, F.expr(EPOCH))


def epoch_micros(ts: Column) -> Column:
    """TIMESTAMP_NTZ as microseconds since the epoch."""
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH), ts)


def whole_seconds(micros: Column) -> Column:
    # the dividend is a multiple of a million below 2 ** 59, so the division of doubles is exact
    return ((micros - F.pmod(micros, F.lit(MILLION))) / F.lit(MILLION)).cast("long")


def seconds_text(seconds: Column, zone: str = "UTC") -> Column:
    """yyyy-MM-dd HH:mm:ss in the zone."""
    ts = F.timestamp_add("SECOND", seconds, F.expr(EPOCH))
    return (ts if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)).cast("string")


def clamped(value: Column, limits: tuple[int, int], scale: int = 1) -> Column:
    """value within limits * scale; least() and greatest() would drop nulls."""
    lo, hi = (F.lit(x * scale).cast("long") for x in limits)
    return F.when(value < lo, lo).when(value > hi, hi).otherwise(value)


def micro_time(micros: Column) -> Column:
    """HH:mm:ss.SSSSSS; wraps around after 24 hours."""
    inside = F.pmod(micros, F.lit(DAY_MICROS))
    return F.concat(F.substring(seconds_text(whole_seconds(inside)), 12, 8), F.lit("."), fraction(inside))


def fraction(micros: Column) -> Column:
    """Six digits of the second's fraction."""
    return F.lpad(F.pmod(micros, F.lit(MILLION)).cast("string"), 6, "0")


def micro_timestamp(micros: Column, zone: str = "UTC", wide: bool = True) -> Column:
    """wide: the 64-bit type with 8 fraction digits; else the 32-bit type without any."""
    if not wide:
        return seconds_text(whole_seconds(clamped(micros, DATETIME32, MILLION)), zone)
    most = F.lit(DATETIME64[1] * MILLION + MILLION - 1)
    high = micros > most
    inside = F.when(high, most).otherwise(F.when(micros < DATETIME64[0] * MILLION, F.lit(DATETIME64[0] * MILLION)).otherwise(micros))
    digits = F.when(high, F.lit("99999999")).otherwise(F.concat(fraction(inside), F.lit("00")))
    return F.concat(seconds_text(whole_seconds(inside), zone), F.lit("."), digits)


def milli_timestamp(millis: Column, zone: str = "UTC", wide: bool = True) -> Column:
    """wide: the 64-bit type with 3 fraction digits; else the 32-bit type without any."""
    text = micro_timestamp(clamped(millis.cast("long"), FAR_MILLIS) * 1000, zone, wide)
    return F.substring(text, 1, 23) if wide else text


def zoned_timestamp(iso: Column, zone: str = "UTC") -> Column:
    """ISO text with up to seven fraction digits, with or without an offset (then of the zone), to six digits; '' if it can't be read."""
    has_zone = iso.rlike(r"(Z|z|[+-]\d\d:?\d\d)$")
    local = iso.try_cast("timestamp_ntz")
    here = epoch_micros(local if zone == "UTC" else F.convert_timezone(F.lit(zone), F.lit("UTC"), local))
    micros = F.when(has_zone, F.unix_micros(F.regexp_replace(iso, r"([+-]\d\d)(\d\d)$", "$1:$2").try_cast("timestamp"))).otherwise(here)
    inside = clamped(micros, DATETIME64, MILLION)
    text = F.concat(seconds_text(whole_seconds(inside), zone), F.lit("."), fraction(inside))
    return F.when(iso.isNull(), F.lit(None).cast("string")).otherwise(F.coalesce(text, F.lit("")))


def zoned_value(iso: Column) -> Column:
    """The same as a typed column: null if it can't be read."""
    return iso.try_cast("timestamp")


def date32(days: Column) -> Column:
    return F.date_from_unix_date(clamped(days, DATE32).cast("int"))


def date16(days: Column) -> Column:
    return F.date_from_unix_date(clamped(days, DATE16).cast("int"))


def strip_zeros(text: Column) -> Column:
    """Trailing zeros, then a trailing dot, removed."""
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))


def millis_text(millis: Column, zone: str = "UTC") -> Column:
    """Transport time as yyyy-MM-dd HH:mm:ss."""
    return seconds_text(whole_seconds(millis * 1000), zone)
