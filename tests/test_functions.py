"""Value conversions: limits, zones, texts."""

import decimal
import struct

import pytest
from pyspark.sql import functions as F

from driftwell.functions import temporal as t
from driftwell.functions import values as v


def one(spark, column, **given):
    row = spark.range(1).select(*[F.lit(x).alias(k) for k, x in given.items()])
    return row.select(column.alias("x")).first()["x"]


MS = 1_640_995_260_000  # 2022-01-01 00:01:00


@pytest.mark.parametrize(
    ("ms", "zone", "wide", "text"),
    [
        (MS, "UTC", True, "2022-01-01 00:01:00.000"),
        (MS, "America/Chicago", True, "2021-12-31 18:01:00.000"),
        (MS, "America/Los_Angeles", True, "2021-12-31 16:01:00.000"),
        (MS, "UTC", False, "2022-01-01 00:01:00"),
        (-315_619_140_000, "UTC", False, "1970-01-01 00:00:00"),
        (-315_619_140_000, "UTC", True, "1960-01-01 00:01:00.000"),
        (10_066_723_260_000, "UTC", True, "2289-01-01 00:01:00.000"),
        (10_066_723_260_000, "UTC", False, "2106-02-07 06:28:15"),
        (10_066_723_260_000, "America/Chicago", False, "2106-02-07 00:28:15"),
        (99_999_999_999_999, "UTC", True, "2299-12-31 23:59:59.999"),
        (9_223_372_036_854_775_807, "UTC", True, "2299-12-31 23:59:59.999"),
        (None, "UTC", True, None),
    ],
)
def test_milli_timestamp(spark, ms, zone, wide, text):
    assert one(spark, t.milli_timestamp(F.col("ms"), zone, wide), ms=ms if ms is not None else F.lit(None).cast("long")) == text


@pytest.mark.parametrize(
    ("us", "zone", "text"),
    [
        (MS * 1000 + 222222, "UTC", "2022-01-01 00:01:00.22222200"),
        (-9_000_000_000_000_000, "UTC", "1900-01-01 00:00:00.00000000"),
        (-9_000_000_000_000_000, "America/Chicago", "1899-12-31 18:00:00.00000000"),
        (90_000_000_000_000_000, "America/Chicago", "2299-12-31 17:59:59.99999999"),
        (-1, "UTC", "1969-12-31 23:59:59.99999900"),
    ],
)
def test_micro_timestamp(spark, us, zone, text):
    assert one(spark, t.micro_timestamp(F.col("us"), zone), us=us) == text


@pytest.mark.parametrize(
    ("iso", "text"),
    [("2021-12-31T19:01:00Z", "2021-12-31 19:01:00.000000"), ("2038-01-19T03:14:07.99Z", "2038-01-19 03:14:07.990000"), ("2338-01-19T03:14:07Z", "2299-12-31 23:59:59.000000"), ("2021-12-31T19:01:00", "2021-12-31 19:01:00.000000"), ("2021-12-31T19:01:00+02:00", "2021-12-31 17:01:00.000000"), ("nonsense", ""), ("", "")],
)
def test_zoned_timestamp(spark, iso, text):
    assert one(spark, t.zoned_timestamp(F.col("iso")), iso=iso) == text


def test_zoned_value_is_null_when_unreadable(spark):
    assert one(spark, t.zoned_value(F.col("iso")), iso="nonsense") is None


@pytest.mark.parametrize(("us", "text"), [(32_461_000_000, "09:01:01.000000"), (86_400_000_001, "00:00:00.000001"), (-1, "23:59:59.999999")])
def test_micro_time(spark, us, text):
    assert one(spark, t.micro_time(F.col("us")), us=us) == text


@pytest.mark.parametrize(("days", "wide", "narrow"), [(-16436, "1925-01-01", "1970-01-01"), (120529, "2299-12-31", "2149-06-06"), (8249, "1992-08-02", "1992-08-02"), (10**6, "2299-12-31", "2149-06-06"), (-(10**6), "1900-01-01", "1970-01-01")])
def test_dates(spark, days, wide, narrow):
    assert str(one(spark, t.date32(F.col("d")), d=days)) == wide
    assert str(one(spark, t.date16(F.col("d")), d=days)) == narrow


@pytest.mark.parametrize(("text", "short"), [("2022-01-01 11:50:00.000", "2022-01-01 11:50:00"), ("2022-01-01 11:50:00.001", "2022-01-01 11:50:00.001"), ("2022-01-01 11:50:00.010", "2022-01-01 11:50:00.01"), ("2022-01-01 11:50:00.100", "2022-01-01 11:50:00.1")])
def test_strip_zeros(spark, text, short):
    assert one(spark, t.strip_zeros(F.col("x")), x=text) == short


@pytest.mark.parametrize("n", [0, 1, -1, 12345, -12345, 2**62, -(2**100), 10**30])
@pytest.mark.parametrize("scale", [0, 2, 7])
def test_variable_decimal(spark, n, scale):
    from decimal import Decimal

    raw = n.to_bytes((n.bit_length() // 8) + 1, "big", signed=True)
    expected = Decimal(n).scaleb(-scale)
    got = one(spark, v.variable_decimal(F.unhex(F.col("h")), F.lit(scale)), h=raw.hex())
    assert got == (expected if abs(expected) < 10**20 else None)


def test_variable_decimal_null(spark):
    assert one(spark, v.variable_decimal(F.lit(None).cast("binary"), F.lit(2))) == 0


def test_bytes(spark):
    assert one(spark, v.bytes_hex(F.unhex(F.lit("00FFAB")))) == "00ffab"
    assert one(spark, v.bytes_text(F.unhex(F.lit("616263")))) == "abc"
    assert one(spark, v.bytes_text(F.unhex(F.lit("FF00")))) == "ff00"
    assert bytes(one(spark, v.bytes_text(F.unhex(F.lit("FF00")), raw=True))) == b"\xff\x00"


def test_polygons(spark):
    ring = [(0.0, 0.0), (1.5, 0.0), (1.5, 2.0), (0.0, 0.0)]
    for order, mark in (("<", 1), (">", 0)):
        raw = bytes([mark]) + struct.pack(f"{order}II", 3, 1) + struct.pack(f"{order}I", 4) + struct.pack(f"{order}8d", *[x for p in ring for x in p])
        assert [[(p["x"], p["y"]) for p in r] for r in v.wkb_rings(raw)] == [ring]
        assert v.wkb_rings(raw[:-3]) == []
    assert v.wkb_rings(None) == v.wkb_rings(b"") == v.wkb_rings(b"\x01\x01\x00\x00\x00") == []
    got = spark.createDataFrame([(bytearray(raw),), (None,)], "w binary").select(v.polygon(F.col("w")).alias("p")).collect()
    assert [len(r.p) for r in got] == [1, 0]


def test_points(spark):
    assert tuple(one(spark, v.point(F.lit(None).cast("struct<x: double, y: double>")))) == (0.0, 0.0)


def test_names_zones_and_servers():
    assert v.valid_database("shop_1") and v.valid_database("_a.b") and not v.valid_database("1a") and not v.valid_database("a" * 64) and not v.valid_database("a-b")
    assert v.zone_of_offset("+02:00") == "Etc/GMT-2" and v.zone_of_offset("-05:00") == "Etc/GMT+5" and v.zone_of_offset("+00:00") == "UTC"
    assert v.zone_of_offset("+05:30") in ("Asia/Calcutta", "Asia/Colombo", "Asia/Kolkata")
    with pytest.raises(ValueError):
        v.zone_of_offset("+05:31")
    assert v.server_at_least("23.2.1") and v.server_at_least("24.1") and not v.server_at_least("22.8.9")
    assert v.resolve_zone("America/Chicago") == "America/Chicago" and v.resolve_zone("Mars/One") == "UTC" and v.resolve_zone("") == "UTC"


@pytest.mark.parametrize(
    ("text", "parts"),
    [
        ("ReplacingMergeTree(_version, is_deleted) ORDER BY id SETTINGS index_granularity = 8192", ("replacing", "_version", "is_deleted")),
        ("ReplacingMergeTree(_version) PARTITION BY toYYYYMM(d) ORDER BY (a, b)", ("replacing", "_version", None)),
        ("ReplicatedReplacingMergeTree('/tables/{shard}/t', '{replica}', `_version`, is_deleted) ORDER BY id", ("replacing", "_version", "is_deleted")),
        ("CollapsingMergeTree(sign) ORDER BY id", ("collapsing", "sign", None)),
        ("MergeTree ORDER BY id", ("append", None, None)),
        ("Memory", ("default", None, None)),
    ],
)
def test_engines(text, parts):
    assert v.parse_engine(text) == parts


def test_format_decimal(spark):
    assert one(spark, v.format_decimal(F.lit("12.5"), 3)) == "12.500" and one(spark, v.format_decimal(F.lit(7), 2)) == "7.00"


def test_wire_types(spark):
    from driftwell.plans import types as w

    assert w.spark_type(w.Wire("a", "BYTES", "x.Decimal", 65, 30)) == "string" and w.spark_type(w.Wire("a", "BYTES"), raw_bytes=True) == "binary"
    assert w.spark_type(w.Wire("a", "ARRAY", element="INT32")) == "array<int>" and w.spark_type(w.Wire("a", "FLOAT64")) == "double"
    for bad in (w.Wire("a", "INT32", "x.Interval"), w.Wire("a", "UNION")):
        with pytest.raises(ValueError):
            w.spark_type(bad)
    assert w.row_fields([w.Wire("id", "INT64", optional=False), w.Wire("d", "INT32", "x.Date")]) == "`id` bigint NOT NULL, `d` date"
    rows = spark.sql("SELECT 1640995260000000L AS a, 90000000000000000L AS b, 1640995260000L AS c, named_struct('value', unhex('FB2E'), 'scale', 1) AS d, unhex('0A') AS e, 3723000 AS f")
    fields = [w.Wire("a", "INT64", "x.MicroTimestamp"), w.Wire("b", "INT64", "x.MicroTimestamp"), w.Wire("c", "INT64", "x.Timestamp"), w.Wire("d", "STRUCT", "x.VariableScaleDecimal"), w.Wire("e", "BYTES", "x.Bits"), w.Wire("f", "INT32", "x.Time")]
    r = w.typed_rows(rows, fields, zone="America/Chicago").first()
    assert (str(r.a), str(r.b), str(r.c), float(r.d), r.e, r.f) == ("2021-12-31 18:01:00", "2299-12-31 17:59:59", "2021-12-31 18:01:00", -123.4, "0a", "01:02:03.000000")


@pytest.mark.parametrize("n", [10**36, -(10**36), 10**37 + 7, -(10**38) + 1, 10**38 - 1, -1, -(2**127), 2**119 + 5])
def test_wide_variable_decimals(spark, n):
    from decimal import Decimal

    raw = n.to_bytes((n.bit_length() + 8) // 8, "big", signed=True)
    got = one(spark, v.variable_decimal(F.unhex(F.col("h")), F.lit(0), "decimal(38,0)"), h=raw.hex())
    assert got == (Decimal(n) if abs(n) < 10**38 else None)
    scaled = one(spark, v.variable_decimal(F.unhex(F.col("h")), F.lit(18)), h=raw.hex())
    assert scaled == (Decimal(f"{n}E-18") if abs(n) < 10**38 else None)


@pytest.mark.parametrize("n, scale", [(127, 0), (-128, 3), (-(2**63), 18), (2**63 - 1, 2), (2**63, 2), (-(2**63) - 1, 5), (5, 19), (12, -2), (-(2**70), -3)])
def test_variable_decimal_digits_are_made_once(spark, n, scale):
    """Of 8 bytes and just above, of scales beyond the target's and below 0; the plan has the digits of a number once, however long it is."""
    raw = n.to_bytes(n.bit_length() // 8 + 1, "big", signed=True)
    exact = decimal.Decimal(n).scaleb(-scale, decimal.Context(prec=60)).quantize(decimal.Decimal(1).scaleb(-18), decimal.ROUND_HALF_UP, decimal.Context(prec=60))
    df = spark.createDataFrame([(bytearray(raw),)], "raw binary").select(v.variable_decimal(F.col("raw"), F.lit(scale)).alias("x"))
    assert df.first()["x"] == (exact if abs(exact) < 10**20 else None)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("conv(") <= 5
