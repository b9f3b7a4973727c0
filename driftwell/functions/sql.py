"""The engine in plain SQL: functions for a session, and views of tables and positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.versions import GTID_BITS, SNOWFLAKE_EPOCH, TIME_BITS
from ..plans.tables import Warehouse
from ..streaming.offsets import status

#: Most fraction digits of format_decimal() in SQL; a type's scale has to be a constant there.
MOST_SCALE = 18


def functions() -> dict[str, str]:
    """Name and definition of each function."""
    scales = " ".join(f"WHEN {n} THEN CAST(CAST(value AS DECIMAL(38,{n})) AS STRING)" for n in range(MOST_SCALE + 1))
    time = f"(ts_ms - {SNOWFLAKE_EPOCH}L) & {(1 << TIME_BITS) - 1}L"
    return {
        "format_decimal": f"(value DECIMAL(38,{MOST_SCALE}), scale INT) RETURNS STRING RETURN CASE scale {scales} END",
        "snowflake_version": f"(ts_ms BIGINT, number BIGINT) RETURNS BIGINT RETURN shiftleft({time}, {GTID_BITS}) | (number & {(1 << GTID_BITS) - 1}L)",
        "transaction_number": "(gtid STRING) RETURNS BIGINT RETURN CASE WHEN size(split(gtid, ':')) = 2 THEN try_cast(split(gtid, ':')[1] AS BIGINT) WHEN gtid RLIKE '^[0-9]+-[0-9]+-[0-9]+$' THEN try_cast(split(gtid, '-')[2] AS BIGINT) END",
        "row_digest": "(line STRING) RETURNS ARRAY<BIGINT> RETURN transform(sequence(0, 3), i -> CAST(conv(substring(md5(line), 1 + 8 * i, 8), 16, 10) AS BIGINT))",
    }


def register(spark: SparkSession, warehouse: Warehouse | None = None, offsets: DataFrame | None = None, prefix: str = "") -> list[str]:
    """Temporary functions, a view `database_table` of the state of each table, and replica_status of stored positions; their names.

    A view is planned anew whenever it is read, over the runs that were there when it was registered.
    """
    names = []
    for name, definition in functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}{definition}")
        names.append(f"{prefix}{name}")
    for db in warehouse.databases() if warehouse is not None else []:
        for table in warehouse.tables(db):
            warehouse.state(warehouse.load(db, table)).createOrReplaceTempView(f"{prefix}{db}_{table}")
            names.append(f"{prefix}{db}_{table}")
    if offsets is not None:
        status(offsets, F.unix_timestamp()).createOrReplaceTempView(f"{prefix}replica_status")
        names.append(f"{prefix}replica_status")
    return names
