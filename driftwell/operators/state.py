"""From change records to table rows, and from the log of rows to the table's state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

VERSION, DELETED, SIGN, SEQ = "_version", "is_deleted", "_sign", "_seq"


def replacing_rows(records: DataFrame, version: Column, seq: Column, ignore_delete: bool = False, signed: bool = False) -> DataFrame:
    """One row a change with _version, _seq and is_deleted (or _sign: 1, and -1 for a delete).

    Truncates stay as rows with a null image; truncate_cut() applies them.
    """
    kept = records.where("operation <> 'DELETE'") if ignore_delete else records
    gone = F.col("operation") == "DELETE"
    mark = F.when(gone, -1).otherwise(1).alias(SIGN) if signed else gone.cast("int").alias(DELETED)
    return kept.select("*", version.alias(VERSION), seq.alias(SEQ), mark)


def collapsing_rows(records: DataFrame, version: Column, seq: Column) -> DataFrame:
    """Rows with _sign: +1 for an image that begins, -1 for one that ends; an update gives both."""
    row = lambda image, sign: F.struct(F.col(image).alias("image"), F.lit(sign).alias(SIGN))
    ends = F.when(F.col("operation").isin("UPDATE", "DELETE") & F.col("before").isNotNull(), row("before", -1))
    begins = F.when(F.col("operation").isin("CREATE", "UPDATE"), row("after", 1))
    each = records.withColumn("__part", F.explode(F.array_compact(F.array(ends, begins))))
    return each.select(*[c for c in records.columns if c != "row"], F.col("__part.image").alias("row"), F.col(f"__part.{SIGN}").alias(SIGN), version.alias(VERSION), seq.alias(SEQ))


def latest(log: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is last by `order`.

    An aggregate with max_by combines on the map side, so a key with very many versions ships one row a
    task; a window would ship and sort them all. Ties in `order` leave any of the tied rows.
    """
    rest = [c for c in log.columns if c not in key]
    best = log.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return best.select(*[F.col(c) if c in key else F.col("__row")[c].alias(c) for c in log.columns])


#: What a source sends in place of a long text that a change leaves as it is, a fixed value.
UNAVAILABLE = "__debezium_unavailable_value"


def _texts(log: DataFrame, key: list[str]) -> list[str]:
    return [f.name for f in log.schema.fields if f.name not in key and isinstance(f.dataType, StringType)]


def latest_by_column(log: DataFrame, key: list[str], order: list[str], missing: str = UNAVAILABLE) -> DataFrame:
    """latest(), but texts that an image leaves out come from the last image of the key that has them.

    A new row has all its texts, so none comes from a deleted row of the same key.
    """
    texts = _texts(log, key)
    rest = [c for c in log.columns if c not in key and c not in texts]
    there = lambda c: ~F.col(c).eqNullSafe(F.lit(missing))
    each = [F.max_by(F.when(there(c), F.struct(c)), F.when(there(c), F.struct(*order))).alias(c) for c in texts]
    best = log.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"), *each)
    return best.select(*[F.col(c) if c in key else F.col(c)[c].alias(c) if c in texts else F.col("__row")[c].alias(c) for c in log.columns])


def needed_by_column(log: DataFrame, key: list[str], order: list[str], missing: str = UNAVAILABLE) -> DataFrame:
    """The rows that latest_by_column() needs, with more rows to come: the last of each key, and the last that has each text."""
    row = F.struct(*[c for c in log.columns if c not in key])
    there = lambda c: ~F.col(c).eqNullSafe(F.lit(missing))
    each = [F.max_by(row, F.struct(*order)), *[F.max_by(F.when(there(c), row), F.when(there(c), F.struct(*order))) for c in _texts(log, key)]]
    found = log.groupBy(*key).agg(F.array_distinct(F.array_compact(F.array(*each))).alias("__rows"))
    return found.select(*key, F.explode("__rows").alias("__row")).select(*[F.col(c) if c in key else F.col("__row")[c].alias(c) for c in log.columns])


def final(log: DataFrame, key: list[str], version: str = VERSION, seq: str = SEQ, deleted: str | None = DELETED) -> DataFrame:
    """State of a replacing table: the row of highest (version, arrival) of each key, unless it is deleted.

    A table without a key only appends: it has no latest rows.
    """
    if not key:
        return log if deleted is None else log.where(F.col(deleted) == 0)
    best = latest(log, key, [version, seq])
    return best if deleted is None else best.where(F.col(deleted) == 0)


def live_by_sign(log: DataFrame, key: list[str], sign: str = SIGN) -> DataFrame:
    """State of a replacing table that marks deletes by sign."""
    return latest(log, key, [VERSION, SEQ]).where(F.col(sign) > 0)


def visible(rows: DataFrame, sign: str = SIGN) -> DataFrame:
    """What a row policy against deleted rows lets through."""
    return rows.where(F.col(sign) != -1)


def collapse(log: DataFrame, key: list[str], order: list[str], sign: str = SIGN) -> DataFrame:
    """State of a collapsing table: keys whose signs add up to more than 0, with their last begun row."""
    rest = [c for c in log.columns if c not in [*key, sign]]
    begun = F.max_by(F.when(F.col(sign) > 0, F.struct(*rest)), F.when(F.col(sign) > 0, F.struct(*order)))
    sums = log.groupBy(*key).agg(F.sum(sign).alias(sign), begun.alias("__row")).where(F.col(sign) > 0)
    return sums.select(*key, *[F.col("__row")[c].alias(c) for c in rest], sign)


def truncate_cut(log: DataFrame, operation: str = "operation", version: str = VERSION, seq: str = SEQ) -> DataFrame:
    """Rows after the last truncate of the log, by version and arrival."""
    last = log.where(F.col(operation) == "TRUNCATE").agg(F.max(F.struct(version, seq)).alias("__cut"))
    rows = log.where(F.col(operation).isNull() | (F.col(operation) != "TRUNCATE"))
    joined = rows.join(F.broadcast(last))  # one row
    return joined.where(F.col("__cut").isNull() | (F.struct(version, seq) > F.col("__cut"))).select(*log.columns)


def previous_image(rows: DataFrame, key: list[str], order: list[str], image: list[str]) -> DataFrame:
    """rows with `before`: the image of the key's event before."""
    return rows.withColumn("before", F.lag(F.struct(*image)).over(Window.partitionBy(*key).orderBy(*order)))


def last_of_batch(rows: DataFrame, batch: list[str], order: list[str]) -> DataFrame:
    """rows with is_last: whether it is the last of its batch."""
    return rows.withColumn("is_last", F.lead(F.lit(1)).over(Window.partitionBy(*batch).orderBy(*order)).isNull())
