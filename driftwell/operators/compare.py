"""Comparing large tables: ranges of equal row counts, and a tree of checksums that finds what differs."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.scratch import folder
from .verify import canonical_row, differences, hash_sums

#: Bits of the key by which a range is split at a time; rows of a range that are compared row by row.
LEVEL_BITS, LEAF_ROWS = 8, 100_000
#: Ranges whose bounds are put into the scan's filter.
FEW = 64
#: monotonically_increasing_id(): a partition's number lies above so many bits.
ID_BITS = 33


def kept(df: DataFrame, tag: str) -> DataFrame:
    path = folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def equal_ranges(rows: DataFrame, key: list[str], size: int, tasks: int | None = None) -> DataFrame:
    """(place, lo, hi): ranges that hold `size` rows each, the last one fewer, whatever the key's type and distribution.

    lo and hi are structs of the key columns; a range goes from lo up to hi, which belongs to the next one, and hi of the
    last is null. Keys are sorted once over all tasks and counted by task; a key's rank is its place
    in its task and the rows of the tasks before. Of a key that is no unique one, all rows are in one range. Rows with a null in the key come first.
    """
    return range_starts(rows, key, size, tasks)[0].select("place", "lo", F.lead("lo").over(Window.orderBy("place")).alias("hi"))  # a row a range


def range_starts(rows: DataFrame, key: list[str], size: int, tasks: int | None = None) -> tuple[DataFrame, int]:
    """(place, lo, rank) of the ranges of equal_ranges(), and the number of rows. rank: rows before the first one of lo's."""
    sorted_ = rows.select(F.struct(*key).alias("k"))
    sorted_ = sorted_.repartitionByRange("k") if tasks is None else sorted_.repartitionByRange(tasks, "k")
    placed = kept(sorted_.sortWithinPartitions("k").withColumn("id", F.monotonically_increasing_id()), "ranked-keys")
    task, at = F.shiftright("id", ID_BITS), F.col("id").bitwiseAND((1 << ID_BITS) - 1)
    counts = [(r["task"], r["n"]) for r in placed.groupBy(task.alias("task")).agg(F.count("*").alias("n")).orderBy("task").collect()]  # a row a task
    before, total = [], 0
    for t, n in counts:
        before.append((t, total))
        total += n
    offsets = rows.sparkSession.createDataFrame(before, "task long, before long")
    ranked = placed.join(F.broadcast(offsets), task == F.col("task")).select("k", (F.col("before") + at).alias("rank"))
    # ranges that begin with one and the same key are joined, so places may have gaps
    keys = ranked.groupBy("k").agg(F.min("rank").alias("rank"), F.max("rank").alias("last")).withColumn("place", F.expr(f"(rank + {size - 1}) div {size}"))
    return kept(keys.where(F.col("place") * size <= F.col("last")).select("place", F.col("k").alias("lo"), "rank"), "range-starts"), total


def range_counts(rows: DataFrame, key: list[str], size: int, tasks: int | None = None) -> DataFrame:
    """(place, lo, n): the ranges of equal_ranges() with the number of rows that each holds.

    Rows of a range are those from its first rank up to the next range's, so ranks tell the numbers; no row looks for its range.
    """
    order, total = range_starts(rows, key, size, tasks)
    after = F.coalesce(F.lead("rank").over(Window.orderBy("place")), F.lit(total))  # a row a range
    return order.select("place", "lo", (after - F.col("rank")).alias("n"))


def within(key: list[str], lo, hi) -> Column:
    """Rows of a range of equal_ranges(); lo and hi: its structs as rows, hi None for the last."""
    this = F.struct(*key)
    bound = lambda row: F.struct(*[F.lit(v).alias(k) for k, v in zip(key, row)])
    above = (this >= bound(lo)) if None not in tuple(lo) else F.lit(True)
    return above if hi is None else above & (this < bound(hi))


@dataclass
class Shipped:
    """What a comparison has moved: rows that were compared one by one, of how many, by level the ranges that differed."""

    rows: int = 0
    total: int = 0
    levels: list[int] = field(default_factory=list)


def tree_differences(source: DataFrame, target: DataFrame, key: list[str], leaf_rows: int = LEAF_ROWS, bits: int = LEVEL_BITS) -> tuple[DataFrame, Shipped]:
    """differences(), and what it took: only rows of ranges whose checksums differ are sent.

    Both sides are cut into 2 ** bits ranges of the key and summed up, a row a range and side. Ranges that differ are cut again
    as long as they hold more than leaf_rows, and of such a pass only their rows are read; of smaller ones
    the rows are compared. A single whole-number key is cut by its values, so that filters on it reach the scan; any other by its hash.
    """
    target = target.select(*source.columns)
    shipped, found = Shipped(), []
    whole = len(key) == 1 and isinstance(source.schema[key[0]].dataType, T.IntegralType)
    least, top = 0, 63
    if whole:
        ends = source.select(key[0]).unionByName(target.select(key[0])).agg(F.min(key[0]).cast("long").alias("a"), F.max(key[0]).cast("long").alias("b")).first()
        least, top = ends["a"] or 0, max(1, ((ends["b"] or 0) - (ends["a"] or 0)).bit_length())
    number = F.col(key[0]).cast("long") - F.lit(least) if whole else F.shiftrightunsigned(F.xxhash64(*key), 1)
    place = lambda shift: F.coalesce(F.shiftright(number, shift), F.lit(-1))  # noqa: E731  null keys are a range of their own
    open_, shift, level = None, top, 0

    def part(side: DataFrame, ranges: DataFrame | None, at: int) -> DataFrame:
        """Rows of the ranges, which are prefixes of the key above `at` bits."""
        if ranges is None:
            return side
        n = ranges.count()
        if whole and n <= FEW:
            each = [r["p"] for r in ranges.select("p").collect()]
            bounds = [F.col(key[0]).isNull() if p < 0 else F.col(key[0]).between(least + (p << at), min(least + ((p + 1) << at) - 1, (1 << 63) - 1)) for p in each]
            return side.where(reduce(Column.__or__, bounds, F.lit(False)))
        return side.withColumn("p", place(at)).join(ranges.select("p"), "p", "left_semi").drop("p")

    while True:
        above, shift, level = shift, max(0, shift - bits), level + 1
        sums = lambda side, tag: part(side, open_, above).select(place(shift).alias("p"), F.md5(canonical_row(side.schema)).alias("hash")).groupBy("p").agg(*hash_sums()).toDF("p", *[f"{tag}{c}" for c in "nabcd"])
        both = sums(source, "s").join(sums(target, "t"), "p", "full_outer")
        unlike = reduce(Column.__or__, [~F.col(f"s{c}").eqNullSafe(F.col(f"t{c}")) for c in "nabcd"])
        rows = F.coalesce("sn", F.lit(0)) + F.coalesce("tn", F.lit(0))
        if level == 1:
            both = kept(both, "tree-sums")
            shipped.total = both.agg(F.coalesce(F.sum(rows), F.lit(0)).alias("n")).first()["n"]
        differ = kept(both.where(unlike).select("p", rows.alias("n")), "tree-level")
        leaves = differ.where((F.col("n") <= leaf_rows) | F.lit(shift == 0))
        n = differ.agg(F.count("*").alias("ranges"), F.coalesce(F.sum(F.when((F.col("n") <= leaf_rows) | F.lit(shift == 0), F.col("n"))), F.lit(0)).alias("rows")).first()
        shipped.levels.append(n["ranges"])
        shipped.rows += n["rows"]
        found.append(differences(part(source, leaves, shift), part(target, leaves, shift), key))
        open_ = differ.where((F.col("n") > leaf_rows) & F.lit(shift > 0))
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, found), shipped
