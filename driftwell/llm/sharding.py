"""Operator 5, sharding: a uniform shuffle with exact shard sizes from a hypergeometric communication matrix.

Rows lie in P partitions. How many rows partition p sends to each target cell is drawn from the
multivariate hypergeometric law, so row sums are the partition sizes and column sums the exact cell
sizes, as under a uniform permutation of all rows. Each partition permutes its rows and deals them
out by its matrix row; each cell permutes what it gets. A shard is a run of cells, so slots are known
without a further count.
"""

from __future__ import annotations

import json
import math
import random
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a partition or cell, about, and the least and most of them. Only hashes of rows pass through them.
ROWS_EACH = 1_000_000
PARTITIONS = (128, 1024)
CELLS_PER_SHARD = (8, 32)
#: Ends of cells are looked up in runs of so many.
STEP = 32


def log_choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def hypergeometric(good: int, bad: int, drawn: int, rng: random.Random) -> int:
    """How many of `drawn` balls, taken without replacement, are among the `good`; inversion outward from the mode."""
    lo, hi = max(0, drawn - bad), min(good, drawn)
    if lo == hi:
        return lo
    mode = min(hi, max(lo, (drawn + 1) * (good + 1) // (good + bad + 2)))
    p = math.exp(log_choose(good, mode) + log_choose(bad, drawn - mode) - log_choose(good + bad, drawn))
    u = rng.random() - p
    up = down = mode
    p_up = p_down = p
    while u > 0 and (up < hi or down > lo):
        if up < hi:
            p_up *= (good - up) * (drawn - up) / ((up + 1) * (bad - drawn + up + 1))
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > lo:
            p_down *= down * (bad - drawn + down) / ((good - down + 1) * (drawn - down + 1))
            down -= 1
            u -= p_down
            if u <= 0:
                return down
    return mode


def communication_matrix(rows: list[int], columns: list[int], seed: int) -> list[list[int]]:
    """Counts with the given row and column sums, as a uniform permutation would give them."""
    if sum(rows) != sum(columns):
        raise ValueError("row and column sums differ")
    rng, left, matrix = random.Random(seed), list(columns), []
    for n in rows:
        rest, row = sum(left), []
        for j, c in enumerate(left):
            rest -= c
            x = hypergeometric(c, rest, n, rng)
            row.append(x)
            left[j] -= x
            n -= x
        matrix.append(row)
    return matrix


def even(total: int, parts: int) -> list[int]:
    """Sizes at most one apart."""
    return [total // parts + (i < total % parts) for i in range(parts)]


def between(n: int, limits: tuple[int, int]) -> int:
    return max(limits[0], min(limits[1], n))


def shard_rows(docs: DataFrame, shards: int = 40, seed: int = 20261, key: tuple[str, ...] = ("doc_id", "text"), partitions: int | None = None, cells: int | None = None) -> DataFrame:
    """docs with shard (int, 0 to shards - 1) and slot (long, from 0 without gaps in each shard).

    Shard sizes differ by one row at most. The result depends on `key`, seed and the counts only, not on
    how Spark split the input, so a lost task gives the same rows again. The two permutations and their
    exchanges are of 64-bit row hashes; the rows themselves move once, when they get their places. Rows
    equal in all of `key` have one hash and get its places in any order; these places are one list, so `key`
    should tell all but some rows apart. Nulls hash like any value.
    The driver gets one count a partition. An empty table gives an empty table.
    Columns of docs called shard or slot are replaced. docs must give the same rows when read again.

    partitions, cells (a shard): by default one for about ROWS_EACH rows, within fixed limits.
    """
    docs = docs.drop("shard", "slot")
    p = "__"  # before the names of helping columns
    while any(c.startswith(p) for c in docs.columns):
        p += "_"
    total = docs.count()
    partitions = partitions or between(total // ROWS_EACH, PARTITIONS)
    cells = cells or between(total // (shards * ROWS_EACH), CELLS_PER_SHARD)
    row_hash = F.xxhash64(F.lit(seed), *[docs[c] for c in key])
    hashes = docs.select(row_hash.alias("__h")).withColumn("__part", F.pmod("__h", F.lit(partitions)).cast("int"))
    counts = {r["__part"]: r["n"] for r in hashes.groupBy("__part").agg(F.count("*").alias("n")).collect()}
    rows = [counts.get(p, 0) for p in range(partitions)]
    sizes = [x for n in even(sum(rows), shards) for x in even(n, cells)]
    ends = [list(accumulate(row)) for row in communication_matrix(rows, sizes, seed)]
    starts = [at for s in range(shards) for at in [0, *accumulate(sizes[s * cells : (s + 1) * cells])][:-1]]
    # the cell of a rank: first by every STEP-th end, then by the ends up to the next of these
    marks = F.from_json(F.lit(json.dumps([row[STEP - 1 :: STEP] for row in ends])), "array<array<bigint>>")
    table = F.from_json(F.lit(json.dumps(ends)), "array<array<bigint>>")
    offsets = F.from_json(F.lit(json.dumps(starts)), "array<bigint>")
    # first permutation: within the partition; the rank falls into one cell of the partition's matrix row
    local = Window.partitionBy("__part").orderBy(F.xxhash64("__h", F.lit(1)), "__h")
    ranked = hashes.withColumn("__rank", F.row_number().over(local).cast("long"))
    passed = lambda ends: F.size(F.filter(ends, lambda end: end < F.col("__rank")))
    ranked = ranked.withColumn("__mark", passed(F.get(marks, F.col("__part"))) * STEP)
    dealt = ranked.withColumn("__cell", F.col("__mark") + passed(F.slice(F.get(table, F.col("__part")), F.col("__mark") + 1, STEP)))
    # second permutation: within the cell
    within = Window.partitionBy("__cell").orderBy(F.xxhash64("__h", F.lit(2)), "__h")
    slot = (F.get(offsets, F.col("__cell")) + F.row_number().over(within) - 1).cast("long").alias("slot")
    placed = dealt.select(F.col("__h").alias(f"{p}h"), F.floor(F.col("__cell") / cells).cast("int").alias("shard"), slot)
    places = placed.groupBy(f"{p}h").agg(F.sort_array(F.collect_list(F.struct("shard", "slot"))).alias(f"{p}places"))
    # rows of one hash take its places in turn
    turn = Window.partitionBy(f"{p}h").orderBy(key[0])
    taken = docs.withColumn(f"{p}h", row_hash).join(places, f"{p}h").withColumn(f"{p}place", F.get(f"{p}places", F.row_number().over(turn) - 1))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(f"{p}place.shard").alias("shard"), F.col(f"{p}place.slot").alias("slot"))
