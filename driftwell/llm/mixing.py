"""Operator 9, mixing sources to target weights: temperature mixing.

A source with token share p gets the weight p ** a, normalised. The exponent a between 0 (all sources
alike) and 1 (as found) is bisected: the largest that meets the target entropy, raised if need be until
no source is repeated more often than the limit. The weights are realised as budgeted block
permutations: each source's documents lie in blocks; every epoch runs through the blocks in an order of
its own, and the last epoch of a source ends where its budget of tokens does.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_scratch, scratch_mark, written

#: Rows of docs that one block of a source stands for, about, and the least number of blocks.
ROWS_A_BLOCK, LEAST_BLOCKS = 50_000, 256
#: Target entropy as a share of the largest possible, and most times that a source is read.
ENTROPY_SHARE = 0.9
MOST_REPEATS = 4.0
#: The interval of the exponent is cut into so many parts in each round; SECTIONS ** -ROUNDS is its final width.
SECTIONS, ROUNDS = 32, 5
WORD_COUNT = r"regexp_count(text, '[^\\x20\\x09-\\x0D]+')"


def exponent(totals: DataFrame, entropy_share: float, most_repeats: float) -> float:
    """The exponent for totals(tokens); each round is one aggregate over the sources."""
    facts = totals.agg(F.count("*").alias("n"), F.max("tokens").alias("most")).first()
    if facts["n"] <= 1:
        return 1.0
    most, goal = float(facts["most"]), entropy_share * math.log(facts["n"])
    lo, hi = 0.0, 1.0  # both conditions: entropy falls with the exponent, so do repeats

    def measure(at: list[float]) -> dict[float, tuple[float, float]]:
        each = totals.select("tokens", F.explode(F.array(*map(F.lit, at))).alias("a")).withColumn("w", F.pow(F.col("tokens") / most, F.col("a")))
        sums = each.groupBy("a").agg(F.sum("w").alias("z"), F.sum(F.col("w") * F.log("w")).alias("s"), F.max(F.col("w") * most / F.col("tokens")).alias("repeats"))
        return {r["a"]: (math.log(r["z"]) - r["s"] / r["z"], r["repeats"]) for r in sums.collect()}

    def bisect(holds) -> float:
        """Largest exponent for which holds, given that it holds from 0 up to there."""
        lo, hi = 0.0, 1.0
        for _ in range(ROUNDS):
            grid = [lo + (hi - lo) * i / SECTIONS for i in range(SECTIONS + 1)]
            found = measure(grid)
            good = [a for a in grid if holds(*found[a])]
            if not good:
                return lo
            if good[-1] == grid[-1]:
                return hi
            lo, hi = good[-1], grid[grid.index(good[-1]) + 1]
        return lo

    a = bisect(lambda entropy, repeats: entropy >= goal)
    if measure([a])[a][1] <= most_repeats:
        return a
    # the largest exponent at which a source is still repeated more often; a hair above, none is
    return min(1.0, bisect(lambda entropy, repeats: repeats > most_repeats) + SECTIONS**-ROUNDS)


def mix_sources(docs: DataFrame, source: str = "source", tokens: str | None = None, key: tuple[str, ...] = ("doc_id", "text"), entropy_share: float = ENTROPY_SHARE, most_repeats: float = MOST_REPEATS, budget: int | None = None, blocks: int | None = None, seed: int = 977) -> DataFrame:
    """docs, each row once for each epoch that it is in, with n_tokens, weight, repeats, epoch (from 0),
    block_position (of the row's block in its source's epoch) and order_key (of the row in the block).

    tokens: SQL expression for a row's tokens; by default the words of the column text.
    budget: tokens of the whole mixture; by default the least that takes every source whole at least
    once, so that no document is lost. With a smaller one, sources above their weight lose documents.
    The tokens realised for a source miss its budget by less than one document, where rows equal in all
    of `key` count as one: they are in the same epochs.
    blocks: of each source; by default one for about ROWS_A_BLOCK rows of docs.

    Null source: a source of its own, apart from ''. Null or empty text: no tokens; it is in every whole
    epoch of its source, and a source without any tokens is taken once, outside the weights. Repeated
    rows are rows like others. An empty table gives an empty table. A column of docs by a new name is
    replaced; other names are free. docs must give the same rows when read again.

    Documents are not sorted or grouped: what a row needs to know is in the line of its block, and only
    the one block in which a source's last epoch ends is ordered, by hashes, to find where in it.
    The driver gets a few numbers a round: no list of sources, blocks or documents.
    """
    new = ["n_tokens", "weight", "repeats", "epoch", "block_position", "order_key"]
    kept = [c for c in docs.columns if c.lower() not in new]
    p = "__"  # before the names of helping columns
    while any(c.startswith(p) for c in docs.columns):
        p += "_"
    blocks = blocks or max(LEAST_BLOCKS, docs.count() // ROWS_A_BLOCK)
    name = F.when(F.col(source).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(source).cast("string")))
    count = F.coalesce(F.expr(tokens or WORD_COUNT).cast("long"), F.lit(0).cast("long"))
    placed = docs.withColumns({f"{p}source": name, f"{p}h": F.xxhash64(F.lit(seed), *[F.col(c) for c in key])})
    placed = placed.withColumn(f"{p}block", F.pmod(f"{p}h", F.lit(blocks)).cast("int"))
    by = [f"{p}source", f"{p}block"]
    s, b = by
    mark = scratch_mark()
    per_block = written(placed.groupBy(*by).agg(F.sum(count).alias("tokens")), "mix-blocks")
    totals = per_block.groupBy(s).agg(F.sum("tokens").alias("tokens"))
    full = written(totals.where("tokens > 0"), "mix-sources", rows=1)
    a = exponent(full, entropy_share, most_repeats)
    facts = full.agg(F.max("tokens").alias("most"), F.sum(F.pow("tokens", F.lit(a))).alias("z")).first()
    z, least = (facts["z"], facts["most"] / (facts["most"] ** a / facts["z"])) if facts["most"] else (1.0, 0.0)
    amount = float(least if budget is None else budget)
    plan = full.withColumn("weight", F.pow("tokens", F.lit(a)) / F.lit(z)).withColumn("budget", F.round(F.col("weight") * amount).cast("long"))
    plan = plan.select(s, "weight", (F.col("budget") / F.col("tokens")).alias("repeats"), F.floor(F.col("budget") / F.col("tokens")).cast("int").alias("whole"), (F.col("budget") % F.col("tokens")).alias("rest"))
    # the part epoch, number `whole`: blocks in its order, running tokens before each
    part = per_block.join(plan, s, "left").withColumns({"whole": F.coalesce("whole", F.lit(1)), "rest": F.coalesce("rest", F.lit(0).cast("long"))})
    order = Window.partitionBy(s).orderBy(F.xxhash64(F.lit(seed), "whole", s, b), b)
    part = written(part.withColumn("before", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("tokens")), "mix-part")
    # the block in which the part epoch ends: one of a source
    ending = written(part.where("before < rest and before + tokens > rest").select(*by, "whole", "rest", "before").toDF(*by, f"{p}whole", f"{p}rest", f"{p}before"), "mix-ending", rows=1)
    last = placed.join(ending, by).select(s, F.xxhash64(f"{p}h", f"{p}whole").alias("at"), F.col(f"{p}rest").alias("rest"), F.col(f"{p}before").alias("before"), count.alias("n"))
    run = Window.partitionBy(s).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = last.groupBy(s, "rest", "before", "at").agg(F.sum("n").alias("n")).withColumn("upto", F.col("before") + F.sum("n").over(run))
    cut = each.where("upto <= rest").groupBy(s).agg(F.max("at").alias("cut"))
    epochs = part.join(cut, s, "left").withColumn("epoch", F.explode(F.expr("sequence(0, whole)")))
    turn = Window.partitionBy(s, "epoch").orderBy(F.xxhash64(F.lit(seed), "epoch", s, b), b)
    epochs = epochs.withColumn("block_position", F.row_number().over(turn) - 1)
    line = epochs.groupBy(*by, "weight", "repeats", "whole", "rest", "before", "tokens", "cut").agg(F.sort_array(F.collect_list(F.struct("epoch", "block_position"))).alias("turns"))
    line = written(line.select(*by, F.struct(*[c for c in line.columns if c not in by]).alias(f"{p}l")), "mix-lines")
    drop_scratch(docs.sparkSession, mark, keep=1)
    joined = placed.join(line, by).withColumn(f"{p}n", count).withColumn(f"{p}at", F.xxhash64(f"{p}h", f"{p}l.whole"))
    within = f"({p}l.before + {p}l.tokens <= {p}l.rest or {p}l.before < {p}l.rest and {p}at <= {p}l.cut)"
    taken = F.expr(f"filter({p}l.turns, t -> t.epoch < {p}l.whole or ({p}l.rest > 0 and {p}n > 0 and coalesce({within}, false)))")
    out = joined.withColumn(f"{p}turn", F.explode(taken))
    own = {"n_tokens": F.col(f"{p}n"), "weight": F.col(f"{p}l.weight"), "repeats": F.col(f"{p}l.repeats"), "epoch": F.col(f"{p}turn.epoch"), "block_position": F.col(f"{p}turn.block_position"), "order_key": F.xxhash64(f"{p}h", f"{p}turn.epoch")}
    return out.select(*[F.col(f"`{c}`") for c in kept], *[v.alias(c) for c, v in own.items()])
