"""Near-dedup by SimHash: grid range-join of segment counts, then fingerprints of shingle samples, with exact similarities.

Every text gets a SimHash fingerprint, and operator 8's grid over the bit counts of its 4-bit segments
links the fingerprints at two differing bits or fewer. These links are checked exactly by the shingle sets.

Two bits don't reach a similarity of 0.8, so what the grid leaves apart is searched further. A text's shingles
are dealt out by hash into small groups, and each group gets a SimHash fingerprint. Texts of a similarity
of 0.8 or more have groups in common that no difference touches: their fingerprints are equal, and the
texts meet in a cell. Only cells whose members the grid has not connected matter. Their members are first
compared exactly with one of them; only members of cells that are then not yet connected are compared
pair by pair, in blocks inside a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_scratch, give_back, in_bits, release, row_bits, scratch_mark, sends_little, slices, written
from .simhash import classes, joins, links, majority, shingle_hashes
from .words import U, mix, spread

WORDS, SHARE = 5, 0.8
#: Differing bits that the grid links.
BITS = 2
#: Fingerprints of a text, about; least number of shingles of a group in texts of SPARSE shingles or more.
GROUPS, LEAST, SPARSE = 32, 3, 16
#: Texts of more distinct shingles than this many are sampled by hash, by powers of two.
SAMPLE = 256
#: Members of either side that are compared pair by pair in one block; columns of a block's matrix at once.
CHUNK, COLUMNS = 256, 1 << 13
#: Texts of which one file of a scratch table holds the fingerprints or shingles at least.
TEXTS_A_FILE = 5_000


def dealing(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sizes between powers of two: bits by which hashes are sampled, groups, and ways to deal them out.

    A sample has SAMPLE / 2 to SAMPLE shingles. Small texts have few groups, so they are dealt out in several ways.
    """
    top = np.frexp(n.astype(np.float64))[1] - 1
    bits = np.maximum(0, top - SAMPLE.bit_length() + 2)
    groups = np.clip((1 << np.maximum(top, 0)) >> 2, np.where(top < 2, 1, 2), GROUPS)
    return bits, groups, np.where(top < 2, 1, GROUPS // groups)


def cells_of(sets: list[np.ndarray], share: float) -> list[np.ndarray]:
    """Cells of each set of distinct shingle hashes: the fingerprints of its groups, with their places.

    Sizes from one power of two to the next deal alike. A set little above such a bound also deals like
    the sizes below it: one of `share` of its size may be there.
    """
    size = np.array([len(x) for x in sets], dtype=np.int64)
    owner, flat = np.repeat(np.arange(len(sets)), size), np.concatenate([*sets, np.zeros(0, dtype=U)])
    order = mix(flat, 0x5EED)
    floor = 1 << np.maximum(0, np.frexp(size.astype(np.float64))[1] - 1)  # of the size's level
    found, whose = [], []
    for sizes, member in ((size, size > 0), (floor // 2, (size * share < floor) & (floor > 1))):
        bits, groups, ways = dealing(np.maximum(sizes, 1))
        use = np.flatnonzero(member[owner] & (order <= (~U(0) >> bits.astype(U))[owner]))
        again, way = spread(ways[owner[use]])
        text, each = owner[use][again], flat[use][again]
        of = groups[text]
        group = way * of + (mix(each ^ (way.astype(U) << U(40)), 0xDEA1) % of.astype(U)).astype(np.int64)
        total = np.where(member, groups * ways, 0)
        base = np.cumsum(total) - total
        at = base[text] + group
        counts = np.bincount(at, minlength=int(total.sum()))
        prints = majority(each[np.argsort(at, kind="stable")], counts)
        text, place = spread(total)
        full = counts >= np.where(size[text] >= SPARSE, LEAST, 1)
        kind = place.astype(U) | (groups[text].astype(U) << U(16)) | (bits[text].astype(U) << U(32))
        found.append(mix(prints[full] ^ mix(kind[full], 0x9A1D)))
        whose.append(text[full])
    found, whose = np.concatenate(found), np.concatenate(whose)
    turn = np.argsort(whose, kind="stable")
    return [np.unique(x) for x in np.split(found[turn], np.searchsorted(whose[turn], np.arange(1, len(sets))))] if sets else []


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    return np.unique(np.array(shingle_hashes(text, words, 42), dtype=U))


def marked_rows(docs: DataFrame, text: str, words: int, share: float) -> DataFrame:
    """docs with s1, s2 (a 128-bit hash of the shingle set), n (its size), f0 (its SimHash fingerprint) and cells."""
    names = [*docs.columns, "s1", "s2", "n", "f0", "cells"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    source = docs.select("*", F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            sets = [shingle_set(t, words) for t in texts]
            whole = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.tobytes()) for x in sets), dtype=np.int64).reshape(-1, 2)
            cells = pa.array([x.view(np.int64) for x in cells_of(sets, share)], pa.list_(pa.int64()))
            size = np.array([len(x) for x in sets], dtype=np.int64)
            prints = majority(np.concatenate([*sets, np.zeros(0, dtype=U)]), size).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.ascontiguousarray(whole[:, 0])), pa.array(np.ascontiguousarray(whole[:, 1])), pa.array(size), pa.array(prints), cells], names=names)

    return source.mapInArrow(run, f"{kinds}, s1 long, s2 long, n long, f0 long, cells array<long>")


def grid_pairs(nodes: DataFrame, count: int) -> DataFrame:
    """Pairs (a, b) that connect the nodes(id, f0) whose fingerprints differ in BITS bits or fewer: the grid's links of distinct fingerprints, and equal ones with the least id of theirs."""
    prints = written(nodes.groupBy("f0").agg(F.min("id").alias("id")), "near-prints", rows=count)
    equal = nodes.join(prints.select("f0", F.col("id").alias("least")), "f0").where("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b"))
    return written(links(prints.select("id", "f0"), BITS).distinct().unionByName(equal), "near-grid", rows=2 * count)


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """(id, s) of texts(id, text): the sorted hashes of the distinct shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(t, words).view(np.int64) for t in raw], pa.list_(pa.int64()))], names=["id", "s"])

    return texts.select("id", "text").mapInArrow(run, "id long, s array<long>")


def similar(pairs: DataFrame, sets: DataFrame, share: float) -> DataFrame:
    """The pairs(a, b) whose sets(id, n, s) have a similarity of `share` or more, computed exactly; sizes alone rule many out."""
    sizes = sets.select("id", "n")
    sized = pairs.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    fit = sized.where(F.least("na", "nb") >= F.lit(share) * F.greatest("na", "nb") - 1e-9).select("a", "b")
    each = sets.select("id", "s")
    both = fit.join(each.toDF("a", "sa"), "a").join(each.toDF("b", "sb"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(common >= F.lit(share) * (F.size("sa") + F.size("sb") - common) - 1e-9).select("a", "b")


def common_counts(sets: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """How many elements the sets number `rows` have in common with each set: products of 0/1 matrices, some columns at a time."""
    size = np.array([len(x) for x in sets], dtype=np.int64)
    owner, flat = np.repeat(np.arange(len(sets)), size), np.concatenate(sets)
    values, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    several = count > 1  # what one set alone has is common to none
    column, owner = (np.cumsum(several) - 1)[column[several[column]]], owner[several[column]]
    turn = np.argsort(column, kind="stable")
    column, owner = column[turn], owner[turn]
    out = np.zeros((len(rows), len(sets)), dtype=np.float32)
    for lo in range(0, int(several.sum()), COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS])
        matrix = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        matrix[owner[a:b], column[a:b] - lo] = 1
        out += matrix[rows] @ matrix.T
    return np.rint(out).astype(np.int64)


def open_groups(met: DataFrame, rooted: DataFrame, count: int) -> DataFrame:
    """(id, root, grp, size, rest, minor) of the members of cells that hold several roots.

    Roots that share a cell are one group. size: its members; rest: those that are not of its largest
    root, which are `minor`.
    """
    own = met.select("cell", "id").join(rooted, "id")
    least = own.groupBy("cell").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("cell", "lo")
    shared = written(own.join(written(least, "near-open", rows=count), "cell"), "near-held", rows=count)
    grouped = classes(shared.select(F.col("root").alias("id")).distinct(), shared.select(F.col("lo").alias("a"), F.col("root").alias("b")).distinct()).toDF("root", "grp")
    each = written(shared.select("id", "root").distinct().join(grouped, "root"), "near-grouped", rows=count)
    sizes = each.groupBy("grp", "root").agg(F.count("*").alias("n")).groupBy("grp").agg(F.sum("n").alias("size"), F.max("n").alias("most"), F.max_by("root", F.struct("n", "root")).alias("largest"))
    sizes = written(sizes.select("grp", "size", (F.col("size") - F.col("most")).alias("rest"), "largest"), "near-sizes", rows=count)
    return each.join(sizes, "grp").withColumn("minor", F.col("root") != F.col("largest")).drop("largest")


def by_rare_shingles(members: DataFrame, share: float, count: int) -> DataFrame:
    """members(id, root, grp, size, rest, minor, s) with the groups that are cheaper to compare by rare shingles cut into cells; nothing similar comes apart.

    Two sets of a similarity of `share` or more have a shingle in common among the rarest n - ceil(share * n) + 1 of each,
    in any order that both follow; here the order is by how many members of the group have it. Texts that
    have only what all of them share in common thus meet in no cell, and their group costs nothing. A group whose
    cells would cost more than comparing it as a whole stays one, as does one that makes no more pairs than a block.
    """
    pairs = F.col("size") * F.col("rest")
    large = members.where(pairs > CHUNK * CHUNK)
    each = large.select("grp", "id", "root", F.size("s").alias("n"), F.explode("s").alias("x"))
    often = each.groupBy("grp", "x").agg(F.count("*").alias("f"))
    rank = F.row_number().over(Window.partitionBy("grp", "id").orderBy("f", "x"))
    rare = each.join(often, ["grp", "x"]).withColumn("rank", rank).where((F.col("f") > 1) & (F.col("rank") <= F.col("n") - F.ceil(F.col("n") * share - 1e-9) + 1))
    rare = written(rare.select("grp", "x", "id", "root"), "near-rare", rows=GROUPS * count)
    sizes = rare.groupBy("grp", "x", "root").agg(F.count("*").alias("n")).groupBy("grp", "x").agg(F.sum("n").alias("size"), F.max("n").alias("most"), F.max_by("root", F.struct("n", "root")).alias("largest"))
    cells = written(sizes.where("most < size").select("grp", "x", "size", (F.col("size") - F.col("most")).alias("rest"), "largest"), "near-cells", rows=GROUPS * count)
    cost = cells.groupBy("grp").agg(F.sum(F.col("size") * (F.col("rest") + CHUNK)).alias("cost"))
    whole = large.groupBy("grp").agg(F.max(pairs).alias("square"))
    kept = written(whole.join(cost, "grp", "left").where("coalesce(cost, 0) >= square").select("grp"), "near-whole", rows=count)
    met = rare.join(kept, "grp", "left_anti").join(cells, ["grp", "x"]).select(F.xxhash64("grp", "x").alias("grp"), "id", "root", "size", "rest", (F.col("root") != F.col("largest")).alias("minor"))
    apart = met.join(large.select("id", "s").dropDuplicates(["id"]), "id").select(*members.columns)
    return members.where(pairs <= CHUNK * CHUNK).unionByName(large.join(kept, "grp", "left_semi")).unionByName(apart)


def links_within(members: DataFrame, share: float) -> DataFrame:
    """Links (a, b) that connect what all similar pairs of different roots would, of members(id, root, grp, size, rest, minor, s) of one group.

    Of two members of different roots one is minor: chunks of the minor members are compared with chunks
    of all. A task sends a forest of its links.
    """
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = lambda n: F.ceil(F.col(n) / CHUNK).cast("int")
    place = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "id"), F.greatest(parts(n), F.lit(1))).cast("int")
    every = members.select("grp", place("size", 1).alias("at"), F.explode(F.sequence(F.lit(0), parts("rest") - 1)).alias("by"), F.lit(False).alias("asks"), "id", "root", "s")
    minor = members.where("minor").select("grp", F.explode(F.sequence(F.lit(0), parts("size") - 1)).alias("at"), place("rest", 2).alias("by"), F.lit(True).alias("asks"), "id", "root", "s")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, up = None, [], {}
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for i, block in enumerate(zip(*columns[:3])):
                if block != held and rows:
                    yield from compare(rows, up)
                    rows = []
                held = block
                rows.append((*[c[i] for c in columns[3:]], batch.column(6)[i].values.to_numpy(zero_copy_only=False)))
        if rows:
            yield from compare(rows, up)
        rows = batch = columns = None
        give_back()

    def compare(rows: list[tuple], up: dict[int, int]) -> Iterator[pa.RecordBatch]:
        asks, ids, roots = (np.array([r[i] for r in rows]) for i in range(3))
        asking, asked = np.flatnonzero(asks), np.flatnonzero(~asks)
        if not len(asking) or not len(asked):
            return
        sets = [r[3] for r in rows]
        size, both = np.array([len(x) for x in sets]), common_counts(sets, asking)[:, asked]
        near = (both >= share * (size[asking][:, None] + size[asked][None, :] - both) - 1e-9) & (roots[asking][:, None] != roots[asked][None, :])
        x, y = np.nonzero(near)
        sent = [(a, b) for a, b in zip(ids[asking[x]].tolist(), ids[asked[y]].tolist()) if joins(up, a, b)]
        if sent:
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in sent], pa.int64()), pa.array([b for _, b in sent], pa.int64())], names=["a", "b"])

    blocks = every.unionByName(minor).select("grp", "at", "by", "asks", "id", "root", "s")
    return blocks.repartition(tasks, "grp", "at", "by").sortWithinPartitions("grp", "at", "by").mapInArrow(run, "a long, b long")


@sends_little
def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, share: float = SHARE) -> DataFrame:
    """docs with one row of each near-duplicate group: the one of least doc_id, nulls last.

    Texts are linked if their shingle sets (A-Z lower-cased) have a similarity of `share` or more; it is
    computed exactly for all texts that meet in a cell. Isolated pairs at exactly 0.8 meet in 997 of 1,000
    cases or more, by the sizes of groups; at 0.85 in all but 1 of 10,000. Texts of equal shingle sets are
    one text. Texts without a word have no shingle to be similar in: each of them stays. Of rows equal in
    every column one stays. Texts are read whole. All columns are kept, whatever their names.

    The grid range-join of operator 8 comes first: its links are checked and connect most copies. In each
    cell that holds several classes the members are then compared with the one that meets most others, which makes as many pairs
    as there are members. Cells that are then not yet connected make up groups. Members that are not of a
    group's largest class are compared with all its members, inside tasks, in blocks of bounded size; where it
    is cheaper, only with those that share a rare shingle, which all similar ones do (by_rare_shingles()).
    """
    names = docs.columns
    docs = docs.toDF(*[f"column{i}" for i in range(len(names))])
    text, doc_id, total = docs.columns[names.index(text)], docs.columns[names.index(doc_id)], docs.count()
    spark = docs.sparkSession
    marked = written(marked_rows(docs, text, words, share).withColumn("row", F.monotonically_increasing_id()), "near-marked", rows=total, each=TEXTS_A_FILE)
    mark = scratch_mark()
    order = F.struct(F.col(doc_id).isNull().alias("null"), F.col(doc_id).alias("id"), "row")
    first = marked.where("n > 0").groupBy("s1", "s2").agg(F.min(order).alias("first"), F.min("f0").alias("f0"))
    nodes = written(first.select(F.col("first.row").alias("id"), "first", "f0"), "near-nodes", rows=total)
    count = nodes.count()
    firsts = written(row_bits(nodes, "id"), "near-firsts", rows=1)
    own = in_bits(marked.select(F.col("row").alias("id"), "cells"), "id", firsts)
    visits = written(own.select("id", F.explode("cells").alias("cell")), "near-visits", rows=GROUPS * count)
    shared = written(visits.groupBy("cell").agg(F.count("*").alias("m")).where("m > 1"), "near-shared", rows=count)
    met = written(visits.join(shared, "cell"), "near-met", rows=GROUPS * count)
    release(spark)
    near = grid_pairs(nodes.select("id", "f0"), count)
    asked = written(met.select("id").unionByName(near.select(F.explode(F.array("a", "b")).alias("id"))).distinct(), "near-asked", rows=count)
    texts = in_bits(marked.select(F.col("row").alias("id"), F.col(text).alias("text")), "id", written(row_bits(asked, "id"), "near-bits", rows=1))
    sets = shingle_sets(texts, words).withColumn("n", F.size("s"))
    sets = written(sets, "near-sets", rows=asked.count(), each=TEXTS_A_FILE)
    linked = written(similar(near, sets, share), "near-linked", rows=count, each=2 * TEXTS_A_FILE)
    release(spark)
    # cells that the grid's links leave in several classes
    rooted = written(classes(asked, linked), "near-rooted", rows=count)
    apart = met.join(rooted, "id").groupBy("cell").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("cell")
    met = written(met.join(written(apart, "near-apart", rows=count), "cell"), "near-left", rows=GROUPS * count)
    # the member of each cell that meets most others, in all its cells
    score = met.groupBy("id").agg(F.sum("m").alias("score"))
    ranked = met.join(score, "id")
    centre = written(ranked.groupBy("cell").agg(F.max_by("id", F.struct("score", -F.col("id"))).alias("centre")), "near-centres", rows=count)
    pairs = met.join(centre, "cell").where("id <> centre").select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
    pairs = pairs.join(rooted.toDF("a", "ra"), "a").join(rooted.toDF("b", "rb"), "b").where("ra <> rb").select("a", "b")
    pairs = written(pairs, "near-pairs", rows=2 * count)
    edges = written(similar(pairs, sets, share).unionByName(linked), "near-edges", rows=count, each=2 * TEXTS_A_FILE)
    release(spark)
    rooted = written(classes(asked, edges), "near-classes", rows=count)
    open_ = open_groups(met, rooted, count)
    members = written(open_.join(sets.select("id", "s"), "id"), "near-members", rows=count, each=TEXTS_A_FILE)
    release(spark)
    members = written(by_rare_shingles(members, share, count), "near-compared", rows=count, each=TEXTS_A_FILE)
    edges = edges.unionByName(written(links_within(members, share).distinct(), "near-links", rows=count))
    heads = classes(nodes.select("id"), edges).join(nodes, "id").groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("row"))
    kept = written(row_bits(heads.unionByName(marked.where("n = 0").select("row")), "row"), "near-kept", rows=1)
    drop_scratch(spark, mark, keep=1)
    return in_bits(marked, "row", kept).select(*[F.col(c).alias(n) for c, n in zip(docs.columns, names)])
