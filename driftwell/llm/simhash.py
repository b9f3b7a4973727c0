"""Operator 8, SimHash near-dedup: segment-popcount embedding with a grid range-join.

A fingerprint is cut into segments of four bits; its bit counts per segment are a point of an integer
grid. Manhattan distance there never exceeds Hamming distance, so fingerprints at two differing bits or
fewer lie at Manhattan distance two or less, and then some grid cell is at most one step away from both.
Since two differing bits leave one of three parts of a fingerprint as it is, the grid is laid over the
counts of the other two, within the fingerprints that have the same bits there: cells stay thin however
many fingerprints there are. Each fingerprint visits its own cells and all one step away; those that meet
are compared exactly. Only distinct fingerprints take part, and a cell sends out a spanning forest of its
links, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, drop_scratch, scratch_mark, sends_little, slices, written

#: Segments in three parts: of two differing bits, one part at least has none.
PARTS = (tuple(range(5)), tuple(range(5, 10)), tuple(range(10, 16)))
ALL = (1 << 64) - 1
#: Members of a cell that are compared in one group; a larger cell is dealt out as pairs of chunks.
CHUNK = 2048
#: Groups of so many members or fewer are compared row by row, many groups at once.
SMALL = 8
#: Texts whose fingerprints one file of a scratch table holds at least.
TEXTS_A_FILE = 5_000


def shingle_hashes(text: bytes | None, words: int, seed: int) -> list[int]:
    """XXH64 of the word shingles, repeats included; A-Z are lower-cased. Fewer words: one shingle of all; none: empty."""
    w = (text or b"").lower().split()
    if not w:
        return []
    digest = xxhash.xxh64_intdigest
    if len(w) <= words:
        return [digest(b" ".join(w), seed)]
    return [digest(b" ".join(x), seed) for x in zip(*[w[i:] for i in range(words)])]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of each group of `counts` consecutive hashes: bits set in over half of them; zero for an empty group."""
    out = np.zeros(len(counts), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        at = (np.cumsum(counts) - counts)[full]
        for bit in range(64):
            ones = np.add.reduceat(((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int64), at)
            out[full] |= (2 * ones > counts[full]).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints(docs: DataFrame, text: str = "text", words: int = 3, seeds: tuple[int, ...] = (42,), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep`, then one long f0, f1, .. for each seed."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    source = docs.select(*[docs[c].alias(f"__k{i}") for i, c in enumerate(keep)], docs[text].alias("__text"))
    names = [*keep, *[f"f{i}" for i in range(len(seeds))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "__text"):
            columns = []
            for seed in seeds:
                each = [shingle_hashes(t, words, seed) for t in texts]
                counts = np.array([len(x) for x in each], dtype=np.int64)
                flat = np.fromiter((h for x in each for h in x), dtype=np.uint64, count=int(counts.sum()))
                columns.append(pa.array(majority(flat, counts).view(np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=names)

    return source.mapInArrow(run, ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], *[f"f{i} long" for i in range(len(seeds))]]))


def popcounts(half: Column) -> Column:
    """Bit counts of the eight 4-bit segments of a value below 2 ** 32, one in each hex digit."""
    two = half.bitwiseAND(0x55555555) + F.shiftrightunsigned(half, 1).bitwiseAND(0x55555555)
    return two.bitwiseAND(0x33333333) + F.shiftrightunsigned(two, 2).bitwiseAND(0x33333333)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def visited(word: Column, packed: Column) -> Column:
    """Array of the cells that a fingerprint with these packed bit counts visits: for each part its bits, and the counts of the others and all a step away."""
    steps = []
    for part in PARTS:
        mask = sum(15 << 4 * i for i in part)
        base = packed.bitwiseAND(F.lit(signed(~mask & ALL))).bitwiseOR(word.bitwiseAND(F.lit(signed(mask))))
        steps.append(base)
        for i in (i for i in range(16) if i not in part):
            count = F.shiftrightunsigned(packed, 4 * i).bitwiseAND(15)
            steps += [F.when(count < 4, base + F.lit(1 << 4 * i)), F.when(count > 0, base - F.lit(1 << 4 * i))]
    return F.array_compact(F.array(*steps))


def packed_counts(word: Column) -> Column:
    """Bit counts of the 16 segments, four bits each."""
    return F.shiftleft(popcounts(F.shiftrightunsigned(word, 32)), 32) + popcounts(word.bitwiseAND(0xFFFFFFFF))


def visited_cells(words: np.ndarray) -> np.ndarray:
    """The same in numpy: rows x steps, -1 for steps that leave the grid."""
    u = np.uint64
    two = (words & u(0x5555555555555555)) + ((words >> u(1)) & u(0x5555555555555555))
    packed = (two & u(0x3333333333333333)) + ((two >> u(2)) & u(0x3333333333333333))
    out = []
    for part in PARTS:
        mask = sum(15 << 4 * i for i in part)
        base = ((packed & u(~mask & ALL)) | (words & u(mask))).view(np.int64)[:, None]
        at = np.array([4 * i for i in range(16) if i not in part])
        count, step = (packed[:, None] >> at.astype(u)) & u(15), np.int64(1) << at
        out += [base, np.where(count < 4, base + step, -1), np.where(count > 0, base - step, -1)]
    return np.concatenate(out, axis=1)


def first_meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least cell that both visit, for pairs of fingerprints."""
    out = np.empty(len(a), dtype=np.int64)
    for lo in range(0, len(a), 1024):
        x, y = visited_cells(a[lo : lo + 1024]), visited_cells(b[lo : lo + 1024])
        both = ((x[:, :, None] == y[:, None, :]) & (x != -1)[:, :, None]).any(2)
        out[lo : lo + 1024] = np.where(both, x, np.iinfo(np.int64).max).min(1)
    return out


def forest(words: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links that connect what `most` differing bits connect among the fingerprints."""
    open_, cluster, found, clusters = np.arange(len(words)), np.zeros(len(words), dtype=np.int64), [], 0
    while len(open_):
        near = np.bitwise_count(words[open_] ^ words[open_[0]]) <= most
        found += [(int(open_[0]), int(i)) for i in open_[near][1:]]
        cluster[open_[near]] = clusters
        clusters += 1
        open_ = open_[~near]
    if clusters > 1:  # clusters may touch at other members than the first
        largest = np.bincount(cluster).argmax()
        for i in np.flatnonzero(cluster != largest):
            near = np.flatnonzero((np.bitwise_count(words ^ words[i]) <= most) & (cluster != cluster[i]))
            if len(near):
                _, first = np.unique(cluster[near], return_index=True)
                found += [(int(i), int(j)) for j in near[first]]
    return found


def joins(up: dict[int, int], a: int, b: int) -> bool:
    """Link a and b; whether they weren't connected yet."""

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    a, b = top(a), top(b)
    up[max(a, b)] = min(a, b)
    return a != b


def links(nodes: DataFrame, most: int) -> DataFrame:
    """Links (a, b) between ids of nodes(id, f0) that connect what all pairs of `most` differing bits or fewer (two at most) would."""
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = nodes.repartition(tasks, "id")  # nodes are narrow, cells many
    cells = narrow.select("id", "f0", packed_counts(F.col("f0")).alias("packed")).select("id", F.explode(visited(F.col("f0"), F.col("packed"))).alias("cell"))
    shared = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    met = cells.join(shared, "cell").withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    pairs = met.withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)"))).select("cell", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "id")
    pairs = pairs.join(nodes, "id").select("cell", "lo", "hi", "id", "f0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, up = None, {}
        for batch in batches:
            now = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(batch.num_columns)], axis=1)
            rest = now if rest is None else np.concatenate([rest, now])
            cut = np.flatnonzero((rest[1:, :3] != rest[:-1, :3]).any(1)) + 1
            if len(cut):
                yield from compare(rest[: cut[-1]], up)
                rest = rest[cut[-1] :]
        if rest is not None and len(rest):
            yield from compare(rest, up)

    def compare(rows: np.ndarray, up: dict[int, int]) -> Iterator[pa.RecordBatch]:
        """rows: whole groups, sorted. up: what this task has linked so far, so that it sends a forest.

        Fingerprints that meet in several cells are linked in the least of them only. What a link of a
        later cell would connect is connected by earlier cells, so nothing is lost.
        """
        edge = np.concatenate([[0], np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(1)) + 1, [len(rows)]])
        size = np.diff(edge)
        ids, fps, group = rows[:, 3], rows[:, 4].view(np.uint64), np.repeat(np.arange(len(size)), size)
        a, b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for step in range(1, min(SMALL, int(size.max(initial=1)))):
            at = np.flatnonzero((group[step:] == group[:-step]) & (size[group[step:]] <= SMALL))
            at = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= most]
            a.append(at)
            b.append(at + step)
        for g in np.flatnonzero(size > SMALL):
            found = np.array(forest(fps[edge[g] : edge[g + 1]], most), dtype=np.int64).reshape(-1, 2) + edge[g]
            a.append(found[:, 0])
            b.append(found[:, 1])
        a, b = np.concatenate(a), np.concatenate(b)
        here = first_meeting(fps[a], fps[b]) == rows[a, 0]
        sent = [(x, y) for x, y in zip(ids[a[here]].tolist(), ids[b[here]].tolist()) if joins(up, x, y)]
        if sent:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in sent], pa.int64()), pa.array([y for _, y in sent], pa.int64())], names=["a", "b"])

    return pairs.repartition(tasks, "cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi").mapInArrow(run, "a long, b long")


def classes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes with root: one number for all that edges connect."""
    return nodes.join(components(edges).withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))


@sends_little
def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 3, seed: int = 42, most: int = 2) -> DataFrame:
    """One row a document: doc_id, f0, component_id (the least doc_id of the documents that links connect).

    Null, empty or blank text: fingerprint zero, linked like any other. Null doc_id: its row counts for
    the links but never names a component unless all its members are null (then null). Repeated rows stay.
    Texts are read whole; other columns are ignored. Groups of equal fingerprints count as one node, so a
    third of all rows in one group is one node; the joins that bring the classes back are skew-split by
    Spark at run time. `most` is two bits at most, which the grid is made for.
    """
    if most > 2:
        raise ValueError("cells one step apart meet at two differing bits or fewer")
    found = written(fingerprints(docs, text, words, (seed,), keep=(doc_id,)), "simhash-prints", rows=docs.count(), each=TEXTS_A_FILE)
    mark = scratch_mark()
    nodes = written(found.select("f0").distinct().withColumn("id", F.monotonically_increasing_id()), "simhash-nodes", rows=found.count())
    n = nodes.count()
    root = classes(nodes, written(links(nodes, most).distinct(), "simhash-links", rows=n))
    least = found.groupBy("f0").agg(F.min(doc_id).alias("least"))
    rooted = written(root.drop("id").join(least, "f0"), "simhash-roots", rows=n)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = written(rooted.join(named, "root").select("f0", "component_id"), "simhash-named", rows=n)
    drop_scratch(docs.sparkSession, mark, keep=1)
    return found.join(by_print, "f0").select(doc_id, "f0", "component_id")
