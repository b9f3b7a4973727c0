"""Operator 6, suffix-array dedup: a run-length index of repeated byte strings.

Each `length`-byte window has a least k-gram, its minimizer. Windows with the same minimizer at nearby
places have most of their bytes in common: runs of them are pieces, filed under a hash of the bytes
that all windows of such places hold. Equal windows are filed alike, so a hash seen once holds nothing
repeated and drops out. The distinct pieces of a bucket of hashes are indexed: a suffix array gives the
Burrows-Wheeler transform, of which only the runs and samples at both ends of each run stay. Matching
statistics then stream over the pieces: the longest match of a position elsewhere is that of the
position before less one, except at sampled run ends, where it is stored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, drop_written, release, scratch_mark, slices, written
from .words import U, gram_hashes

LENGTH = 400
GRAM = 32
#: Bytes of distinct pieces that are indexed together, about.
BUCKET_BYTES = 1 << 20
#: Distinct pieces under one hash above which they are cut finer before they are indexed, so that no index grows large.
GROUP_PIECES = 1500
#: Bytes of a text that are cut into pieces at once, and bits of the place of a gram in them.
CHUNK_BYTES, PLACE_BITS = 1 << 20, 24
#: In a text that repeats itself every so many bytes or fewer, equal pieces in a row are one with a count.
FOLD = 64
#: Pieces whose bodies one file of a scratch table holds at least.
BODIES_A_FILE = 10_000


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` consecutive values."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:n] = values
    grid = padded.reshape(-1, width)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[: n - width + 1], head[width - 1 : n])


def class_widths(length: int, gram: int) -> list[int]:
    """How many places of the minimizer in the window are one class, from coarse to fine: half of all, then a quarter of that, .. 1."""
    out = [-(-(length - gram + 1) // 2)]
    while out[-1] > 1:
        out.append(-(-out[-1] // 4))
    return out


def chunks(texts: list[bytes | None], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (text number, offset, bytes) of the texts with a window, long ones in parts that overlap: each window is in one part."""
    out, size = [], 0
    for i, t in enumerate(texts):
        if t and len(t) >= length:
            for lo in range(0, len(t) - length + 1, CHUNK_BYTES):
                out.append((i, lo, t[lo : lo + CHUNK_BYTES + length - 1]))
                size += len(out[-1][2])
                if size >= CHUNK_BYTES:
                    yield out
                    out, size = [], 0
    if out:
        yield out


def pieces_of(texts: list[bytes | None], length: int, gram: int, width: int, fold: int = 0) -> Iterator[tuple[list[np.ndarray], list[bytes]]]:
    """Pieces of the texts: hash they are filed under, two halves of a content hash, text number, first window, windows, how often in a row; and their bytes.

    A piece is a run of windows that have the same minimizer (the first place of the least gram hash) in
    places of the same class, `width` places each. It is filed under the bytes that all windows of the
    class hold, wherever the piece begins. What a window is filed under follows from its bytes alone.
    Pieces of `fold` windows or fewer that follow each other and are equal, as in a run of one byte, come once.
    """
    for parts in chunks(texts, length):
        yield _pieces(parts, length, gram, width, fold)


def in_a_row(raw: np.ndarray, start: np.ndarray, windows: np.ndarray, alike: np.ndarray, length: int, fold: int) -> np.ndarray:
    """For each piece but the first whether it has the bytes of the one before and follows on it; alike: where that may be."""
    again = alike & (start[:-1] + windows[:-1] == start[1:]) & (windows[1:] == windows[:-1]) & (windows[1:] <= fold)
    for step in np.unique(windows[1:][again]).tolist():
        at = np.flatnonzero(again & (windows[1:] == step))
        unlike = np.append(np.flatnonzero(raw[:-step] != raw[step:]), len(raw))
        again[at] = unlike[np.searchsorted(unlike, start[at])] >= start[at] + step + length - 1
    return again


def _pieces(parts: list[tuple[int, int, bytes]], length: int, gram: int, width: int, fold: int) -> tuple[list[np.ndarray], list[bytes]]:
    data = b"".join(x for *_, x in parts)
    raw = np.frombuffer(data, dtype=np.uint8)
    size = np.array([len(x) for *_, x in parts], dtype=np.int64)
    end = np.cumsum(size)
    place = np.arange(len(raw) - gram + 1, dtype=np.int64)
    order = ((gram_hashes(raw, gram) >> U(PLACE_BITS + 1)) << U(PLACE_BITS)).view(np.int64) | place  # of equal hashes the first place
    span = length - gram + 1
    at = sliding_least(order, span) & ((1 << PLACE_BITS) - 1)
    window = place[: len(at)]
    part = np.repeat(np.arange(len(parts)), size)[: len(at)]
    fits = window + length <= end[part]
    kind = (at - window) // width
    first = np.ones(len(at), dtype=bool)
    first[1:] = (at[1:] != at[:-1]) | (kind[1:] != kind[:-1]) | (part[1:] != part[:-1])
    start = np.flatnonzero(first & fits)
    stop = np.flatnonzero(np.append(first[1:] | ~fits[1:], True) & fits) + 1
    times = np.ones(len(start), dtype=np.int64)
    if fold and len(start) > 1:
        least, lead = order[at[start]] >> PLACE_BITS, at[start] - start
        again = in_a_row(raw, start, stop - start, (least[1:] == least[:-1]) & (lead[1:] == lead[:-1]), length, fold)
        one = np.flatnonzero(np.append(True, ~again))
        times = np.diff(np.append(one, len(start)))
        start, stop = start[one], stop[one]
    near = kind[start] * width  # places near .. far - 1 are the class
    far = np.minimum(near + width, span)
    lo, hi = at[start] - near, at[start] - far + 1 + length
    digest, bodies = xxhash.xxh3_64_intdigest, [data[a:b] for a, b in zip(start.tolist(), (stop + length - 1).tolist())]
    filed = np.fromiter((digest(data[a:b], k) for a, b, k in zip(lo.tolist(), hi.tolist(), near.tolist())), dtype=U, count=len(start))
    content = np.frombuffer(b"".join(hashlib.sha256(x).digest()[:16] for x in bodies), dtype=np.int64).reshape(-1, 2)
    owner, offset = (np.array([x[i] for x in parts], dtype=np.int64)[part[start]] for i in (0, 1))
    return [filed.view(np.int64), np.ascontiguousarray(content[:, 0]), np.ascontiguousarray(content[:, 1]), owner, start - (end - size)[part[start]] + offset, stop - start, times], bodies


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of a list of byte strings, with samples at run ends.

    head_at / head_match: text positions of run heads and their match with the suffix sorted before;
    tail_at / tail_match: of run ends and their match with the suffix sorted after. Matches end at the
    end of a string.
    """

    #: Symbols of 9 bits that the first sort takes at once.
    PACKED = 7

    def __init__(self, strings: list[bytes]):
        sizes = np.array([len(s) for s in strings], dtype=np.int64)
        ends = np.cumsum(sizes + 1) - 1
        n = int(ends[-1]) + 1
        symbols = np.zeros(n + self.PACKED, dtype=np.int64)  # 0: end of a string
        inside = np.ones(n, dtype=bool)
        inside[ends] = False
        symbols[:n][inside] = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.int64) + 1
        self.n, self.ends, self.starts, self.symbols = n, ends, ends - sizes, symbols
        order, levels = self.sorted_suffixes()
        # ends of strings differ from each other and from all bytes
        before = np.where(inside, symbols[:n], -1 - np.cumsum(~inside))
        transform = before[order - 1]
        head = np.ones(n, dtype=bool)
        head[1:] = transform[1:] != transform[:-1]
        rows = np.flatnonzero(head)
        self.run_symbols, self.run_lengths = transform[rows], np.diff(np.append(rows, n))
        tails = np.append(rows[1:], n) - 1
        self.head_at, self.tail_at = order[rows], order[tails]
        self.head_match, self.tail_match = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
        self.head_match[1:] = self.tail_match[:-1] = self.common(order[rows[1:] - 1], order[rows[1:]], levels)

    def sorted_suffixes(self) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """The suffix array by prefix doubling, and the ranks by the first 7, 14, 28 .. symbols.

        A rank is the place of the first suffix of its group; only groups of several are sorted again.
        Suffixes that end within the first symbols form groups of their own: their matches are shorter.
        """
        n, key, ending = self.n, np.zeros(self.n, dtype=np.int64), np.zeros(self.n, dtype=bool)
        for k in range(self.PACKED):
            part = self.symbols[k : n + k]
            key = (key << 9) | part
            ending |= part == 0
        order = np.argsort(key)
        sorted_ = key[order]
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = (sorted_[1:] != sorted_[:-1]) | ending[order[1:]] | ending[order[:-1]]
        first = np.flatnonzero(fresh)
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.repeat(first, np.diff(np.append(first, n)))
        levels, step = [(self.PACKED, rank.astype(np.int32))], self.PACKED
        slots = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
        while len(slots):
            at = order[slots]
            key = rank[at] * n + rank[at + step]
            turn = np.argsort(key)
            at, key = at[turn], key[turn]
            order[slots] = at
            fresh = np.ones(len(slots), dtype=bool)
            fresh[1:] = key[1:] != key[:-1]
            first = np.flatnonzero(fresh)
            rank[at] = np.repeat(slots[first], np.diff(np.append(first, len(slots))))
            step *= 2
            levels.append((step, rank.astype(np.int32)))
            slots = slots[~(fresh & np.append(fresh[1:], True))]
        return order, levels

    def common(self, a: np.ndarray, b: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and b."""
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), dtype=np.int64)
        for step, rank in reversed(levels):
            same = np.flatnonzero(rank[a] == rank[b])
            a[same] += step
            b[same] += step
            out[same] += step
        open_ = np.arange(len(a))
        for _ in range(self.PACKED):
            open_ = open_[(self.symbols[a[open_]] == self.symbols[b[open_]]) & (self.symbols[a[open_]] > 0)]
            a[open_] += 1
            b[open_] += 1
            out[open_] += 1
        return out

    def matching_statistics(self, counts: np.ndarray | None = None) -> np.ndarray:
        """For each position of the strings (separators included) the longest match that starts elsewhere.

        counts: how many equal strings each stands for; of several, each matches another to its end.
        """
        position = np.arange(self.n)
        out = np.zeros(self.n, dtype=np.int64)
        for at, match in ((self.head_at, self.head_match), (self.tail_at, self.tail_match)):
            reach = np.zeros(self.n, dtype=np.int64)
            reach[at] = at + match
            np.maximum(out, np.maximum.accumulate(reach) - position, out=out)
        if counts is not None:
            copied = np.repeat(counts > 1, self.ends - self.starts + 1)
            out[copied] = (np.repeat(self.ends, self.ends - self.starts + 1) - position)[copied]
        return out


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of true."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[0::2], edge[1::2] - 1


def indexed(bodies: DataFrame, length: int, bucket_bytes: int) -> DataFrame:
    """(pid, lo, hi): runs of repeated windows of bodies(m, pid, n, body); n: how often the piece occurs. Equal m are indexed together."""
    total = bodies.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0)).alias("b")).first()["b"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("pid")
        strings, pids = list(pdf["body"]), pdf["pid"].to_numpy()
        index = RunLengthIndex(strings)
        repeated = index.matching_statistics(pdf["n"].to_numpy()) >= length
        lo, hi = runs(repeated)  # a match ends with its string, so a run does
        at = np.searchsorted(index.ends, lo)
        return pd.DataFrame({"pid": pids[at], "lo": lo - index.starts[at], "hi": hi - index.starts[at]})

    bucket = F.pmod(F.xxhash64("m"), F.lit(max(1, -(-total // bucket_bytes))))
    return bodies.select(bucket.alias("bucket"), "pid", "n", "body").groupBy("bucket").applyInPandas(run, "pid long, lo long, hi long")


def repeats(bodies: DataFrame, length: int, gram: int, bucket_bytes: int, group_pieces: int, widths: list[int]) -> DataFrame:
    """indexed(), but the pieces of a hash with more than group_pieces of them are first cut by the next, finer classes.

    Filed under more bytes in common, the parts of a passage that very many texts share come together
    as equal pieces, and the rest comes apart. In classes of one place a piece is one window.
    """
    spark = bodies.sparkSession
    large = bodies.groupBy("m").agg(F.count("*").alias("k")).where(F.col("k") > group_pieces)
    if not widths or (large := written(large, "suffix-large", rows=1)).count() == 0:
        return indexed(bodies, length, bucket_bytes)
    width, large, most = widths[0], large.select("m"), 4 * large.agg(F.sum("k").alias("k")).first()["k"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "body"):
            for (m, c1, c2, owner, start, *_), parts in pieces_of(texts, length, gram, width):
                of = pa.array(owner)
                yield pa.RecordBatch.from_arrays([pa.array(m), pa.array(c1), pa.array(c2), batch.column(0).take(of), batch.column(1).take(of), pa.array(start), pa.array(parts, pa.binary())], names=["m", "c1", "c2", "pid", "n", "start", "body"])

    within = bodies.join(large, "m", "left_semi").dropDuplicates(["pid"])
    finer = written(within.select("pid", "n", "body").mapInArrow(cut, "m long, c1 long, c2 long, pid long, n long, start long, body binary"), "suffix-finer", rows=most, each=BODIES_A_FILE)
    often = written(finer.groupBy("m").agg(F.sum("n").alias("n")).where("n > 1").select("m"), "suffix-often", rows=most)
    equal = finer.join(often, "m").groupBy("m", "c1", "c2").agg(F.sum("n").alias("n"), F.first("body").alias("body"))
    equal = written(equal.withColumn("pid", F.monotonically_increasing_id()), "suffix-equal", rows=most, each=BODIES_A_FILE)
    release(spark)
    found = repeats(equal, length, gram, bucket_bytes, group_pieces, widths[1:])
    found = written(found.join(equal.select("pid", "c1", "c2"), "pid").select("c1", "c2", "lo", "hi"), "suffix-found", rows=most)
    deeper = finer.join(found, ["c1", "c2"]).select("pid", (F.col("lo") + F.col("start")).alias("lo"), (F.col("hi") + F.col("start")).alias("hi"))
    return indexed(bodies.join(large, "m", "left_anti"), length, bucket_bytes).unionByName(deeper)


def removed(rows: DataFrame, length: int, texts: bool) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (bytes) of rows(doc_id, text, spans)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bodies in slices(batches, "text"):
            spans, out = batch.column(2), []
            for i, t in enumerate(bodies):
                body, gone, n = t or b"", 0, 0
                if spans[i].is_valid and len(spans[i]):
                    flat = spans[i].values
                    lo, hi = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                    mark = np.zeros(len(body) + 1, dtype=np.int64)
                    np.add.at(mark, lo, 1)
                    np.add.at(mark, hi + length, -1)
                    drop = np.cumsum(mark)[:-1] > 0
                    gone, n = int(drop.sum()), len(runs(drop)[0])
                    kept = np.frombuffer(body, dtype=np.uint8)[~drop].tobytes()
                else:
                    kept = body
                out.append((len(body), gone, n, hashlib.sha256(kept).hexdigest(), kept if texts else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns[: 4 + texts]], names=names[: 5 + texts])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text", "spans").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts)


def suffix_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES, group_pieces: int = GROUP_PIECES, texts: bool = True) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (left out if not `texts`).

    A byte goes if a `length`-byte string that covers it also starts anywhere else in the corpus, the
    same document included; matches stay within a document, and all is judged on the input. The kept
    bytes need not be valid UTF-8. Null or empty text: no bytes. Rows equal in doc_id and text are two
    documents that hold the same bytes. doc_id may be null or of any type. Very long texts are cut in
    overlapping parts. Runs that repeat with a period of up to FOLD bytes, such as one byte many times, are a few pieces
    with a count; those of a longer period take up to seven times their size in pieces. An empty table gives an empty table; other columns are ignored.

    Pieces are made distinct with their counts before any text moves, so copies cost one piece; they are
    equal if their SHA-256, cut to 128 bits, is. A passage that very many texts hold would make one large
    index: its pieces are cut finer and filed again, until no more than `group_pieces` lie together.
    """
    spark = docs.sparkSession
    widths, mark = class_widths(length, gram), scratch_mark()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), F.col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bodies in slices(batches, "text"):
            for (m, c1, c2, owner, start, count, times), _ in pieces_of(bodies, length, gram, widths[0], FOLD):
                of = pa.array(owner)
                yield pa.RecordBatch.from_arrays([*[pa.array(x) for x in (m, c1, c2)], batch.column(0).take(of), batch.column(1).take(of), pa.array(start), pa.array(count.astype(np.int32)), pa.array(times.astype(np.int32))], names=["m", "c1", "c2", "t1", "t2", "start", "windows", "times"])

    pieces = written(rows.select("t1", "t2", "text").mapInArrow(cut, "m long, c1 long, c2 long, t1 long, t2 long, start long, windows int, times int"), "suffix-pieces", rows=docs.count(), each=2_000)
    often = written(pieces.groupBy("m").agg(F.sum("times").alias("n")).where("n > 1").select("m"), "suffix-often", rows=pieces.count() // 2)
    same = ["m", "c1", "c2", "windows"]
    distinct = pieces.join(often, "m").groupBy(*same).agg(F.sum("times").alias("n"), F.first("t1").alias("t1"), F.first("t2").alias("t2"), F.first("start").alias("start"))
    distinct = written(distinct.withColumn("pid", F.monotonically_increasing_id()), "suffix-distinct")
    release(spark)
    size, wanted = distinct.count(), distinct.groupBy("t1", "t2").agg(F.collect_list(F.struct("m", "pid", "n", "start", (F.col("windows") + length - 1).alias("size"))).alias("pieces"))
    wanted = written(wanted, "suffix-wanted", rows=size, each=BODIES_A_FILE)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # texts equal to one before hold the same pieces
        for batch, bodies in slices(batches, "text"):
            out = []
            for t, found in zip(bodies, batch.column(0).to_pylist()):
                if found[0]["pid"] not in seen:
                    seen.add(found[0]["pid"])
                    out += [(p["m"], p["pid"], p["n"], t[p["start"] : p["start"] + p["size"]]) for p in found]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["m", "pid", "n", "body"])

    holders = rows.join(wanted, ["t1", "t2"]).select("pieces", "text")
    bodies = written(holders.mapInArrow(fetch, "m long, pid long, n long, body binary"), "suffix-bodies", rows=size, each=BODIES_A_FILE)
    release(spark)
    found = repeats(bodies, length, gram, bucket_bytes, group_pieces, widths[1:]).groupBy("pid").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))
    spotted = written(distinct.join(found, "pid").select(*same, "found"), "suffix-spotted", rows=size)
    drop_written(spark, bodies)
    # of equal pieces in a row every window is repeated
    spans = F.expr("CASE WHEN times > 1 THEN array(named_struct('lo', start, 'hi', start + times * windows - 1)) ELSE transform(found, x -> named_struct('lo', x.lo + start, 'hi', x.hi + start)) END")
    marks = pieces.join(spotted, same).select("t1", "t2", spans.alias("spans"))
    marks = written(marks.distinct().groupBy("t1", "t2").agg(F.flatten(F.collect_list("spans")).alias("spans")), "suffix-marks", rows=docs.count(), each=10_000)
    drop_scratch(spark, mark, keep=1)
    release(spark)
    return removed(rows.join(marks, ["t1", "t2"], "left"), length, texts)
