"""Operator 10, substring dedup: difference-cover anchors.

Only windows that begin at positions in a difference cover modulo a period are hashed. For any two
positions i and j the cover has a shift d below the period with i + d and j + d both in it, so a match
of `window` words holds an anchor of window - period + 1 words that is hashed on both sides. Anchors
that several documents share are extended to the windows around them, which are compared by a
128-bit hash of the 128-bit hashes of all their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, drop_written, release, scratch_mark, slices, written
from .words import Words, spread, window_hashes

WINDOW = 50
#: A perfect difference set: each residue but zero is one difference of two elements. Fixed values.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
#: Anchors and windows are matched in so many passes over their hash values, one after the other: less shuffled at a time.
PASSES = 2
#: Texts whose anchors or windows one file of a scratch table holds at least.
TEXTS_A_FILE = 2_000


def covers(cover: tuple[int, ...], period: int) -> bool:
    """Whether every residue is a difference of two elements."""
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


def keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """did, k (hash of did and text) and text. Rows equal in did and text are treated alike."""
    return docs.select(F.col(doc_id).alias("did"), F.xxhash64(F.col(doc_id), F.col(text)).alias("k"), F.col(text).alias("text"))


def parted(df: DataFrame, column: str, parts: int) -> list[DataFrame]:
    """The rows of df in `parts` parts by a hash column: equal hashes are in one part."""
    return [df.where(F.pmod(column, F.lit(parts)) == i) for i in range(parts)]


def least_of_several(df: DataFrame, *by: str) -> DataFrame:
    """by and lo, the least did, of the groups that hold a greater did too; null is greater than all others."""
    each = df.groupBy(*by).agg(F.min("did").alias("lo"), F.max("did").alias("hi"), F.count("*").alias("n"), F.count("did").alias("known"))
    return each.where("lo < hi or known > 0 and known < n").select(*by, "lo")


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return (a["k"] == b["k"]) & a["did"].eqNullSafe(b["did"])


def anchors(rows: DataFrame, window: int, period: int, cover: tuple[int, ...]) -> DataFrame:
    """(h, k, pos): hashes of the sampled windows of texts that have `window` words."""
    width = window - period + 1
    sampled = np.zeros(period, dtype=bool)
    sampled[list(cover)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            w = Words(texts)
            h = window_hashes(w.a, width)
            first = w.first[:-1]
            owner = w.text_of_word()[: len(h)]
            at = np.arange(len(h)) - first[owner]
            size = np.diff(w.first)[owner]
            use = np.flatnonzero((size >= window) & (at + width <= size) & sampled[at % period])
            k = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(h[use].view(np.int64)), pa.array(k[owner[use]]), pa.array(at[use].astype(np.int32))], names=["h", "k", "pos"])

    return rows.select("k", "text").mapInArrow(run, "h long, k long, pos int")


def windows(rows: DataFrame, window: int, period: int) -> DataFrame:
    """(w1, w2, did, k, start): hashes of the windows around the shared anchors of rows(did, k, text, pos array)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            w = Words(texts)
            w1, w2 = window_hashes(w.a, window), window_hashes(w.b, window)
            mark = np.zeros(len(w.a) + 2, dtype=np.int64)
            lists = batch.column(3)
            pos, size = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.array([len(x) for x in lists], dtype=np.int64)
            owner, _ = spread(size)
            first, last = w.first[:-1][owner], w.first[1:][owner] - window
            ok = last >= first
            lo, hi = np.maximum(first + pos - period + 1, first)[ok], np.minimum(first + pos, last)[ok]
            ok = hi >= lo
            np.add.at(mark, lo[ok], 1)
            np.add.at(mark, hi[ok] + 1, -1)
            at = np.flatnonzero(np.cumsum(mark)[: len(w1)] > 0)
            text = w.text_of_word()[at]
            did, k = (batch.column(i).take(pa.array(text)) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(w1[at].view(np.int64)), pa.array(w2[at].view(np.int64)), did, k, pa.array((at - w.first[text]).astype(np.int32))], names=["w1", "w2", "did", "k", "start"])

    kind = rows.schema["did"].dataType.simpleString()
    return rows.select("did", "k", "text", "pos").mapInArrow(run, f"w1 long, w2 long, did {kind}, k long, start int")


def removed(rows: DataFrame, window: int, texts: bool) -> DataFrame:
    """doc_id, n_words, n_removed, n_spans, kept_sha256 and, if asked for, kept_text of rows(did, text, copy, starts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bodies in slices(batches, "text"):
            copies, starts = batch.column(2).to_pylist(), batch.column(3)
            out = []
            for i, t in enumerate(bodies):
                words = (t or b"").split()
                n, gone, spans, kept = len(words), 0, 0, words
                if copies[i] and n >= window:
                    gone, spans, kept = n, 1, []
                elif starts[i].is_valid and len(starts[i]):
                    at = np.sort(starts[i].values.to_numpy(zero_copy_only=False))
                    cut = np.flatnonzero(np.diff(at) > window) + 1
                    lo, hi = at[np.concatenate([[0], cut])], at[np.concatenate([cut - 1, [len(at) - 1]])] + window
                    kept, end = [], 0
                    for a, b in zip(lo.tolist(), hi.tolist()):
                        kept += words[end:a]
                        end = b
                    kept += words[end:]
                    gone, spans = int((hi - lo).sum()), len(lo)
                body = b" ".join(kept)
                out.append((n, gone, spans, hashlib.sha256(body).hexdigest(), body.decode() if texts else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
            names = ["doc_id", "n_words", "n_removed", "n_spans", "kept_sha256", "kept_text"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns[: 4 + texts]], names=names[: 5 + texts])

    kind = rows.schema["did"].dataType.simpleString()
    return rows.select("did", "text", "copy", "starts").mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * texts)


def substring_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, period: int = PERIOD, cover: tuple[int, ...] = COVER, passes: int = PASSES, texts: bool = True) -> DataFrame:
    """One row a document: doc_id, n_words, n_removed, n_spans, kept_sha256, kept_text (kept words joined by one space; left out if not `texts`).

    A word goes if a window of `window` words that covers it also starts in a document of smaller doc_id;
    windows are judged on the input. doc_id may be of any type that has an order. Null or empty text: no
    words, nothing removed. Null doc_id counts as larger than all others. Rows of one doc_id never remove
    from each other. Repeated rows get a row each. Very long texts are read whole. An empty table gives an
    empty table; other columns are ignored.

    What several documents share is found by aggregates that combine before the shuffle: a passage in a
    third of all documents is one group with a least doc_id, never a list or a set of pairs. These groups
    are written, so that the joins which bring them back to anchors and windows have nothing but an
    exchange on either side, and Spark splits a hash that very many rows have over many tasks. A text
    equal to one of a smaller doc_id goes as a whole, and its windows need not be compared again.
    """
    if not covers(cover, period) or period >= window:
        raise ValueError("the cover must have every difference modulo the period, and the period be below the window")
    spark = docs.sparkSession
    rows, mark = keyed(docs, text, doc_id), scratch_mark()
    n = docs.count()
    found = written(anchors(rows, window, period, cover), "anchors", rows=n, each=TEXTS_A_FILE)
    most, parts = found.count() // passes, []
    for part in parted(found, "h", passes):
        shared = part.groupBy("h").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).where("lo <> hi").select("h")
        shared = written(shared, "anchor-shared", rows=most // 2)
        parts.append(written(part.join(shared, "h", "left_semi").groupBy("k").agg(F.collect_set("pos").alias("pos")), "anchor-reach", rows=n, each=10 * TEXTS_A_FILE))
        release(spark)
    drop_written(spark, found)
    long = rows.where(F.octet_length("text") >= 2 * window - 1).select("did", "k", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))
    owner = written(least_of_several(long, "t1", "t2"), "anchor-owners", rows=n // 2)
    copies = written(long.join(owner, ["t1", "t2"]).where("did > lo or did is null").select("did", "k").distinct(), "anchor-copies", rows=n)
    reach = reduce(DataFrame.unionByName, parts).groupBy("k").agg(F.flatten(F.collect_list("pos")).alias("pos"))
    whole = copies.groupBy("k").agg(F.collect_list("did").alias("copies"), F.max(F.col("did").isNull()).alias("of_null"))
    reach = written(reach.join(whole, "k", "left"), "anchor-reach", rows=n, each=10 * TEXTS_A_FILE)
    release(spark)
    near = rows.join(reach, "k").where("copies is null or not (case when did is null then of_null else array_contains(copies, did) end)")
    around = written(windows(near, window, period), "anchor-windows", rows=n, each=TEXTS_A_FILE)
    release(spark)
    most, parts = around.count() // passes, []
    for part in parted(around, "w1", passes):
        least = written(least_of_several(part, "w1", "w2"), "anchor-least", rows=most // 2)
        parts.append(written(part.join(least, ["w1", "w2"]).where("did > lo or did is null").groupBy("did", "k").agg(F.collect_set("start").alias("starts")), "anchor-starts", rows=n, each=10 * TEXTS_A_FILE))
        release(spark)
    starts = reduce(DataFrame.unionByName, parts).groupBy("did", "k").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    marks = starts.withColumn("copy", F.lit(False)).unionByName(copies.withColumns({"starts": F.array().cast("array<int>"), "copy": F.lit(True)}))
    marks = written(marks, "anchor-marks", rows=n, each=10 * TEXTS_A_FILE)
    drop_scratch(spark, mark, keep=1)
    release(spark)
    joined = rows.join(marks, same_row(rows, marks), "left").select(rows["did"], rows["text"], F.coalesce(marks["copy"], F.lit(False)).alias("copy"), marks["starts"])
    return removed(joined, window, texts)


#: DuckDB SQL of the query: all windows of all documents by their words.
ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
m AS (SELECT g, min(doc_id) AS lo FROM s GROUP BY g),
c AS (SELECT DISTINCT doc_id, i AS k, i FROM s JOIN m USING (g) WHERE doc_id > lo),
p AS (SELECT doc_id, k, w[k] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM d)),
r AS (SELECT doc_id, k, word, coalesce(max(i) OVER (PARTITION BY doc_id ORDER BY k ROWS UNBOUNDED PRECEDING) >= k - 49, false) AS gone FROM p LEFT JOIN c USING (doc_id, k)),
t AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY k), false) AS first FROM r),
a AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS n_gone, count(*) FILTER (first) AS spans, string_agg(word, ' ' ORDER BY k) FILTER (NOT gone) AS kept FROM t GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_words, coalesce(n_gone, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN a USING (doc_id)
"""
