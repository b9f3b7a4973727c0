"""Operator 11, MinHash near-dedup by fast similarity sketching.

A sketch has COORDINATES bins. In round i each shingle of a text is hashed into one bin with a value, and a
bin keeps its least value of the first round that reached it. After as many rounds as there are bins, each
further round puts all shingles into one bin, so that no bin stays empty. Rounds end as soon as a text has
filled its bins, which for long texts is after one or two. Two texts agree in a coordinate with the
probability of their Jaccard similarity, and the number of agreements is as concentrated as that of
independent draws or more. Sketches are cut into bands; texts that agree in a whole band meet, and what
meets is checked on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, in_bits, release, row_bits, scratch_mark, sends_little, slices, written
from .contain import shingles
from .neardup import TEXTS_A_FILE, by_rare_shingles, links_within, open_groups, similar
from .simhash import classes
from .words import U, Words, joined, mix

WORDS, SHARE = 5, 0.85
#: A pair at 0.85 shares no band once in two million; at 0.5 it shares one in 0.55 of all cases, at 0.3 in 0.06.
BANDS, ROWS = 25, 5
COORDINATES = BANDS * ROWS
#: Bits of a hash that are a shingle's value; the bits above them hold the round.
VALUE_BITS = 56
LOWER = bytes(range(256)).lower()


def shingle_sets(texts: list[bytes | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, hashes): the sorted hashes of the distinct shingles of all texts, and where each text's begin, with the end."""
    owner, hashes = shingles(Words(texts, LOWER), words)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])])[: len(owner)]
    return np.searchsorted(owner[new], np.arange(len(texts) + 1)), hashes[new]


def sketches(first: np.ndarray, hashes: np.ndarray, bins: int = COORDINATES) -> np.ndarray:
    """Sets x bins: the sketch of each set of hashes. That of an empty set is all ones."""
    size = np.diff(first)
    none = ~U(0)
    out = np.full(len(size) * bins, none, dtype=U)
    owner, values = np.repeat(np.arange(len(size)), size), hashes
    low = U((1 << VALUE_BITS) - 1)
    for i in range(2 * bins):
        if not len(values):
            break
        h = mix(values, 0xFA57 + (i << 32))
        bin_ = (((h >> U(32)) * U(bins)) >> U(32)).astype(np.int64) if i < bins else i - bins
        np.minimum.at(out, owner * bins + bin_, (U(i) << U(VALUE_BITS)) | (h & low))
        open_ = (out.reshape(len(size), bins) == none).any(axis=1)
        still = open_[owner]
        if not still.all():
            owner, values = owner[still], values[still]
    return out.reshape(len(size), bins)


def bands_of(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """Sets x bands: a hash of each band's coordinates and place."""
    cut = sketch.reshape(len(sketch), sketch.shape[1] // rows, rows)
    h = np.broadcast_to(np.arange(cut.shape[1], dtype=U), cut.shape[:2])
    for i in range(rows):
        h = joined(h, cut[:, :, i])
    return h


def marked_rows(docs: DataFrame, text: str, doc_id: str, words: int) -> DataFrame:
    """(doc_id, row, text, s1, s2, n, bands): a 128-bit hash of the shingle set, its size, its bands (none if empty)."""
    kinds = {c: docs.schema[c].dataType.simpleString() for c in (doc_id, text)}
    source = docs.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            first, hashes = shingle_sets(texts, words)
            size = np.diff(first)
            whole = [xxhash.xxh3_128_digest(hashes[a:b].tobytes()) for a, b in zip(first, first[1:])]
            halves = np.frombuffer(b"".join(whole), dtype=np.int64).reshape(-1, 2)
            full = np.flatnonzero(size)
            bands = bands_of(sketches(np.concatenate([[0], np.cumsum(size[full])]), hashes))
            offsets = np.concatenate([[0], np.cumsum(np.where(size > 0, BANDS, 0))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.ravel().view(np.int64)))
            columns = [pa.array(np.ascontiguousarray(halves[:, i])) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns, pa.array(size.astype(np.int64)), lists], names=["doc_id", "row", "text", "s1", "s2", "n", "bands"])

    return source.mapInArrow(run, f"doc_id {kinds[doc_id]}, row long, text {kinds[text]}, s1 long, s2 long, n long, bands array<long>")


def sets_of(texts: DataFrame, words: int) -> DataFrame:
    """(id, s, n) of texts(id, text): the full shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in slices(batches, "text"):
            first, hashes = shingle_sets(raw, words)
            s = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), s, pa.array(np.diff(first).astype(np.int32))], names=["id", "s", "n"])

    return texts.select("id", "text").mapInArrow(run, "id long, s array<long>, n int")


def similar_pairs(met: DataFrame, sets: DataFrame, asked: DataFrame, count: int, share: float) -> DataFrame:
    """Links (a, b) that connect what all similar pairs that meet would, of met(cell, id, m).

    Each cell's members are compared with the one that meets most others, which makes as many pairs as there
    are members. Cells whose members are then not all of one class are compared pair by pair, in blocks, or
    by their rare shingles.
    """
    score = met.groupBy("id").agg(F.sum("m").alias("score"))
    centre = met.join(score, "id").groupBy("cell").agg(F.max_by("id", F.struct("score", -F.col("id"))).alias("centre"))
    pairs = met.join(written(centre, "sketch-centres", rows=count), "cell").where("id <> centre")
    pairs = written(pairs.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct(), "sketch-pairs", rows=2 * count)
    edges = written(similar(pairs, sets, share), "sketch-edges", rows=count, each=2 * TEXTS_A_FILE)
    release(met.sparkSession)
    rooted = written(classes(asked, edges), "sketch-classes", rows=count)
    members = written(open_groups(met, rooted, count).join(sets.select("id", "s"), "id"), "sketch-members", rows=count, each=TEXTS_A_FILE)
    release(met.sparkSession)
    members = written(by_rare_shingles(members, share, count), "sketch-compared", rows=count, each=TEXTS_A_FILE)
    return edges.unionByName(written(links_within(members, share).distinct(), "sketch-links", rows=count))


@sends_little
def minhash_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, share: float = SHARE) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (the least doc_id of what links connect), kept (whether that is its own).

    Documents are linked if their sets of distinct shingles (A-Z lower-cased; a text of fewer words is
    one shingle) have a similarity of `share` or more, computed on the full sets of all that meet in a
    band. `share` below 0.8 would need more bands. Null, empty or blank text: no shingles, linked with
    nothing. Equal sets are one node, so a third of all rows in one group of copies is one node; the joins
    that bring classes back are skew-split by Spark at run time. Null doc_id: links like others, but never
    names a component unless all its members are null (then null, and kept). Repeated rows stay, and all
    rows of the least doc_id are kept. Texts are read whole; other columns are ignored; no rows give no rows.
    """
    total, mark = docs.count(), scratch_mark()
    marked = written(marked_rows(docs, text, doc_id, words), "sketch-rows", rows=total, each=TEXTS_A_FILE)
    nodes = marked.where("n > 0").groupBy("s1", "s2").agg(F.min("row").alias("id"), F.min("doc_id").alias("least"))
    nodes = written(nodes, "sketch-nodes", rows=total)
    count = nodes.count()
    firsts = written(row_bits(nodes, "id"), "sketch-firsts", rows=1)
    visits = in_bits(marked.select(F.col("row").alias("id"), "bands"), "id", firsts).select("id", F.explode("bands").alias("cell"))
    visits = written(visits, "sketch-visits", rows=BANDS * count)
    shared = written(visits.groupBy("cell").agg(F.count("*").alias("m")).where("m > 1"), "sketch-shared", rows=count)
    met = written(visits.join(shared, "cell"), "sketch-met", rows=BANDS * count)
    release(docs.sparkSession)
    asked = written(met.select("id").distinct(), "sketch-asked", rows=count)
    bits = written(row_bits(asked, "id"), "sketch-bits", rows=1)
    sets = written(sets_of(in_bits(marked.select(F.col("row").alias("id"), "text"), "id", bits), words), "sketch-sets", rows=asked.count(), each=TEXTS_A_FILE)
    edges = similar_pairs(met, sets, asked, count, share)
    rooted = written(classes(nodes.select("id"), edges).join(nodes, "id"), "sketch-roots", rows=count)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_set = written(rooted.join(named, "root").select("s1", "s2", "component_id"), "sketch-named", rows=count)
    full = marked.where("n > 0").select("doc_id", "n", "s1", "s2").join(by_set, ["s1", "s2"]).select("doc_id", "n", "component_id")
    every = full.unionByName(marked.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    result = every.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    result = written(result, "sketch-result", rows=total)
    drop_scratch(docs.sparkSession, mark, keep=1)
    return result
