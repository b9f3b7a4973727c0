"""Operator 7, benchmark decontamination: size-partitioned MinHash containment search.

Test items are partitioned by their number of shingles. In a partition every item keeps the bottom of
its shingle hashes, a bottom-k MinHash sketch, just wide enough that a document holding the asked-for share of
the largest item of the partition must hold one hash of the sketch. The sketch is thus used as a prefix filter:
documents are not sketched, however long they are, and looked up whole, so that no item is missed by chance.
Candidates are verified by exact shingle containment.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import apart, slices
from .words import U, Words, mix, split, window_hashes

SHINGLE = 5
SHARE = 0.8
#: Most words of items that travel to the executors together; more items are searched in blocks, pass after pass.
BLOCK_WORDS = 1_000_000
FILTER_BITS = 20

#: Words are runs of a-z, 0-9 and bytes above 0x7F, after A-Z are lower-cased; all else counts as a space.
LETTERS = bytes(c if c > 0x7F or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower())


def windows(words: Words, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of all runs of n words; runs of fewer than `width` have hashes of their own kind."""
    full = window_hashes(words.a, n)
    owner = words.text_of_word()
    at = np.arange(len(owner)) - words.first[:-1][owner]
    fits = np.flatnonzero((at + n <= np.diff(words.first)[owner])[: len(full)])
    return owner[fits], full[fits] if n == width else mix(full[fits], n)


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of all shingles; a text of 1 to width - 1 words has one shingle, of all of them."""
    size = np.diff(words.first)
    found = [windows(words, width, width)]
    for n in range(1, width):
        short = size == n
        if short.any():
            owner, hashes = windows(words, n, width)
            found.append((owner[short[owner]], hashes[short[owner]]))
    return np.concatenate([o for o, _ in found]), np.concatenate([h for _, h in found])


def word_tuples(text: bytes, width: int) -> set[tuple[bytes, ...]]:
    """The shingles themselves; of a text of fewer words all of it."""
    words = split(text, LETTERS)
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


class Items:
    """Test items of one block: their sketches, sorted by hash, and all their shingles."""

    def __init__(self, ids: list, texts: list[bytes], width: int, share: float):
        self.ids, self.width, self.share = ids, width, share
        self.tuples = [word_tuples(t, width) for t in texts]
        self.wide = [len(next(iter(t), ())) for t in self.tuples]  # words of an item's shingles
        self.widths = sorted({n for n in self.wide if n})
        owner, hashes = shingles(Words(texts, LETTERS), width)
        self.sets = [np.unique(hashes[owner == i]) for i in range(len(texts))] if len(texts) < 64 else self.grouped(owner, hashes, len(texts))
        sketch, whose = [], []
        for i, own in enumerate(self.sets):
            if len(own):
                largest = (1 << len(own).bit_length()) - 1  # of the size partition
                wide = largest - math.ceil(share * largest) + 1
                low = own[np.argsort(mix(own, 7), kind="stable")[: min(len(own), wide)]]
                sketch.append(low)
                whose.append(np.full(len(low), i))
        sketch, whose = (np.concatenate(x) if x else np.zeros(0, dtype=t) for x, t in ((sketch, U), (whose, np.int64)))
        order = np.argsort(sketch, kind="stable")
        self.sketch, self.whose = sketch[order], whose[order]
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[(self.sketch >> U(64 - FILTER_BITS)).astype(np.int64)] = True

    @staticmethod
    def grouped(owner: np.ndarray, hashes: np.ndarray, n: int) -> list[np.ndarray]:
        order = np.argsort(owner, kind="stable")
        return [np.unique(x) for x in np.split(hashes[order], np.searchsorted(owner[order], np.arange(1, n)))]

    def search(self, texts: list[bytes | None]) -> list[list[tuple[object, float]]]:
        """(id, containment) of the items that each text holds."""
        out: list[list] = [[] for _ in texts]
        words = Words(texts, LETTERS)
        found = [windows(words, n, self.width) for n in self.widths]
        if not found:
            return out
        owner, hashes = np.concatenate([o for o, _ in found]), np.concatenate([h for _, h in found])
        maybe = np.flatnonzero(self.filter[(hashes >> U(64 - FILTER_BITS)).astype(np.int64)])
        lo, hi = np.searchsorted(self.sketch, hashes[maybe], "left"), np.searchsorted(self.sketch, hashes[maybe], "right")
        pairs = {(int(owner[m]), int(i)) for m, a, b in zip(maybe, lo, hi) if a < b for i in self.whose[a:b]}
        if not pairs:
            return out
        order = np.argsort(owner, kind="stable")
        owner, hashes = owner[order], hashes[order]
        of, held, tuples = -1, hashes[:0], {}
        for text, item in sorted(pairs):
            if text != of:
                of, held, tuples = text, np.unique(hashes[np.searchsorted(owner, text) : np.searchsorted(owner, text + 1)]), {}
            own, n = self.sets[item], self.wide[item]
            if np.isin(own, held).sum() < self.share * len(own) - 1e-9:
                continue
            if n not in tuples:
                tuples[n] = word_tuples(texts[text], n)
            asked = self.tuples[item]
            part = len(asked & tuples[n]) / len(asked)
            if part >= self.share - 1e-12:
                out[text].append((self.ids[item], part))
        return out


def containment(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", keep: tuple[str, ...] = ("doc_id",), width: int = SHINGLE, share: float = SHARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Columns `keep` and matches: array of (item, containment) of the items of which the text holds `share` or more.

    Containment is the share of an item's distinct shingles of `width` words that the text has. An item
    of fewer words has one shingle, of all of them, and is found wherever these words stand in a row; an
    item without words is found nowhere. Null or empty text: no matches. Null item
    id: matched like others. A column of `keep` called matches is left out. Repeated items: each is listed. Rows are independent and never shuffled;
    only items move, in blocks of about `block_words` words, so their number is not bounded. Ties and
    other columns are of no account. An empty table of either kind gives no matches.
    """
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    keep = apart(keep, "matches")
    id_kind = items.schema[item_id].dataType.simpleString()
    chosen = items.where(F.col(item_text).isNotNull()).select(F.col(item_id).alias("item"), F.col(item_text).alias("text"))
    words = chosen.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"] // 4
    blocks = max(1, -(-words // block_words))
    shape = f"array<struct<item:{id_kind},containment:double>>"
    names = [f"__k{i}" for i in range(len(keep))]
    frame = docs.select(*[docs[c].alias(n) for c, n in zip(keep, names)], docs[text].alias("__text"), F.array().cast(shape).alias("__matches"))

    def search(block: Items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in slices(batches, "__text"):
                at = batch.schema.get_field_index("__matches")
                before = batch.column(at).to_pylist()
                found = [b + [{"item": i, "containment": c} for i, c in x] for b, x in zip(before, block.search(texts))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(found, batch.schema.field(at).type)], schema=batch.schema)

        return run

    for b in range(blocks):
        part = chosen if blocks == 1 else chosen.where(F.pmod(F.xxhash64("text", "item"), F.lit(blocks)) == b)  # equal items come apart
        got = part.collect()  # of about block_words words
        frame = frame.mapInArrow(search(Items([r["item"] for r in got], [r["text"].encode() for r in got], width, share)), frame.schema)
    return frame.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], F.array_sort("__matches").alias("matches"))


#: DuckDB SQL of the query: documents and the items that they hold.
ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bs AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT item_id, w, least(len(w), 5) AS k, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM b WHERE len(w) > 0)),
ds AS (SELECT DISTINCT doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bs) WHERE len(w) >= k)),
n AS (SELECT item_id, count(*) AS n FROM bs GROUP BY item_id),
hit AS (SELECT doc_id, item_id, count(*) AS k FROM ds JOIN bs USING (k, s) GROUP BY ALL)
SELECT doc_id, item_id, CAST(1000 * k // n AS BIGINT) AS contained_permille FROM hit JOIN n USING (item_id) WHERE k >= 0.8 * n
"""
