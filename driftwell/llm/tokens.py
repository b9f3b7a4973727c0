"""Operator 4, token counts: rank-synchronous array merging.

Pre-tokens are held as ragged numpy arrays of symbol ids. In each step every sequence applies its own
lowest-ranked pair, all sequences at once, until no sequence has a pair to merge; the symbols that
survive are the tokens.

A pass over all symbols for each rank would cost a long unbroken run the square of its length. Long
sequences are therefore merged by themselves: a queue holds the places of each rank, and a step touches
only the places of the lowest one and their neighbours.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import apart

#: Pre-token counts that a worker keeps between batches.
CACHE_ENTRIES = 300_000
#: Symbols merged together in one block of sequences.
BLOCK_SYMBOLS = 1 << 18
#: Sequences of more bytes than this are merged by a queue of ranks.
LONG = 1 << 12
#: The ByteLevel pre-tokenizer's pattern, a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.int64(1 << 40)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones themselves, others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merger:
    """A byte-level BPE model read from a tokenizers JSON file."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        if model["model"]["type"] != "BPE" or model["pre_tokenizer"]["type"] != "ByteLevel" or model["pre_tokenizer"].get("add_prefix_space") or model["normalizer"] or model["model"].get("ignore_merges"):
            raise ValueError("a plain byte-level BPE without normalizer is asked for")
        vocab, letters = model["model"]["vocab"], byte_letters()
        self.byte_ids = np.full(256, -1, dtype=np.int64)
        for letter, b in letters.items():
            self.byte_ids[b] = vocab[letter]
        self.size = max(vocab.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order.astype(np.int64)
        self.result = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        # an open-addressed table: one or two looks instead of a binary search
        self.bits = max(8, (2 * len(self.keys)).bit_length())
        self.slots = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NONE, dtype=np.int64)
        left_keys, left_ranks, step = self.keys, self.ranks, 0
        while len(left_keys):
            at = (self.place(left_keys) + step) & ((1 << self.bits) - 1)
            free = self.slots[at] < 0
            where, first = np.unique(at, return_index=True)
            took = np.zeros(len(at), dtype=bool)
            took[first] = True
            took &= free
            self.slots[at[took]], self.values[at[took]] = left_keys[took], left_ranks[took]
            left_keys, left_ranks, step = left_keys[~took], left_ranks[~took], step + 1
        self.steps = step
        special = sorted((t["content"] for t in model["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def place(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where there is no such merge."""
        key = left * self.size + right
        out = np.full(len(key), NONE, dtype=np.int64)
        at, open_ = self.place(key), np.arange(len(key))
        for step in range(self.steps):
            slot = (at[open_] + step) & ((1 << self.bits) - 1)
            found = self.slots[slot]
            hit = found == key[open_]
            out[open_[hit]] = self.values[slot[hit]]
            open_ = open_[~hit & (found >= 0)]
            if not len(open_):
                break
        return out

    def merge(self, pieces: list[bytes]) -> np.ndarray:
        """Number of symbols left of each piece (at least one byte long)."""
        size = np.array([len(p) for p in pieces], dtype=np.int64)
        ids = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), size)
        out = size.copy()
        while len(ids) > 1:
            joint = owner[1:] == owner[:-1]
            rank = np.full(len(ids), NONE, dtype=np.int64)
            rank[:-1][joint] = self.rank(ids[:-1][joint], ids[1:][joint])
            edge = np.concatenate([[0], np.flatnonzero(~joint) + 1])
            least = np.minimum.reduceat(rank, edge)
            lengths = np.diff(np.append(edge, len(ids)))
            done = least == NONE
            chosen = (rank == np.repeat(least, lengths)) & (rank < NONE)
            # runs of overlapping choices (a a a): every second one from the left
            at = np.flatnonzero(chosen)
            if len(at):
                start = np.ones(len(at), dtype=bool)
                start[1:] = at[1:] != at[:-1] + 1
                in_run = at - at[start][np.cumsum(start) - 1]
                at = at[in_run % 2 == 0]
                ids[at] = self.result[rank[at]]
                keep = np.ones(len(ids), dtype=bool)
                keep[at + 1] = False
                np.subtract.at(out, owner[at], 1)
            else:
                keep = np.ones(len(ids), dtype=bool)
            if done.any():
                keep &= ~np.repeat(done, lengths)
            ids, owner = ids[keep], owner[keep]
        return out

    def merge_long(self, piece: bytes) -> int:
        """Number of symbols left of one piece: as merge(), but a step costs what it touches."""
        ids = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)]
        n = left = len(ids)
        ids = np.append(ids, -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)  # place n is the end; before the first is -1, which is place n too
        rank = np.full(n + 1, NONE, dtype=np.int64)  # of the pair that begins at a place that is still a symbol
        places: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def add(at: np.ndarray) -> None:
            """Rank the pairs that begin at these places anew."""
            right = after[at]
            new = np.where(right < n, self.rank(ids[at], ids[np.minimum(right, n)]), NONE)
            rank[at] = new
            at, new = at[new < NONE], new[new < NONE]
            turn = np.argsort(new, kind="stable")
            at, new = at[turn], new[turn]
            edge = np.flatnonzero(np.append(True, new[1:] != new[:-1])) if len(new) else np.zeros(0, dtype=np.int64)
            for lo, hi in zip(edge.tolist(), [*edge[1:].tolist(), len(new)]):
                r = int(new[lo])
                if r not in places:
                    places[r] = []
                    heapq.heappush(queue, r)
                places[r].append(at[lo:hi])

        add(np.arange(n))
        while queue:
            r = heapq.heappop(queue)
            at = np.unique(np.concatenate(places.pop(r)))
            at = at[rank[at] == r]  # others have changed since
            if not len(at):
                continue
            # runs of overlapping choices: every second one from the left
            start = np.append(True, after[at[:-1]] != at[1:])
            at = at[(np.arange(len(at)) - np.flatnonzero(start)[np.cumsum(start) - 1]) % 2 == 0]
            gone = after[at]
            ids[at] = self.result[r]
            rank[gone] = NONE
            after[at] = after[gone]
            before[after[at]] = at
            left -= len(at)
            touched = np.concatenate([at, before[at]])
            add(np.unique(touched[touched >= 0]))
        return left

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text; strings of added tokens in a text count one each."""
        split, missing, totals, known = [], {}, [], self.known
        for t in texts:
            n = 0
            parts = [t]
            if self.special is not None and self.special.search(t):
                n, parts = len(self.special.findall(t)), self.special.split(t)
            pieces = [p for part in parts for p in self.pattern.findall(part)]
            split.append((n, pieces))
            for p in pieces:
                if p not in known:
                    missing[p] = 0
        for p in missing:
            if len(raw := p.encode()) > LONG:
                missing[p] = self.merge_long(raw)
        names = [p for p, n in missing.items() if not n]
        lo = total = 0
        raw = [p.encode() for p in names]
        for i, p in enumerate(raw):
            total += len(p)
            if total >= BLOCK_SYMBOLS or i == len(raw) - 1:
                missing.update(zip(names[lo : i + 1], self.merge(raw[lo : i + 1]).tolist()))
                lo, total = i + 1, 0
        for n, pieces in split:
            totals.append(n + sum([known[p] if p in known else missing[p] for p in pieces]))
        if len(known) + len(missing) > CACHE_ENTRIES:
            known.clear()
        if len(missing) <= CACHE_ENTRIES:
            known.update(missing)
        return totals


def token_counts(docs: DataFrame, spec: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), limit: int = 1024) -> DataFrame:
    """Columns `keep`, n_bytes, n_tokens, over_limit (n_tokens > limit) of each row.

    spec: the JSON text of the tokenizer, which travels to the executors with the job.
    Null text counts as empty: no bytes, no tokens. Rows are independent, so repeated rows are counted
    each and nothing is shuffled. Texts are counted whole, unbroken runs too: their time grows a little faster than their length. An empty
    table gives an empty table. Columns not in `keep` are ignored, as are those
    of `keep` that are named like a new one.
    """
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    keep = apart(keep, "n_bytes", "n_tokens", "over_limit")
    source = docs.select(*[docs[c].alias(f"__k{i}") for i, c in enumerate(keep)], docs[text].alias("__text"))
    names = [*keep, "n_bytes", "n_tokens", "over_limit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = None
        for batch in batches:
            merger = merger or Merger(spec)
            texts, counts, sizes = [t.as_py() or "" for t in batch.column(batch.num_columns - 1)], [], []
            lo = size = 0
            for i, t in enumerate(texts):
                size += len(t)
                if size > 1 << 20 or i == len(texts) - 1:
                    counts += merger.count(texts[lo : i + 1])
                    lo, size = i + 1, 0
            sizes = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())], names=names)

    return source.mapInArrow(run, "".join(f"`{c}` {kinds[c]}, " for c in keep) + "n_bytes long, n_tokens long, over_limit boolean")
