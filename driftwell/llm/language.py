"""Operator 3, language identification of mixed-language text.

The script of a word's letters narrows the candidate languages; every word gets a score for each
candidate from letter trigrams; Viterbi with a penalty for switching then labels the spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import apart, drop_scratch, scratch_mark, written

#: About so many labelled rows are what the model is fitted on at most, the same number of each language that has enough, chosen by a hash of the row.
FIT_ROWS = 20_000
BUCKETS = 1 << 16
SWITCH_PENALTY = 8.0
#: A language is a candidate for a script that has at least this share of its letters.
SCRIPT_SHARE = 0.01
#: Steps of the Viterbi pass run over all texts of a block of so many bytes at once, for up to eight languages; of more, blocks are smaller.
BLOCK_BYTES = 4 << 20

#: First code point and name of script ranges, fixed values; a range ends where the next begins.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"),
)
SCRIPT_NAMES = tuple(dict.fromkeys(n for _, n in SCRIPTS))


class Letters:
    """Lookup tables over the basic plane; code points beyond it count as letters of script 'other' if alphabetic."""

    def __init__(self):
        points = range(0x10000)
        self.lower = np.array([ord(low) if len(low := chr(c).lower()) == 1 else c for c in points], dtype=np.uint32)
        self.alpha = np.array([chr(c).isalpha() for c in points])
        self.script = np.zeros(0x10000, dtype=np.int8)
        for first, name in SCRIPTS:
            self.script[first:] = SCRIPT_NAMES.index(name)
        self.other = SCRIPT_NAMES.index("other")


class Block:
    """Letters, words and trigram buckets of a list of texts."""

    def __init__(self, texts: list[str], tables: Letters):
        joined = " ".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        self.at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        plane = points < 0x10000
        low = np.where(plane, points, 0)
        alpha = np.where(plane, tables.alpha[low], False)
        for i in np.flatnonzero(~plane):
            alpha[i] = chr(points[i]).isalpha()
        folded = np.where(alpha, np.where(plane, tables.lower[low], points), 0).astype(np.uint64)
        padded = np.concatenate([[0], folded, [0]]).astype(np.uint64)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], alpha.astype(np.int8), [0]])))
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.start, self.at)
        self.letters = np.flatnonzero(alpha)
        with np.errstate(over="ignore"):
            h = padded[:-2] * np.uint64(0x9E3779B97F4A7C15) + padded[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + padded[2:] * np.uint64(0x165667B19E3779F9)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        self.bucket = (h[self.letters] >> np.uint64(48)).astype(np.int64)
        self.script = np.where(plane, tables.script[low], tables.other)[self.letters]
        self.word_at = np.searchsorted(self.letters, self.start)  # first letter of each word


def fit(docs: DataFrame, text: str, lang: str, rows: int = FIT_ROWS) -> dict | None:
    """A model from the labelled rows: languages, trigram log probabilities, candidate scripts. None without labels.

    Rows beyond `rows` are left out by language: each has an equal part, and one with fewer rows than that
    keeps all of them, so rare languages stay. Copies of a text are chosen each by itself. Of each language
    one row of counts comes to the driver.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("h"))
    found = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    part = found.withColumn("part", F.lit(float(rows << 30)) / (F.col("n") * F.count("*").over(Window.partitionBy())))  # a row a language
    mark = scratch_mark()
    part = written(part.select("lang", "part"), "language-parts", rows=1)  # of known size, so Spark broadcasts it if it is small
    sample = labelled.join(part, "lang").where(F.pmod("h", F.lit(1 << 30)) < F.col("part")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Letters()
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for name in sorted(set(langs)):
                own = [t for x, t in zip(langs, texts) if x == name]
                for i in range(0, len(own), 200):
                    block = Block(own[i : i + 200], tables)
                    for kind, values, n in (("g", block.bucket, BUCKETS), ("s", block.script, len(SCRIPT_NAMES))):
                        counts = np.bincount(values, minlength=n)
                        at = np.flatnonzero(counts)
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array([kind] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], names=["lang", "kind", "at", "n"])

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        """The counts of one language, trigrams and then scripts, as bytes."""
        counts = np.zeros(BUCKETS + len(SCRIPT_NAMES))
        counts[pdf["at"].to_numpy() + np.where(pdf["kind"] == "s", BUCKETS, 0)] = pdf["n"].to_numpy()
        return pd.DataFrame({"lang": pdf["lang"].iloc[:1], "counts": [counts.tobytes()]})

    summed = sample.mapInArrow(count, "lang string, kind string, at int, n long").groupBy("lang", "kind", "at").agg(F.sum("n").alias("n"))
    packed = sorted(summed.groupBy("lang").applyInPandas(pack, "lang string, counts binary").collect())
    drop_scratch(docs.sparkSession, mark)
    names = [r["lang"] for r in packed]
    if not names:
        return None
    both = np.stack([np.frombuffer(r["counts"]) for r in packed], axis=1)
    grams, scripts = both[:BUCKETS], both[BUCKETS:]
    logs = np.log((grams + 0.1) / (grams.sum(0) + 0.1 * BUCKETS))
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
    allowed |= ~allowed.any(1, keepdims=True)  # a script of no language leaves all of them
    return {"names": names, "logs": logs.astype(np.float32), "allowed": allowed}


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word. scores: words x labels; first: where each text's words begin, and the end.

    Step t advances every text that has a word t, all at once. Values are doubles relative to the best
    one, so they neither grow nor lose digits with the length of a text.
    """
    kind = np.min_scalar_type(-scores.shape[1])
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    begin, counts = first[:-1][order], counts[order]
    longest = int(counts[0]) if len(counts) else 0
    active = np.searchsorted(-counts, -np.arange(longest), side="left")  # texts with more than t words
    back = np.zeros(scores.shape, dtype=kind)
    labels = np.zeros(len(scores), dtype=kind)
    if not longest:
        return labels
    own = np.arange(scores.shape[1], dtype=kind)
    value = scores[begin[: active[0]]].astype(np.float64)
    final = np.zeros(len(counts), dtype=kind)
    for t in range(1, longest):
        k = active[t]
        if k < len(value):
            final[k : len(value)] = value[k:].argmax(1)
            value = value[:k]
        best = value.argmax(1)
        top = np.take_along_axis(value, best[:, None], 1) - penalty
        stay = value >= top
        at = begin[:k] + t
        back[at] = np.where(stay, own, best[:, None])
        value = np.where(stay, value, top) - (top + penalty) + scores[at]
    final[: len(value)] = value.argmax(1)
    now = final.copy()
    for t in range(longest - 1, -1, -1):
        k = active[t]
        at = begin[:k] + t
        labels[at] = now[:k]
        now[:k] = back[at, now[:k]]
    return labels


def label(texts: list[str], model: dict, tables: Letters, penalty: float) -> list[tuple[str, float, str]]:
    """(language, score, spans) of each text."""
    block = Block(texts, tables)
    names = model["names"]
    if not len(block.start):
        return [("und", 0.0, "")] * len(texts)
    scores = np.add.reduceat(model["logs"][block.bucket], block.word_at, axis=0)
    scores = np.where(model["allowed"][block.script[block.word_at]], scores, scores - 1e6)
    labels = viterbi(scores, block.first, penalty)
    size = block.end - block.start
    out = []
    for i in range(len(texts)):
        lo, hi = block.first[i], block.first[i + 1]
        if lo == hi:
            out.append(("und", 0.0, ""))
            continue
        own, base = labels[lo:hi], block.at[i]
        weight = np.bincount(own, weights=size[lo:hi], minlength=len(names))
        cut = np.flatnonzero(np.diff(own)) + 1
        begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [hi - lo]]) - 1
        spans = ",".join(f"{names[own[b]]}:{block.start[lo + b] - base}:{block.end[lo + e] - base}" for b, e in zip(begin, end))
        best = int(weight.argmax())
        out.append((names[best], float(weight[best] / weight.sum()), spans))
    return out


def identify_languages(docs: DataFrame, model: dict | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",), penalty: float = SWITCH_PENALTY) -> DataFrame:
    """Columns `keep`, lang_pred, score (share of the letters in spans of that language), spans (language:start:end in code points).

    Columns of `keep` that are named like a new one are left out.
    und, 0 and '' for a text that is null or has no letter, and for all texts if there is no model.
    Rows are independent: no shuffle; repeated rows are labelled each. Texts are labelled whole.
    Ties go to the language first in order of name. An empty table gives an empty table.
    """
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    keep = apart(keep, "lang_pred", "score", "spans")
    source = docs.select(*[docs[c].alias(f"__k{i}") for i, c in enumerate(keep)], docs[text].alias("__text"))
    most = BLOCK_BYTES * 8 // max(8, len(model["names"]) if model else 0)
    names = [*keep, "lang_pred", "score", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Letters()
        for batch in batches:
            texts, out = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()], []
            lo = size = 0
            for i, t in enumerate(texts):
                size += len(t)
                if size > most or i == len(texts) - 1:
                    out += label(texts[lo : i + 1], model, tables, penalty) if model else [("und", 0.0, "")] * (i + 1 - lo)
                    lo, size = i + 1, 0
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64()), pa.array([x[2] for x in out], pa.string())], names=names)

    return source.mapInArrow(run, "".join(f"`{c}` {kinds[c]}, " for c in keep) + "lang_pred string, score double, spans string")


def held_out(doc_id: str = "doc_id", folds: int = 5):
    """True for documents that no model may learn from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds == 0
