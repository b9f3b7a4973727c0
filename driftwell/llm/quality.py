"""Operator 1, quality rules: compression bands.

A text is rejected when zstandard shrinks it too much (repetitive) or hardly at all (incompressible),
as a whole or in too many of its fixed chunks. The limits depend on the length, because short texts
shrink less than long ones.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import apart, give_back

#: (bytes up to and including, least ratio, most ratio). The last band is open. Limits for prose: a little outside
#: the least and greatest ratios of texts that are labelled good. Code or tables need limits of their own.
BANDS = (
    (128, 0.55, 1.60),
    (512, 0.95, 2.10),
    (1024, 1.25, 2.12),
    (2048, 1.45, 2.25),
    (4096, 1.60, 2.32),
    (16384, 1.75, 2.50),
    (131072, 2.00, 2.65),
    (None, 2.00, 3.20),
)
LEVEL = 3
CHUNK_BYTES = 4096
#: A text goes when more than this share of its chunks lies outside the chunk's band.
CHUNK_SHARE = 0.5

SYMBOLS = re.compile(r"[#*$%&|<>]")
WORD = re.compile(r"[^ \t-\r]+")

SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, ratio double, n_chunks long, n_chunks_out long, verdict string, kept boolean"


def band(n_bytes: int, bands=BANDS) -> tuple[float, float]:
    """Least and most ratio for a text of so many bytes."""
    return next((lo, hi) for most, lo, hi in bands if most is None or n_bytes <= most)


def repeated_words(words: list[str]) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    total, covered = 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


def duplicate_lines(text: str) -> int:
    """Lines between \\n that hold a word and equal an earlier line."""
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(lines) - len(set(lines))


def measure(text: str | None, press: zstandard.ZstdCompressor, bands=BANDS, chunk: int = CHUNK_BYTES, share: float = CHUNK_SHARE) -> tuple:
    """The columns of SCHEMA for one text; a null text counts as empty."""
    text = text or ""
    raw = text.encode()
    words = WORD.findall(text)
    n, repeats = len(words), repeated_words(words)
    failed = n < 50 or 100 * repeats > 50 * n
    ratio, chunks, out, verdict = None, 0, 0, "empty"
    if raw:
        ratio = len(raw) / len(press.compress(raw))
        lo, hi = band(len(raw), bands)
        verdict = "incompressible" if ratio < lo else "repetitive" if ratio > hi else "in band"
        for i in range(0, len(raw), chunk):
            part = raw[i : i + chunk]
            lo, hi = band(len(part), bands)
            chunks += 1
            out += not lo <= len(part) / len(press.compress(part)) <= hi
        if verdict == "in band" and out > share * chunks:
            verdict = "chunks out of band"
    return n, sum(map(len, words)), len(SYMBOLS.findall(text)), duplicate_lines(text), repeats, failed, ratio, chunks, out, verdict, not failed and verdict == "in band"


def quality_rules(docs: DataFrame, text: str = "text", bands=BANDS, level: int = LEVEL, chunk_bytes: int = CHUNK_BYTES, chunk_share: float = CHUNK_SHARE, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Measures and verdict of each row, beside the columns of `keep` (all columns by default).

    Rows are independent: no shuffle. Columns of docs named like a measure are left out.
    Null text: no words, base_failed, ratio null. Empty text: the same. Repeated rows: each on its own.
    Very long texts are measured whole, one at a time. An empty table gives an empty table.
    """
    measures = [x.split()[0] for x in SCHEMA.split(", ")]
    keep = apart(tuple(docs.columns) if keep is None else keep, *measures)
    kept = docs.select(*[f"`{c}`" for c in keep])
    hidden = "__text"
    source = docs.select(*[f"`{c}`" for c in keep], docs[text].alias(hidden))
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=level)
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
        for batch in batches:
            rows = [measure(t.as_py(), press, bands, chunk_bytes, chunk_share) for t in batch.column(batch.num_columns - 1)]
            columns = [pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], type=k) for k in kinds]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*keep, *measures])
        give_back()

    return source.mapInArrow(run, f"{names}{', ' if names else ''}{SCHEMA}")
