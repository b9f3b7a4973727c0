"""Texts of a batch as numpy arrays: words, their hashes, hashes of windows."""

from __future__ import annotations

from itertools import chain

import numpy as np
import xxhash

U = np.uint64
#: Odd multipliers: of the polynomial hash of grams, and of the two halves of a pair.
GRAM_BASE, LEFT, RIGHT = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


class Digests(dict):
    """XXH3 hashes of 128 bits of byte words; those of words that come again are kept."""

    MOST = 1 << 17

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.MOST:
            self.clear()
        found = self[word] = xxhash.xxh3_128_digest(word)
        return found


_digests = Digests()


def split(text: bytes | None, table: bytes | None = None) -> list[bytes]:
    """Words between space, tab, \\n, \\v, \\f and \\r; table: what each byte counts as."""
    return (text.translate(table) if table else text).split() if text else []


class Words:
    """Hashes of the words of a list of byte texts; None and '' have none.

    a, b: the halves of each word's 128-bit hash; first: index of each text's first word, and the number of all at the end.
    """

    def __init__(self, texts: list[bytes | None], table: bytes | None = None):
        words = [split(t, table) for t in texts]
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in words])]).astype(np.int64)
        both = np.frombuffer(b"".join(map(_digests.__getitem__, chain.from_iterable(words))), dtype=U).reshape(-1, 2)
        self.a, self.b = (np.ascontiguousarray(both[:, i]) for i in (0, 1))

    def text_of_word(self) -> np.ndarray:
        """Index of the text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        x = x ^ U(salt)
        x ^= x >> U(33)
        x *= U(0xFF51AFD7ED558CCD)
        x ^= x >> U(33)
        x *= U(0xC4CEB9FE1A85EC53)
        x ^= x >> U(33)
        return x


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of each pair, in this order."""
    with np.errstate(over="ignore"):
        return mix(a * U(LEFT) + b * U(RIGHT))


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of each `width` consecutive values (uint64); windows of equal values have equal hashes.

    A window is halved down to single values, and two halves are scrambled together: unlike a
    polynomial modulo 2 ** 64, on which structured sequences collide for every odd base.
    """
    n = len(values) - width + 1
    if n < 1:
        return np.zeros(0, dtype=U)
    h, span = values, 1
    while 2 * span <= width:
        h, span = joined(h[:-span], h[span:]), 2 * span
    return h[:n] if span == width else joined(h[:n], h[width - span :])


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of each `width` bytes: quick, and only good to choose minimizers by."""
    n = len(data) - width + 1
    if n < 1:
        return np.zeros(0, dtype=U)
    with np.errstate(over="ignore"):
        up, down = (np.multiply.accumulate(np.concatenate([[U(1)], np.full(len(data), x, dtype=U)])) for x in (U(GRAM_BASE), U(pow(GRAM_BASE, -1, 1 << 64))))
        total = np.zeros(len(data) + 1, dtype=U)
        np.cumsum((data.astype(U) + U(1)) * up[:-1], out=total[1:])
        return mix((total[width:] - total[:-width]) * down[:n])


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts (2, 0, 3): owners (0, 0, 2, 2, 2) and ranks (0, 1, 0, 1, 2)."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
