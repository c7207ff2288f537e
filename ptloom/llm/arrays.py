"""Vectorised byte and word arrays: the numpy work inside a task.

Texts are handled as UTF-8 bytes.  A chunk is a few texts joined by a
separator that is no word byte, so that words, lines and n-grams of many
texts come out of a handful of whole-array operations.  Hashes are 64 bit:
a polynomial over the bytes of a word, finished by a mixer, and a polynomial
over word hashes for word n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U8 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INV = pow(_BASE, -1, 2**64)
_powers: list[np.ndarray] = [np.ones(1, U8), np.ones(1, U8)]

#: words of the quality rules and the n-gram join: whatever is not ASCII white space
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: words of decontamination: digits, letters, every byte of a non-ASCII character
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: A-Z to a-z, every other byte as it is
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, grown on demand and kept by the worker."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for i, b in enumerate((_BASE, _INV)):
            p = np.full(size, U8(b))
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    x = np.asarray(x, U8)
    x = (x ^ (x >> U8(30))) * U8(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U8(27))) * U8(0x94D049BB133111EB)
    return x ^ (x >> U8(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for each span; equal content gives an equal hash."""
    if not len(starts):
        return np.zeros(0, U8)
    up, down = powers(len(values) + 1)
    total = np.empty(len(values) + 1, U8)
    total[0] = 0
    np.cumsum((values.astype(U8) + U8(1)) * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U8) * U8(0xD6E8FEB86659FD93))


def window_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of ``n`` consecutive values, by its first index."""
    first = np.arange(max(0, len(values) - n + 1))
    return span_hashes(values, first, first + n)


def chunks(texts: list[bytes | None], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of up to ``limit`` bytes in total (one text at least)."""
    lo = size = 0
    for i, t in enumerate(texts):
        n = len(t or b"") + 1
        if i > lo and size + n > limit:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)


class Words:
    """The words of some texts: spans in the joined bytes, owner, hash, index in the owner."""

    def __init__(self, texts: list[bytes | None], word_bytes: np.ndarray, lower: bool = False):
        self.n_texts = len(texts)
        self.flat = np.frombuffer(b"\n".join([t or b"" for t in texts]) + b"\n", np.uint8)
        if lower:
            self.flat = LOWER[self.flat]
        sizes = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, self.n_texts)
        self.text_starts = np.concatenate(([0], np.cumsum(sizes)))
        inside = np.concatenate(([False], word_bytes[self.flat], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.owner = np.searchsorted(self.text_starts, self.starts, "right") - 1
        self.counts = np.bincount(self.owner, minlength=self.n_texts)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        self.hashes = span_hashes(self.flat, self.starts, self.ends)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every window of ``n`` words that lies within one text."""
        first = np.flatnonzero(self.owner[n - 1:] == self.owner[: len(self.owner) - n + 1]) if len(self.owner) >= n else np.zeros(0, int)
        return first, span_hashes(self.hashes, first, first + n)

    def word(self, i: int) -> bytes:
        return self.flat[self.starts[i]:self.ends[i]].tobytes()


def covered(first: np.ndarray, n: int | np.ndarray, size: int) -> np.ndarray:
    """Mask of the positions that any of the runs ``[first, first + n)`` covers."""
    step = np.bincount(first, minlength=size + 1)[: size + 1] - np.bincount(first + n, minlength=size + 1)[: size + 1]
    return np.cumsum(step)[:size] > 0


def sum_by(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values[bounds[i]:bounds[i + 1]]`` for each i; empty ranges give 0."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[bounds[1:]] - total[bounds[:-1]]


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return edge[0::2], edge[1::2]
