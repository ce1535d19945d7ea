"""Sets of word shingles as sorted 64-bit hashes, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BLOCK_BYTES = 1 << 20  # text hashed at a time
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_RNG = np.random.default_rng(20_011)
BYTE_CODES = _RNG.integers(0, 2 ** 64, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 2 ** 64)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (multiply, shift and exclusive-or)."""
    x = x ^ np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Shingler:
    """Distinct shingles of ``size`` words; texts with fewer words have one, their whole sequence; texts without, none."""

    def __init__(self, size: int):
        self.size = size
        self.factors = np.random.default_rng(97).integers(1, 2 ** 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = self.down = np.zeros(0, np.uint64)

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The hash of every word, and how many words each text has."""
        joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        if len(self.up) < len(joined) + 1:
            self.up, self.down = _powers(BASE, len(joined) + 1), _powers(INVERSE, len(joined) + 1)
        space = SPACE[joined]
        edge = np.flatnonzero(np.diff(space, prepend=True))  # starts and ends of words take turns
        begin, end = edge[::2], edge[1::2]
        # a polynomial over the word's bytes: differences of prefix sums, shifted back to the word's start
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_CODES[joined] * self.up[:len(joined)], dtype=np.uint64)))
        hashes = mix((sums[end] - sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64))
        starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        return hashes, np.diff(np.searchsorted(begin, starts))

    def sets(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """``(offsets, hashes)``: the sorted distinct hashes of text ``k`` are ``hashes[offsets[k]:offsets[k+1]]``."""
        flat, counts = self.words([(t or "").encode("utf-8", "replace").translate(TO_LOWER) for t in texts])
        start = np.concatenate(([0], np.cumsum(counts)))
        k = self.size
        n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
        text = np.repeat(np.arange(len(texts)), n)
        first = start[text] + np.arange(len(text)) - np.concatenate(([0], np.cumsum(n)))[text]
        # a sum of the words' hashes, each times the factor of its place; nothing of the next text is added
        flat = np.append(flat, np.zeros(k, np.uint64))
        value = flat[first] * self.factors[0]
        short = np.flatnonzero(counts[text] < k)
        for j in range(1, k):
            term = flat[first + j] * self.factors[j]
            term[short[counts[text[short]] <= j]] = 0
            value += term
        value = mix(value + np.minimum(counts, k)[text].astype(np.uint64))
        ends = np.cumsum(n).tolist()
        parts = []
        for a, b in zip([0, *ends], ends, strict=False):
            part = np.sort(value[a:b])
            parts.append(part[np.concatenate(([True], part[1:] != part[:-1]))] if b > a else part)
        return np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64), np.concatenate(parts) if parts else value


def blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BLOCK_BYTES`` characters, one text at least."""
    start = size = 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= BLOCK_BYTES:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)
