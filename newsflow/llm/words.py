"""Words and word windows of many texts at once, as numpy arrays.

A chunk of texts becomes one byte buffer. Words are found with a byte table (UTF-8 bytes of other characters never
look like ASCII, so the byte form is exact), hashed to 64 bits with a polynomial over their bytes, and windows of
words are hashed with a polynomial over the word hashes. All arithmetic wraps modulo 2^64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
CHUNK_BYTES = 1 << 19
CHUNK_ROWS = 1000
KEPT_POWERS = 1 << 20

_UPPER = slice(ord("A"), ord("Z") + 1)

# Which bytes belong to words: all but ASCII white space; or digits, a-z (after lower-casing) and all beyond ASCII.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective 64-bit finalizer with well-spread bits."""
    x = x + U((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand; those for a very long text are not kept."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up, self.down = np.ones(1, U), np.ones(1, U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > KEPT_POWERS:
            return self._powers(self.base, n), self._powers(self.inverse, n)
        if len(self.up) < n:
            size = min(max(n, 2 * len(self.up), 1 << 16), KEPT_POWERS)
            self.up, self.down = self._powers(self.base, size), self._powers(self.inverse, size)
        return self.up[:n], self.down[:n]

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        steps = np.full(n, U(base))
        steps[0] = 1
        return np.cumprod(steps, out=steps)


_BYTES, _WORDS = _Powers(0xD6E8FEB86659FD93), _Powers(0xA0761D6478BD642F)


class Words:
    """The words of a chunk of texts.

    ``data``: the texts' bytes, each followed by a space; ``begin``, ``end``: byte range of each word; ``count``: words
    per text; ``first``: index of each text's first word; ``text``: text of each word; ``left``: words from this one to
    the end of its text, itself included; ``hash``: 64-bit hash of each word.
    """

    def __init__(self, texts: list[bytes | None], table: np.ndarray, lower: bool):
        texts = [t or b"" for t in texts]
        self.data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        if lower:
            self.data = self.data.copy()
            capital = (self.data >= 65) & (self.data <= 90)
            self.data[capital] += 32
        self.start = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        inside = table[self.data] if len(self.data) else np.zeros(0, bool)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
        self.begin, self.end = edge[0::2], edge[1::2]
        at = np.searchsorted(self.begin, self.start)
        self.first, self.count = at[:-1], np.diff(at)
        self.text = np.repeat(np.arange(len(texts)), self.count)
        self.left = at[1:][self.text] - np.arange(len(self.begin))
        self.hash = self._hashes(table)

    def _hashes(self, table: np.ndarray) -> np.ndarray:
        if not len(self.begin):
            return np.zeros(0, U)
        weight = np.where(table, mix(np.arange(256, dtype=U), 7), U(0))
        up, down = _BYTES.get(len(self.data))
        sums = weight[self.data]
        sums *= up
        return mix(np.add.reduceat(sums, self.begin) * down[self.begin])

    def windows(self, n: int, seed: int = 0) -> np.ndarray:
        """Hash of the ``n`` words from each word on; only meaningful where ``left >= n``."""
        size = len(self.hash)
        out = np.zeros(size, U)
        if size >= n:
            up, down = _WORDS.get(size)
            base = self.hash if not seed else mix(self.hash, seed)
            sums = np.concatenate([np.zeros(1, U), np.cumsum(base * up)])
            out[: size - n + 1] = (sums[n:] - sums[:-n]) * down[: size - n + 1]
        return mix(out, seed + n)

    def word(self, i: int) -> bytes:
        return self.data[self.begin[i] : self.end[i]].tobytes()


def chunks(batch: pa.RecordBatch | pa.Table, column: str = "text", limit: int = CHUNK_BYTES, rows: int = CHUNK_ROWS) -> Iterator[tuple[slice, list[bytes | None]]]:
    """Slices of a batch of at most ``rows`` texts and about ``limit`` bytes (one text at least), with the texts as bytes."""
    array = batch[column]
    array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
    array = array.cast(pa.binary())
    upto = np.cumsum(pc.binary_length(array).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(array):
        before = upto[start - 1] if start else 0
        stop = min(int(np.searchsorted(upto, before + limit)) + 1, start + rows, len(array))
        yield slice(start, stop), array.slice(start, stop - start).to_pylist()
        start = stop


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a window of ``n`` words that begins at one of ``starts``."""
    steps = np.zeros(size + n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + n, -1)
    return np.cumsum(steps[:size]) > 0
