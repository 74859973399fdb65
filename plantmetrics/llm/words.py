"""Word spans and word hashes of Arrow string batches, vectorised over whole batches.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. Everything here works on
one slice of rows at a time (``slices`` bounds a slice by bytes), so memory does not depend
on the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
U = np.uint64
_PRIME = U(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (splitmix finaliser)."""
    x = np.asarray(x, dtype=U)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=U))
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]


class Powers:
    """C**i and C**-i modulo 2**64, grown on demand."""

    C = 0xD6E8FEB86659FD93

    def __init__(self) -> None:
        self.n = 0
        self.up = self.down = np.ones(1, dtype=U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 2 * self.n, 1 << 16)
            inv = pow(self.C, -1, 1 << 64)
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.r_[U(1), np.full(self.n, self.C, dtype=U)], dtype=U)
                self.down = np.cumprod(np.r_[U(1), np.full(self.n, inv, dtype=U)], dtype=U)
        return self.up, self.down


_POWERS = Powers()


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about ``limit`` bytes (one row at least)."""
    if not batch.num_rows:
        return
    size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
    total = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        base = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """Words of the rows of one string array: byte spans, hashes, and each row's range."""

    def __init__(self, texts: pa.Array, fold: bool = False) -> None:
        texts = texts.fill_null("") if texts.null_count else texts
        texts = pa.concat_arrays([texts]).cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
        self.raw = raw[offsets[0]:offsets[-1]]
        self.offsets = offsets - offsets[0]
        word = ~_SPACE[self.raw]
        n = len(word)
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.offsets] = True
        before, after = np.r_[False, word], np.r_[word, False]
        self.start = np.flatnonzero((after & (~before | edge))[:n])
        self.end = np.flatnonzero((before & (~after | edge))[1:]) + 1
        #: Row r holds words row[r] to row[r + 1] - 1.
        self.row = np.searchsorted(self.start, self.offsets)
        self.hash = self._hashes(_FOLDED if fold else _BYTE)

    def _hashes(self, table: np.ndarray) -> np.ndarray:
        size = self.end - self.start
        # 16-bit keys sort by counting; longer words need the full width
        key = (65535 - size).astype(np.uint16) if not len(size) or size.max() < 65536 else -size
        order = np.argsort(key, kind="stable")
        start, size = self.start[order], size[order]
        acc = mix(size.astype(U))
        longest = int(size[0]) if len(size) else 0
        active = np.searchsorted(-size, -np.arange(longest), side="left")
        with np.errstate(over="ignore"):
            for i in range(longest):
                a = acc[:active[i]]
                a ^= table[self.raw[start[:active[i]] + i]]
                a *= _PRIME
                a ^= a >> U(29)
        out = np.empty(len(size), dtype=U)
        out[order] = mix(acc)
        return out

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.row) - 1), np.diff(self.row))

    def row_end(self) -> np.ndarray:
        """For each word, the index just past its row's last word."""
        return np.repeat(self.row[1:], np.diff(self.row))

    def code_points(self) -> np.ndarray:
        """Number of code points before each byte of the slice (one more entry at the end)."""
        return np.r_[0, np.cumsum((self.raw & 0xC0) != 0x80)]


class Grams:
    """Hashes of runs of consecutive words, from one prefix sum."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.n = len(hashes)
        up, self.down = _POWERS.upto(self.n + 1)
        with np.errstate(over="ignore"):
            self.sums = np.r_[U(0), np.cumsum(hashes * up[:self.n], dtype=U)]

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[stop] - self.sums[start]) * self.down[start] + (stop - start).astype(U))
