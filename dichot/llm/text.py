"""Vectorised word arithmetic over Arrow text columns (runs inside tasks).

A word is a run of characters other than ASCII white space (``\\x20``,
``\\x09``-``\\x0D``).  Words never leave the UTF-8 buffer of their Arrow batch:
they are byte spans, and everything that compares them works on 64-bit hashes.
The hash of a word is a polynomial over a random byte table, taken from one
prefix sum over the buffer, then mixed; hashes of word sequences are
polynomials over word hashes.  All seeds are fixed, so a recomputed task
produces the same values.

Nulls are texts without words.  Very long texts are one row each and are
processed whole; a slice holds at least one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_SEQ = 0xD1B54A32D192ED03 | 1
_MASK = (1 << 64) - 1

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def grow(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, SLICE_BYTES + 1024)
            up, down = np.full(n, self.base, dtype=np.uint64), np.full(n, self.inverse, dtype=np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up, self.down


_powers = _Powers(_BASE)


class Words:
    """The words of some texts, in order.

    ``first[i]:first[i + 1]`` are the words of text ``i``; ``begin`` and
    ``end`` are their byte spans in ``data``.
    """

    def __init__(self, texts: pa.Array) -> None:
        texts = texts.cast(pa.large_string())
        n = len(texts)
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, dtype=np.int64)
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
        self.data = raw[at[0]:at[-1]]
        self.at = at - at[0]
        size = len(self.data)
        solid = ~SPACE[self.data]
        edge = np.zeros(size + 1, dtype=bool)
        edge[self.at] = True
        edge = edge[:size]
        starts = solid.copy()
        starts[1:] &= ~solid[:-1] | edge[1:]
        stops = solid
        stops[:-1] &= ~solid[1:] | edge[1:]
        self.begin = np.flatnonzero(starts)
        self.end = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.begin, self.at)
        self.counts = np.diff(self.first)
        self.text_of = np.repeat(np.arange(n), self.counts)

    def __len__(self) -> int:
        return len(self.begin)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """One 64-bit hash per word; ``lower`` treats A-Z as a-z."""
        up, down = _powers.grow(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum((_LOWER if lower else _TABLE)[self.data] * up[:len(self.data)], out=total[1:])
        return mix((total[self.end] - total[self.begin]) * down[self.begin] + (self.end - self.begin).astype(np.uint64))

    def windows(self, hashes: np.ndarray, width: int, base: int = _SEQ) -> tuple[np.ndarray, np.ndarray]:
        """``(hash, valid)`` for the window of ``width`` words that starts at each
        word; ``valid`` is False where the window would leave its text."""
        n = len(hashes)
        out = np.zeros(n, dtype=np.uint64)
        fits = np.zeros(n, dtype=bool)
        if n >= width:
            acc = hashes[:n - width + 1].copy()
            for k in range(1, width):
                acc *= _U(base)
                acc += hashes[k:n - width + 1 + k]
            out[:n - width + 1] = mix(acc)
            fits[:n - width + 1] = self.text_of[:n - width + 1] == self.text_of[width - 1:]
        return out, fits


def slices(batch: pa.RecordBatch | pa.Table, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text each."""
    batches = batch.to_batches() if isinstance(batch, pa.Table) else [batch]
    for part in batches:
        n = part.num_rows
        if not n:
            continue
        texts = part.column(column).cast(pa.large_string())
        at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
        lo = 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
            yield part.slice(lo, hi - lo)
            lo = hi


def spread(flags: np.ndarray, width: int) -> np.ndarray:
    """True at every position that is at most ``width - 1`` after a flagged one."""
    n = len(flags)
    steps = np.zeros(n + width, dtype=np.int32)
    steps[:n] += flags
    steps[width:width + n] -= flags
    return np.cumsum(steps[:n]) > 0


def pack_deltas(values: np.ndarray) -> bytes:
    """Ascending uint32 values as steps of 2, 3 or 4 bytes, whichever takes
    least, after one byte that tells which; the largest number of that many bytes
    stands for a step of that size without a value.  Few values far apart take
    4 bytes each, never a run of empty steps."""
    if not len(values):
        return b""
    steps = np.diff(values.astype(np.int64), prepend=0)
    size = min((2, 3, 4), key=lambda k: k * (len(steps) + int((steps // ((1 << 8 * k) - 1)).sum())))
    top = (1 << 8 * size) - 1
    jumps, rest = np.divmod(steps, top)
    out = np.full(len(values) + int(jumps.sum()), top, dtype="<u4")
    out[np.cumsum(jumps + 1) - 1] = rest
    return bytes([size]) + out.view(np.uint8).reshape(-1, 4)[:, :size].tobytes()


def unpack_deltas(data: bytes) -> np.ndarray:
    """The inverse of :func:`pack_deltas`."""
    if not data:
        return np.zeros(0, dtype=np.uint32)
    size = data[0]
    packed = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(-1, size)
    steps = np.zeros((len(packed), 4), dtype=np.uint8)
    steps[:, :size] = packed
    steps = steps.view("<u4").ravel()
    return np.cumsum(steps, dtype=np.int64)[steps != (1 << 8 * size) - 1].astype(np.uint32)


def binary(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, type=pa.binary())
