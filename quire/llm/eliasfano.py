"""Elias-Fano coded monotone sequences of unsigned integers, with vectorised access and successor search.

A sequence of n numbers below u takes about 2 + log2(u / n) bits each: the low bits as they are, the
high parts in unary. Reading works on the coded bytes, which may be memory-mapped; beside them a reader holds
the places of the ones and zeros of the unary part.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable

import numpy as np
import zstandard

_TYPES = ("|u1", "<u2", "<u4", "<u8", "<i8")
#: Numbers whose low bits are packed at a time; a multiple of 8, so that slices end on whole bytes.
_SLICE = 1 << 15


def packed(arrays: Iterable[np.ndarray]) -> bytes:
    """Arrays in one block of bytes, each 8-aligned, with a small table before them."""
    arrays = list(arrays)
    head = np.zeros(1 + 2 * len(arrays), "<i8")
    head[0] = len(arrays)
    body = []
    for i, a in enumerate(arrays):
        raw = a.tobytes()
        head[1 + 2 * i : 3 + 2 * i] = _TYPES.index(a.dtype.str), len(a)
        body.append(raw + b"\0" * (-len(raw) % 8))
    return head.tobytes() + b"".join(body)


def unpacked(raw) -> list[np.ndarray]:
    """Views of the arrays in a block, without copying."""
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head = np.frombuffer(raw, "<i8", 2 * n, 8)
    at, out = 8 + 16 * n, []
    for i in range(n):
        dtype, size = np.dtype(_TYPES[head[2 * i]]), int(head[2 * i + 1])
        out.append(np.frombuffer(raw, dtype, size, at))
        at += -(-size * dtype.itemsize // 8) * 8
    return out


def sent(arrays: Iterable[np.ndarray]) -> bytes:
    """A block for the way between tasks."""
    return zstandard.ZstdCompressor(level=3).compress(packed(arrays))


def received(raw: bytes) -> list[np.ndarray]:
    return unpacked(zstandard.ZstdDecompressor().decompress(raw))


def mapped(arrays: Iterable[np.ndarray]) -> list[np.ndarray]:
    """The arrays in a memory-mapped file that goes with its last view."""
    with tempfile.TemporaryFile() as f:
        f.write(packed(arrays))
        f.flush()
        return unpacked(np.memmap(f, np.uint8, "r"))


class EliasFano:
    ARRAYS = 3

    def __init__(self, arrays: list[np.ndarray]) -> None:
        (self.n, self.width), low, high = (int(x) for x in arrays[0]), *arrays[1:]
        self.lows = np.ndarray((len(low) - 8,), "<u8", low, 0, (1,))
        self.mask = np.uint64((1 << self.width) - 1)
        bits = np.unpackbits(high, bitorder="little").view(bool)
        self.ones = np.flatnonzero(bits).astype(np.uint32 if len(bits) < 1 << 32 else np.int64)
        self._bits = bits

    @staticmethod
    def coded(values: np.ndarray) -> list[np.ndarray]:
        """Three arrays for ascending numbers, which may repeat."""
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = min(max((top // max(n, 1)).bit_length() - 1, 0), 56)
        parts = []
        for k in range(0, n if width else 0, _SLICE):
            bits = np.unpackbits(values[k : k + _SLICE].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, count=width, bitorder="little")
            parts.append(np.packbits(bits.ravel(), bitorder="little"))
        high = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        unary = np.zeros((int(high[-1]) if n else 0) + 2, np.uint8)
        unary[high] = 1
        return [np.array([n, width], "<i8"), np.concatenate([*parts, np.zeros(16, np.uint8)]), np.packbits(unary, bitorder="little")]

    def _low(self, i: np.ndarray) -> np.ndarray:
        at = i * self.width
        return self.lows[at >> 3] >> (at & 7).astype(np.uint64) & self.mask

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """The i-th numbers."""
        i = np.asarray(i, np.int64)
        return (self.ones[i].astype(np.int64) - i).astype(np.uint64) << np.uint64(self.width) | self._low(i)

    def all(self) -> np.ndarray:
        return self[np.arange(self.n)]

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first number that is at least x, whether it equals x)."""
        x = np.asarray(x, np.uint64)
        if not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        if not hasattr(self, "starts"):  # of the numbers with each high part
            zeros = np.flatnonzero(~self._bits)
            self.starts = np.concatenate([[0], zeros - np.arange(len(zeros))]).astype(self.ones.dtype)
            self._bits = None
        high, low = x >> np.uint64(self.width), x & self.mask
        last = np.uint64(len(self.starts) - 2)
        beyond = high > last
        high = np.minimum(high, last).astype(np.int64)
        index, end = self.starts[high].astype(np.int64), self.starts[high + 1].astype(np.int64)
        index[beyond] = end[beyond] = self.n
        equal = np.zeros(len(x), bool)
        active = np.flatnonzero(index < end)
        steps = 0
        while len(active):
            i, want = index[active], low[active]
            value = self._low(i)
            equal[active[value == want]] = True
            less = value < want
            active = active[less]
            index[active] += 1
            active = active[index[active] < end[active]]
            steps += 1
            if steps == 4 and len(active):  # the others have many numbers before them: halve what is left
                lo, hi, want = index[active], end[active], low[active]
                while (some := lo < hi).any():
                    middle = (lo + hi) >> 1
                    less = some & (self._low(np.minimum(middle, self.n - 1)) < want)
                    lo = np.where(less, middle + 1, lo)
                    hi = np.where(some & ~less, middle, hi)
                index[active] = lo
                found = lo < end[active]
                equal[active[found]] = self._low(lo[found]) == want[found]
                break
        return index, equal
