"""Texts as arrays: code points of many texts in one array, and hashes of any slices of it."""

from __future__ import annotations

from collections.abc import Iterator
from weakref import WeakSet

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
"""Characters that are worked on at once; a longer text is a chunk of its own."""

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` with about ``CHUNK`` characters each."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points, and the offsets of the texts in them (one more than texts)."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return points, offsets


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


PRIME = np.uint64((1 << 61) - 1)
SHORT_SLICE = 1 << 11
"""Code points in a slice up to which products of 53 bits can be summed."""

LOW31, LOW30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)


def reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo `PRIME`."""
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.minimum(x, x - PRIME)  # below zero it wraps to a large number


BLOCK = 1 << 14
"""Numbers worked on at once, so that what is in between stays in the processor's cache."""


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a * b`` modulo `PRIME` for factors below it."""
    out = np.empty(len(a), np.uint64)
    whole = np.ndim(b) == 0
    for i in range(0, len(a), BLOCK):
        out[i : i + BLOCK] = _product(a[i : i + BLOCK], b if whole else b[i : i + BLOCK])
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """From products of halves; 2**61 counts as 1."""
    a1, a0, b1, b0 = a >> np.uint64(31), a & LOW31, b >> np.uint64(31), b & LOW31
    middle = a1 * b0 + a0 * b1
    return reduced(((a1 * b1) << np.uint64(1)) + (middle >> np.uint64(30)) + ((middle & LOW30) << np.uint64(31)) + a0 * b0)


_between_tasks: WeakSet[Scratch | PrimeSliceHash | SliceHash] = WeakSet()


def forget() -> None:
    """Drop the buffers and powers that hashes of this worker keep between chunks; they come back when needed."""
    for one in _between_tasks:
        one.clear()


class Scratch:
    """Arrays that are used again and again, so that the system need not hand out new memory each time."""

    def __init__(self) -> None:
        self.clear()
        _between_tasks.add(self)

    def clear(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, n: int) -> np.ndarray:
        if len(self.held.get(name, ())) < n:
            self.held[name] = np.zeros(max(n, CHUNK + 1), np.uint64)
        return self.held[name][:n]


class PrimeSliceHash:
    """Hashes of slices of an array, by prefix sums of a polynomial modulo the prime 2**61 - 1.

    Two different slices of n values collide for at most n of all bases, whatever their structure.
    """

    def __init__(self) -> None:
        self.base = BASES[0] % int(PRIME)
        self.inverse = pow(self.base, -1, int(PRIME))
        self.scratch = Scratch()
        self.clear()
        _between_tasks.add(self)

    def clear(self) -> None:
        self.powers = self.inverses = np.ones(1, np.uint64)
        self.high, self.low = self.powers >> np.uint64(31), self.powers & LOW31

    def _reach(self, n: int) -> None:
        while len(self.powers) < n:
            for name, factor in (("powers", self.base), ("inverses", self.inverse)):
                some = getattr(self, name)
                step = np.uint64(pow(factor, len(some), int(PRIME)))
                setattr(self, name, np.concatenate([some, product(some, step)]))
            self.high, self.low = self.powers >> np.uint64(31), self.powers & LOW31

    def __call__(self, values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """One 64-bit hash per slice [begin, end); values count from 1, so zeros at the end do count."""
        n = len(values)
        self._reach(n + 1)
        if values.dtype.itemsize <= 4:
            # Code points: sums of products with half a power stay below 2**64 in short slices, and
            # wrapped prefix sums give them exactly.
            counted = np.add(values, np.uint64(1), out=self.scratch("counted", n), dtype=np.uint64, casting="unsafe")
            high = self._sums(np.multiply(counted, self.high[:n], out=self.scratch("terms", n)), begin, end)
            low = self._sums(np.multiply(counted, self.low[:n], out=self.scratch("terms", n)), begin, end)
            for k in np.flatnonzero(end - begin > SHORT_SLICE).tolist():
                i, j = int(begin[k]), int(end[k])
                terms = product(counted[i:j], self.powers[i:j])
                high[k], low[k] = (terms >> np.uint64(31)).sum(), (terms & LOW31).sum()
        else:
            terms = product(reduced(values.astype(np.uint64)) + np.uint64(1), self.powers[:n])
            high, low = self._sums(terms >> np.uint64(31), begin, end), self._sums(terms & LOW31, begin, end)
        out = np.empty(len(begin), np.uint64)
        for i in range(0, len(begin), BLOCK):
            part = slice(i, i + BLOCK)
            a, b = reduced(high[part]), reduced(low[part])
            turned = ((a & LOW30) << np.uint64(31)) | (a >> np.uint64(30))
            out[part] = mixed(_product(reduced(turned + b), self.inverses[begin[part]]))
        return out

    def _sums(self, terms: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums = self.scratch("sums", len(terms) + 1)
        sums[0] = 0
        np.cumsum(terms, out=sums[1:])
        return sums[end] - sums[begin]


class SliceHash:
    """64-bit hashes of slices of an array, by prefix sums of a polynomial modulo 2**64.

    Cheap, but some patterns of two values collide whatever the base: only beside a `PrimeSliceHash`.
    """

    def __init__(self) -> None:
        self.base = BASES[1]
        self.inverse = pow(self.base, -1, 1 << 64)
        self.scratch = Scratch()
        self.clear()
        _between_tasks.add(self)

    def clear(self) -> None:
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 2 * len(self.powers))
            for name, factor in (("powers", self.base), ("inverses", self.inverse)):
                steps = np.full(n, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def __call__(self, values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """One hash per slice [begin, end); equal slices have equal hashes wherever they stand.

        Values count from 1 in the polynomial, so zeros at the end of a slice do count.
        """
        n = len(values)
        self._reach(n + 1)
        terms = np.add(values, np.uint64(1), out=self.scratch("terms", n), dtype=np.uint64, casting="unsafe")
        np.multiply(terms, self.powers[:n], out=terms)
        sums = self.scratch("sums", n + 1)
        sums[0] = 0
        np.cumsum(terms, out=sums[1:])
        out = np.empty(len(begin), np.uint64)
        for i in range(0, len(begin), BLOCK):
            part = slice(i, i + BLOCK)
            out[part] = mixed((sums[end[part]] - sums[begin[part]]) * self.inverses[begin[part]])
        return out


def slice_hashes() -> tuple[PrimeSliceHash, SliceHash]:
    """Two hashes of different kind: together 125 bits, the first sound by itself."""
    return PrimeSliceHash(), SliceHash()


def distinct_slices(points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The number of each slice points[begin:end], and the distinct slices by number as 16-bit letters.

    Slices are in order, are not empty and do not overlap; points are below 2**16. Contents are compared, not hashes only.
    """
    if not len(begin):
        return np.zeros(0, np.int32), []
    if not np.array_equal(begin[1:], end[:-1]):
        edges = np.zeros(len(points) + 1, np.int8)
        edges[begin] = 1
        edges[end] -= 1
        points = points[np.cumsum(edges[:-1], dtype=np.int8).view(bool)]
    else:
        points = points[begin[0] : end[-1]]
    bounds = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(2 * (end - begin), out=bounds[1:])
    wide = bounds[-1] >= 1 << 31
    buffers = [None, pa.py_buffer(bounds if wide else bounds.astype(np.int32)), pa.py_buffer(points.astype("<u2"))]
    coded = pa.Array.from_buffers(pa.large_binary() if wide else pa.binary(), len(begin), buffers).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


class HashIndex:
    """Numbers for 64-bit keys in order of arrival: open addressing, looked up for whole arrays."""

    def __init__(self, bits: int = 16) -> None:
        self.size = 0
        self._make(bits)

    def _make(self, bits: int) -> None:
        self.bits = bits
        self.key = np.zeros(1 << bits, np.uint64)
        self.number = np.full(1 << bits, -1, np.int32)

    def find(self, a: np.ndarray) -> np.ndarray:
        """The key's number, -1 where it is unknown."""
        slot = (a >> np.uint64(64 - self.bits)).astype(np.int64)
        out = self.number[slot]
        left = np.flatnonzero((self.key[slot] != a) & (out >= 0))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            out[left] = number = self.number[slot]
            go = (self.key[slot] != a[left]) & (number >= 0)
            left, slot = left[go], slot[go]
        return out

    def add(self, a: np.ndarray) -> None:
        """Number new, distinct keys from ``size`` on."""
        numbers = np.arange(self.size, self.size + len(a), dtype=np.int32)
        while self.size + len(a) > (1 << self.bits) // 2:
            used = self.number >= 0
            old = self.key[used], self.number[used]
            self._make(self.bits + 1)
            self._put(*old)
        self._put(a, numbers)
        self.size += len(a)

    def _put(self, a: np.ndarray, numbers: np.ndarray) -> None:
        slot = (a >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(a):
            free = self.number[slot] < 0
            self.number[slot[free]] = numbers[free]
            won = self.number[slot] == numbers
            self.key[slot[won]] = a[won]
            go = ~won
            a, numbers = a[go], numbers[go]
            slot = (slot[go] + 1) & ((1 << self.bits) - 1)


def grown(array: np.ndarray, size: int) -> np.ndarray:
    """``array``, doubled until it has ``size`` entries."""
    while len(array) < size:
        array = np.concatenate([array, np.zeros_like(array)])
    return array


def spread_ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, ... of each range, one range after the other."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(begin - (ends - count), count) + np.arange(total)
