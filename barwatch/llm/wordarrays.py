"""Words of many texts as arrays, and hashes of word sequences, in two halves."""

from __future__ import annotations

import numpy as np

from barwatch.llm.textarrays import slice_hashes

GAP = np.zeros(256, bool)
GAP[[9, 10, 11, 12, 13, 32]] = True

_letters = slice_hashes()
_sequences = slice_hashes()


class Words:
    """The words (runs without white space, unchanged) of some texts.

    ``begin`` and ``end`` are byte ranges in ``data``, ``first`` the number of each text's first word
    (one more than texts), ``hashes`` two independent 64-bit hashes per word.
    """

    def __init__(self, texts: list[str]) -> None:
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = b"".join(raw)
        points = np.frombuffer(self.data, np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        gap = GAP[points]
        opens = ~gap
        opens[1:] &= gap[:-1]
        closes = ~gap
        closes[:-1] &= gap[1:]
        edge = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(points))]
        opens[edge] = ~gap[edge]
        closes[edge - 1] = ~gap[edge - 1]
        self.begin, self.end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.begin, offsets)
        self.hashes = tuple(h(points, self.begin, self.end) for h in _letters)

    def sequences(self, begin: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        """A 64-bit hash of each word range."""
        return _sequences[which](self.hashes[which], begin, end)

    def contents(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each text's words."""
        return tuple(self.sequences(self.first[:-1], self.first[1:], k).view(np.int64) for k in range(2))

    def texts(self, begin: int, end: int) -> list[bytes]:
        """The words begin to end as bytes."""
        return [self.data[i:j] for i, j in zip(self.begin[begin:end].tolist(), self.end[begin:end].tolist())]
