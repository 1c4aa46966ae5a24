"""Token ids of many texts: split once, look every piece up, encode only pieces not met before."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

import numpy as np
import tiktoken

from barwatch.llm.pretokens import byte_pieces, is_plain, word_pieces
from barwatch.llm.textarrays import HashIndex, SliceHash, chunks, distinct_slices, grown, spread_ranges

MEMORY = 500_000
"""Pieces a worker remembers; beyond that it starts anew, which changes no result."""

MEMORY_LETTERS = 1 << 25
"""Letters of remembered pieces, beyond which it starts anew as well."""


ROUNDS = 3
"""Words of four letters that are compared for all pieces at once, before those of long pieces."""

FEW = np.array([(1 << 16 * k) - 1 for k in range(5)], np.uint64)
"""Up to four letters of a word."""


def four_letters(points: np.ndarray) -> np.ndarray:
    """The four letters from each place on as one word; letters count from 1, so that none is like no letter."""
    padded = np.zeros(len(points) + 4, np.uint16)
    np.add(points, 1, out=padded[: len(points)], casting="unsafe")
    return np.ndarray(len(points) + 1, "<u8", buffer=padded, strides=(2,)).copy()


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Bytes that are visible Latin-1 characters stand for themselves, the others for the code points
    from 256 on, in order.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


def merger(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """Byte-pair merges of a tokenizer file that work on lines, and which ids close a line.

    Merging by ids as ranks needs a vocabulary whose ids follow the order of its merges; that is
    checked. A word end is a line feed here: it merges with the byte before it first, as those
    256 ids come before all merges.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    letters, suffix = byte_letters(), model["end_of_word_suffix"] or ""
    order = [model["vocab"][a.removesuffix(suffix) + b if suffix else a + b] for a, b in model["merges"]]
    assert order == sorted(order), "ids do not follow the merges"
    ranks, closing = {}, np.zeros(1 << 16, bool)
    for token, i in model["vocab"].items():
        ended = bool(suffix) and token.endswith(suffix)
        body = token[: len(token) - len(suffix)] if ended else token
        if all(c in letters for c in body):
            ranks[bytes(letters[c] for c in body) + b"\n" * ended] = i
        closing[i] = ended
    if not suffix:
        closing[ranks[b"\n"]] = True
    pattern = r"[^\n]*\n" if suffix else r"[^\n]+|\n"
    return tiktoken.Encoding("lines", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), closing


class PieceEncoder:
    """Ids as the tokenizers library gives them, for one tokenizer file.

    The merges of byte-pair encoding never cross a piece, so a text's ids are those of its pieces.
    Each distinct piece is merged once per worker; texts that cannot be split here, or
    that may hold a special token, go to the library whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.word_ends = self.tokenizer.normalizer is not None
        self.split: Callable = word_pieces if self.word_ends else byte_pieces
        self.merges, self.closing = merger(path)
        self.hash = SliceHash()
        self._forget()

    def _forget(self) -> None:
        self.known = HashIndex()
        self.ids, self.words = np.zeros(1 << 12, np.uint16), np.zeros(1 << 12, np.uint64)
        # Where the ids and the words of four letters of each known piece end, after a zero.
        self.bounds, self.spelled = np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int64)

    def _merged(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after the other, and how many each has.

        Pieces are merged many at a time as lines of one text. In a vocabulary with word ends the
        line feed stands for the word end, so the last id of a piece is one with a word end; else it
        is an id of its own between pieces. White space is left to the library.
        """
        white = [i for i, p in enumerate(pieces) if p.isspace()]
        alone = {i: self.tokenizer.encode(pieces[i], add_special_tokens=False).ids for i in white}
        solid = np.array([i for i in range(len(pieces)) if i not in alone], np.int64)
        flat = np.array(self.merges.encode_ordinary("".join([pieces[i] + "\n" for i in solid.tolist()])), np.int64)
        closes = self.closing[flat]
        owner = np.cumsum(closes) - closes
        if not self.word_ends:
            flat, owner = flat[~closes], owner[~closes]
        assert closes.sum() == len(solid), "pieces and merges differ"
        all_ids = np.concatenate([flat, *(np.array(x, np.int64) for x in alone.values())])
        all_owner = np.concatenate([solid[owner], *(np.full(len(x), i) for i, x in alone.items())])
        sizes = np.bincount(all_owner, minlength=len(pieces))
        return all_ids[np.argsort(all_owner, kind="stable")].astype(np.uint16), sizes

    def _remember(
        self, hashed: np.ndarray, points: np.ndarray, fours: np.ndarray, begin: np.ndarray, end: np.ndarray
    ) -> None:
        text = points.tobytes().decode("utf-32-le")
        flat, sizes = self._merged([text[i:j] for i, j in zip(begin.tolist(), end.tolist())])
        parts = (end - begin + 3) >> 2
        done = 4 * spread_ranges(np.zeros_like(parts), parts)
        words = fours[begin.repeat(parts) + done] & FEW[np.minimum((end - begin).repeat(parts) - done, 4)]
        n, m = self.known.size, len(sizes)
        for table, ends, new, counts in (
            ("ids", "bounds", flat, sizes),
            ("words", "spelled", words, parts),
        ):
            last = getattr(self, ends)[n]
            setattr(self, ends, grown(getattr(self, ends), n + m + 1))
            setattr(self, table, grown(getattr(self, table), last + len(new)))
            getattr(self, ends)[n + 1 : n + 1 + m] = last + np.cumsum(counts)
            getattr(self, table)[last : last + len(new)] = new
        self.known.add(hashed)

    def _misread(self, number: np.ndarray, fours: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The pieces that are not what was remembered under their hash."""
        left, first = end - begin, self.spelled.take(number)
        other = self.spelled.take(number + 1) - first != (left + 3) >> 2
        some = np.flatnonzero(~other)
        at, left, first = begin[some], left[some], first[some]
        for _ in range(ROUNDS):
            differ = fours.take(at)
            differ &= FEW.take(np.minimum(left, 4))
            other[some[differ != self.words.take(first)]] = True
            on = np.flatnonzero(left > 4)
            some, at, left, first = some[on], at[on] + 4, left[on] - 4, first[on] + 1
        parts = (left + 3) >> 2
        done = 4 * spread_ranges(np.zeros_like(parts), parts)
        words = fours[at.repeat(parts) + done] & FEW[np.minimum(left.repeat(parts) - done, 4)]
        other[some.repeat(parts)[words != self.words[spread_ranges(first, parts)]]] = True
        return np.flatnonzero(other)

    def ids_of(self, points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces points[begin:end], one after the other, and how many each has.

        A piece is looked up by its hash and compared with what is remembered; where two
        pieces share a hash, the later one is merged each time.
        """
        hashed, fours = self.hash(points, begin, end), four_letters(points)
        number = self.known.find(hashed)
        new = np.flatnonzero(number < 0)
        if len(new):
            if self.known.size > MEMORY or 4 * self.spelled[self.known.size] > MEMORY_LETTERS:
                self._forget()
                new = np.arange(len(hashed))
            keys, where = np.unique(hashed[new], return_index=True)
            self._remember(keys, points, fours, begin[new[where]], end[new[where]])
            number = self.known.find(hashed)
        first = self.bounds[number]
        count = self.bounds[number + 1] - first
        pool = self.ids
        odd = self._misread(number, fours, begin, end)
        if len(odd):
            code, pieces = distinct_slices(points, begin[odd], end[odd])
            flat, sizes = self._merged([p.decode("utf-16-le") for p in pieces])
            first[odd], count[odd] = len(pool) + (np.cumsum(sizes) - sizes)[code], sizes[code]
            pool = np.concatenate([pool, flat])
        return pool[spread_ranges(first, count)], count

    def _chunk(self, texts: list[str]) -> list[np.ndarray]:
        points, offsets, begin, end = self.split(texts)
        flat, count = self.ids_of(points, begin, end)
        sums = np.concatenate([[0], np.cumsum(count)])
        cuts = sums[np.searchsorted(begin, offsets)].tolist()
        return [flat[i:j] for i, j in zip(cuts, cuts[1:])]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """One array of 16-bit ids per text."""
        out: list[np.ndarray] = [np.zeros(0, np.uint16)] * len(texts)
        plain = [i for i, t in enumerate(texts) if t and is_plain(t) and "<|" not in t]
        rest = set(range(len(texts))).difference(plain)
        for i in rest:
            if texts[i]:
                out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint16)
        some = [texts[i] for i in plain]
        for i, j in chunks(some):
            for k, ids in zip(plain[i:j], self._chunk(some[i:j])):
                out[k] = ids
        return out


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
