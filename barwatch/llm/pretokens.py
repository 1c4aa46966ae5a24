"""Splitting texts into the pieces that byte-pair merges work on, for whole arrays of characters.

Texts of the first 384 code points are split here; whether a text is among them is checked per text,
and others go through the tokenizers library's own splitting.
"""

from __future__ import annotations

import unicodedata

import numpy as np

from barwatch.llm.textarrays import code_points

LIMIT = 0x180
SPACE, LETTER, NUMBER, OTHER = range(4)


def _class_of(point: int) -> int:
    if point in (9, 10, 11, 12, 13, 32, 0x85, 0xA0):
        return SPACE
    return {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(point))[0], OTHER)


CLASS = np.array([_class_of(p) for p in range(LIMIT)], np.int8)
LOWER = np.array([ord(chr(p).lower()) if len(chr(p).lower()) == 1 else p for p in range(LIMIT)], np.uint32)
LOWER_AND_CLASS = LOWER | CLASS.astype(np.uint32) << 16
WIDE = {p for p in range(LIMIT) if len(chr(p).lower()) != 1 or ord(chr(p).lower()) >= LIMIT}
"""Code points whose lower case is longer or beyond the limit."""


def is_plain(text: str) -> bool:
    """Whether ``text`` can be split here: its code points are below the limit and of simple case."""
    if text.isascii():
        return True
    highest = code_points([text])[0].max()
    return bool(highest < LIMIT) and not any(chr(p) in text for p in WIDE)


def _contractions(points: np.ndarray, kinds: np.ndarray, starts: np.ndarray, last: np.ndarray) -> None:
    """Cut 's 't 're 've 'm 'll 'd where a piece starts at the apostrophe; changes ``starts``."""
    at = np.flatnonzero((points == ord("'")) & starts)
    at = at[at < last[at]]
    if not len(at):
        return
    one = points[at + 1]
    more = at + 1 < last[at]
    two = np.where(more, points[np.minimum(at + 2, len(points) - 1)], 0)
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.zeros(len(at), bool)
    for pair in ("re", "ve", "ll"):
        long |= (one == ord(pair[0])) & (two == ord(pair[1]))
    for length, hit in ((2, at[short]), (3, at[long & ~short])):
        starts[hit + 1] = False
        after = hit + length
        starts[after[after < len(points)]] = True


def _laid_out(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points, offsets, a flag at the first point of each text, the last place of each text."""
    points, offsets = code_points(texts)
    first = np.zeros(len(points), bool)
    first[offsets[:-1][offsets[:-1] < len(points)]] = True
    last = np.repeat(offsets[1:] - 1, np.diff(offsets))
    return points, offsets, first, last


def _pieces(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    begin = np.flatnonzero(starts)
    return begin, np.append(begin[1:], size).astype(np.int64)


def word_pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case code points, offsets of the texts, begin and end of the pieces.

    A piece is a run of letters, one digit, a run of other characters or a contraction; white
    space is in no piece.
    """
    points, offsets, starts, last = _laid_out(texts)
    both = LOWER_AND_CLASS.take(points)
    points, kinds = both & 0xFFFF, (both >> 16).astype(np.int8)
    starts[1:] |= (kinds[1:] != kinds[:-1]) | (kinds[1:] == NUMBER)
    _contractions(points, kinds, starts, last)
    begin, end = _pieces(starts, len(points))
    solid = kinds[begin] != SPACE
    return points, offsets, begin[solid], end[solid]


def byte_pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points, offsets of the texts, begin and end of the pieces, which cover every text.

    A piece is a run of letters, digits or other characters with a space before it, a
    contraction, or white space: a run without the character that stands before the next piece.
    """
    points, offsets, first, last = _laid_out(texts)
    kinds = CLASS[points]
    starts = first.copy()
    starts[1:] |= kinds[1:] != kinds[:-1]
    white = np.flatnonzero(kinds == SPACE)
    before = white[white < last[white]]
    before = before[kinds[before + 1] != SPACE]  # the last white character before a piece
    starts[before] = True
    starts[before[points[before] == 32] + 1] = False
    _contractions(points, kinds, starts, last)
    return points, offsets, *_pieces(starts, len(points))
