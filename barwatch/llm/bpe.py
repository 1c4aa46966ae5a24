"""Byte-pair encoding with a lexicon automaton for frequent words, and decoding."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.llm.common import in_python, whole_text
from barwatch.llm.encoding import PieceEncoder, encoder
from barwatch.llm.pretokens import LIMIT, is_plain
from barwatch.llm.textarrays import chunks, distinct_slices, spread_ranges
from barwatch.session import materialize

LEXICON_WORDS = 65_536
"""Words compiled into the lexicon: the most frequent of the whole corpus."""

COUNTED = 200_000
"""Distinct words a task holds before it passes its counts on."""


def word_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(word, n): how often each piece occurs in all texts that the array splitter takes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        seen: dict[str, int] = {}

        def passed_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": list(seen), "n": list(seen.values())}, schema=schema)
            seen.clear()
            return out

        for batch in batches:
            texts = [t for t in batch.column(0).to_pylist() if t and is_plain(t)]
            for i, j in chunks(texts):
                points, _, begin, end = tool.split(texts[i:j])
                code, words = distinct_slices(points, begin, end)
                for letters, k in zip(words, np.bincount(code).tolist()):
                    word = letters.decode("utf-16-le")
                    seen[word] = seen.get(word, 0) + k
                if len(seen) > COUNTED:
                    yield passed_on()
        yield passed_on()

    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    parts = in_python(docs.select(whole_text(text).alias("_text")), count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


class Lexicon:
    """A minimal acyclic transducer from words to id sequences, in one array of 32-bit numbers.

    Words share suffixes as well as prefixes: equal right languages are one state. Every step adds
    how many words sort before it, so a word's sum is its rank, and the rank leads to its ids. The array
    can be mapped from a file by all processes of a machine.
    """

    def __init__(self, data: np.ndarray) -> None:
        self.symbols, states, words, ids = (int(x) for x in data[:4])
        parts, at = [], 4
        for size in (LIMIT, states * self.symbols, states * self.symbols, states, words + 1, ids):
            parts.append(data[at : at + size])
            at += size
        self.symbol, self.target, self.add, self.final, self.bounds, self.ids = parts

    @classmethod
    def compiled(cls, entries: dict[str, list[int]]) -> np.ndarray:
        """The array for words whose code points are below the limit."""
        alphabet = sorted({c for word in entries for c in word})
        symbol = np.full(LIMIT, -1, np.int32)
        symbol[[ord(c) for c in alphabet]] = np.arange(len(alphabet))
        words = sorted(entries)
        register: dict[tuple, int] = {}
        # The path of the last word: per state its edges (symbol, state) and whether a word ends there.
        path: list[tuple[list[tuple[str, int]], bool]] = [([], False)]
        letters: list[str] = []
        states: list[tuple] = []

        def close(depth: int) -> None:
            """Replace the states of the path below ``depth`` by equal ones already registered."""
            while len(path) > depth + 1:
                edges, ends = path.pop()
                key = (tuple(edges), ends)
                if key not in register:
                    register[key] = len(states)
                    states.append(key)
                path[-1][0].append((letters.pop(), register[key]))

        for word in words:
            common = 0
            while common < min(len(word), len(letters)) and word[common] == letters[common]:
                common += 1
            close(common)
            for c in word[common:]:
                letters.append(c)
                path.append(([], False))
            path[-1] = (path[-1][0], True)
        close(0)
        states.append((tuple(path[0][0]), path[0][1]))

        size, width = len(states), len(alphabet)
        target = np.full((size, width), -1, np.int32)
        add = np.zeros((size, width), np.int32)
        below = np.zeros(size, np.int64)
        for s, (edges, ends) in enumerate(states):  # children come before their parents
            count = int(ends)
            for c, child in edges:
                k = symbol[ord(c)]
                target[s, k], add[s, k] = child, count
                count += below[child]
            below[s] = count
        flat = [entries[w] for w in words]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in flat])])
        parts = [
            [width, size, len(words), bounds[-1]], symbol, target.ravel(), add.ravel(),
            [ends for _, ends in states], bounds, [i for x in flat for i in x],
        ]
        return np.concatenate([np.asarray(p, np.int32) for p in parts])

    @classmethod
    def mapped(cls, data: bytes) -> Lexicon:
        """The lexicon, mapped from an unnamed scratch file of this process."""
        file = tempfile.TemporaryFile()
        file.write(data)
        file.flush()
        return cls(np.memmap(file, np.int32, "r"))

    def ranks(self, points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The rank of each word points[begin:end], -1 where the lexicon does not have it."""
        out = np.full(len(begin), -1, np.int32)
        if not self.symbols:
            return out
        letters = self.symbol[points]
        live, at, stop = np.arange(len(begin)), begin.copy(), end
        state = np.full(len(begin), len(self.final) - 1, np.int64)
        rank = np.zeros(len(begin), np.int32)
        while len(live):
            letter = letters[at]
            edge = state * self.symbols + letter
            state = self.target[edge]
            rank = rank + self.add[edge]
            at = at + 1
            go = (letter >= 0) & (state >= 0)
            done = go & (at == stop)
            hit = done & (self.final[state] == 1)
            out[live[hit]] = rank[hit]
            go &= ~done
            live, at, stop, state, rank = live[go], at[go], stop[go], state[go].astype(np.int64), rank[go]
        return out


def compile_lexicon(counts: DataFrame, path: str, words: int = LEXICON_WORDS) -> bytes:
    """The lexicon of the most frequent words (ties by word), at most ``words`` of them."""
    top = [r.word for r in counts.orderBy(F.desc("n"), "word").limit(words).collect()]
    flat, sizes = PieceEncoder(path)._merged(top) if top else (np.zeros(0, np.uint16), np.zeros(0, np.int64))
    ends = np.cumsum(sizes)
    entries = {w: flat[e - n : e].tolist() for w, e, n in zip(top, ends.tolist(), sizes.tolist())}
    return Lexicon.compiled(entries).tobytes()


class LexiconEncoder(PieceEncoder):
    """Looks pieces up in the lexicon; only what it does not have is remembered or merged."""

    def __init__(self, path: str, lexicon: Lexicon) -> None:
        super().__init__(path)
        self.lexicon = lexicon

    def ids_of(self, points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank = self.lexicon.ranks(points, begin, end)
        known = rank >= 0
        rare = np.flatnonzero(~known)
        flat, count = super().ids_of(points, begin[rare], end[rare])
        counts = np.zeros(len(begin), np.int64)
        counts[rare] = count
        first = self.lexicon.bounds[rank[known]]
        counts[known] = self.lexicon.bounds[rank[known] + 1] - first
        out = np.zeros(int(counts.sum()), np.uint16)
        ends = np.cumsum(counts)
        out[spread_ranges((ends - counts)[known], counts[known])] = self.lexicon.ids[
            spread_ranges(first.astype(np.int64), counts[known])
        ]
        out[spread_ranges((ends - counts)[rare], count)] = flat
        return out, counts


def token_texts(path: str) -> np.ndarray:
    """The text of every id; added tokens included."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    vocab = model["model"]["vocab"] | {t["content"]: t["id"] for t in model["added_tokens"]}
    out = np.full(max(vocab.values()) + 1, "", object)
    for token, i in vocab.items():
        out[i] = token
    return out


_own: dict[str, LexiconEncoder] = {}


def encode_decode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (array of int), decoded (string).

    ``ids`` is what the tokenizers library gives for the file at ``path`` without special tokens;
    null and empty texts have none. ``decoded`` joins the ids' tokens by spaces, as a file without
    decoder asks for. Every row is worked on by itself, so repeated rows and null ids need no care;
    other columns are ignored.

    A first pass counts words over all texts; the most frequent ones become a lexicon automaton, which
    is broadcast (bounded by ``LEXICON_WORDS``) and mapped. The second pass walks all words of a chunk
    through it at once.
    """
    return _encoded(docs, path, doc_id, text, digests=False)


def encode_digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``encode_decode``, with n_tokens, ids_sha256 and decoded_sha256 instead of the values.

    ``ids_sha256`` is over the decimal ids joined by one space. The values stay inside the task.
    """
    return _encoded(docs, path, doc_id, text, digests=True)


def _encoded(docs: DataFrame, path: str, doc_id: str, text: str, digests: bool) -> DataFrame:
    counts = materialize(word_counts(docs, path, text))
    lexicon = docs.sparkSession.sparkContext.broadcast(compile_lexicon(counts, path))
    name = uuid.uuid4().hex
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("_text"))
    id_field = rows.schema["doc_id"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _own:
            _own.clear()
            _own[name] = LexiconEncoder(path, Lexicon.mapped(lexicon.value))
        tool, tokens = _own[name], token_texts(path)
        decimal = np.array([str(i) for i in range(len(tokens))], object)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in chunks(texts):
                some = tool.encode(texts[i:j])
                keys = batch.column(0).slice(i, j - i)
                decoded = [" ".join(tokens[x].tolist()) for x in some]
                if digests:
                    columns = [
                        keys,
                        pa.array([len(x) for x in some], pa.int64()),
                        pa.array([sha(" ".join(decimal[x].tolist())) for x in some]),
                        pa.array([sha(x) for x in decoded]),
                    ]
                    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    columns = [keys, pa.array([x.astype(np.int32) for x in some], pa.list_(pa.int32())), pa.array(decoded)]
                    names = ["doc_id", "ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    made = (
        "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    )
    return in_python(rows, encode, f"doc_id {id_field.dataType.simpleString()}, {made}")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
