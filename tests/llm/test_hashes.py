"""Hashes of slices against equality, on patterns that polynomials modulo 2**64 cannot tell apart."""

import random

import numpy as np
import pytest
from frames import rows_of

from barwatch.llm import textarrays
from barwatch.llm.encoding import PieceEncoder
from barwatch.llm.queries import tokenizer_path
from barwatch.llm.substring_dedup import repeated_passages
from barwatch.llm.textarrays import PRIME, PrimeSliceHash, product
from barwatch.llm.wordarrays import Words

SIZES = (512, 1024, 2048, 4096, 8192)


def pattern(n: int, letters=("a", "b")) -> list[str]:
    """Thue-Morse sequence: at each place the parity of the ones in its number."""
    return [letters[i.bit_count() % 2] for i in range(n)]


def test_products_modulo_the_prime():
    rng = random.Random(3)
    p = int(PRIME)
    a = [rng.randrange(p) for _ in range(2000)] + [0, 1, p - 1, p - 1]
    b = [rng.randrange(p) for _ in range(2000)] + [5, p - 1, p - 1, 0]
    got = product(np.array(a, np.uint64), np.array(b, np.uint64)).tolist()
    assert got == [x * y % p for x, y in zip(a, b)]


def test_equal_slices_have_equal_hashes_and_others_do_not():
    rng = random.Random(4)
    values = np.array([rng.randrange(3) for _ in range(3000)] * 2, np.uint64)
    begin = np.arange(3000)
    end = np.minimum(begin + np.array([rng.randrange(0, 400) for _ in range(3000)]), 3000)
    hashed = PrimeSliceHash()
    assert np.array_equal(hashed(values, begin, end), hashed(values, begin + 3000, end + 3000))
    seen = {}
    for h, i, j in zip(hashed(values, begin, end).tolist(), begin.tolist(), end.tolist()):
        assert seen.setdefault(h, tuple(values[i:j].tolist())) == tuple(values[i:j].tolist())


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_of_pattern_words(name):
    encoder = PieceEncoder(tokenizer_path(name))
    texts = ["".join(pattern(n, x)) for n in SIZES for x in (("a", "b"), ("b", "a"))]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_where_most_pieces_share_a_hash(name):
    encoder, rng = PieceEncoder(tokenizer_path(name)), random.Random(5)
    whole = encoder.hash
    encoder.hash = lambda *slices: whole(*slices) >> np.uint64(60) << np.uint64(60)
    for _ in range(3):
        texts = [" ".join("".join(rng.choices("abé1'.", k=rng.randint(1, 6))) for _ in range(40)) for _ in range(30)]
        for text, ids in zip(texts, encoder.encode(texts)):
            assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", SIZES)
def test_contents_of_pattern_texts_differ(n):
    first, second = ([f"u{i} {w}" for i, w in enumerate(pattern(n, x))] for x in (("alpha", "beta"), ("beta", "alpha")))
    a, b = Words([" ".join(first), " ".join(second), " ".join(pattern(n)), " ".join(pattern(n, ("b", "a")))]).contents()
    assert len(set(a.tolist())) == 4 and len(set(zip(a.tolist(), b.tolist()))) == 4


def test_pattern_texts_share_no_passage(spark):
    texts = [" ".join(f"u{i} {w}" for i, w in enumerate(pattern(2048, x))) for x in (("alpha", "beta"), ("beta", "alpha"))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert rows_of(repeated_passages(docs), "doc_id", "n_words", "n_removed") == {(0, 4096, 0): 1, (1, 4096, 0): 1}


def test_buffers_forgotten_between_tasks_change_no_hash():
    values = np.random.default_rng(6).integers(0, 1000, 60_000).astype(np.uint32)
    begin = np.arange(0, 50_000, 7)
    hashes = textarrays.slice_hashes()
    for some in (values, values.astype(np.uint64) << np.uint64(40)):
        first = [h(some, begin, begin + 5000) for h in hashes]
        assert all(len(h.powers) > 60_000 for h in hashes)
        textarrays.forget()
        assert all(len(h.powers) == 1 and not h.scratch.held for h in hashes)
        assert all(np.array_equal(a, h(some, begin, begin + 5000)) for a, h in zip(first, hashes))
