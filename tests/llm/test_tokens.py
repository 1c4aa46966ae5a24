import hashlib
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from frames import empty, messy, messy_rows, prose, rows_of
from tokenizers import Tokenizer

from barwatch.llm import packing
from barwatch.llm.bpe import Lexicon, encode_decode, encode_digests
from barwatch.llm.coder import NEITHER, Candidates, decode_blocks, encode_blocks, foretold, histories
from barwatch.llm.encoding import PieceEncoder
from barwatch.llm.token_files import read_token_files, write_token_files
from barwatch.session import new_folder

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def library(path):
    tool = Tokenizer.from_file(path)
    return lambda text: tool.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_equal_the_library(path):
    rng = random.Random(2)
    letters = list("ab'strevlmd  \n\t.,'1²\x85\xa0\x00éÉßÀſ") + ["'s", "<|", "|>", "<|endoftext|>", "İ", "ж", "日", "́"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(5000)]
    texts += [chr(i) + "a" + chr(i) * 2 for i in range(0x200)] + [r[1] or "" for r in messy_rows()]
    ids = library(path)
    for text, found in zip(texts, PieceEncoder(path).encode(texts)):
        assert found.tolist() == ids(text), repr(text)


def test_lexicon_knows_its_words_only():
    rng = random.Random(3)
    words = {prose(rng, 1) for _ in range(500)} | {"a", "ab", "abc"}
    data = Lexicon.compiled({w: [len(w), i] for i, w in enumerate(sorted(words))})
    lexicon = Lexicon.mapped(data.tobytes())
    asked = sorted(words) + ["zz", "abcd", "b", "é", "kaq"]
    points = np.frombuffer("".join(asked).encode("utf-32-le"), "<u4")
    ends = np.cumsum([len(w) for w in asked])
    ranks = lexicon.ranks(points, ends - [len(w) for w in asked], ends)
    assert ranks.tolist() == [sorted(words).index(w) if w in words else -1 for w in asked]
    assert lexicon.ids[lexicon.bounds[ranks[1]]] == len(asked[1])


def test_encode_and_decode_messy_rows(spark):
    ids, tool = library(WORD), Tokenizer.from_file(WORD)
    want = Counter((r[0], tuple(ids(r[1])), tool.decode(ids(r[1]), skip_special_tokens=False)) for r in messy_rows())
    found = encode_decode(messy(spark), WORD).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in found) == want
    assert encode_digests(empty(spark), WORD).count() == 0


def test_digests_equal_the_library(spark):
    tool = Tokenizer.from_file(WORD)
    docs = messy(spark)
    found = sorted(tuple(r) for r in encode_digests(docs, WORD).collect() if r.doc_id is not None)
    want = []
    for row in docs.filter("doc_id is not null").collect():
        ids = tool.encode(row.text or "", add_special_tokens=False).ids
        decoded = tool.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded)]
        want.append((row.doc_id, len(ids), *digests))
    assert found == sorted(want)


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    blocks = [rng.integers(0, 65536, n).astype(np.uint16) for n in (0, 1, 5, 3000)]
    blocks += [np.zeros(2000, np.uint16), np.full(100, 65535, np.uint16), np.tile([1, 2, 3], 500).astype(np.uint16)]
    blocks += [np.array([0], np.uint16), np.arange(1, 6000, dtype=np.uint16), np.tile(np.arange(5000, 0, -1), 2).astype(np.uint16)]
    blocks += [(rng.zipf(1.2, 2048) % 50_000).astype(np.uint16) for _ in range(50)]
    payloads = encode_blocks(blocks)
    for a, b in zip(blocks, decode_blocks(payloads, [len(b) for b in blocks])):
        assert (a == b).all()
    assert len(payloads[4]) < 100 and len(payloads[6]) < 300


def skewed_blocks(n, size=2048):
    """Blocks of some 350 ids each, of which few are frequent."""
    rng = np.random.default_rng(1)
    return [(rng.zipf(1.4, size) % 600 * rng.integers(1, 80)).astype(np.uint16) for _ in range(n)]


def test_long_and_many_kinds_of_blocks_round_trip():
    rng = np.random.default_rng(5)
    blocks = [rng.integers(0, 65536, n).astype(np.uint16) for n in (65536, 65537, 200_000)]
    blocks += [np.tile(np.arange(65536), 4).astype(np.uint16), np.zeros(0, np.uint16), np.repeat(np.arange(1000), 3).astype(np.uint16)]
    blocks += skewed_blocks(70, 300)
    for a, b in zip(blocks, decode_blocks(encode_blocks(blocks), [len(b) for b in blocks])):
        assert a.dtype == b.dtype and np.array_equal(a, b)


def test_symbols_found_at_once_equal_those_step_by_step():
    rows = np.array([np.unique(b, return_inverse=True)[1] for b in skewed_blocks(40, 500)], np.uint16)
    rows[1], rows[2, 10:40] = rows[0, 0], rows[2, 50:80]
    for at in (0, 32):
        some = rows[at : at + 32]
        symbols, steps = foretold(some), Candidates(len(some))
        for k in range(some.shape[1]):
            found = np.where(symbols[:, k] < NEITHER, 65535, some[:, k]).astype(np.uint16)
            steps.step(symbols[:, k], found, symbols[:, k] < NEITHER)
            assert np.array_equal(found, some[:, k])
        last = {}
        for k in range(some.shape[1]):  # the order-1 candidate of one row, by hand
            before = int(some[0, k - 1]) if k else 0
            assert (last.get(before, 0) != some[0, k]) or symbols[0, k] < NEITHER
            last[before] = some[0, k]
        want = [sum(int(symbols[3, k - 1 - i] < NEITHER) << i for i in range(min(5, k))) for k in range(some.shape[1])]
        assert histories(symbols)[3].tolist() == want


def test_damaged_payloads_never_give_the_block():
    blocks, rng = skewed_blocks(30, 700), np.random.default_rng(3)
    for block, payload in zip(blocks, encode_blocks(blocks)):
        broken = bytearray(payload)
        broken[rng.integers(len(payload) * 3 // 4)] ^= 1 << int(rng.integers(8))
        with np.errstate(all="ignore"):
            try:
                assert not np.array_equal(decode_blocks([bytes(broken)], [len(block)])[0], block)
            except ValueError as error:
                assert "damaged block" in str(error)


def test_an_id_costs_little_time_and_few_bits():
    blocks, times = skewed_blocks(2048), []
    for _ in range(2):
        began = time.process_time()
        sum(range(2_000_000))
        spin = (time.process_time() - began) * 27.5  # about 1 on the machine of the check tool
        began = time.process_time()
        payloads = encode_blocks(blocks)
        decode_blocks(payloads, [len(b) for b in blocks])
        times.append((time.process_time() - began) / spin / 2048**2)
    assert sum(map(len, payloads)) * 8 / 2048**2 < 7
    assert min(times) < 0.55e-6


def test_token_files_hold_all_documents_in_order(spark):
    folder, ids = new_folder(spark), library(WORD)
    write_token_files(messy(spark), folder, WORD)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    at, want = 0, Counter()
    for r in sorted(messy_rows(), key=key):
        some = np.array([*ids(r[1]), 2], "<u4")
        want[r[0], at, len(some), zlib.crc32(some.tobytes())] += 1
        at += len(some)
    assert rows_of(read_token_files(spark, folder), "doc_id", "start", "n_tokens", "ids_crc32") == want
    nothing = new_folder(spark)
    write_token_files(empty(spark), nothing, WORD)
    assert read_token_files(spark, nothing).count() == 0


def test_a_damaged_block_raises(spark):
    folder = new_folder(spark)
    write_token_files(messy(spark), folder, WORD)
    from pyspark.sql import functions as F

    damaged, blocks = new_folder(spark), spark.read.parquet(folder)
    blocks.withColumn("crc32", F.col("crc32") + 1).write.parquet(damaged)
    with pytest.raises(Exception, match="damaged block"):
        read_token_files(spark, damaged).count()


def test_packing_places_every_id_once(spark):
    ids, pieces = library(BYTE), packing.pack(messy(spark), BYTE).collect()
    want = Counter((r[0], np.array([*ids(r[1]), 0], "<u2").tobytes()) for r in messy_rows())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 2 * p.length
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append((p.offset, p.length))
    whole = Counter()
    for (key, text), n in want.items():
        for at in range(0, len(text) // 2):
            whole[key, at] += n
    covered = Counter((p.doc_id, p.start + i) for p in pieces for i in range(p.length))
    assert covered == whole
    texts = Counter()
    for key, some in by_doc.items():
        if sum(n for (k, _), n in want.items() if k == key) == 1:
            some = sorted(some, key=lambda p: p.start)
            texts[key, b"".join(bytes(p.ids) for p in some)] += 1
    assert all(want[k] == n for k, n in texts.items())
    for some in by_sequence.values():
        some.sort()
        ends = [o + n for o, n in some]
        assert [o for o, _ in some] == [0, *ends[:-1]] and ends[-1] <= packing.WINDOW
    assert packing.pack(empty(spark), BYTE).count() == 0


def test_neighbours_of_a_seed_come_first():
    rows = [np.array(x, np.uint16) for x in ([1, 2, 3, 4] * 100, [9, 8, 7], [1, 2, 3], [9, 7])]
    index = packing.Index(rows, np.ones(packing.VOCABULARY), 100.0)
    assert [p[0] for p in next(packing.windows(rows, index, True))][:2] == [0, 2]
