"""Adaptive range coder for token ids, run over many independent blocks at once.

A block's payload begins with the list of its ids in ascending order, each with a count (order 0); from there on an id is
its place in that list. For each id there are two candidates: what followed the last two ids (order 2) and what followed
the last id (order 1). One symbol says that the id is the order-2 candidate, or the order-1 candidate, or neither. Its
distribution mixes what was counted after the same hits and misses with what was counted in the whole block so far; it
stays as it is for a stretch of ids and then moves at once. An id that is neither is told by its share of the counts. These
hold for the whole block, so that reading such an id is one look into a table. As a distribution depends on earlier symbols only,
candidates are looked up only where they are hit, and the writer finds all symbols by sorting. All arithmetic
is on integers, so decoding repeats it exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK = 2048
"""Ids per block."""

LANES = 4096
"""Blocks worked on at once, fewer where some are long; affects memory and speed only."""

SLOTS = 11
"""Bits of the candidate tables of a block, and at least of the shares of its counts."""

MASK = (1 << SLOTS) - 1

GROUP = 32
"""Blocks whose candidates are found together; their slots are told apart in 16 bits."""

U = np.uint64
ONES = U(0x0101010101010101)
"""Times this, the sum of a number's bytes is its highest byte."""
WORD, LOW = U(32), U((1 << 32) - 1)
TOTAL, FLOOR, RATE = 14, 16, 5

NEITHER, SYMBOLS = 2, 3
"""The symbol of ids that are no candidate; 0 and 1 are the candidates."""

HISTORY = 5
CONTEXTS = 1 << HISTORY
"""A context says which of the last ids were candidates."""

STRETCHES = {16 * ((1 << k) - 1) - 1 for k in range(1, 6)}
LONGEST, PRIOR = 512, 8
"""The steps after which distributions move: stretches get longer, up to ``LONGEST``."""

WIDTH = 24
"""Cumulated counts of a distribution over the bit lengths in a list."""

LENGTH = np.array([i.bit_length() for i in range((1 << 17) + 1)], np.int64)


EVEN = (np.arange(WIDTH) * (1 << TOTAL) // (WIDTH - 1)).astype(np.int16)
STEP = np.arange(WIDTH) * FLOOR
GOALS = np.array([np.where(np.arange(WIDTH) <= s, STEP, (1 << TOTAL) - STEP[::-1]) for s in range(WIDTH - 1)], np.int16)
"""Where a distribution moves to after each symbol."""


def slot_numbers(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Where the candidates after the last ids ``one`` and those before them, ``two``, stand in a block's tables."""
    out = np.empty((2, len(one)), np.uint32)
    mixed = np.multiply(one, np.uint32(40503), out=out[0])
    mixed += two * np.uint32(60493)
    mixed >>= 4
    out[1] = one
    out &= MASK
    return out


def foretold(places: np.ndarray) -> np.ndarray:
    """Symbols of ``GROUP`` rows of places at most: what `Candidates` names, for all steps at once."""
    lanes, steps = places.shape
    before = np.zeros((lanes, steps + 2), np.uint32)
    before[:, 2:] = places
    flat = places.ravel()
    lane = np.repeat(np.arange(lanes, dtype=np.uint16) << SLOTS, steps)
    hits = []
    for slots in slot_numbers(before[:, 1:-1].ravel(), before[:, :-2].ravel()).astype(np.uint16):
        slots |= lane
        order = np.argsort(slots, kind="stable")
        slots, own = slots.take(order), flat.take(order)
        # The place before it at the same slot, or none yet, which counts as 0.
        hit = np.empty(len(own), bool)
        np.equal(own[1:], own[:-1] * (slots[1:] == slots[:-1]), out=hit[1:])
        hit[:1] = own[:1] == 0
        back = np.empty(len(own), np.uint8)
        back[order] = hit
        hits.append(back)
    return ((NEITHER - hits[1]) * (hits[0] ^ 1)).reshape(places.shape)


def histories(symbols: np.ndarray) -> np.ndarray:
    """Contexts in rows of symbols: which of the last ids were candidates, the last one in the lowest bit."""
    out = np.zeros(symbols.shape, np.uint8)
    hit = (symbols < NEITHER).view(np.uint8)
    for k in range(HISTORY):
        out[:, k + 1 :] |= hit[:, : max(0, hit.shape[1] - k - 1)] << k
    return out


class Candidates:
    """What followed the last two ids and the last id, in ``lanes`` blocks."""

    def __init__(self, lanes: int) -> None:
        # Order 2 block by block; order 1 slot by slot, as blocks often have the same ids last.
        self.table = np.zeros(2 * lanes << SLOTS, np.uint16)
        lane = np.arange(lanes, dtype=np.int64)
        self.factor = np.array([[1], [lanes]], np.int64)
        self.base = np.stack([lane << SLOTS, (lanes << SLOTS) + lane])
        self.last, self.earlier = np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)

    def step(self, symbol: np.ndarray, places: np.ndarray, hit: np.ndarray) -> None:
        """Put the candidates that were hit into ``places``, and take note of what followed."""
        n = len(places)
        slots = self.factor * slot_numbers(self.last[:n], self.earlier[:n])
        slots += self.base[:, :n]
        lanes = np.flatnonzero(hit)
        places[lanes] = self.table.take(slots[symbol.take(lanes), lanes])
        for own in slots:
            self.table[own] = places
        self.earlier, self.last = self.last, places.astype(np.uint32)


class Flags:
    """Distributions over the three symbols for every context, in ``lanes`` blocks.

    They stay as they are for a stretch of ids; after it, what was counted moves all of them at once. A context's own
    counts are mixed with those of its whole block, which weigh as much as ``PRIOR`` ids.
    """

    def __init__(self, lanes: int) -> None:
        self.lane = np.arange(lanes, dtype=np.int64)
        self.counts = np.zeros((SYMBOLS, CONTEXTS, lanes), np.int64)
        self.coded: list[np.ndarray] = []
        self._move()

    def keys(self, codes: np.ndarray) -> np.ndarray:
        """Where contexts, with ``CONTEXTS`` added for each symbol, of the first lanes stand."""
        out = codes * np.int64(len(self.lane))
        out += self.lane[: len(out)]
        return out

    def _move(self) -> None:
        whole = self.counts.sum(axis=1) + 1
        prior = PRIOR * ((whole << 8) // whole.sum(axis=0)).astype(U)
        own = [(counts.astype(U) << U(8)) + some for counts, some in zip(self.counts, prior)]
        own[1] += own[0]
        own[2] += own[1]
        room = U((1 << TOTAL) - SYMBOLS * FLOOR)
        first, second = (o * room // own[2] + U(k * FLOOR) for k, o in enumerate(own[:2], 1))
        spans = np.empty(self.counts.shape, np.uint32)
        for s, (begin, end) in enumerate(((U(0), first), (first, second), (second, U(1 << TOTAL)))):
            spans[s] = begin | ((end - begin) << U(16))
        self.spans = spans.ravel()
        """Where a symbol's part begins, and above it its size, by symbol, context and lane."""

    def learn(self, step: int, keys: np.ndarray) -> None:
        """Take note of what was coded at ``step``, by symbol, context and lane."""
        self.coded.append(keys)
        if step in STRETCHES or step % LONGEST == LONGEST - 1:
            self.counts += np.bincount(np.concatenate(self.coded), minlength=self.counts.size).reshape(self.counts.shape)
            self.coded.clear()
            self._move()


class Range:
    """Carry-less range coder with 64-bit bounds and 32-bit words, one per lane.

    Between two words it narrows by 14 and up to 17 bits and starts with a width of 2**32 - 1 or more, so that one
    word at most is due after it.
    """

    def __init__(self, lanes: int) -> None:
        self.low = np.zeros(lanes, U)
        self.width = np.full(lanes, (1 << 64) - 1, U)

    def shift(self, lanes: np.ndarray, low: np.ndarray) -> None:
        raise NotImplementedError

    def turn(self, order: np.ndarray) -> None:
        """Put the lanes into another order."""
        self.low, self.width = self.low[order], self.width[order]

    def narrow(self, unit: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        """Set new bounds for as many lanes as are given."""
        n = len(unit)
        low = self.low if n == len(self.low) else self.low[:n]
        low += begin * unit
        np.multiply(size, unit, out=self.width if n == len(self.low) else self.width[:n])

    def settle(self, n: int) -> None:
        """Words on which the bounds of the first ``n`` lanes agree go out."""
        go = np.flatnonzero(self.width[:n] <= LOW)
        if len(go):
            some, size = self.low.take(go), self.width.take(go)
            self.shift(go, some)
            some <<= WORD
            size <<= WORD
            # Where the bounds differ in a higher bit, the part below that bit is kept; elsewhere ``size`` is the smaller one.
            self.width[go] = np.minimum(size, ~some, out=size)
            self.low[go] = some


class Writer(Range):
    def __init__(self, lanes: int) -> None:
        super().__init__(lanes)
        self.lane = np.arange(lanes).astype(np.uint32 if lanes > 1 << 16 else np.uint16)
        self.given: list[tuple[np.ndarray, np.ndarray]] = []  # lanes and words in the order of their making

    def shift(self, lanes: np.ndarray, low: np.ndarray) -> None:
        self.given.append((self.lane.take(lanes), (low >> WORD).astype("<u4")))

    def turn(self, order: np.ndarray) -> None:
        super().turn(order)
        self.lane = self.lane[order]

    def step(self, n: int, bits: int | np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        self.narrow(self.width[:n] >> bits, begin, size)

    def finish(self) -> list[bytes]:
        every = np.arange(len(self.low))
        for low in (self.low, self.low << WORD):
            self.shift(every, low)
        lanes, words = (np.concatenate(x) for x in zip(*self.given))
        whole = words.take(np.argsort(lanes, kind="stable")).tobytes()
        ends = (4 * np.cumsum(np.bincount(lanes, minlength=len(every)))).tolist()
        return [whole[i:j] for i, j in zip([0, *ends], ends)]


class Reader(Range):
    def __init__(self, payloads: list[bytes]) -> None:
        sizes = np.array([len(p) // 4 for p in payloads])
        if (sizes < 3).any():
            raise ValueError("damaged block: too short")
        whole = b"".join([p[: len(p) // 4 * 4] for p in payloads])
        self.words = np.append(np.frombuffer(whole, "<u4"), np.uint32(0))
        begin = np.cumsum(sizes) - sizes
        super().__init__(len(payloads))
        self.at = begin + 3
        self.first = self.words[begin].astype(np.int64)
        self.code = (self.words[begin + 1].astype(U) << WORD) | self.words[begin + 2]

    def shift(self, lanes: np.ndarray, low: np.ndarray) -> None:
        at = self.at.take(lanes)
        code = self.code.take(lanes)
        code <<= WORD
        code |= self.words.take(at, mode="clip")
        self.code[lanes] = code
        at += 1
        self.at[lanes] = at

    def turn(self, order: np.ndarray) -> None:
        super().turn(order)
        self.code, self.at = self.code[order], self.at[order]

    def value(self, n: int, bits: int | np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the code lies, at most ``most``, in units of a width cut into 2**bits, and that unit."""
        unit = self.width[:n] >> bits
        rest = self.code[:n] - self.low[:n]
        rest //= unit
        return np.minimum(rest, most, out=rest), unit


def _lists(coder: Writer | Reader, sizes: np.ndarray, numbers: np.ndarray) -> None:
    """Code the columns of ``numbers`` (steps in the list, counts), or fill them; ``sizes`` must not increase."""
    cuts = [np.tile(EVEN, (len(sizes), 1)) for _ in numbers]
    steps = numbers.shape[1]
    active = np.searchsorted(-sizes, -np.arange(steps), "left").tolist()
    most = U((1 << TOTAL) - 1)
    for step, n in enumerate(active):
        for own, cut in zip(numbers, cuts):
            cut = cut[:n]
            if isinstance(coder, Writer):
                number = own[step, :n]
                symbol = LENGTH.take(number) - 1
            else:
                value, unit = coder.value(n, U(TOTAL), most)
                below = (cut <= value.astype(np.int16)[:, None]).view(U)
                symbol = (((below[:, 0] + below[:, 1] + below[:, 2]) * ONES) >> U(56)).astype(np.int64) - 1
            at = np.arange(n) * WIDTH + symbol
            begin, end = (cut.ravel().take(at + k).astype(U) for k in range(2))
            end -= begin
            bits, one = symbol.astype(U), np.ones(n, U)
            if isinstance(coder, Writer):
                coder.step(n, U(TOTAL), begin, end)
                coder.step(n, bits, number.astype(U) ^ (one << bits), one)
            else:
                coder.narrow(unit, begin, end)
                value, unit = coder.value(n, bits, (one << bits) - one)
                own[step, :n] = value | (one << bits)
                coder.narrow(unit, value, one)
            coder.settle(n)
            moved = GOALS.take(symbol, axis=0)
            moved -= cut
            moved >>= RATE
            cut += moved


class Shares:
    """What part of 2**bits each place of each block's list has, by its count.

    ``counts`` hold the blocks' lists one after the other. A block's counts add up to 2**bits at most, so every
    place has a part. After the places of a block comes one that has the whole, for ids that are candidates.
    """

    def __init__(self, lengths: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> None:
        lanes = np.arange(len(sizes))
        self.bits = np.array([share_bits(n) for n in lengths.tolist()], np.int64)
        ends = np.cumsum(sizes)
        sums = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=sums[1:])
        before = sums[ends - sizes]
        total = sums[ends] - before
        if (total > np.minimum(lengths, 1 << self.bits)).any() or ((sizes == 0) & (lengths > 0)).any():
            raise ValueError("damaged block: counts")
        upto = (sums[1:] - before.repeat(sizes)).astype(U)
        upto <<= self.bits.astype(U).repeat(sizes)
        upto //= total.astype(U).repeat(sizes)
        begin = np.zeros(len(counts), U)
        begin[1:] = upto[:-1]
        begin[(ends - sizes)[sizes > 0]] = 0
        self.own = (upto - begin).astype(np.int64)
        self.offset, self.whole = ends - sizes + lanes, ends + lanes
        self.half = 16 if (self.bits < 16).all() else 32
        self.spans = np.empty(len(counts) + len(sizes), np.uint32 if self.half == 16 else U)
        """Where parts begin, and ``half`` bits above it their sizes."""
        self.spans[self.whole] = 1 << (self.bits + self.half)
        self.spans[np.arange(len(counts)) + lanes.repeat(sizes)] = begin | ((upto - begin) << U(self.half))

    def inside(self, outer: np.ndarray, span: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and size of these parts inside outer ones (of `Flags`), with ``bits`` more than those."""
        size = outer >> 16
        begin = outer & 0xFFFF
        begin <<= bits
        begin += size * (span & ((1 << self.half) - 1)).astype(np.uint32, copy=False)
        size *= (span >> self.half).astype(np.uint32, copy=False)
        return begin, size


def share_bits(length: int) -> int:
    return max(SLOTS, (length - 1).bit_length()) if length <= 1 << 16 else 17


def _listed(block: np.ndarray, seen: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block's ids in ascending order, and the places of its ids in that list; ``seen`` is left empty."""
    seen[block] = True
    eights = np.flatnonzero(seen.view(U) != 0)
    some = np.flatnonzero(seen.reshape(-1, 8).take(eights, axis=0))
    own = (eights << 3).take(some >> 3) + (some & 7)
    seen[own] = False
    rank[own] = np.arange(len(own))
    return own, rank.take(block)


def _columns(flat: np.ndarray, sizes: np.ndarray, out: np.ndarray) -> None:
    """Lay pieces of ``flat`` of the given sizes side by side, as columns of ``out``."""
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at *= len(sizes)
    at += np.repeat(np.arange(len(sizes)), sizes)
    out.reshape(-1)[at] = flat


def _encode(some: list[np.ndarray]) -> list[bytes]:
    """Payloads of blocks whose lengths do not increase."""
    lengths, lanes = np.array([len(b) for b in some]), len(some)
    steps = int(lengths.max())
    rows = np.zeros((lanes, steps), np.uint16)
    seen, rank, lists = np.zeros(1 << 16, bool), np.zeros(1 << 16, np.uint16), []
    for row, block in zip(rows, some):
        own, row[: len(block)] = _listed(block, seen, rank)
        lists.append(own)
    symbols, codes = np.empty((lanes, steps), np.uint8), np.empty((lanes, steps), np.uint8)
    for i in range(0, lanes, GROUP):
        part = slice(i, i + GROUP)
        symbols[part] = foretold(rows[part])
        codes[part] = histories(symbols[part]) + symbols[part] * np.uint8(CONTEXTS)

    sizes = np.array([len(own) for own in lists])
    counts = np.ones(int(sizes.sum()), np.int64)
    at = 0
    for row, neither, own, n in zip(rows, symbols == NEITHER, lists, lengths.tolist()):
        told = np.bincount(row[:n][neither[:n]], minlength=len(own)) >> max(0, (n - 1).bit_length() - 16)
        np.maximum(told, 1, out=counts[at : at + len(own)])
        at += len(own)
    shares = Shares(lengths, sizes, counts)

    by_size = np.argsort(-sizes, kind="stable")
    numbers = np.zeros((2, int(sizes.max()), lanes), np.int32)
    _columns(np.concatenate([np.diff(own, prepend=-1) for own in lists]), sizes, numbers[0])
    _columns(counts, sizes, numbers[1])
    writer = Writer(lanes)
    writer.shift(np.arange(lanes), sizes.astype(U) << WORD)
    writer.turn(by_size)
    _lists(writer, sizes[by_size], np.ascontiguousarray(numbers[:, :, by_size]))
    writer.turn(np.argsort(by_size))

    spans = np.empty((lanes, steps), shares.spans.dtype)
    for row, out, symbol, begin, whole in zip(rows, spans, symbols, shares.offset.tolist(), shares.whole.tolist()):
        out[:] = shares.spans[begin : whole + 1].take(np.where(symbol < NEITHER, np.int64(whole - begin), row))
    spans, codes = np.ascontiguousarray(spans.T), np.ascontiguousarray(codes.T)
    flags, short, total = Flags(lanes), shares.bits.astype(np.uint32), shares.bits.astype(U) + U(TOTAL)
    active = np.searchsorted(-lengths, -np.arange(steps), "left").tolist()
    for step, (n, span, code) in enumerate(zip(active, spans, codes)):
        keys = flags.keys(code[:n])
        begin, size = shares.inside(flags.spans.take(keys), span[:n], short[:n])
        writer.step(n, total[:n], begin, size)
        writer.settle(n)
        flags.learn(step, keys)
    return writer.finish()


def _decode(payloads: list[bytes], lengths: np.ndarray) -> list[np.ndarray]:
    """The ids of payloads whose lengths do not increase."""
    lanes, steps = len(payloads), int(lengths.max())
    reader = Reader(payloads)
    sizes = reader.first
    if (sizes > np.minimum(lengths, 1 << 16)).any():
        raise ValueError("damaged block: list")
    by_size = np.argsort(-sizes, kind="stable")
    numbers = np.zeros((2, int(sizes.max()), lanes), np.int32)
    reader.turn(by_size)
    _lists(reader, sizes[by_size], numbers)
    back = np.argsort(by_size)
    reader.turn(back)
    filled = np.arange(numbers.shape[1]) < sizes[:, None]
    ids = (np.cumsum(numbers[0], axis=0) - 1)[:, back].T[filled]
    if len(ids) and ids.max() >= 1 << 16:
        raise ValueError("damaged block: list")
    shares = Shares(lengths, sizes, numbers[1][:, back].T[filled])
    starts = np.cumsum(sizes) - sizes
    table = np.repeat((np.arange(len(ids)) - np.repeat(starts, sizes)).astype(np.uint16), shares.own)
    held = np.where(sizes > 0, 1 << shares.bits, 0)
    base, short, total = np.cumsum(held) - held, shares.bits.astype(np.uint32), shares.bits.astype(U) + U(TOTAL)
    most = (U(1) << total) - U(1)

    # Place by place, as blocks often have the same ids; the last row is for candidates.
    spans = np.zeros((int(sizes.max()) + 1, lanes), shares.spans.dtype)
    _columns(shares.spans, sizes + 1, spans)
    spans[-1] = shares.spans[shares.whole]
    spans, lane = spans.ravel(), np.arange(lanes)
    whole = lane + sizes.max() * lanes

    places = np.zeros((steps, lanes), np.uint16)
    candidates, flags, past = Candidates(lanes), Flags(lanes), np.zeros(lanes, np.uint8)
    active = np.searchsorted(-lengths, -np.arange(steps), "left").tolist()
    now_active = -1
    for step, n in enumerate(active):
        if n != now_active:
            now_active = n
            past = past[:n]
            short, total, most, base, lane, whole = short[:n], total[:n], most[:n], base[:n], lane[:n], whole[:n]
        keys = flags.keys(past)
        second = flags.spans.take(keys + CONTEXTS * lanes)
        value, unit = reader.value(n, total, most)
        value = value.astype(np.uint32)
        high = value >> short
        first = second & 0xFFFF
        second >>= 16
        second += first
        later = second <= high
        hit = ~later
        symbol = (first <= high).view(np.uint8) + later.view(np.uint8)
        keys += symbol * np.int64(CONTEXTS * lanes)
        outer = flags.spans.take(keys)
        value -= (outer & 0xFFFF) << short
        value //= outer >> 16
        now = table.take(value + base)
        own = now * np.int64(lanes)
        own += lane
        np.copyto(own, whole, where=hit)
        begin, size = shares.inside(outer, spans.take(own), short)
        reader.narrow(unit, begin, size)
        reader.settle(n)
        candidates.step(symbol, now, hit)
        places[step, :n] = now
        flags.learn(step, keys)
        past <<= 1
        past |= hit.view(np.uint8)
        past &= CONTEXTS - 1
    rows, ids = np.ascontiguousarray(places.T), ids.astype(np.uint16)
    lists = np.split(ids, starts[1:])
    return [own[row[:n]] for own, row, n in zip(lists, rows, lengths.tolist())]


def batches(sizes: list[int]) -> Iterator[list[int]]:
    """The numbers of the blocks coded at once, by descending size; fewer where one is long."""
    lanes = max(1, LANES * BLOCK // max(BLOCK, *sizes, 0))
    for at in range(0, len(sizes), lanes):
        yield (at + np.argsort([-n for n in sizes[at : at + lanes]], kind="stable")).tolist()


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """One payload per array of 16-bit ids; any lengths."""
    out: list[bytes] = [b""] * len(blocks)
    for order in batches([len(b) for b in blocks]):
        for i, payload in zip(order, _encode([blocks[i] for i in order])):
            out[i] = payload
    return out


def decode_blocks(payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids of each payload, given how many they are."""
    out: list = [None] * len(payloads)
    for order in batches(sizes):
        for i, ids in zip(order, _decode([payloads[i] for i in order], np.array([sizes[i] for i in order]))):
            out[i] = ids
    return out
