"""Blocks of token ids, compressed by an adaptive context-mixing range coder.

Ids are cut into blocks of ``BLOCK`` ids. Every block starts from the same fresh model and
can be decoded alone. Within a block the next id x has the probability

    P(x) = w P2(x) + (1 - w) P1(x),    Pk(x) = rk [x = what followed last] + (1 - rk) P0(x)

P2 and P1 look up what followed the last two ids and the last one; rk grows with the hits that
a context has had in a row; w drifts to the order that was right where only one was; P0 is
the share of an id among the block's ids so far, added to prior counts, brought up to date at
the steps in ``REFRESH``.

All blocks of a group advance together, one id a step, each in its lane of numpy arrays;
encoder and decoder run the same integer model, so they agree on every machine.
"""

from __future__ import annotations

import math

import numpy as np

BLOCK = 2048
REFRESH = (64, 256, 1024)
GROUP_BYTES = 96 << 20
GROUP_LANES = 2048
SLOTS = 2048  # contexts remembered per block and order
ONE = 1 << 16
PRIOR = 1 << 15  # prior counts add up to about this
WEIGHTS = 32
NOTHING = 0xFFFF << 4  # a context's entry: id << 4 | hits in a row, 0 for none yet
FLOOR = np.uint64(1 << 32)
LOW32 = np.uint64((1 << 32) - 1)
U16, U32 = np.uint64(16), np.uint64(32)
BYTE_SUM, TOP_BYTE = np.uint64(0x0101010101010101), np.uint64(56)
TAIL = 3  # words that end a block
REFRESH_LANES = 32

# Share of ONE given to a prediction after so many hits in a row, none for an unknown context.
_TRUST = np.array([0] + [ONE * h * h // (h * h + 8) for h in range(1, 16)], np.int32)
_HITS = np.array([*range(1, 16), 15], np.int32)


class Encoder:
    """Range coder with 48 bits of range; words of 16 bits, carries settled at the end."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, (1 << 48) - 1, np.uint64)
        self.lanes = lanes
        self.words = np.zeros((BLOCK + 512) * lanes, np.uint32)  # a row of lanes a word
        self.at = np.arange(lanes)

    def reserve(self, steps: int) -> None:
        """Room for ``steps`` more coding steps; each writes a word at most."""
        missing = int(self.at.max()) + (steps + TAIL + 1) * self.lanes - len(self.words)
        if missing > 0:
            grown = np.zeros(missing + len(self.words) // 4 // self.lanes * self.lanes, np.uint32)
            self.words = np.concatenate([self.words, grown[: len(grown) // self.lanes * self.lanes]])

    def put(self, unit: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        n = len(unit)
        low, span = self.low[:n], self.range[:n]
        low += unit * start
        np.multiply(unit, size, out=span)
        short = np.flatnonzero(span < FLOOR)
        out = low.take(short)
        at = self.at.take(short)
        self.words[at] = out >> U32
        self.at[short] = at + self.lanes
        low[short] = (out & LOW32) << U16
        span[short] = span.take(short) << U16

    def finish(self) -> list[bytes]:
        self.reserve(TAIL)
        for shift in (32, 16, 0):
            word = self.low >> np.uint64(shift)
            self.words[self.at] = word if shift == 32 else word & np.uint64(0xFFFF)
            self.at += self.lanes
        lengths = self.at // self.lanes
        words = self.words.reshape(-1, self.lanes)[: lengths.max()]
        for row in range(len(words) - 1, 0, -1):
            words[row - 1] += words[row] >> 16
        packed = np.ascontiguousarray(words.astype("<u2").T)
        return [packed[i, :n].tobytes() for i, n in enumerate(lengths.tolist())]


class Decoder:
    def __init__(self, payloads: list[bytes]):
        self.lanes = len(payloads)
        words = np.zeros((self.lanes, max(map(len, payloads)) // 2 + 1), "<u2")
        for i, payload in enumerate(payloads):
            words[i, : len(payload) // 2] = np.frombuffer(payload, "<u2")
        self.words = np.ascontiguousarray(words.T).reshape(-1)
        self.range = np.full(self.lanes, (1 << 48) - 1, np.uint64)
        self.code = np.zeros(self.lanes, np.uint64)
        self.at = np.arange(self.lanes)
        for _ in range(TAIL):
            self.code = self.code << U16 | self.words.take(self.at).astype(np.uint64)
            self.at += self.lanes

    def take(self, unit: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        n = len(unit)
        code, span = self.code[:n], self.range[:n]
        code -= unit * start
        np.multiply(unit, size, out=span)
        short = np.flatnonzero(span < FLOOR)
        at = self.at.take(short)
        code[short] = code.take(short) << U16 | self.words.take(at).astype(np.uint64)
        self.at[short] = at + self.lanes
        span[short] = span.take(short) << U16


class Contexts:
    """What followed each context of a block last, and how often in a row it did."""

    def __init__(self, lanes: int):
        self.entries = np.full(lanes * SLOTS, NOTHING, np.int32)
        self.first = np.arange(lanes, dtype=np.int32) * SLOTS

    def predict(self, n: int, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.slot = self.first[:n] + (hashed & (SLOTS - 1))
        entry = self.entries.take(self.slot)
        self.hits = entry & 15
        return entry >> 4, _TRUST.take(self.hits)

    def learn(self, hit: np.ndarray, shifted: np.ndarray) -> None:
        self.entries[self.slot] = shifted + _HITS.take(self.hits * hit)


class Counts:
    """Order 0: running counts per lane, as they stood at the last refresh.

    ``starts`` are the sums below each symbol; ``coarse`` every 16th, every 256th and so on
    of them, so that a search reads 16 neighbours a level.
    """

    def __init__(self, lanes: int, prior: np.ndarray):
        self.prior = prior_counts(prior)
        self.learn = (ONE - 1 - int(self.prior.sum())) // BLOCK
        self.depth = 1
        while 16**self.depth < len(prior) + 1:
            self.depth += 1
        self.width = 16**self.depth
        self.first = np.arange(lanes, dtype=np.int64) * self.width
        self.starts = np.full((lanes, self.width), ONE - 1, np.uint16)
        self.starts[:, 0] = 0
        self.flat = self.starts.reshape(-1)
        self.total = np.empty(lanes, np.uint64)
        self._set(slice(0, lanes), np.cumsum(self.prior)[None, :])
        self._sample()

    def _set(self, lanes: slice, sums: np.ndarray) -> None:
        self.starts[lanes, 1 : len(self.prior) + 1] = sums
        self.total[lanes] = sums[:, -1]

    def _sample(self) -> None:
        steps = [16**k for k in range(self.depth - 1, -1, -1)]
        self.levels = [
            np.ascontiguousarray(self.starts[:, ::step]).view(np.uint64).reshape(-1, 4) for step in steps
        ]

    def refresh(self, so_far: np.ndarray) -> None:
        """``so_far``: the ids of each lane, a row a step."""
        size = len(self.prior)
        for at in range(0, len(self.starts), REFRESH_LANES):
            part = so_far[:, at : at + REFRESH_LANES]
            n = part.shape[1]
            seen = (part + np.arange(n) * size).reshape(-1)
            counts = np.bincount(seen, minlength=n * size).reshape(n, size)
            self._set(slice(at, at + n), np.cumsum(counts * self.learn + self.prior, axis=1))
        self._sample()

    def find(self, value: np.ndarray) -> np.ndarray:
        """The place in ``flat`` of the last sum that is not above ``value``, for each lane."""
        at = np.arange(len(value))
        wide = value[:, None]
        for rows in self.levels:
            upto = (rows.take(at, axis=0).view(np.uint16) <= wide).view(np.uint64)
            # Each comparison is a byte of 0 or 1: the product's top byte is their number.
            among = ((upto[:, 0] + upto[:, 1]) * BYTE_SUM >> TOP_BYTE).view(np.int64)
            at = at * 16 + (among - 1)
        return at


def prior_counts(frequencies: np.ndarray) -> np.ndarray:
    """Counts that a block starts from: 1 and a share of what is left of ``PRIOR``."""
    spare = max(0, PRIOR - len(frequencies))
    whole = max(1, int(frequencies.sum()))
    return 1 + frequencies.astype(np.int64) * spare // whole


class Model:
    """The state of all lanes of a group."""

    def __init__(self, lanes: int, prior: np.ndarray):
        self.one, self.two, self.zero = Contexts(lanes), Contexts(lanes), Counts(lanes, prior)
        self.state = np.full(lanes, WEIGHTS // 2, np.int32)
        self.last = np.zeros(lanes, np.int32)
        self.before = np.zeros(lanes, np.int32)

    def predict(self, n: int) -> None:
        """Ids foretold by both orders, and where their shares of ONE end."""
        last, before = self.last[:n], self.before[:n]
        self.a, trust_a = self.one.predict(n, last * 0x9E5)
        self.b, trust_b = self.two.predict(n, last * 0x2F3 + before * 0x6D1)
        state = self.state[:n]
        share_a = trust_a * (WEIGHTS - state) >> 5
        self.to_a = share_a + (trust_b * state >> 5)
        self.to_b = self.to_a - share_a * (self.a != self.b)

    def learn(self, ids: np.ndarray, hit_a: np.ndarray, hit_b: np.ndarray) -> None:
        n = len(ids)
        shifted = ids << 4
        self.one.learn(hit_a, shifted)
        self.two.learn(hit_b, shifted)
        drift = hit_b.view(np.int8) - hit_a.view(np.int8)
        self.state[:n] = np.minimum(np.maximum(self.state[:n] + drift, 1), WEIGHTS - 1)
        self.before[:n] = self.last[:n]
        self.last[:n] = ids

    def interval(self, hit_a: np.ndarray, hit_b: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, ...]:
        """Start and size of the share of order 2, of order 1, or of what both leave."""
        between = self.to_a - self.to_b
        start = (self.to_b + between * other) * ~hit_b
        size = self.to_b * hit_b + between * (hit_a & ~hit_b) + (ONE - self.to_a) * other
        return start.astype(np.uint64), size.astype(np.uint64)


def _lane_groups(blocks: int, distinct: int) -> list[tuple[int, int]]:
    per_lane = 16 ** max(1, math.ceil(math.log(distinct + 1, 16))) * 5 // 2 + SLOTS * 8 + BLOCK * 10
    size = max(1, min(GROUP_LANES, GROUP_BYTES // per_lane))
    return [(at, min(blocks, at + size)) for at in range(0, blocks, size)]


def encode(symbols: np.ndarray, prior: np.ndarray) -> list[bytes]:
    """A payload per block. ``prior``: frequencies, one for each symbol there may be."""
    payloads: list[bytes] = []
    for first, last in _lane_groups(-(-len(symbols) // BLOCK), len(prior)):
        payloads += _encode_group(symbols[first * BLOCK : last * BLOCK], last - first, prior)
    return payloads


def _encode_group(symbols: np.ndarray, lanes: int, prior: np.ndarray) -> list[bytes]:
    steps, rest = min(BLOCK, len(symbols)), len(symbols) - (lanes - 1) * BLOCK
    padded = np.zeros(lanes * steps, np.int32)
    padded[: len(symbols)] = symbols
    by_step = np.ascontiguousarray(padded.reshape(lanes, steps).T)
    model, coder = Model(lanes, prior), Encoder(lanes)
    zero = model.zero
    for step in range(steps):
        n = lanes if step < rest else lanes - 1
        if step % 64 == 0:
            coder.reserve(128)
        if step in REFRESH:
            zero.refresh(by_step[:step])
        ids = by_step[step, :n]
        model.predict(n)
        hit_a, hit_b = ids == model.a, ids == model.b
        other = ~(hit_a | hit_b)
        coder.put(coder.range[:n] >> U16, *model.interval(hit_a, hit_b, other))
        # Lanes that are done code all of order 0's range, which costs nothing.
        at = zero.first[:n] + ids
        total = zero.total[:n]
        start = zero.flat.take(at).astype(np.uint64)
        size = zero.flat.take(at + 1).astype(np.uint64) - start
        size += (total - size) * ~other
        coder.put(coder.range[:n] // total, start * other, size)
        model.learn(ids, hit_a, hit_b)
    return coder.finish()


def decode(payloads: list[bytes], length: int, prior: np.ndarray) -> np.ndarray:
    """The symbols of consecutive blocks that hold ``length`` of them."""
    parts = [np.zeros(0, np.int32)]
    for first, last in _lane_groups(len(payloads), len(prior)):
        held = min(length, last * BLOCK) - first * BLOCK
        parts.append(_decode_group(payloads[first:last], held, prior))
    return np.concatenate(parts)


def _decode_group(payloads: list[bytes], length: int, prior: np.ndarray) -> np.ndarray:
    lanes = len(payloads)
    steps, rest = min(BLOCK, length), length - (lanes - 1) * BLOCK
    found = np.zeros((steps, lanes), np.int32)
    model, coder = Model(lanes, prior), Decoder(payloads)
    zero = model.zero
    for step in range(steps):
        n = lanes if step < rest else lanes - 1
        if step in REFRESH:
            zero.refresh(found[:step])
        model.predict(n)
        unit = coder.range[:n] >> U16
        value = coder.code[:n] // unit
        in_b, known = value < model.to_b, value < model.to_a
        other = ~known
        coder.take(unit, *model.interval(known & ~in_b, in_b, other))
        total = zero.total[:n]
        unit = coder.range[:n] // total
        value = np.minimum(coder.code[:n] // unit, total - np.uint64(1))
        at = zero.find(value.astype(np.uint16))
        start = zero.flat.take(at).astype(np.uint64)
        size = zero.flat.take(at + 1).astype(np.uint64) - start
        size += (total - size) * ~other
        coder.take(unit, start * other, size)
        foretold = model.a + (model.b - model.a) * in_b
        ids = foretold + ((at - zero.first[:n]).astype(np.int32) - foretold) * other
        found[step, :n] = ids
        model.learn(ids, ids == model.a, ids == model.b)
    return found.T.reshape(-1)[:length]
