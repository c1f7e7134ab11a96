"""Adaptive context-mixing range coder for token ids.

A block holds up to ``BLOCK_IDS`` ids. They are laid out in ``LANES`` runs
that are coded side by side, one 64-bit range coder each, so that a step of
the coder works on one id of every lane at once. A step's interval mixes three
predictions of the next id:

* order 2 and order 1: the id that last followed the hashed context; what it
  weighs depends on how often such a prediction, of that confidence, was right;
* order 0: counts of all ids so far, in any case at least 1.

The model starts empty in every block and learns all lanes' ids after rounds of
growing length, so blocks decode independently. The file format of a block:

    magic 'CMR1', symbols, ids, lanes, crc32 of the ids, crc32 of the body (uint32 each),
    body: words per lane (uint32 each), then each lane's 32-bit words

Everything is little-endian. Numpy only; Spark is in ``idfiles``.
"""

from __future__ import annotations

import zlib

import numpy as np

MAGIC = b"CMR1"
BLOCK_IDS = 1 << 20
LANES = 4096
#: Intervals are shares of 2 ** SCALE; order 0 deals in about 2 ** SCALE_0. An order
#: above 0 weighs at most 1 - 2 ** -CAP, so order 0 keeps more than its own scale.
SCALE, SCALE_0, CAP = 31, 21, 4
#: Slots of the hashed contexts.
SLOTS = 1 << 18
#: Steps between updates of the model: 1, 1, 2, 4, ... up to this.
LONGEST_ROUND = 32
CONFIDENCE = 4

U = np.uint64
_TOP, _LOW = U(32), U(0xFFFFFFFF)


class Model:
    """What a block has taught so far."""

    def __init__(self, n_symbols: int):
        self.n = n_symbols
        self.counts = np.zeros(n_symbols, np.int64)
        self.next = [np.full(SLOTS, -CONFIDENCE, np.int32) for _ in range(2)]  # id * CONFIDENCE + confidence
        self.right = np.ones((2, CONFIDENCE), np.int64)
        self.seen = np.full((2, CONFIDENCE), 2, np.int64)
        self.refresh()

    @staticmethod
    def slots(one: np.ndarray, two: np.ndarray) -> list[np.ndarray]:
        """Context slots after the ids ``one`` (last) and ``two`` (before it)."""
        a = one.astype(U) + U(1)
        b = two.astype(U) + U(1)
        first = (a * U(0x9E3779B97F4A7C15)) >> U(46)
        second = ((a * U(0xC2B2AE3D27D4EB4F) ^ b * U(0x9E3779B97F4A7C15)) * U(0xFF51AFD7ED558CCD)) >> U(46)
        return [first.astype(np.int64), second.astype(np.int64)]

    def refresh(self):
        """Order-0 cumulative shares and the weights of the other orders."""
        share = self.counts * max((1 << SCALE_0) // max(int(self.counts.sum()), 1), 1) + 1
        self.cum = np.concatenate([[0], np.cumsum(share)]).astype(np.uint32)
        self.total = U(self.cum[-1])
        self.weight = np.minimum(self.right * (1 << 16) // self.seen, (1 << 16) - (1 << (16 - CAP))).astype(U)

    def holder(self) -> np.ndarray:
        """The id that each point of the order-0 scale belongs to."""
        return np.repeat(np.arange(self.n, dtype=np.int32), np.diff(self.cum))

    def predict(self, one, two):
        """For order 2, then 1: predicted ids (-1: none) and their shares of the
        interval; then what each order-0 share is worth in the rest."""
        slot = self.slots(one, two)
        guess, share = [], []
        left = np.full(len(one), 1 << SCALE, U)
        for order in (1, 0):
            both = self.next[order][slot[order]]
            g = both >> 2
            w = (left >> U(16)) * self.weight[order][both & 3]
            w *= g >= 0
            guess.append(g)
            share.append(w)
            left = left - w
        return guess, share, quotient(left, self.total)

    def learn(self, ids: np.ndarray, one: np.ndarray, two: np.ndarray):
        self.counts += np.bincount(ids, minlength=self.n)
        slot = self.slots(one, two)
        for order in (1, 0):
            s = slot[order]
            g, conf = self.next[order][s] >> 2, self.next[order][s] & 3
            known = g >= 0
            hit = known & (g == ids)
            self.right[order] += np.bincount(conf[hit], minlength=CONFIDENCE)
            self.seen[order] += np.bincount(conf[known], minlength=CONFIDENCE)
            self.next[order][s] = ids * CONFIDENCE + np.where(hit, np.minimum(conf + 1, CONFIDENCE - 1), 0)
        self.refresh()


def rounds(steps: int):
    """(first step, last step + 1) of each round."""
    at, size = 0, 1
    while at < steps:
        yield at, min(at + size, steps)
        at += size
        size = min(max(at, 1), LONGEST_ROUND)


def quotient(a: np.ndarray, b) -> np.ndarray:
    """a // b for whole numbers below 2 ** 32: doubles hold the quotient well
    enough that rounding never reaches the next whole number."""
    return (a.astype(np.float64) / b).astype(U)


def split(model: Model, guess, share, unit, ids):
    """Begin and width of the ids' intervals. The rest of an interval is dealt
    out in proportion to the order-0 shares; what rounding leaves goes unused."""
    low = model.cum[ids]
    begin = share[0] + share[1] + low * unit
    width = (model.cum[ids + 1] - low) * unit
    hit = np.flatnonzero(guess[1] == ids)
    begin[hit], width[hit] = share[0][hit], share[1][hit]
    hit = np.flatnonzero(guess[0] == ids)
    begin[hit], width[hit] = U(0), share[0][hit]
    return begin, width


def narrowed(low, size, begin, width):
    unit = size >> U(SCALE)
    return low + begin * unit, width * unit


def settle(low, size):
    """Lanes whose upper word is fixed, or made so because the range got small."""
    fixed = (low ^ (low + size)) >> _TOP == 0
    short = ~fixed & (size <= _LOW)
    size[short] = (U(0) - low[short]) & _LOW
    return np.flatnonzero(fixed | short)


def layout(n: int, lanes: int) -> int:
    return -(-n // lanes)


def encode_block(ids: np.ndarray, n_symbols: int, lanes: int = LANES) -> bytes:
    n = len(ids)
    lanes = max(1, min(lanes, n // 64))
    steps = layout(n, lanes)
    grid = np.zeros(steps * lanes, np.int64)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    before = np.vstack([np.full((2, lanes), -1), grid])
    model = Model(n_symbols)
    low, size = np.zeros(lanes, U), np.full(lanes, (1 << 64) - 1, U)
    out, used = np.zeros((steps + 1, lanes), np.uint32), np.zeros(lanes, np.int64)
    for a, b in rounds(steps):
        one, two, now = before[a + 1:b + 1].ravel(), before[a:b].ravel(), grid[a:b].ravel()
        begin, width = split(model, *model.predict(one, two), now)
        for step, (bg, wd) in enumerate(zip(begin.reshape(b - a, lanes), width.reshape(b - a, lanes), strict=True)):
            low, size = narrowed(low, size, bg, wd)
            done = settle(low, size)
            if len(done):
                out[used[done], done] = (low[done] >> _TOP).astype(np.uint32)
                used[done] += 1
                low[done] <<= _TOP
                size[done] <<= _TOP
        model.learn(now, one, two)
    out[used, np.arange(lanes)] = ((low + _LOW) >> _TOP).astype(np.uint32)  # the first word-aligned number in the range
    used += 1
    body = used.astype("<u4").tobytes() + out.T[np.arange(steps + 1) < used[:, None]].astype("<u4").tobytes()
    head = np.array([n_symbols, n, lanes, zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body)], "<u4").tobytes()
    return MAGIC + head + body


def decode_block(blob: bytes) -> np.ndarray:
    if blob[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    n_symbols, n, lanes, ids_crc, body_crc = (int(x) for x in np.frombuffer(blob, "<u4", 5, 4))
    body = blob[24:]
    if zlib.crc32(body) != body_crc:
        raise ValueError("a block of token ids is damaged")
    used = np.frombuffer(body, "<u4", lanes).astype(np.int64)
    words = np.append(np.frombuffer(body, "<u4", offset=4 * lanes), np.zeros(2, "<u4")).astype(U)
    at = np.cumsum(used) - used
    stop = at + used
    steps = layout(n, lanes)

    def fetch(which):
        w = np.where(at[which] < stop[which], words[np.minimum(at[which], len(words) - 1)], U(0))
        at[which] += 1
        return w

    every = np.arange(lanes)
    code = fetch(every) << _TOP
    code |= fetch(every)
    model = Model(n_symbols)
    low, size = np.zeros(lanes, U), np.full(lanes, (1 << 64) - 1, U)
    before = np.full((steps + 2, lanes), -1, np.int64)
    for a, b in rounds(steps):
        holder = model.holder()
        for step in range(a, b):
            guess, share, unit = model.predict(before[step + 1], before[step])
            target = np.minimum((code - low) // (size >> U(SCALE)), U((1 << SCALE) - 1))
            upto = share[0] + share[1]
            rest = quotient(target - np.minimum(upto, target), unit)
            ids = holder[np.minimum(rest, model.total - U(1)).astype(np.int64)]
            under = model.cum[ids]
            begin, width = upto + under * unit, (model.cum[ids + 1] - under) * unit
            hit = np.flatnonzero(target < upto)
            first = target[hit] < share[0][hit]
            ids[hit] = np.where(first, guess[0][hit], guess[1][hit])
            begin[hit], width[hit] = np.where(first, U(0), share[0][hit]), np.where(first, share[0][hit], share[1][hit])
            before[step + 2] = ids
            low, size = narrowed(low, size, begin, width)
            done = settle(low, size)
            if len(done):
                low[done] <<= _TOP
                size[done] <<= _TOP
                code[done] = (code[done] << _TOP) | fetch(done)
        model.learn(before[a + 2:b + 2].ravel(), before[a + 1:b + 1].ravel(), before[a:b].ravel())
    ids = np.ascontiguousarray(before[2:].T).ravel()[:n]
    if zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
        raise ValueError("a block of token ids does not match its checksum")
    return ids
