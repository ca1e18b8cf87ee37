"""Adaptive context-mixing range coder for 16-bit ids, many blocks in lockstep.

Every block starts from the same reset model and is a closed code string, so
blocks decode in any order. One NumPy lane per block: step t codes the t-th id
of every block.

Model of an id after (p2, p1). The order-2 and order-1 tables each propose the
id that last followed their context, with a small confidence. The event "the
proposal is right" is predicted three times (by the order-2 confidence, by the
order-1 confidence and agreement, and by the order-0 hit rate); the three
probabilities are mixed with weights that move toward the predictors that were
right. A miss is coded by the order-0 distribution: an adaptive frequency of
the id's magnitude class, then its remaining bits. All arithmetic is on
integers, so encoder and decoder agree on every machine.

The range coder keeps a 60-bit window and emits 12-bit words once they are
settled; an interval too small to go on is cut at the word boundary instead of
carrying.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK_IDS = 2048
ORDER2, ORDER1 = 1 << 9, 1 << 8
CLASSES = 17
REFRESH = 32
WORD, TOP, BOT = 12, 48, 1 << 40
LOW_MASK = (1 << TOP) - 1

_IDS = np.arange(1 << 16)
#: class of an id: bit length of id + 1, less one; so many bits remain
CLASS = (np.frexp(_IDS + 1.0)[1] - 1).astype(np.int64)
FIRST = (1 << np.arange(CLASSES, dtype=np.int64)) - 1


class Model:
    """Tables of ``n`` lanes; ``step`` works on lanes [0, a)."""

    def __init__(self, n: int):
        self.n, self.lane = n, np.arange(n)
        self.base2, self.base1 = self.lane * ORDER2, self.lane * ORDER1
        self.lane4, self.lane8 = self.lane * 4, self.lane * 8
        self.t2, self.t1 = np.zeros(n * ORDER2, np.int32), np.zeros(n * ORDER1, np.int32)
        self.by2, self.by1, self.by0 = np.full(n * 4, 1024, np.int32), np.full(n * 8, 1024, np.int32), np.full(n, 512, np.int32)
        self.w2, self.w1 = np.full(n, 21845, np.int32), np.full(n, 21845, np.int32)
        self.hist = np.ones(CLASSES * n, np.int32)
        self.cum = np.zeros((CLASSES + 1, n), np.int32)
        self.flat = self.cum.ravel()
        self.p1, self.p2 = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.refresh()

    def refresh(self) -> None:
        """Class frequencies out of 4096 from the counts so far, each at least 1."""
        seen = np.cumsum(self.hist.reshape(CLASSES, self.n), axis=0, dtype=np.int32)
        self.cum[1:] = np.arange(1, CLASSES + 1, dtype=np.int32)[:, None] + (seen * ((4096 - CLASSES) / seen[-1])).astype(np.int32)
        self.cum[-1] = 4096

    def propose(self, a: int) -> tuple[np.ndarray, np.ndarray]:
        """(proposed id, probability of 1..4095 that it is right) of lanes [0, a)."""
        h1 = self.p1[:a] * 40503
        self.i2 = ((h1 + self.p2[:a] * 30011) >> 5 & (ORDER2 - 1)) + self.base2[:a]
        self.i1 = (h1 >> 7 & (ORDER1 - 1)) + self.base1[:a]
        e2, e1 = self.t2[self.i2], self.t1[self.i1]
        self.c2, self.n2, self.c1, self.n1 = e2 & 0xFFFF, e2 >> 16, e1 & 0xFFFF, e1 >> 16
        self.x2 = self.lane4[:a] + self.n2
        self.x1 = self.lane8[:a] + (self.n1 * 2 + (self.c1 == self.c2))
        self.q2, self.q1, self.q0 = self.by2[self.x2], self.by1[self.x1], self.by0[:a]
        w2, w1 = self.w2[:a], self.w1[:a]
        p = (w2 * self.q2 + w1 * self.q1 + (65536 - w2 - w1) * self.q0) >> 16
        self.p = np.minimum(np.maximum(p, 1), 4095)
        return np.where(self.n2 > 0, self.c2, self.c1), self.p

    def learn(self, a: int, ids: np.ndarray, cls: np.ndarray, hit: np.ndarray) -> None:
        goal = hit * np.int32(4096)
        right = np.where(hit, np.int32(1), np.int32(-1))
        for w, q in ((self.w2[:a], self.q2), (self.w1[:a], self.q1)):
            w += right * (q - self.p) >> 2
            np.minimum(np.maximum(w, 512, out=w), 31000, out=w)
        self.by2[self.x2] = self.q2 + ((goal - self.q2) >> 4)
        self.by1[self.x1] = self.q1 + ((goal - self.q1) >> 4)
        self.by0[:a] += (goal - self.q0) >> 5
        at = cls * self.n + self.lane[:a]
        self.hist[at] += ~hit
        ids = ids.astype(np.int32)
        for table, at, c, n in ((self.t2, self.i2, self.c2, self.n2), (self.t1, self.i1, self.c1, self.n1)):
            same = c == ids
            table[at] = np.where(same, c + (np.minimum(n + 1, 3) << 16), np.where(n > 0, c + ((n - 1) << 16), ids + 65536))
        self.p2[:a] = self.p1[:a]
        self.p1[:a] = ids


def _order(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lanes by falling length, and how many are active at each step."""
    order = np.argsort(-lengths, kind="stable")
    steps = int(lengths.max(initial=0))
    return order, np.searchsorted(-lengths[order], -np.arange(steps), "left")


def _unsettled(low: np.ndarray, rng: np.ndarray) -> np.ndarray:
    """Lanes whose next word is settled, or whose interval has become too small to go on."""
    return np.flatnonzero((low ^ (low + rng - 1) < 1 << TOP) | (rng < BOT))


def _cut(low: np.ndarray, rng: np.ndarray) -> np.ndarray:
    """The interval within its word (shorter only where it is cut at the word's end)."""
    return np.minimum(rng, (1 << TOP) - (low & LOW_MASK))


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Code string of each block of ids below 2**16."""
    lengths = np.array([len(b) for b in blocks], np.int64)
    n = len(blocks)
    order, active = _order(lengths)
    ids = np.zeros((int(lengths.max(initial=0)), n), np.uint16)
    for lane, k in enumerate(order):
        ids[: lengths[k], lane] = blocks[k]
    model = Model(n)
    low, rng = np.zeros(n, np.int64), np.full(n, 1 << (TOP + WORD), np.int64)
    room = int(lengths.max(initial=0) * 4 + 16)
    words = np.zeros(n * room, np.uint16)
    filled = np.arange(n) * room
    for t, a in enumerate(active):
        if t and t % REFRESH == 0:
            model.refresh()
        x = ids[t, :a].astype(np.int64)
        proposed, p = model.propose(a)
        hit = proposed == x
        lo, ra = low[:a], rng[:a]
        yes = (ra >> 12) * p
        no = ra - yes
        cls = CLASS[x]
        at = cls * n + model.lane[:a]
        c0 = model.flat[at]
        part = no >> 12
        rest = (part * (model.flat[at + n] - c0)) >> cls
        lo = np.where(hit, lo, lo + yes + part * c0 + rest * (x - FIRST[cls]))
        ra = np.where(hit, yes, rest)
        model.learn(a, x, cls, hit)
        at = _unsettled(lo, ra)
        while len(at):
            l = lo[at]
            g = _cut(l, ra[at]) << WORD
            words[filled[at]] = l >> TOP
            filled[at] += 1
            l = (l & LOW_MASK) << WORD
            lo[at], ra[at] = l, g
            at = at[_unsettled(l, g)]
        low[:a], rng[:a] = lo, ra
    out: list[bytes] = [b""] * n
    for lane, k in enumerate(order):
        tail = [(int(low[lane]) >> s) & 0xFFF for s in (48, 36, 24, 12, 0)]
        out[k] = _pack(np.concatenate([words[lane * room : filled[lane]], np.array(tail, np.uint16)]))
    return out


def _pack(words: np.ndarray) -> bytes:
    """Two 12-bit words in three bytes."""
    w = np.concatenate([words, np.zeros(len(words) % 2, np.uint16)]).reshape(-1, 2).astype(np.uint16)
    b = np.stack([w[:, 0] >> 4, ((w[:, 0] & 15) << 4) | (w[:, 1] >> 8), w[:, 1] & 255], axis=1)
    return b.astype(np.uint8).tobytes()


def _unpack(code: bytes) -> np.ndarray:
    b = np.frombuffer(code, np.uint8).reshape(-1, 3).astype(np.int64)
    return np.stack([(b[:, 0] << 4) | (b[:, 1] >> 4), ((b[:, 1] & 15) << 8) | b[:, 2]], axis=1).ravel()


def decode_blocks(codes: list[bytes], lengths: np.ndarray) -> list[np.ndarray]:
    """The ids of each block."""
    lengths = np.asarray(lengths, np.int64)
    n = len(codes)
    order, active = _order(lengths)
    parts = [_unpack(codes[k]) for k in order]
    start = np.concatenate([[0], np.cumsum([len(w) + 8 for w in parts])]).astype(np.int64)
    words = np.zeros(int(start[-1]), np.int64)
    for s, w in zip(start, parts):
        words[s : s + len(w)] = w
    start = start[:-1].copy()
    code = np.zeros(n, np.int64)
    for k in range(5):
        code = (code << WORD) | words[start + k]
    start += 5
    model = Model(n)
    low, rng = np.zeros(n, np.int64), np.full(n, 1 << (TOP + WORD), np.int64)
    out = np.zeros((int(lengths.max(initial=0)), n), np.uint16)
    for t, a in enumerate(active):
        if t and t % REFRESH == 0:
            model.refresh()
        proposed, p = model.propose(a)
        lo, ra, co = low[:a], rng[:a], code[:a]
        yes = (ra >> 12) * p
        off = co - lo
        hit = off < yes
        off = np.where(hit, 0, off - yes)
        part = (ra - yes) >> 12
        slot = _floor_div(off, part).astype(np.int32)
        cls = np.zeros(a, np.int32)
        for k in range(1, CLASSES):
            cls += model.cum[k, :a] <= slot
        cls = cls.astype(np.int64)
        at = cls * n + model.lane[:a]
        c0 = model.flat[at]
        rest = (part * (model.flat[at + n] - c0)) >> cls
        off -= part * c0
        more = np.minimum(_floor_div(off, rest), FIRST[cls])
        x = np.where(hit, proposed, FIRST[cls] + more)
        lo = np.where(hit, lo, lo + yes + part * c0 + rest * more)
        ra = np.where(hit, yes, rest)
        out[t, :a] = x
        model.learn(a, x, cls, hit)
        at = _unsettled(lo, ra)
        while len(at):
            l = lo[at]
            g = _cut(l, ra[at]) << WORD
            co[at] = ((co[at] & LOW_MASK) << WORD) | words[start[at]]
            start[at] += 1
            l = (l & LOW_MASK) << WORD
            lo[at], ra[at] = l, g
            at = at[_unsettled(l, g)]
        low[:a], rng[:a] = lo, ra
    ids: list[np.ndarray] = [out[:0, 0]] * n if n else []
    for lane, k in enumerate(order):
        ids[k] = out[: lengths[k], lane]
    return ids


def _floor_div(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x // y for 0 <= x < 2**60 and quotients below 2**17: a rounded quotient, put right by at most one."""
    q = (x / y).astype(np.int64)
    r = x - q * y
    return q + (r >= y) - (r < 0)


def checksum(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
