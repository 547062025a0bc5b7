"""An adaptive context-mixing range coder for token ids, in independent, checksummed blocks.

Three predictions of the next id are mixed: the id that last followed the last two ids (order 2), the one that last
followed the last id (order 1), and the ids' frequencies so far (order 0). Each order-1 and order-2 prediction carries
a confidence, and how often predictions of a confidence came true gives their weights; the mixed distribution drives
one step of a carry-less range coder. Every block of up to ``TOKENS`` ids starts from nothing, so it can be read
alone, and many blocks are coded side by side, one lane of an array each.

A block is: magic, number of ids, of distinct ids, of bytes that list the distinct ids, of 16-bit code words (each
32-bit, little-endian), the list, the words, and the crc32 of the ids (as little-endian 32-bit numbers) and of all
bytes before it.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

TOKENS, LANES = 8192, 1024
_MAGIC, _HEAD = b"IDC1", struct.Struct("<4sIIII")
_SLOTS, _PARTS, _GAIN = 4096, 4096, 16  # order-2 contexts, parts of the mixed distribution, what an occurrence counts
_TOP, _LOW = np.uint64(1 << 48), np.uint64(1 << 32)
_WORD, _SHIFT = np.uint64(16), np.uint64(48)


def _listed(ids: np.ndarray) -> bytes:
    """Rising ids as differences: one byte, or 255 and four bytes."""
    steps = np.diff(ids.astype(np.int64), prepend=-1)
    if (steps < 255).all():
        return steps.astype(np.uint8).tobytes()
    return b"".join(bytes([s]) if s < 255 else b"\xff" + struct.pack("<I", s) for s in steps.tolist())


def _unlisted(raw: bytes, n: int) -> np.ndarray:
    if len(raw) == n:
        return np.cumsum(np.frombuffer(raw, dtype=np.uint8).astype(np.int64)) - 1
    steps, at = [], 0
    for _ in range(n):
        if raw[at] < 255:
            steps.append(raw[at])
            at += 1
        else:
            steps.append(struct.unpack_from("<I", raw, at + 1)[0])
            at += 5
    return np.cumsum(np.array(steps, dtype=np.int64)) - 1


class _Model:
    """The predictions of all lanes; lanes are in falling order of length, so those still running come first."""

    def __init__(self, lanes: int, symbols: np.ndarray):
        self.width = width = int(symbols.max()) + 1
        self.symbols = symbols
        lane = np.arange(lanes, dtype=np.int64)
        self.at1, self.at2, self.at_weight, self.at_sum = lane * width, lane * _SLOTS, lane * 4, lane * (width + 1)
        self.next1, self.sure1 = np.zeros(lanes * width, dtype=np.uint16), np.zeros(lanes * width, dtype=np.uint8)
        self.next2, self.sure2 = np.zeros(lanes * _SLOTS, dtype=np.uint16), np.zeros(lanes * _SLOTS, dtype=np.uint8)
        self.weight1 = np.tile(np.array([64, 600, 1600, 2600], dtype=np.int32), lanes)
        self.weight2 = np.tile(np.array([64, 1200, 2400, 3200], dtype=np.int32), lanes)
        self.last, self.before = np.zeros(lanes, dtype=np.int64), np.zeros(lanes, dtype=np.int64)
        self.counts = (np.arange(width)[None, :] < symbols[:, None]).astype(np.int32)
        self.renew = 0
        self._sum_up(lanes, 0)

    def _sum_up(self, n: int, step: int) -> None:
        """Order-0 frequencies are taken over at rarer and rarer steps."""
        if step == 0:
            self.sums = np.zeros((len(self.counts), self.width + 1), dtype=np.int64)
        np.cumsum(self.counts[:n], axis=1, out=self.sums[:n, 1:])
        self.total = self.sums[:, -1].copy()
        self.flat = self.sums.ravel()
        self.renew = min(max(16, 2 * step), step + 512)

    def predict(self, n: int, step: int) -> None:
        if step == self.renew:
            self._sum_up(n, step)
        self.i1 = self.at1[:n] + self.last[:n]
        self.i2 = self.at2[:n] + ((self.before[:n] * 40503 + self.last[:n] * 2654435761 >> 7) & (_SLOTS - 1))
        self.c1, self.c2 = self.next1[self.i1], self.next2[self.i2]
        self.k1, self.k2 = self.sure1[self.i1], self.sure2[self.i2]
        self.j1, self.j2 = self.at_weight[:n] + self.k1, self.at_weight[:n] + self.k2
        self.w1, self.w2 = self.weight1[self.j1], self.weight2[self.j2]
        self.f2 = self.w2.astype(np.int64)
        f1 = (_PARTS - self.f2) * self.w1 >> 12
        f1[self.c1 == self.c2] = 0
        self.rest = self.f2 + f1
        self.f0 = _PARTS - self.rest

    def update(self, n: int, x: np.ndarray, hit1: np.ndarray, hit2: np.ndarray) -> None:
        w2 = self.w2 + ((hit2 * _PARTS - self.w2) >> 5)
        self.weight2[self.j2] = np.clip(w2, 32, 3968)
        w1 = np.where(hit2, self.w1, self.w1 + ((hit1 * _PARTS - self.w1) >> 5))
        self.weight1[self.j1] = np.clip(w1, 32, 3968)
        for i, c, k, following, sure in ((self.i1, self.c1, self.k1, self.next1, self.sure1), (self.i2, self.c2, self.k2, self.next2, self.sure2)):
            same = x == c
            following[i] = np.where(same | (k > 0), c, x)
            sure[i] = np.where(same, np.minimum(k + 1, 3), np.maximum(k, 1) - 1)
        self.counts.ravel()[self.at1[:n] + x] += _GAIN
        self.before[:n] = self.last[:n]
        self.last[:n] = x


def _ordered(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lanes in falling order of length, and how many of them are longer than each step."""
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max(initial=0))
    return order, len(lengths) - np.cumsum(np.bincount(lengths, minlength=longest + 1))[:longest]


def _encode(blocks: list[np.ndarray]) -> list[bytes]:
    alphabets, codes = zip(*(np.unique(b, return_inverse=True) for b in blocks), strict=True)
    lengths = np.array([len(b) for b in blocks])
    order, running = _ordered(lengths)
    lanes = len(blocks)
    symbols = np.zeros((len(running), lanes), dtype=np.int64)
    for lane, i in enumerate(order):
        symbols[: lengths[i], lane] = codes[i]
    model = _Model(lanes, np.array([max(len(alphabets[i]), 1) for i in order]))
    low, span = np.zeros(lanes, dtype=np.uint64), np.full(lanes, (1 << 64) - 1, dtype=np.uint64)
    out, used = np.zeros((lanes, 2 * len(running) + 8), dtype="<u2"), np.zeros(lanes, dtype=np.int64)
    for step, n in enumerate(running.tolist()):
        x = symbols[step, :n]
        model.predict(n, step)
        hit2 = x == model.c2
        hit1 = (x == model.c1) & ~hit2
        total = model.total[:n]
        at = model.at_sum[:n] + x
        below, above = model.flat[at], model.flat[at + 1]
        start = np.where(hit2, 0, np.where(hit1, model.f2 * total, model.rest * total + model.f0 * below))
        size = np.where(hit2, model.f2 * total, np.where(hit1, (model.rest - model.f2) * total, model.f0 * (above - below)))
        part = span[:n] // (total * _PARTS).astype(np.uint64)
        low[:n] += part * start.astype(np.uint64)
        span[:n] = part * size.astype(np.uint64)
        model.update(n, x, hit1, hit2)
        while True:
            settled = (low[:n] ^ (low[:n] + span[:n])) < _TOP
            lanes_out = np.flatnonzero(settled | (span[:n] < _LOW))
            if not len(lanes_out):
                break
            short = lanes_out[~settled[lanes_out]]
            span[short] = (np.uint64(0) - low[short]) & (_LOW - np.uint64(1))
            out[lanes_out, used[lanes_out]] = low[lanes_out] >> _SHIFT
            used[lanes_out] += 1
            low[lanes_out] <<= _WORD
            span[lanes_out] <<= _WORD
    results: list[bytes] = [b""] * lanes
    for lane, i in enumerate(order):
        words = out[lane, : used[lane]].tobytes() + b"".join(struct.pack("<H", int(low[lane]) >> s & 0xFFFF) for s in (48, 32, 16, 0))
        listed = _listed(alphabets[i])
        body = _HEAD.pack(_MAGIC, lengths[i], len(alphabets[i]), len(listed), len(words) // 2) + listed + words
        body += struct.pack("<I", zlib.crc32(blocks[i].astype("<u4").tobytes()))
        results[i] = body + struct.pack("<I", zlib.crc32(body))
    return results


def _decode(blocks: list[bytes]) -> list[np.ndarray]:
    heads, alphabets, words = [], [], []
    for raw in blocks:
        if len(raw) < _HEAD.size + 8 or zlib.crc32(raw[:-4]) != struct.unpack("<I", raw[-4:])[0] or raw[:4] != _MAGIC:
            raise ValueError("a block of ids is damaged")
        _, n, distinct, listed, count = _HEAD.unpack_from(raw)
        heads.append(n)
        alphabets.append(_unlisted(raw[_HEAD.size : _HEAD.size + listed], distinct))
        words.append(np.frombuffer(raw, dtype="<u2", count=count, offset=_HEAD.size + listed))
    lengths = np.array(heads)
    order, running = _ordered(lengths)
    lanes = len(blocks)
    model = _Model(lanes, np.array([max(len(alphabets[i]), 1) for i in order]))
    code = np.zeros((lanes, max(len(w) for w in words) + 4), dtype=np.uint64)
    for lane, i in enumerate(order):
        code[lane, : len(words[i])] = words[i]
    value, used = np.zeros(lanes, dtype=np.uint64), np.full(lanes, 4, dtype=np.int64)
    for k in range(4):
        value = value << _WORD | code[:, k]
    low, span = np.zeros(lanes, dtype=np.uint64), np.full(lanes, (1 << 64) - 1, dtype=np.uint64)
    symbols = np.zeros((len(running), lanes), dtype=np.int64)
    far = np.int64(1 << 40)  # keeps the sums of the lanes apart in one rising array
    apart = np.arange(lanes, dtype=np.int64) * far
    searched, rising = -1, np.empty(0, dtype=np.int64)
    for step, n in enumerate(running.tolist()):
        model.predict(n, step)
        if searched != model.renew:
            searched, rising = model.renew, (model.sums[:, :-1] + apart[:, None]).ravel()
        total = model.total[:n]
        part = span[:n] // (total * _PARTS).astype(np.uint64)
        place = np.minimum(((value[:n] - low[:n]) // part).astype(np.int64), total * _PARTS - 1)
        border = model.rest * total
        hit2 = place < model.f2 * total
        hit1 = (place < border) & ~hit2
        frequent = np.minimum(np.maximum(place - border, 0) // model.f0, total - 1)
        # sums of symbols beyond a lane's own alphabet all equal its total, which no place reaches
        found = np.searchsorted(rising, frequent + apart[:n], side="right") - 1 - model.at1[:n]
        x = np.where(hit2, model.c2, np.where(hit1, model.c1, found))
        at = model.at_sum[:n] + x
        below, above = model.flat[at], model.flat[at + 1]
        start = np.where(hit2, 0, np.where(hit1, model.f2 * total, border + model.f0 * below))
        size = np.where(hit2, model.f2 * total, np.where(hit1, border - model.f2 * total, model.f0 * (above - below)))
        low[:n] += part * start.astype(np.uint64)
        span[:n] = part * size.astype(np.uint64)
        # as the encoder had it: an id that a prediction names is never coded by its frequency
        model.update(n, x, hit1, hit2)
        symbols[step, :n] = x
        while True:
            settled = (low[:n] ^ (low[:n] + span[:n])) < _TOP
            lanes_in = np.flatnonzero(settled | (span[:n] < _LOW))
            if not len(lanes_in):
                break
            short = lanes_in[~settled[lanes_in]]
            span[short] = (np.uint64(0) - low[short]) & (_LOW - np.uint64(1))
            value[lanes_in] = value[lanes_in] << _WORD | code[lanes_in, used[lanes_in]]
            used[lanes_in] += 1
            low[lanes_in] <<= _WORD
            span[lanes_in] <<= _WORD
    results: list[np.ndarray] = [np.empty(0, dtype=np.uint32)] * lanes
    for lane, i in enumerate(order):
        ids = alphabets[i][symbols[: lengths[i], lane]].astype("<u4")
        if zlib.crc32(ids.tobytes()) != struct.unpack("<I", blocks[i][-8:-4])[0]:
            raise ValueError("a block of ids does not decode to what was encoded")
        results[i] = ids
    return results


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Each array of at most ``TOKENS`` ids as one block."""
    return [raw for at in range(0, len(blocks), LANES) for raw in _encode(blocks[at : at + LANES])]


def decode(blocks: list[bytes]) -> list[np.ndarray]:
    """The ids of each block; raises ValueError if one is damaged."""
    return [ids for at in range(0, len(blocks), LANES) for ids in _decode(blocks[at : at + LANES])]
