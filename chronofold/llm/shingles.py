"""Word shingles of a batch of texts as 64-bit hashes, computed over the whole batch at once."""

from __future__ import annotations

import numpy as np

_MASK = (1 << 64) - 1
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (the finaliser of splitmix64)."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
#: Bytes whose words are hashed at once.
PIECE = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _piece_end(raw: np.ndarray, at: int) -> int:
    """Where a piece that begins at ``at`` ends: behind the first white space after ``PIECE`` bytes, or at the end."""
    for look in range(at + PIECE, len(raw), PIECE):
        space = _SPACE[raw[look : look + PIECE]]
        if space.any():
            return look + int(space.argmax()) + 1
    return len(raw)


def _words_of_piece(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    word = ~_SPACE[raw]
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return start, end, np.empty(0, dtype=np.uint64)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_LOWER[raw] * _powers(_MULTIPLIER, len(raw)), dtype=np.uint64, out=sums[1:])
    hashes = (sums[end] - sums[start]) * _powers(_INVERSE, len(raw))[start]
    return start, end, mixed(hashes + (end - start).astype(np.uint64))


def words_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word in UTF-8 bytes; A-Z count as a-z, white space is 0x20 and 0x09-0x0D.

    Long bytes are taken in pieces of whole words, so the memory for single bytes does not grow with them.
    """
    found, at = [], 0
    while at < len(raw) or not found:
        to = _piece_end(raw, at)
        start, end, hashes = _words_of_piece(raw[at:to])
        found.append((start + at, end + at, hashes))
        at = to
    start, end, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
    return start, end, hashes


def shingle_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``width`` words.

    A text of fewer words has its whole sequence as its one shingle; a text without words, or null, has none.
    """
    joined = b"\n".join(text or b"" for text in texts) + b"\n"
    raw = np.frombuffer(joined, dtype=np.uint8)
    start, _, words = words_of(raw)
    lengths = np.array([len(text or b"") + 1 for text in texts], dtype=np.int64)
    cuts = np.searchsorted(start, np.cumsum(lengths) - lengths)
    cuts = np.append(cuts, len(start))
    grams = np.zeros(len(words), dtype=np.uint64)
    for k in range(width):  # grams[i]: the words i .. i + width - 1
        shifted = np.zeros(len(words), dtype=np.uint64)
        shifted[: max(len(words) - k, 0)] = words[k:]
        grams = mixed(grams * np.uint64(_MULTIPLIER) + shifted)
    out = []
    for at, to in zip(cuts[:-1], cuts[1:], strict=True):
        n = to - at
        if n >= width:
            out.append(np.unique(grams[at : to - width + 1]))
        elif n:
            whole = np.uint64(n)
            for word in words[at:to]:
                whole = mixed(np.array([int(whole) * _MULTIPLIER + int(word) & _MASK], dtype=np.uint64))[0]
            out.append(np.array([whole], dtype=np.uint64))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out
