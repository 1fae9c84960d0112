"""Words, lines and rolling hashes of many texts at once, as numpy arrays.

A *block* is a list of texts laid end to end.  Words are cut at the bytes
``20 09-0D`` and hashed as polynomials modulo 2^64 with a final mix; a window
of k words is hashed from the hashes of its words.  Every step is vectorised
over the block, and bytes are worked through in pieces, so a long text costs
a few times its own size.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np

from tallyline.shipping import by_value

by_value(__name__)

U = np.uint64
PIECE = 1 << 20
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word."""
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h = h ^ (h >> U(29))
    h = h * U(0x9FB21C651E98DF25)
    return h ^ (h >> U(32))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2^64."""
    out = np.full(max(n, 1), U(base))
    out[0] = U(1)
    return np.cumprod(out, dtype=U)


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def blocks(texts: list, limit: int = 4 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, texts as UTF-8) with at most ``limit`` bytes, or one text; null is empty."""
    first, own, size = 0, [], 0
    for k, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        if own and size + len(raw) > limit:
            yield first, own
            first, own, size = k, [], 0
        own.append(raw)
        size += len(raw)
    if own:
        yield first, own


def segment_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each non-empty, ascending, disjoint segment."""
    out = np.empty(len(start), U)
    k = 0
    while k < len(start):
        stop = max(int(np.searchsorted(end, start[k] + PIECE)), k + 1)
        s, e = start[k:stop], end[k:stop]
        size = e - s
        at = np.cumsum(size) - size
        inside = np.arange(int(size.sum())) - np.repeat(at, size)
        values = buf[np.repeat(s, size) + inside].astype(U) + U(1)
        values *= powers(BASES[0], int(size.max()))[inside]
        out[k:stop] = mix(np.add.reduceat(values, at) + size.astype(U))
        k = stop
    return out


class Block:
    """``start``/``end`` bytes of each word, the text it is in, and its place in that text."""

    def __init__(self, raws: list[bytes]) -> None:
        sizes = np.array([len(r) + 1 for r in raws])
        self.offset = np.cumsum(sizes) - sizes
        self.buf = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
        gap = _SPACE[self.buf]
        before = np.concatenate(([True], gap[:-1]))
        self.start = np.flatnonzero(before & ~gap)
        self.end = np.flatnonzero(gap & ~before)
        self.n = len(self.start)
        self.count = np.diff(np.append(np.searchsorted(self.start, self.offset), self.n))
        self.text = np.repeat(np.arange(len(raws)), self.count)
        self.first = np.cumsum(self.count) - self.count
        self.place = np.arange(self.n) - np.repeat(self.first, self.count)
        self.raws = raws

    def word_hashes(self) -> np.ndarray:
        return segment_hash(self.buf, self.start, self.end) if self.n else np.empty(0, U)

    def windows(self, size: int) -> np.ndarray:
        """Indices of the words that begin a window of ``size`` words inside one text."""
        return np.flatnonzero(self.place + size <= np.repeat(self.count, self.count))


def rolling(hashes: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hash of ``size`` consecutive values from each place; the last size - 1 places have none."""
    n = len(hashes)
    if n < size:
        return np.empty(0, U)
    total = np.zeros(n + 1, U)
    np.cumsum(hashes * powers(base, n), out=total[1:])
    return mix((total[size:] - total[:-size]) * powers(inverse(base), n - size + 1))


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """True for each of n places inside a window of ``size`` that begins at one of ``starts``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + size, n), -1)
    return np.cumsum(change[:-1]) > 0


assert sys.byteorder == "little", "packed arrays are little endian"
