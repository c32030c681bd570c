"""Words of whole texts as 64-bit hashes, taken straight from Arrow's bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def byte_classes(word_byte) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words, and every byte with A-Z in lower case."""
    member = np.array([bool(word_byte(b)) for b in range(256)])
    folded = np.arange(256, dtype=np.uint64)
    folded[65:91] += 32
    return member, folded + np.uint64(1)


#: Words `[^\x20\x09-\x0D]+`.
SPACED = byte_classes(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of a text in lower case.
LETTERS = byte_classes(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        steps = np.full(max(n, 1 << 16), _BASE if kind == "up" else _INVERSE, dtype=np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps)
    return _powers[kind][:n]


class Words:
    """Words of some texts: `hashes` of all of them in order, `first[i]:first[i + 1]` those of text i."""

    def __init__(self, texts: pa.Array, classes: tuple[np.ndarray, np.ndarray]):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        self.data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None and len(texts) else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0] if len(bounds) else np.zeros(1, np.int64)
        member, folded = classes
        inside = member[self.data]
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edge = bounds[1:-1]
        edge = edge[(edge > 0) & (edge < len(inside))]
        starts[edge] = inside[edge]
        ends[edge - 1] = inside[edge - 1]
        self.start, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, bounds)
        n = len(self.data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(folded[self.data] * _power("up", n), out=sums[1:])
        self.hashes = mix((sums[self.end] - sums[self.start]) * _power("down", n)[self.start] + (self.end - self.start).astype(np.uint64))

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i] : self.first[i + 1]]

    def strings(self, lo: int, hi: int) -> list[str]:
        """Words lo to hi - 1 themselves, A-Z in lower case."""
        raw = self.data.tobytes() if hi - lo > 1000 else None
        take = (lambda s, e: raw[s:e]) if raw is not None else (lambda s, e: self.data[s:e].tobytes())
        return [take(s, e).lower().decode() for s, e in zip(self.start[lo:hi].tolist(), self.end[lo:hi].tolist())]


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of `size` words; none if there are fewer words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x9FB21C651E98DF25) + hashes[k : k + n]
        total ^= total >> np.uint64(32)
    return mix(total)


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles in order; a text of fewer words is one shingle, a text without words none."""
    if 0 < len(hashes) < size:
        return shingles(hashes, len(hashes))
    found = np.sort(shingles(hashes, size))
    return found[np.append(True, found[1:] != found[:-1])] if len(found) else found
