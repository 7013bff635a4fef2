"""Vectorised tokenising and hashing over Arrow string buffers (numpy, no per-word Python)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_Q = np.uint64(0xD1342543DE82EF95)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}
#: most powers a worker keeps of a base (8 MB); a longer text has its own
POWERS_KEPT = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pow(base: np.uint64, n: int, name: str) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        out = np.cumprod(out, dtype=np.uint64)
        if size <= POWERS_KEPT:
            _powers[name] = out
        return out[:n]
    return have[:n]


class Texts:
    """Byte view of an Arrow string array; a null counts as an empty text."""

    def __init__(self, column: pa.Array, lower: bool = False):
        column = pc.fill_null(column.cast(pa.large_string()), "")
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
        offsets = offsets[column.offset:column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
        self.n = len(column)
        self.data = data[offsets[0]:offsets[-1]] if self.n else data[:0]
        self.offsets = offsets - offsets[0] if self.n else np.zeros(1, np.int64)
        if lower:
            self.data = _LOWER[self.data]
        self._sums: np.ndarray | None = None

    def words(self, separators: np.ndarray = _SPACE,
              cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte starts and ends of the runs without separators (by default the words
        ``[^\\x20\\x09-\\x0D]+``), and each text's first run (length n + 1). Runs also end
        before the bytes marked in ``cuts``."""
        space = separators[self.data]
        first = np.ones(len(space), dtype=bool)
        first[1:] = space[:-1]
        if cuts is not None:
            first |= cuts
        inner = self.offsets[:-1]
        first[inner[inner < len(space)]] = True
        starts = np.flatnonzero(~space & first)
        last = np.ones(len(space), dtype=bool)
        last[:-1] = space[1:]
        if cuts is not None:
            last[:-1] |= cuts[1:]
        after = self.offsets[1:]
        last[after[after > 0] - 1] = True
        ends = np.flatnonzero(~space & last) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte ranges, equal wherever the bytes are equal."""
        n = len(self.data)
        if self._sums is None:
            self._sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(_BYTE[self.data] * _pow(_P, n, "p"), dtype=np.uint64, out=self._sums[1:])
        return mix((self._sums[ends] - self._sums[starts]) * _pow(_P_INV, n + 1, "q")[starts])

    def count(self, mask: np.ndarray) -> np.ndarray:
        """How many marked bytes each text has."""
        total = np.zeros(len(mask) + 1, dtype=np.int64)
        np.cumsum(mask, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def windows(word_hash: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words (length max(0, n - size + 1))."""
    n = len(word_hash) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = word_hash[:n].copy()
    q = np.uint64(1)
    for j in range(1, size):
        q = np.uint64((int(q) * int(_Q)) & (2**64 - 1))
        out += word_hash[j:j + n] * q
    return mix(out)


def shingle_sets(texts: Texts, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words has its whole
    sequence as its only shingle, one without words an empty set."""
    starts, ends, first = texts.words()
    h = texts.hashes(starts, ends)
    out = []
    for i in range(texts.n):
        own = h[first[i]:first[i + 1]]
        if 0 < len(own) < size:
            out.append(windows(own, len(own)))
        else:
            out.append(np.unique(windows(own, size)))
    return out
