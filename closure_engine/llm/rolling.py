"""Rolling hashes of words, word n-grams and lines over the raw UTF-8 bytes of many texts, in numpy.

Hashes are polynomials modulo 2^64 over random byte values, finished by a
mixing step.  Prefix sums give the hash of any byte or word range by one
subtraction and one multiplication with an inverse power of the base.  Bytes
are read in blocks, so a very long text needs little more than its own size.
Equal ranges always have equal hashes; different ones differ but for a chance
of about 2^-64 a pair.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
#: Bytes read at a time, and blocks that a text may have: their powers are held by every worker process, 10 MB in all.
_BITS, _BLOCKS = 16, 1 << 18
_BLOCK = 1 << _BITS
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
#: ASCII letters and all bytes of other characters.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
_RANDOM = np.random.default_rng(20_240_501)
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.int64).astype(_U)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, any exponent below 2^34 (a string has less than 2^31 bytes)."""

    def __init__(self, base: int):
        inverse = pow(base, -1, 1 << 64)
        self.low, self.high = self._table(base, _BLOCK), self._table(pow(base, _BLOCK, 1 << 64), _BLOCKS)
        self.inv_low, self.inv_high = self._table(inverse, _BLOCK), self._table(pow(inverse, _BLOCK, 1 << 64), _BLOCKS)

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, _U)
        out[0] = 1
        return np.multiply.accumulate(out)

    def of(self, i: np.ndarray) -> np.ndarray:
        return self.low[i & (_BLOCK - 1)] * self.high[i >> _BITS]

    def inverse(self, i: np.ndarray) -> np.ndarray:
        return self.inv_low[i & (_BLOCK - 1)] * self.inv_high[i >> _BITS]


_TABLES: list[_Powers] = []


def _powers() -> tuple[_Powers, _Powers]:
    if not _TABLES:  # made in the worker that needs them
        _TABLES.extend((_Powers(0x9E3779B97F4A7C15), _Powers(0xD6E8FEB86659FD93)))
    return _TABLES[0], _TABLES[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _prefix(values, n: int, at: np.ndarray, powers: _Powers) -> np.ndarray:
    """Sum of values(i) * base^i over i < p, for each p of the sorted array ``at``."""
    out = np.empty(len(at), _U)
    total, k = _U(0), 0
    with np.errstate(over="ignore"):
        for a in range(0, n + 1, _BLOCK):
            b = min(n, a + _BLOCK)
            m = int(np.searchsorted(at, b, "right")) if b < n else len(at)
            sums = np.zeros(b - a + 1, _U)
            np.cumsum(values(a, b) * powers.low[:b - a], out=sums[1:])
            sums *= powers.high[a >> _BITS]
            sums += total
            out[k:m] = sums[at[k:m] - a]
            total, k = sums[-1], m
    return out


class Texts:
    """The words of texts that stand one after the other in ``data``; text i is data[ends[i]:ends[i + 1]]."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, lower: bool = False, solid: np.ndarray | None = None):
        """``solid``: table of the bytes that words consist of; all but white space by default."""
        self.data, self.ends, self.n = (LOWER[data] if lower else data), ends, len(ends) - 1
        solid = ~_SPACE[data] if solid is None else solid[data]
        before = np.empty(len(data), bool)
        before[1:] = solid[:-1]
        after = np.empty(len(data), bool)
        after[:-1] = solid[1:]
        real = ends[:-1][np.diff(ends) > 0]  # a text's first byte starts a word, its last one ends it
        before[real] = False
        after[np.append(real[1:], len(data)) - 1 if len(real) else real] = False
        if len(data) and not len(real):
            raise ValueError("bytes outside of all texts")
        self.solid = solid
        self.start = np.flatnonzero(solid & ~before)
        self.stop = np.flatnonzero(solid & ~after) + 1
        self.first = np.searchsorted(self.start, ends)  # of text i: words first[i] to first[i + 1]
        self.n_words = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n), self.n_words)

    def ranges(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges; both arrays are sorted."""
        p = _powers()[0]
        value = lambda a, b: _BYTES[self.data[a:b]]
        n = len(self.data)
        return mix((_prefix(value, n, stop, p) - _prefix(value, n, start, p)) * p.inverse(start))

    def words(self) -> np.ndarray:
        return self.ranges(self.start, self.stop)

    def grams(self, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, position of the first word) of every run of ``n`` words inside one text."""
        count = len(words)
        if count < n:
            return np.zeros(0, _U), np.zeros(0, np.int64)
        at = np.flatnonzero(self.doc[:count - n + 1] == self.doc[n - 1:])
        p, every = _powers()[1], np.arange(count + 1)
        sums = _prefix(lambda a, b: words[a:b], count, every, p)
        return mix((sums[at + n] - sums[at]) * p.inverse(at)), at

    def runs(self, words: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """The hashes that ``grams`` gives to the runs of ``n`` words from the places ``at`` on."""
        p, out = _powers()[1], np.zeros(len(at), _U)
        for j in range(n):
            out += words[at + j] * p.low[j]
        return mix(out)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sums of a value of each byte over each text."""
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return np.diff(sums[self.ends])


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    if len(keys) < 2:
        return np.zeros(len(keys), bool)
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    twice = np.unique(twice)
    return twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys
