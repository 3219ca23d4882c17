"""Rolling hashes of word sequences, as NumPy over the bytes of one text.

Polynomial hashes modulo 2^64 of word n-grams come from prefix sums, so a text
of any length costs a few passes over its bytes.  They choose positions; what
must be exact is compared or digested by its bytes.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)          # odd, so it has an inverse modulo 2^64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_POWERS = {1: np.ones(1, np.uint64), -1: np.ones(1, np.uint64)}


def _powers(n: int, sign: int) -> np.ndarray:
    """BASE^(sign * i) for i < n, grown on demand."""
    have = _POWERS[sign]
    if len(have) < n:
        step = np.full(max(n, 2 * len(have), 1 << 16), BASE if sign == 1 else INVERSE, np.uint64)
        step[0] = 1
        with np.errstate(over="ignore"):
            have = np.multiply.accumulate(step)
        if len(have) <= 1 << 23:               # longer tables belong to one text only
            _POWERS[sign] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose order and bits look random."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return h ^ (h >> np.uint64(33))


class Words:
    """The words of a text: runs of bytes other than 0x20 and 0x09-0x0D, joined by one space."""

    def __init__(self, text: str | None, lower: bool = False):
        raw = (text or "")
        data = (raw.lower() if lower else raw).encode("utf-8", "surrogatepass")
        self.data = b" ".join(data.split())    # bytes.split() cuts at exactly those bytes
        b = np.frombuffer(self.data, np.uint8)
        spaces = np.flatnonzero(b == 32)
        if len(b):
            self.start = np.concatenate([[0], spaces + 1])
            self.end = np.concatenate([spaces, [len(b)]])
        else:
            self.start = self.end = np.empty(0, np.int64)
        self.n = len(self.start)
        self._bytes, self._prefix = b, None

    def grams(self, k: int) -> np.ndarray:
        """Mixed hash of each k consecutive words (empty if there are fewer)."""
        if self.n < k:
            return np.empty(0, np.uint64)
        if self._prefix is None:
            with np.errstate(over="ignore"):
                terms = (self._bytes.astype(np.uint64) + np.uint64(1)) * _powers(len(self._bytes), 1)
                self._prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        s, e = self.start[:self.n - k + 1], self.end[k - 1:]
        with np.errstate(over="ignore"):
            return mixed((self._prefix[e] - self._prefix[s]) * _powers(len(self._bytes), -1)[s])

    def text(self, i: int, j: int) -> bytes:
        """Words i .. j-1, joined by one space."""
        return self.data[self.start[i]:self.end[j - 1]] if j > i else b""


def sliding(a: np.ndarray, width: int, op) -> np.ndarray:
    """op (np.minimum or np.maximum) over each ``width`` consecutive values."""
    n, out, done = len(a) - width + 1, a, 1
    if n <= 0:
        return a[:0]
    while done * 2 <= width:
        out = op(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return op(out[:len(out) - rest], out[rest:])[:n] if rest else out[:n]
