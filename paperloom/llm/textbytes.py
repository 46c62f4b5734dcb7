"""Vectorised passes over the UTF-8 bytes of many texts at once.

Hashes are 64-bit polynomial sums over bytes with an odd base, modulo 2**64, so
the hash of any span is a difference of prefix sums times a power of the base's
inverse. A finalizer spreads the bits. Blocks bound the memory that prefix sums
need, whatever the length of a text.
"""

from __future__ import annotations

import functools

import numpy as np

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BLOCK = 1 << 18

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII but letters and digits.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = None


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64))


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def of(base):
        out = np.full(n + 1, base, U64)
        out[0] = 1
        return np.cumprod(out, dtype=U64)

    return of(_BASE), of(_BASE_INV)


def pack(texts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, a newline after each, and where each begins (one more: the end)."""
    coded = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    offsets = np.zeros(len(coded) + 1, np.int64)
    np.cumsum([len(c) + 1 for c in coded], out=offsets[1:])
    return np.frombuffer(b"\n".join([*coded, b""]), np.uint8), offsets


def spans(buf: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that are not separators."""
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = ~separator[buf]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span; spans are in order and do not overlap."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + BLOCK, "right")))
        hi = int(ends[j - 1])
        size = max(BLOCK, 1 << (hi - lo).bit_length())
        power, inverse = _powers(size)
        prefix = np.zeros(hi - lo + 1, U64)
        np.cumsum(_BYTE[buf[lo:hi]] * power[: hi - lo], out=prefix[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((prefix[e] - prefix[s]) * inverse[s] + (e - s).astype(U64))
        i = j
    return out


def grams(word_hash: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hashes of n words from each position on, and which of them stay inside one document."""
    count = max(0, len(word_hash) - n + 1)
    key = np.zeros(count, U64)
    for k in range(n):
        key = key * _BASE + word_hash[k : k + count]
    return mix(key), doc[:count] == doc[n - 1 : n - 1 + count]


def repeated(key: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(key), bool)
    twice = np.unique(twice)
    at = np.searchsorted(twice, key)
    at[at == len(twice)] = 0
    return twice[at] == key


def chunks(texts, limit: int = 1 << 18, most: int = 512):
    """Index ranges of at most ``most`` texts that hold about ``limit`` characters; a long text stands alone."""
    lo = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and (size + n > limit or i - lo == most):
            yield lo, i
            lo, size = i, 0
        size += n + 1
    if lo < len(texts):
        yield lo, len(texts)
