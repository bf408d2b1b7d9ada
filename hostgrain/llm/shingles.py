"""Word shingles of whole texts as 64-bit hashes, computed on UTF-8 bytes with numpy."""

from __future__ import annotations

import hashlib

import numpy as np

_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_MULT), -1, 1 << 64))
#: Longer words are hashed with BLAKE2 instead of the polynomial.
_LONG_WORD = 256


def _byte_table() -> np.ndarray:
    """A random-looking 64-bit value for each byte, the same for A-Z as for a-z."""
    x = np.arange(1, 257, dtype=np.uint64)
    table = mix64(x * np.uint64(0xD1342543DE82EF95))
    table[65:91] = table[97:123]
    return table


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = _byte_table()
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    table = _powers[name]
    if len(table) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        table = _powers[name] = np.multiply.accumulate(steps)
    return table[:n]


def word_hashes(text: str | None) -> np.ndarray:
    """A hash for each word `[^\\x20\\x09-\\x0D]+` of the text, A-Z taken as a-z, in order."""
    if not text:
        return np.empty(0, np.uint64)
    raw = text.encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    word = np.concatenate(([False], ~_BLANK[data], [False]))
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * _power("up", _MULT, n), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _power("down", _INVERSE, n)[starts]
    lengths = (ends - starts).astype(np.uint64)
    hashes = mix64(hashes + lengths * np.uint64(0xA0761D6478BD642F))
    for i in np.flatnonzero(lengths > _LONG_WORD):
        lowered = raw[starts[i] : ends[i]].lower()  # bytes.lower touches A-Z only
        hashes[i] = int.from_bytes(hashlib.blake2b(lowered, digest_size=8).digest(), "little")
    return hashes


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; fewer words make one shingle, no words none."""
    words = word_hashes(text)
    n = len(words)
    if not n:
        return words
    width = min(k, n)
    out = np.full(n - width + 1, np.uint64(width), dtype=np.uint64)
    for j in range(width):
        out = mix64(out * np.uint64(0xE7037ED1A0B428DB) + words[j : n - width + 1 + j])
    return np.unique(out)
