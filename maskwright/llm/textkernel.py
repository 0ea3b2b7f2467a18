"""Vectorised word hashing shared by the text operators.

A text is handled as its UTF-8 bytes.  Words are maximal runs of bytes outside
a separator class; every word gets a 64-bit hash from prefix sums of a
polynomial (one pass over the bytes, no Python object per word), finished by a
splitmix step.  Hashes depend only on the word, so they join across tasks.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def _classes(separator) -> bytes:
    return bytes(0 if separator(i) else 1 for i in range(256))


#: byte -> 0 for [\x20\x09-\x0D], else 1
WHITESPACE = _classes(lambda i: i == 0x20 or 0x09 <= i <= 0x0D)

#: byte -> 0 for ASCII bytes that are neither letters nor digits, else 1
NON_WORD = _classes(lambda i: i < 128 and not chr(i).isalnum())

_powers = {"up": np.ones(1, dtype=U64), "down": np.ones(1, dtype=U64)}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, base, dtype=U64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def word_spans(raw: bytes, separators: bytes = WHITESPACE) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets [start, end) of the words."""
    inside = np.frombuffer(b"\0" + raw.translate(separators) + b"\0", dtype=np.uint8)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_hashes(raw: bytes, separators: bytes = WHITESPACE) -> np.ndarray:
    """One hash per word of ``raw``, in text order.  Callers lower-case first."""
    starts, ends = word_spans(raw, separators)
    if not len(starts):
        return np.empty(0, dtype=U64)
    up, down = _power_table(len(raw))
    sums = np.empty(len(raw) + 1, dtype=U64)
    sums[0] = 0
    scaled = np.frombuffer(raw, dtype=np.uint8) * up
    np.cumsum(scaled, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64) * U64(0xC2B2AE3D27D4EB4F))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words."""
    if len(words) < n:
        return np.empty(0, dtype=U64)
    last = len(words) - n + 1
    total = words[:last].copy()
    for k in range(1, n):
        total *= U64(0xD6E8FEB86659FD93)
        total += words[k : last + k]
    return mix(total)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a text shorter than ``n`` words is one shingle."""
    words = word_hashes(text.encode("utf-8", "surrogatepass").lower()) if text else np.empty(0, dtype=U64)
    if not len(words):
        return words
    if len(words) < n:
        return mix(ngram_hashes(words, len(words)) + U64(len(words)))
    return distinct(ngram_hashes(words, n))
