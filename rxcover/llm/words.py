"""Word and shingle hashes of whole texts, vectorised over their bytes."""

from __future__ import annotations

import numpy as np

from rxcover.llm.common import mix64

_M = (1 << 64) - 1
_R = 0x9E3779B97F4A7C15 | 1
_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_SPACES = frozenset([32, *range(9, 14)])
#: A-Z to a-z, the contract's white space to a space, all else kept.
LOWER_ASCII = bytes(32 if c in _SPACES else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Also every ASCII character but letters, digits and underscore to a space.
WORD_ASCII = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() or c == 95 else 32 for c in range(256))

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers 0 to n - 1 modulo 2**64, and their inverses."""
    if len(_powers["up"]) < n:
        size = max(n, 1 << 16, 2 * len(_powers["up"]) if n < 1 << 24 else n)
        for name, r in (("up", _R), ("down", pow(_R, -1, 1 << 64))):
            f = np.full(size, r, np.uint64)
            f[0] = 1
            _powers[name] = np.multiply.accumulate(f)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """c[i] = sum of value(data[j]) * r**j for j < i, modulo 2**64."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * powers(len(data))[0], out=out[1:])
    return out


def word_hashes(text: str | None, table: bytes) -> np.ndarray:
    """A 64-bit hash of every word, in order; ``table`` maps the UTF-8 bytes
    so that words are runs of bytes other than the space."""
    if not text:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(text.encode("utf-8", "replace").translate(table), np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = data != 32
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, np.uint64)
    c = prefix_sums(data)
    down = powers(len(data))[1]
    return mix64((c[end] - c[start]) * down[start] + (end - start).astype(np.uint64))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of n words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out *= np.uint64(_R)
        out += words[k:len(words) - n + 1 + k]
    return mix64(out + np.uint64(n))
