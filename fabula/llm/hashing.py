"""Hashes of substrings over one byte buffer, computed for all positions at once.

Bytes are first mapped through a table of random odd 64-bit numbers; a prefix sum
of ``table[byte] * B**i`` then gives the hash of any substring by one subtraction
and one multiplication with the inverse power of B (arithmetic modulo 2**64).
"""

from __future__ import annotations

import numpy as np

_B = 0x9E3779B97F4A7C15
_INV = pow(_B, -1, 1 << 64)
_B2 = 0xD1342543DE82EF95
_INV2 = pow(_B2, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def splitmix(seed: int, n: int) -> np.ndarray:
    """n pseudo-random 64-bit numbers; the same on every machine."""
    with np.errstate(over="ignore"):
        x = np.uint64(seed) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_B)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


TABLE = splitmix(20, 256) | np.uint64(1)
TABLE2 = splitmix(1 << 40, 256) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads a difference in any bit over all 64."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(1 << 20, 1 << (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        with np.errstate(over="ignore"):
            have = _powers[name] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def prefix(values: np.ndarray, second: bool = False) -> np.ndarray:
    """Prefix sums H (one longer than values) for ``between``; values: bytes, or 64-bit hashes of items. second: of another base and table, for checks."""
    x = (TABLE2 if second else TABLE)[values] if values.dtype == np.uint8 else values
    out = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x * (_power("up2", _B2, len(x)) if second else _power("up", _B, len(x))), out=out[1:])
    return out


def between(h: np.ndarray, start: np.ndarray, end: np.ndarray, second: bool = False) -> np.ndarray:
    """Hashes of the substrings [start, end)."""
    return mix((h[end] - h[start]) * (_power("down2", _INV2, len(h)) if second else _power("down", _INV, len(h)))[start])


def checks(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """32 more bits on substrings of bytes, independent of ``between``."""
    return (between(prefix(data, True), start, end, True) >> np.uint64(32)).astype(np.uint32)


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all substrings of length k, by start."""
    n = len(h) - k
    return mix((h[k:] - h[:n]) * _power("down", _INV, n)) if n > 0 else np.zeros(0, np.uint64)


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours, by start."""
    if len(v) < w:
        return v[:0]
    have = 1
    while have * 2 <= w:
        v = np.minimum(v[:-have], v[have:])
        have *= 2
    return np.minimum(v[: len(v) - (w - have)], v[w - have :]) if have < w else v
