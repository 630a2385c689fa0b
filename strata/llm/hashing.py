"""64-bit mixing on arrays."""

from __future__ import annotations

import numpy as np

U = np.uint64


def mix(x: np.ndarray, a: int = 0x9E3779B97F4A7C15, b: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """A permutation of the 64-bit numbers: odd multipliers and shifts."""
    x = x * U(a)
    x ^= x >> U(32)
    x *= U(b)
    x ^= x >> U(29)
    return x
