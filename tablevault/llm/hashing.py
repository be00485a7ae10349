"""Vectorised content hashes of windows, for code that runs on batches inside tasks."""

from __future__ import annotations

import numpy as np

U = np.uint64
_MUL1, _MUL2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all others (the splitmix64 finaliser)."""
    x = (x ^ (x >> U(30))) * _MUL1
    x = (x ^ (x >> U(27))) * _MUL2
    return x ^ (x >> U(31))


def mix_pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return mix(x * U(0x9E3779B97F4A7C15) + mix(y))


class Rolling:
    """Polynomial hashes, modulo 2**64, of any stretch of one array of 64-bit symbols.

    Equal stretches have equal hashes wherever they stand. The base is odd, hence it has an
    inverse, and a stretch's hash is a difference of prefix sums brought back to position 0.
    """

    def __init__(self, base: int):
        self.base = base | 1
        self._powers = self._inverses = np.ones(1, U)

    def _grow(self, n: int) -> None:
        if len(self._powers) < n:
            size = 1 << (n - 1).bit_length()
            with np.errstate(over="ignore"):
                step = np.full(size, self.base, U)
                back = np.full(size, pow(self.base, -1, 1 << 64), U)
                step[0] = back[0] = 1
                self._powers = np.multiply.accumulate(step)
                self._inverses = np.multiply.accumulate(back)

    def prefix(self, symbols: np.ndarray) -> np.ndarray:
        self._grow(len(symbols) + 1)
        sums = np.zeros(len(symbols) + 1, U)
        np.cumsum(symbols * self._powers[: len(symbols)], out=sums[1:])
        return sums

    def between(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self._inverses[start])

    def every(self, sums: np.ndarray, length: int) -> np.ndarray:
        """The hash of each stretch of `length` symbols."""
        n = len(sums) - length
        return mix((sums[length:] - sums[:n]) * self._inverses[:n])


def symbols(count: int, seed: int) -> np.ndarray:
    """`count` fixed, arbitrary 64-bit values."""
    return mix(np.arange(1, count + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
