"""Words of a text as 64-bit hashes, computed on whole arrays.

A word is a maximal run of bytes other than ASCII white space, which is the pattern
`[^\\x20\\x09-\\x0D]+` on the characters of the text. Hashes depend on the word's UTF-8
bytes alone, so every task of every run gets the same ones.
"""

from __future__ import annotations

import numpy as np

#: Pattern of a word for Spark SQL and DuckDB.
WORD = r"[^\x20\x09-\x0D]+"

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = values.astype(_U)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _steps(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=_U) * _U(_BASE) + _U(seed))


_BYTES = _steps(256, 1)
_FACTOR = 0xD1342543DE82EF95
_INVERSE = pow(_FACTOR, -1, 1 << 64)


class _Powers:
    """Powers of the factor and of its inverse, grown to the longest text so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, factor in (("up", _FACTOR), ("down", _INVERSE)):
                steps = np.full(size, factor, _U)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_powers = _Powers()


def bounds(raw: np.ndarray, outside: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end byte of every run of bytes that are not `outside`."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~outside[raw]
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def run_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run of bytes, the same wherever the run stands."""
    if not len(starts):
        return np.zeros(0, _U)
    up, down = _powers.to(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, _U)
    np.cumsum(_BYTES[raw] * up[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


def hashes(text: str | None, lower: bool = True) -> np.ndarray:
    """Hashes of the words of a text in order; A-Z become lower case first. Null has none."""
    if not text:
        return np.zeros(0, _U)
    raw = text.encode("utf-8", "surrogatepass")
    raw = np.frombuffer(raw.lower() if lower else raw, np.uint8)
    return run_hashes(raw, *bounds(raw))


def windows(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` words in order; a shorter text is one run, none without words."""
    n = len(word_hashes)
    if not n:
        return np.zeros(0, _U)
    width = min(width, n)
    total = np.full(n - width + 1, width, _U)
    for k, factor in enumerate(_steps(width, 2)):
        total += word_hashes[k : n - width + 1 + k] * (factor | _U(1))
    return mix(total)


def signed(values: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return values.view(np.int64)
