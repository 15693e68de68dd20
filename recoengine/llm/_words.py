"""Words of UTF-8 texts as numpy arrays: places, hashes and shingles.

All hashes are polynomials modulo 2**64 over random 64-bit letters, taken from
prefix sums, so that any stretch of a text is hashed by two look-ups.
"""

from __future__ import annotations

import functools

import numpy as np

U = np.uint64
#: Odd multipliers (random); each inverse is computed.
BYTE_STEP, WORD_STEP = 0x9E6C63D0876A9A47, 0xD1B54A32D192ED03
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
#: Random letters for bytes, and the same with A-Z as a-z.
LETTERS = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
FOLDED = LETTERS.copy()
FOLDED[65:91] = LETTERS[97:123]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


#: By step, as far as they were needed: one table each, whatever the lengths asked for.
_POWERS: dict[int, np.ndarray] = {}


def powers(step: int, n: int) -> np.ndarray:
    """step**0 .. step**(n - 1) modulo 2**64."""
    if len(_POWERS.get(step, ())) < n:
        out = np.full(1 << max(16, (n - 1).bit_length()), step, np.uint64)
        out[0] = 1
        _POWERS[step] = np.multiply.accumulate(out)
    return _POWERS[step][:n]


@functools.cache
def inverse(step: int) -> int:
    return pow(step, -1, 1 << 64)


def prefix_sums(values: np.ndarray, step: int) -> np.ndarray:
    """n + 1 sums of values[i] * step**i."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(step, len(values)), out=out[1:])
    return out


def stretches(sums: np.ndarray, step: int, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the stretches first..end, alike wherever they stand."""
    return (sums[end] - sums[first]) * powers(inverse(step), len(sums))[first]


class Words:
    """The words (runs of bytes other than white space) of n texts."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, separators: np.ndarray = SPACE):
        inside = np.empty(len(buf) + 2, bool)
        inside[0] = inside[-1] = False
        np.logical_not(separators[buf], out=inside[1:-1])
        edges = inside[1:] != inside[:-1]
        begin = edges & inside[1:]
        over = edges & inside[:-1]
        joints = off[1:-1][inside[off[1:-1]] & inside[off[1:-1] + 1]]  # a word may not run on into the next text
        begin[joints] = over[joints] = True
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(over)
        self.off = np.searchsorted(self.start, off)  # n + 1 offsets into the words
        self.buf = buf

    @property
    def doc(self) -> np.ndarray:
        """Each word's text."""
        return np.repeat(np.arange(len(self.off) - 1), np.diff(self.off))

    def hashes(self, letters: np.ndarray) -> np.ndarray:
        sums = prefix_sums(letters[self.buf], BYTE_STEP)
        return mix(stretches(sums, BYTE_STEP, self.start, self.end) + (self.end - self.start).astype(np.uint64))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k words in a row, texts not minded."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    at = np.arange(n)
    return mix(stretches(prefix_sums(words, WORD_STEP), WORD_STEP, at, at + k))


def inside_texts(off: np.ndarray, n: int, k: int) -> np.ndarray:
    """Which of the n stretches of k items lie within one text."""
    ok = np.zeros(n, bool)
    at = np.repeat(off[1:], np.diff(off))[:n]  # the end of the text that each begins in
    ok[: len(at)] = np.arange(len(at)) + k <= at
    return ok


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over every ``width`` values in a row."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def chosen(order: np.ndarray, width: int) -> np.ndarray:
    """Winnowing: which places are least in some ``width`` places in a row.
    The choice rests on the values in those places alone, so equal stretches
    of two texts choose alike."""
    if len(order) < width:
        return np.zeros(len(order), bool)
    least = sliding(order, width, np.minimum)
    pad = np.zeros(width - 1, order.dtype)
    return sliding(np.concatenate([pad, least, pad]), width, np.maximum) == order
