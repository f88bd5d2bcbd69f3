"""Words and word shingles of whole texts as 64-bit hashes, column at a time."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# An odd base has an inverse modulo 2**64, so prefix sums give any word's hash.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, _U)
    if n > 1:
        out[1:] = _U(base)
        out = np.multiply.accumulate(out)
    return out


_UP, _DOWN = _powers(_BASE, _STEP), _powers(_INVERSE, _STEP)


def words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words per text) of texts that lie one
    behind the other in ``data``; ASCII letters count without case."""
    low, high = (int(starts[0]), int(ends[-1])) if len(starts) else (0, 0)
    n = high - low
    if n == 0:
        return np.zeros(0, _U), np.zeros(len(starts), np.int64)
    piece = _LOWER[data[low:high]]
    space = _SPACE[piece]
    begin, finish = ~space, ~space
    begin[1:] &= space[:-1]
    finish[:-1] &= space[1:]
    full = ends > starts
    edge = (starts[full] - low).astype(np.int64)
    begin[edge] = ~space[edge]
    finish[ends[full] - low - 1] = ~space[ends[full] - low - 1]
    first, last = np.flatnonzero(begin), np.flatnonzero(finish)
    # Powers restart every _STEP bytes; a word over a border is summed anew.
    value = _BYTE[piece]
    at = np.arange(n) & (_STEP - 1)
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(value * _UP[at], dtype=_U)])
    out = (sums[last + 1] - sums[first]) * _DOWN[at[first]]
    for k in np.flatnonzero((first // _STEP) != (last // _STEP)):
        h, run = 0, value[first[k] : last[k] + 1].tolist()
        for v in reversed(run):
            h = (h * _BASE + v) & 0xFFFFFFFFFFFFFFFF
        out[k] = _U(h)
    per_text = np.searchsorted(first, ends - low) - np.searchsorted(first, starts - low)
    return mix(out + (last - first + 1).astype(_U)), per_text


def shingles(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Per text: the sorted distinct hashes of its ``width``-word shingles; of
    fewer words, the one hash of the whole sequence; without words, nothing."""
    w, per_text = words(data, starts, ends)
    with np.errstate(over="ignore"):
        h = np.zeros(max(0, len(w) - width + 1), _U)
        for j in range(width):
            h = mix(h + w[j : j + len(h)])
        out, at = [], 0
        for n in per_text.tolist():
            if n >= width:
                out.append(np.unique(h[at : at + n - width + 1]))
            elif n:
                s = np.zeros(1, _U)
                for j in range(n):
                    s = mix(s + w[at + j : at + j + 1])
                out.append(mix(s + _U(n)))
            else:
                out.append(np.zeros(0, _U))
            at += n
    return out
