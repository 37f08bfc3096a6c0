"""Vectorised 64-bit hashes of words, shingles and other spans of UTF-8 text.

A span's hash is a polynomial in its bytes modulo 2^64, taken from running sums
over the whole buffer, then mixed with its length.  Spans with equal bytes get
equal hashes wherever they stand, in any task.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = {"n": 0}
#: Powers that a worker keeps; longer buffers have theirs made for the call.
_KEPT = 1 << 21

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= _POWERS["n"]:
        return _POWERS["up"], _POWERS["down"]
    inverse = pow(_BASE, -1, 1 << 64)
    size = n if n > _KEPT else min(_KEPT, max(2 * n, 1 << 16))
    with np.errstate(over="ignore"):
        up, down = (np.cumprod(np.full(size, x, _U)) for x in (_BASE, inverse))
    if size <= _KEPT:
        _POWERS.update(n=size, up=up, down=down)
    return up, down


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each data[starts[i]:ends[i]] of a byte buffer."""
    up, down = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, _U)
        np.cumsum((data.astype(_U) + _U(1)) * up[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs without ASCII white space) of several texts.

    Returns the joined buffer, the words' starts, ends and hashes, and the
    position of each text's first word (one more than texts).  ``lower`` lowers
    A-Z only."""
    joined = b"\n".join(texts)
    data = np.frombuffer(joined.lower() if lower else joined, np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~SPACE[data]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    text_starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return data, starts, ends, span_hashes(data, starts, ends), np.searchsorted(starts, text_starts)


_ODD = [_U(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def window_hashes(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of each k consecutive words; empty if there are fewer than k."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    base = int(_ODD[seed % 4]) ^ (seed << 33) | 1
    up, down = np.empty(len(hashes) + 1, _U), np.empty(len(hashes) + 1, _U)
    up[0] = down[0] = 1
    with np.errstate(over="ignore"):
        up[1:] = np.cumprod(np.full(len(hashes), base, _U))
        down[1:] = np.cumprod(np.full(len(hashes), pow(base, -1, 1 << 64), _U))
        sums = np.zeros(len(hashes) + 1, _U)
        np.cumsum(hashes * up[:-1], out=sums[1:])
        return mix((sums[k:] - sums[:n]) * down[:n] + _U(k))


def text_windows(hashes: np.ndarray, first: np.ndarray, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Window hashes of several texts and the position of each text's first one.

    Windows that would run over the end of a text are left out."""
    every = window_hashes(hashes, k, seed)
    counts = np.maximum(np.diff(first) - k + 1, 0)
    at = np.concatenate([[0], np.cumsum(counts)])
    if not len(every):
        return every, at
    keep = np.repeat(first[:-1] - at[:-1], counts) + np.arange(at[-1])
    return every[keep], at


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct k-word shingle hashes of each text, A-Z lowered.

    A text with fewer words has its whole sequence as its one shingle; one
    without words has none."""
    _, _, _, hashes, first = words(texts, lower=True)
    windows, at = text_windows(hashes, first, k)
    out = []
    for i in range(len(texts)):
        n = first[i + 1] - first[i]
        if n >= k:
            out.append(np.unique(windows[at[i] : at[i + 1]]))
        else:
            out.append(window_hashes(hashes[first[i] : first[i + 1]], int(n)) if n else np.zeros(0, _U))
    return out
