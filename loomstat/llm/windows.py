"""Hashes of byte windows, for whole buffers at a time."""

from __future__ import annotations

import numpy as np

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def odd(seed: int) -> np.uint64:
    """The odd multiplier number ``seed``."""
    return mixed(np.array([2 * seed + 1], np.uint64))[0] | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit words."""
    x = x * _M1
    x ^= x >> np.uint64(32)
    x *= _M2
    x ^= x >> np.uint64(29)
    x *= _M3
    x ^= x >> np.uint64(32)
    return x


def words_at_every_byte(buf: np.ndarray) -> np.ndarray:
    """The scrambled eight bytes that begin at each byte (``len(buf) - 7`` of them)."""
    n = len(buf) - 7
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mixed(_words(buf).astype(np.uint64))


def _words(buf: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at each byte, as a view."""
    return np.ndarray((len(buf) - 7,), "<u8", np.ascontiguousarray(buf), 0, (1,))


def offsets(width: int) -> list[int]:
    """Where eight-byte words must begin to cover ``width`` bytes."""
    return sorted({*range(0, width - 7, 8), width - 8})


def window_hashes(words: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes (eight or more) that begin at each byte."""
    n = len(words) + 8 - width
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k, at in enumerate(offsets(width)):
        total += words[at : at + n] * odd(97 * seed + k + 1)
    return mixed(total)


def hashes_at(buf: np.ndarray, places: np.ndarray, width: int, seeds: tuple[int, ...]) -> list[np.ndarray]:
    """One hash for each seed of the windows of ``buf`` that begin at ``places``; the rest is not worked out."""
    totals = [np.zeros(len(places), np.uint64) for _ in seeds]
    if len(places):
        view = _words(buf)
        for k, at in enumerate(offsets(width)):
            word = mixed(view[places + at].astype(np.uint64))
            for total, seed in zip(totals, seeds, strict=True):
                total += word * odd(97 * seed + k + 1)
    return [mixed(t) for t in totals]


def sliding(best, values: np.ndarray, width: int) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) over every ``width`` neighbours, by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    span, out = 1, values
    while span * 2 <= width:
        out = best(out[: len(out) - span], out[span:])
        span *= 2
    return best(out[:n], out[width - span : width - span + n])
