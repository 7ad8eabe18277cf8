"""Words of many texts at once: their hashes and a few marks, by array operations on bytes."""

from __future__ import annotations

import numpy as np

from loomstat.llm.windows import mixed, odd

_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_WORD = _DIGIT.copy()  # ASCII letters and digits and every byte of other characters
_WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of an odd number and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = 1 << n.bit_length()
        base = int(odd(23))
        for k, b in enumerate((base, pow(base, -1, 1 << 64))):
            _POWERS[k] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64))])
    return _POWERS[0], _POWERS[1]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one buffer, a newline after each, and where each begins (and the end)."""
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), starts


def hashes_of(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``codes[begin:end]`` (bytes) for each range."""
    power, back = powers(len(codes) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[codes] * power[: len(codes)], dtype=np.uint64)])
    return mixed((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64) * odd(29))


def edges(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the runs of True."""
    step = np.diff(inside.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def plain_words(buf: np.ndarray):
    """White-space words reduced to lower-case letters and digits: (begin, end, hash, kept bytes, kept before)."""
    begin, end = edges(~_SPACE[buf])
    kept = _WORD[buf]
    rank = np.concatenate([[0], np.cumsum(kept)])
    a, b = rank[begin], rank[end]
    return begin, end, hashes_of(_LOWER[buf[kept]], a, b), b - a, np.flatnonzero(kept), a


def has_digit(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(_DIGIT[buf])])
    return total[end] > total[begin]


def mixed_tokens(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, hash) of runs of word bytes and of runs of other bytes that are not white space."""
    word, other = _WORD[buf], ~(_WORD[buf] | _SPACE[buf])
    a, b = edges(word)
    c, d = edges(other)
    begin, end = np.concatenate([a, c]), np.concatenate([b, d])
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], end[order]
    return begin, hashes_of(buf, begin, end)
