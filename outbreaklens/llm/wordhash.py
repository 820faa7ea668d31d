"""Words of many texts as arrays of 64-bit hashes, without a Python object per word."""

from __future__ import annotations

from functools import cache
from typing import NamedTuple

import numpy as np

SLICE = 1 << 17
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_STEP = np.uint64(0xD6E8FEB86659FD93)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# Terms are runs of ASCII letters, digits and all characters beyond ASCII.
NO_TERM = np.ones(256, bool)
NO_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


class Words(NamedTuple):
    """Hash, text number and first and last byte (exclusive) in the joined texts of every word."""

    hashes: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    values = (values ^ (values >> np.uint64(33))) * _MIX[0]
    values = (values ^ (values >> np.uint64(33))) * _MIX[1]
    return values ^ (values >> np.uint64(33))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(size, _BASE), np.full(size, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A polynomial of the bytes of every span, from differences of one running sum."""
    up, down = _powers(1 << max(18, (len(data) - 1).bit_length()))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def words(texts: list[bytes], between: np.ndarray = SPACE) -> Words:
    """Words of the texts joined by one space, in slices of `SLICE` bytes that end between words.

    `between` tells for every byte whether it separates words; the space has to.
    """
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    gaps = between[joined]
    edges = np.flatnonzero(gaps[1:] != gaps[:-1]) + 1
    if not gaps[0]:
        edges = np.concatenate([[0], edges])
    start, end = edges[0::2], edges[1::2]
    hashes = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        low = start[at]
        to = max(int(np.searchsorted(end, low + SLICE, "right")), at + 1)
        hashes[at:to] = _span_hashes(joined[low : end[to - 1]], start[at:to] - low, end[at:to] - low)
        at = to
    begins = np.cumsum([0, *(len(text) + 1 for text in texts)])[:-1]
    return Words(hashes, np.searchsorted(begins, start, "right") - 1, start, end)


def terms(texts: list[str | None]) -> Words:
    """Terms of texts, A-Z in lower case; a text that is null has none."""
    return words([(text or "").encode().lower() for text in texts], NO_TERM)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` words, runs over text borders included."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    found = hashes[:n].copy()
    for step in range(1, size):
        found *= _STEP
        found += hashes[step : n + step]
    return mixed(found)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every `width` consecutive ones."""
    done, found = 1, values
    while done < width:
        step = min(done, width - done)
        found = np.minimum(found[: len(found) - step], found[step:])
        done += step
    return found
