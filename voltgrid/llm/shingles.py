"""Hashes of words and of word shingles, vectorised over a batch of texts."""

from __future__ import annotations

import numpy as np

from voltgrid.llm.common import byte_view, mix64

WIDTH = 5
SHORT = 32                  # bytes
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_VALUE = _LOWER.astype(np.uint64) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = mix64(np.arange(1, 17, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def word_hashes(texts: list[bytes], separates: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, in order, and for each text
    the bounds of its words (len(texts) + 1 numbers). ``lower``: A-Z only."""
    data, starts, _ = byte_view(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    space = separates[data]
    first = ~space
    first[1:] &= space[:-1]
    at = np.flatnonzero(first)
    bounds = np.concatenate([np.searchsorted(at, starts), [len(at)]])
    if not len(at):
        return np.zeros(0, np.uint64), bounds
    # a polynomial in a fixed odd base over each word's bytes: byte by byte of
    # all words, the longest ones first; what exceeds SHORT bytes in one piece
    size = np.flatnonzero(space[1:] & ~space[:-1]) + 1 - at
    order = np.argsort(np.uint16(0xFFFF) - np.minimum(size, 0xFFFF).astype(np.uint16), kind="stable")
    place, longest = at[order], int(size.max())
    longer = len(at) - np.cumsum(np.bincount(np.minimum(size, SHORT + 1), minlength=SHORT + 2))
    power = np.ones(longest, np.uint64)
    power[1:] = np.cumprod(np.full(longest - 1, _BASE, np.uint64))
    total = np.zeros(len(at), np.uint64)
    for j in range(min(longest, SHORT)):
        n = longer[j]
        total[:n] += _VALUE[data[place[:n] + j]] * power[j]
    if n := longer[SHORT]:
        left = size[order[:n]] - SHORT
        starts = np.cumsum(left) - left
        inner = np.arange(int(left.sum())) - np.repeat(starts, left) + SHORT
        total[:n] += np.add.reduceat(_VALUE[data[np.repeat(place[:n], left) + inner]] * power[inner], starts)
    out = np.empty_like(total)
    out[order] = total
    return mix64(out), bounds


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of ``width`` words of each text, repeats
    included; a shorter text is one shingle. With the bounds by text."""
    n = np.diff(bounds)
    count = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(n)), count)
    first = np.arange(out_bounds[-1]) - out_bounds[doc] + bounds[doc]
    padded = np.append(words, np.zeros(width, np.uint64))
    total = np.minimum(n[doc], width).astype(np.uint64) * _PLACE[15]
    left = bounds[doc + 1]
    for j in range(width):
        total += np.where(first + j < left, padded[first + j], np.uint64(0)) * _PLACE[j]
    return mix64(total), out_bounds


def distinct_by_text(hashes: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct hashes of each text."""
    return [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
