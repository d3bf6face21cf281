"""Numpy kernels that find where repeats may lie: minimizer anchors of token sequences.

A window is `length` consecutive tokens of one document. Every window has one
anchor, the leftmost of its k-grams with the smallest hash, so equal windows
have equal anchors at equal places. Neighbouring windows mostly share theirs:
an anchor and the run of windows that it stands for make a region. Windows can
only be equal if their regions' anchors are; regions that are equal altogether
(same anchor, same content, same alignment) have all their windows in common.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

U = np.uint64
#: Tokens that one block of texts holds, about; a longer text is a block of its own.
BLOCK_TOKENS = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: An odd factor for each doubling of a gram's length.
_FACTORS = [U(pow(_BASE, 2 * i + 3, 1 << 64) | 1) for i in range(32)]


def mix(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every bit of 64 (wrapping arithmetic)."""
    x = x ^ (x >> U(32))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=U) * U(_BASE))


@lru_cache(maxsize=4)
def _table(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


class Prefix:
    """Polynomial prefix sums of token values: the hash of any range in constant time."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        size = max(BLOCK_TOKENS * 2, 1 << n.bit_length())
        self.inverse = _table(_INVERSE, size)
        self.sums = np.zeros(n + 1, U)
        np.cumsum(values * _table(_BASE, size)[:n], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(U))


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """The hash of every k consecutive values (len - k + 1 of them), put together from power-of-two lengths."""
    level, size, step, out, done = values, 1, 0, None, 0
    while True:
        if k & size:
            part = level[done:]
            out = part if out is None else out[: len(part)] * _FACTORS[step + 16] + part
            done += size
        if size * 2 > k:
            break
        level = level[:-size] * _FACTORS[step] + level[size:]
        size, step = size * 2, step + 1
    return mix(out[: max(0, len(values) - k + 1)])


def byte_grams(raw: np.ndarray, k: int) -> np.ndarray:
    """gram_hashes() of bytes, k a multiple of 8: starts from the eight bytes at every place."""
    n = len(raw)
    if n < k:
        return np.zeros(0, U)
    eights = mix(np.ndarray((n - 7,), "<u8", raw, strides=(1,)))
    level, size, step, out, done = eights, 8, 3, None, 0
    while True:
        if k & size:
            part = level[done:]
            out = part if out is None else out[: len(part)] * _FACTORS[step + 16] + part
            done += size
        if size * 2 > k:
            break
        level = level[:-size] * _FACTORS[step] + level[size:]
        size, step = size * 2, step + 1
    return mix(out[: n - k + 1])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    size, level = 1, x
    while size * 2 <= w:
        level = np.minimum(level[:-size], level[size:])
        size *= 2
    return level if size == w else np.minimum(level[: len(x) - w + 1], level[w - size : len(x) - size + 1])


@dataclass
class Regions:
    """Per region: anchor, content (48 bits, with its alignment), document, first window and last window + 1 as token places of the block."""

    anchor: np.ndarray
    content: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    stop: np.ndarray


def find_regions(grams: np.ndarray, content: Callable, starts: np.ndarray, ends: np.ndarray, length: int, k: int) -> Regions:
    """grams: k-gram hashes of a block's documents one after another; starts, ends: where each document lies; content(first, end): a hash of token ranges."""
    none = np.zeros(0, np.int64)
    if len(grams) < length - k + 1 or not len(starts):
        return Regions(none.astype(U), none.astype(U), none, none, none)
    bits = max(20, len(grams).bit_length())
    mask = U((1 << bits) - 1)
    low = sliding_min((grams & ~mask) | np.arange(len(grams), dtype=U), length - k + 1) & mask
    low = low.astype(np.int64)
    # Windows of one document; the places between are cut off.
    edge = np.empty(len(low) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(low[1:], low[:-1], out=edge[1:-1])
    inside = np.minimum(ends - length + 1, len(low))
    whole = inside > starts
    edge[starts[whole]] = True
    edge[inside[whole]] = True
    cuts = np.flatnonzero(edge)
    first, stop = cuts[:-1], cuts[1:]
    doc = np.searchsorted(starts, first, side="right") - 1
    ok = stop + length - 1 <= ends[doc]
    first, stop, doc = first[ok], stop[ok], doc[ok]
    at = low[first]
    # Anchors are small hashes; mixed again they spread over all buckets.
    return Regions(mix(grams[at] + U(1)), mix(content(first, stop + length - 1) + (at - first).astype(U)) >> U(16), doc, first, stop)


class Bytes:
    """Tokens are bytes."""

    def __init__(self, length: int, k: int):
        assert k % 8 == 0 and length <= 2 * k
        self.length, self.k = length, k

    def regions(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[Regions, np.ndarray, np.ndarray]:
        """Regions, and the byte ranges of the tokens they count in."""
        k = self.k
        grams = byte_grams(raw, k)

        def content(first, end):
            # Three overlapping grams cover a region of up to 3k bytes; longer than 2 * length it never is.
            middle = (first + end - k) // 2
            return mix(grams[first] * _FACTORS[1] + grams[middle] * _FACTORS[2] + grams[end - k] * _FACTORS[4] + (end - first).astype(U))

        return find_regions(grams, content, starts, ends, self.length, k), None, None

    def window_hashes(self, raw: np.ndarray, first: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each window of a region."""
        part = raw[first : stop + self.length - 1]
        p = Prefix(BYTE_VALUES[part])
        at = np.arange(stop - first)
        return p.hash(at, at + self.length), gram_hashes(BYTE_VALUES[part], self.length)


def is_blank(raw: np.ndarray) -> np.ndarray:
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def word_spans(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the words of texts one after another; ends: where each text ends (a word never crosses)."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    blank = is_blank(raw)
    inner = ends[(ends > 0) & (ends < len(raw))]
    before = np.empty(len(raw), bool)
    before[0] = True
    before[1:] = blank[:-1]
    before[inner] = True
    after = np.empty(len(raw), bool)
    after[-1] = True
    after[:-1] = blank[1:]
    after[inner - 1] = True
    word = ~blank
    return np.flatnonzero(before & word), np.flatnonzero(after & word) + 1


class Words:
    """Tokens are words, runs of anything but the six ASCII blanks."""

    def __init__(self, length: int, k: int):
        self.length, self.k = length, k

    def regions(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[Regions, np.ndarray, np.ndarray]:
        """Regions in word places of the block, and the words' byte ranges."""
        begin, end = word_spans(raw, ends)
        values = Prefix(BYTE_VALUES[raw]).hash(begin, end)
        first, stop = np.searchsorted(begin, starts), np.searchsorted(begin, ends)
        return find_regions(gram_hashes(values, self.k), Prefix(values).hash, first, stop, self.length, self.k), begin, end

    def window_hashes(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(len(values) - self.length + 1)
        return Prefix(values).hash(at, at + self.length), gram_hashes(values, self.length)
