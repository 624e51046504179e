"""Phrases of texts by hash triggers, as arrays over a buffer of many texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from sessiongrain.llm.near_duplicates import xxh64

#: A trigger is the least hash of GRAM bytes among SPAN successive places: content alone decides it, and no
#: stretch of SPAN + GRAM bytes is without one. A repeated string of `length` bytes has its first trigger, and
#: the core behind it, at the same places in every copy.
SPAN = 240
GRAM = 8
_CHUNK_BYTES = 1 << 20

TABLE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15


def pieces(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about _CHUNK_BYTES, or of one longer text."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _CHUNK_BYTES, "right")) - 1)
        yield first, last
        first = last


def hasher(values: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Polynomial hashes of values[start : end) for arrays of starts and ends, by prefix sums modulo 2**64."""
    with np.errstate(over="ignore"):
        power = np.concatenate([np.ones(1, np.uint64), np.full(len(values), BASE, np.uint64)]).cumprod(dtype=np.uint64)
        back = np.concatenate([np.ones(1, np.uint64), np.full(len(values), pow(BASE, -1, 1 << 64), np.uint64)]).cumprod(dtype=np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * power[:-1], dtype=np.uint64)])

    def run(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (sums[ends] - sums[starts]) * back[starts]
            return h ^ (h >> np.uint64(32))

    return run


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ of all texts in order, and the offsets of the texts among them."""
    solid = (data != 32) & ((data < 9) | (data > 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True  # words end with their text
    begin, end = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:-1]
    end[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(begin)
    return hasher(TABLE[data])(starts, np.flatnonzero(end) + 1), np.searchsorted(starts, offsets)


def least_places(data: np.ndarray, span: int = SPAN) -> np.ndarray:
    """For each start i the place of the least hash in [i, i + span), the leftmost of equal ones; ends are cut off."""
    n = len(data) - GRAM + 1
    if n < span:
        return np.zeros(0, np.int64)
    return least_of(np.ndarray((n,), "<u8", np.ascontiguousarray(data), 0, (1,)).copy(), span)


def least_of(grams: np.ndarray, span: int) -> np.ndarray:
    """least_places of grams given as numbers, which are overwritten."""
    n = len(grams)
    if n < span:
        return np.zeros(0, np.int64)
    bits = max(20, n.bit_length())
    with np.errstate(over="ignore"):
        grams ^= grams >> np.uint64(29)
        grams *= np.uint64(0xBF58476D1CE4E5B9)
        grams ^= grams >> np.uint64(32)
        grams *= np.uint64(0x94D049BB133111EB)
    grams &= np.uint64((1 << 64) - (1 << bits))
    grams |= np.arange(n, dtype=np.uint64)
    blocks = -(-n // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = grams
    ahead = np.minimum.accumulate(padded.reshape(blocks, span), axis=1).reshape(-1)
    back = np.minimum.accumulate(padded.reshape(blocks, span)[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(back[: n - span + 1], ahead[span - 1 : n])
    return (least & np.uint64((1 << bits) - 1)).astype(np.int64)


def phrases(data: np.ndarray, offsets: np.ndarray, length: int, span: int = SPAN) -> tuple[np.ndarray, ...]:
    """(text, a, b, trigger) of every phrase: the strings of `length` bytes that start in [a, b] have this first trigger.

    Places are in the buffer; a phrase's bytes are [a, b + length), so phrases overlap as windows do.
    """
    return phrases_at(least_places(data, span), offsets, length)


def phrases_at(place: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """The same from the triggers of all places."""
    sizes = np.diff(offsets)
    count = np.maximum(sizes - length + 1, 0)
    texts = np.repeat(np.arange(len(sizes)), count)
    if not len(texts):
        return (np.zeros(0, np.int64),) * 4
    starts = np.arange(len(texts)) - np.repeat(np.cumsum(count) - count, count) + offsets[:-1][texts]
    trigger = place[starts]
    new = np.flatnonzero(np.concatenate([[True], (trigger[1:] != trigger[:-1]) | (texts[1:] != texts[:-1])]))
    last = np.concatenate([new[1:], [len(texts)]]) - 1
    return texts[new], starts[new], starts[last], trigger[new]


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int, chunk: int = 1 << 15) -> np.ndarray:
    """XXH64 of data[start:end), in pieces so that memory stays small."""
    return np.concatenate([np.zeros(0, np.uint64), *[xxh64(data, starts[i : i + chunk], ends[i : i + chunk], seed) for i in range(0, len(starts), chunk)]])
