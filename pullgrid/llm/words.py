"""Words and word hashes of many texts at once, on their bytes.

A word is a run of bytes other than space and 0x09 to 0x0D; A-Z count as a-z. Its hash
is a sum over its bytes of a random 64-bit value of the byte times a random one of the
place, mixed at the end, so that two words share one with a chance near 2^-62.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PLACES = 64  # longer words are hashed one by one

_random = np.random.default_rng(20_240_117)
_draw = lambda n: _random.integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE, _PLACE, _STEP, _COUNT = _draw(256), _draw(PLACES), _draw(16), _draw(64)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True
BLANK_OR_MARK = BLANK.copy()  # ASCII punctuation parts words too
BLANK_OR_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all bits (one to one)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """Of consecutive texts: each word's hash, first and last byte, and the words of each text."""

    hashes: np.ndarray  # uint64
    starts: np.ndarray
    stops: np.ndarray
    bounds: np.ndarray  # text i has words bounds[i] : bounds[i + 1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def words_of(flat: np.ndarray, ends: np.ndarray, blank: np.ndarray = BLANK) -> Words:
    """flat: the texts' UTF-8 bytes end to end; ends: their offsets, from 0."""
    solid = ~blank[flat]
    edge = np.zeros(len(flat) + 1, bool)
    edge[ends] = True
    before = np.zeros(len(flat), bool)
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.zeros(len(flat), bool)
    after[:-1] = solid[1:]
    stops = np.flatnonzero(solid & (~after | edge[1:])) + 1
    sizes = stops - starts
    at = np.flatnonzero(solid)
    place = at - np.repeat(starts, sizes)
    value = _BYTE[flat[at]] * _PLACE[np.minimum(place, PLACES - 1)]
    sums = np.zeros(len(at) + 1, np.uint64)
    np.cumsum(value, out=sums[1:])
    cuts = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=cuts[1:])
    hashes = mixed(sums[cuts[1:]] - sums[cuts[:-1]])
    for k in np.flatnonzero(sizes > PLACES):
        hashes[k] = _long_hash(flat[starts[k] : stops[k]])
    return Words(hashes, starts, stops, np.searchsorted(starts, ends))


def _long_hash(word: np.ndarray) -> np.uint64:
    import hashlib

    digest = hashlib.blake2b(_LOWER[word].tobytes(), digest_size=8).digest()
    return np.frombuffer(digest, np.uint64)[0]


def shingle_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets per text) of all runs of n words; a shorter text is one run by itself."""
    counts = words.counts
    runs = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    ends = np.zeros(len(runs) + 1, np.int64)
    np.cumsum(runs, out=ends[1:])
    total = len(words.hashes)
    out = np.zeros(ends[-1], np.uint64)
    if total >= n:
        rolled = np.zeros(total - n + 1, np.uint64)
        for k in range(n):
            rolled += words.hashes[k : total - n + 1 + k] * _STEP[k]
        long_ = counts >= n
        shift = np.repeat(words.bounds[:-1][long_] - ends[:-1][long_], runs[long_])
        place = np.repeat(long_, runs)
        spots = np.flatnonzero(place)
        out[spots] = rolled[spots + shift]
    for i in np.flatnonzero((counts > 0) & (counts < n)):
        own = words.hashes[words.bounds[i] : words.bounds[i + 1]]
        out[ends[i]] = np.sum(np.append(own * _STEP[: len(own)], _COUNT[len(own)]))
    return mixed(out), ends


def distinct_per_text(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct hashes in ascending order, and their offsets."""
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    counts = np.bincount(text[new], minlength=len(ends) - 1)
    out = np.zeros(len(ends), np.int64)
    np.cumsum(counts, out=out[1:])
    return hashes[new], out
