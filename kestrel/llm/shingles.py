"""Word shingles of texts as sorted sets of 64-bit fingerprints, in numpy.

Words are the runs of bytes other than blank, tab, line feed, vertical tab, form
feed and carriage return, A-Z lower-cased. Five words make a shingle; a text of
one to four words is one shingle as a whole; a text without words has none. Two
different shingles share a 64-bit fingerprint with a chance of 2**-64, so sets of
fingerprints are compared in place of sets of shingles.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
for _b in range(ord("A"), ord("Z") + 1):
    _BYTE[_b] = _BYTE[_b + 32]
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
# For texts compared whatever their punctuation: all ASCII but letters and digits.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_BASE = U(0x9E3779B97F4A7C15)
_PLACE = _RNG.integers(1, 1 << 63, 8, dtype=np.uint64) | U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def word_hashes(data: np.ndarray, ends: np.ndarray, separator: np.ndarray = _SEPARATOR
                ) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint of each word of the texts that lie one after the other in
    ``data`` and end at ``ends``; and the number of words of each text."""
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(ends), np.int64)
    inside = ~separator[data]
    border = np.zeros(len(data) + 1, dtype=bool)
    border[ends] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | border[1:-1]
    first = np.flatnonzero(start)
    if not len(first):
        return np.empty(0, np.uint64), np.zeros(len(ends), np.int64)
    at = np.flatnonzero(inside)
    word = np.cumsum(start)[at] - 1
    place = at - first[word]
    power = np.cumprod(np.concatenate([[U(1)], np.full(int(place.max()), _BASE, dtype=np.uint64)]))
    head = np.flatnonzero(place == 0)
    sums = np.add.reduceat(_BYTE[data[at]] * power[place], head)
    size = np.diff(np.append(head, len(at)))
    return mix(sums + size.astype(np.uint64) * _PLACE[7]), np.diff(np.searchsorted(first, np.concatenate([[0], ends])))


def shingle_sums(words: np.ndarray, count: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each shingle in order: its fingerprint before mixing, its first word, its text."""
    text = np.repeat(np.arange(len(count)), count)
    upto = np.repeat(np.cumsum(count), count)
    first = np.flatnonzero(np.arange(len(words)) + width <= upto)
    sums = np.zeros(len(first), dtype=np.uint64)
    for k in range(width):
        sums += words[first + k] * _PLACE[k]
    return sums, first, text[first]


def shingle_sets(data: np.ndarray, ends: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle fingerprints of each text, one text after the other,
    and the size of each text's set."""
    words, count = word_hashes(data, ends)
    prints, _, owner = shingle_sums(words, count, width)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        base = (np.cumsum(count) - count)[short]
        whole = np.zeros(len(short), dtype=np.uint64)
        for k in range(width - 1):
            has = count[short] > k
            whole[has] += words[base[has] + k] * _PLACE[k]
        whole += count[short].astype(np.uint64) * _PLACE[6]  # no such sum is a full shingle's
        prints, owner = np.concatenate([prints, whole]), np.concatenate([owner, short])
    prints = mix(prints)
    order = np.lexsort((prints, owner))
    prints, owner = prints[order], owner[order]
    if len(prints):
        fresh = np.ones(len(prints), dtype=bool)
        fresh[1:] = (prints[1:] != prints[:-1]) | (owner[1:] != owner[:-1])
        prints, owner = prints[fresh], owner[fresh]
    return prints, np.bincount(owner, minlength=len(ends))
