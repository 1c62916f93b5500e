"""Hashes of words and of word shingles for many texts at once, without a Python step per word."""

from __future__ import annotations

import numpy as np

from ionloom.llm.shared import flat

SHINGLE = 5
_P = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers have inverses
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_ONE = np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_known_powers: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0, 1, ... of n numbers; those of usual slices are remembered."""
    known = _known_powers.get(int(base))
    if known is None or len(known) < n:
        known = np.full(n + n // 8 + 1, base, np.uint64)
        known[0] = _ONE
        known = np.multiply.accumulate(known)
        if len(known) <= 2 << 20:
            _known_powers[int(base)] = known
    return known[:n]


def word_edges(buffer: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin and end in the buffer of all texts, and the first word of each text (one more than texts)."""
    solid = np.ones(len(buffer) + 2, bool)
    solid[0] = solid[-1] = False
    np.logical_or(buffer > 32, (buffer < 9) | ((buffer > 13) & (buffer < 32)), out=solid[1:-1])
    rising = solid[1:] & ~solid[:-1]
    falling = solid[:-1] & ~solid[1:]
    inner = starts[(starts > 0) & (starts < len(buffer))]
    cut = inner[solid[inner] & solid[inner + 1]]  # a word at the end of a text meets one at the start of the next
    rising[cut] = True
    falling[cut] = True
    begin, end = np.flatnonzero(rising), np.flatnonzero(falling)
    return begin, end, np.searchsorted(begin, starts)


def word_hashes(items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in turn, and the first word of each text (one more than texts)."""
    hashes, _, _, first = hashed_words(*flat(items))
    return hashes, first


def hashed_words(buffer: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words in turn, and their edges as word_edges has them."""
    begin, end, first = word_edges(buffer, starts)
    total = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum((buffer.astype(np.uint64) + _ONE) * _powers(_P, len(buffer)), out=total[1:])
    inverse = _powers(_P_INVERSE, len(buffer) + 1)
    return mixed((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64)), begin, end, first


def shingle_hashes(items: list[bytes], width: int = SHINGLE, below: int = 1 << 64, distinct: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and where each text's begin (one more than texts).

    A text of fewer words than width has one shingle, of all its words; a text without words has none. Only hashes under
    `below` are kept. With distinct=False, all of them in the text's order.
    """
    words, first = word_hashes(items)
    n = np.diff(first)
    if not len(words):
        return words, first
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    multipliers = mixed(np.arange(1, width + 1, dtype=np.uint64)) | _ONE
    out = np.zeros(len(words), np.uint64)
    place = np.arange(len(words))
    owner = np.repeat(np.arange(len(n)), n)
    last = first[1:][owner]
    for k in range(width):
        out += np.where(place + k < last, padded[k : k + len(words)] * multipliers[k], np.uint64(0))
    out = mixed(out)
    valid = (place + width <= last) | ((n[owner] < width) & (place == first[:-1][owner]))
    if below < 1 << 64:
        valid &= out < np.uint64(below)
    out, owner = out[valid], owner[valid]
    if not distinct:
        return out, np.searchsorted(owner, np.arange(len(n) + 1))
    order = np.argsort(out)
    small = owner[order].astype(np.uint16) if len(n) < 1 << 16 else owner[order]
    order = order[np.argsort(small, kind="stable")]
    out, owner = out[order], owner[order]
    fresh = np.ones(len(out), bool)
    fresh[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    out, owner = out[fresh], owner[fresh]
    return out, np.searchsorted(owner, np.arange(len(n) + 1))
