"""64-bit hashes of the words of many texts at once.

A word is a run of characters other than space, tab and line breaks
(`[^\\x20\\x09-\\x0D]+`), with A-Z lower-cased. Its hash is a polynomial over
per-byte random values, finished by a bijective mix, modulo 2^64.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

WINDOW_BYTES = 4 << 20
_U = np.uint64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORD = np.array([c != 32 and not 9 <= c <= 13 for c in range(256)])
_DRAWN = np.random.default_rng(515).integers(1, 2**63, 258, np.uint64)
_VALUES, _BASE, END = _DRAWN[:256], _DRAWN[256] | _U(1), _DRAWN[257]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


@lru_cache(maxsize=1)
def _powers(bits: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(1 << bits, _BASE, np.uint64))


def _hash_window(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of every word in lower-cased data that starts and ends between words."""
    a = np.frombuffer(data, np.uint8)
    inside = _WORD[a]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    at = np.flatnonzero(inside)
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    offset = np.arange(len(at)) - np.repeat(first, sizes)
    powers = _powers(max(16, int(sizes.max()).bit_length()))
    return mix(np.add.reduceat(_VALUES[a[at]] * powers[offset], first) + sizes.astype(np.uint64)), starts


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, number of words of each text)."""
    encoded = [t.encode() for t in texts]
    data = b"\n".join(encoded).translate(_LOWER)
    hashes, places, at = [], [], 0
    while at < len(data):
        stop = len(data)
        if stop - at > WINDOW_BYTES:  # cut behind a separator; a longer word stays whole
            cuts = (data.find(c, at + WINDOW_BYTES) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            stop = min((c for c in cuts if c >= 0), default=stop)
        h, s = _hash_window(data[at:stop])
        hashes.append(h)
        places.append(s + at)
        at = stop
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    ends = np.cumsum([len(e) + 1 for e in encoded])
    counts = np.diff(np.searchsorted(np.concatenate(places), ends), prepend=0)
    return np.concatenate(hashes), counts


def token_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of each text and one END after it, number of tokens of each text)."""
    words, counts = word_hashes(texts)
    tokens = np.full(len(words) + len(texts), END, np.uint64)
    tokens[np.arange(len(words)) + np.repeat(np.arange(len(texts)), counts)] = words
    return tokens, counts + 1
