"""Sets of word shingles of many texts, as sorted 64-bit hashes."""

from __future__ import annotations

import hashlib

import numpy as np

from millrace.llm.words import mix, word_hashes

_U = np.uint64


def _fold(parts: list[np.ndarray]) -> np.ndarray:
    out = mix(parts[0] + _U(len(parts)))
    for p in parts[1:]:
        out = mix(out * _U(3) + p)
    return out


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Per text its distinct runs of `size` words; of fewer words, the whole sequence as one; of none, nothing."""
    words, counts = word_hashes(texts)
    whole = _fold([words[k:len(words) - size + 1 + k] for k in range(size)]) if len(words) >= size else words[:0]
    sets, at = [], 0
    for n in counts.tolist():
        if n >= size:
            own = np.sort(whole[at:at + n - size + 1])
            sets.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        else:
            sets.append(_fold([words[at + k:at + k + 1] for k in range(n)]) if n else words[:0])
        at += n
    return sets


def signature(shingles: np.ndarray) -> bytes:
    """16 bytes that name a set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
