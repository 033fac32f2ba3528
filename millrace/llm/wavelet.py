"""A wavelet matrix of token ids in one compressed file, with the documents that it holds.

One plane of bits for each binary digit of the ids, the highest first; below every plane
the ids stand in the order zeros first, then ones, each side in its former order. Which of a
plane's bits are one, and how many stand before a place (rank) or where the k-th is (select),
answers what the id at a place is, how often an id occurs before a place and where.

A plane is cut into blocks of 2^16 bits. A directory holds the ones before every block and
its place in the file; a block is stored by zstd or as it is, whichever is shorter. One answer
reads a block or two of each plane, a whole shard is decoded plane by plane from below.

File: the magic, the header's length, the header (JSON: n, planes, documents, sections), and
the sections: ids of the documents, which of them are NULL, their ends, zeros of the planes,
directory, blocks. Numbers are little-endian.
"""

from __future__ import annotations

import json
import struct

import numpy as np
import zstandard

MAGIC = b"MRWM0001"
BLOCK_BITS = 1 << 16
_WORDS = BLOCK_BITS // 64
_ONE = np.uint64(1)


def _packed_words(mask: np.ndarray) -> np.ndarray:
    """Bits as 64-bit words, padded with zeros to whole blocks."""
    blocks = -(-len(mask) // BLOCK_BITS)
    out = np.zeros(blocks * BLOCK_BITS // 8, np.uint8)
    out[:(len(mask) + 7) // 8] = np.packbits(mask, bitorder="little")
    return out.view("<u8")


def _narrow(planes: int):
    return np.uint16 if planes <= 16 else np.uint32


def planes_of(ids: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
    """The words of every plane, highest digit first, and its number of zeros."""
    digits = max(1, int(ids.max(initial=0)).bit_length())
    rest, words, zeros = ids.astype(_narrow(digits)), [], []
    below, ones = np.empty_like(rest), np.empty_like(rest)
    for k in range(digits - 1, -1, -1):
        mask = (rest & rest.dtype.type(1 << k)) != 0
        words.append(_packed_words(mask))
        low = high = 0
        for at in range(0, len(rest), BLOCK_BITS):  # a block and its parts stay in a core's cache
            part, is_one = rest[at:at + BLOCK_BITS], mask[at:at + BLOCK_BITS]
            one, zero = part.compress(is_one), part.compress(~is_one)
            below[low:low + len(zero)], ones[high:high + len(one)] = zero, one
            low, high = low + len(zero), high + len(one)
        zeros.append(low)
        below[low:] = ones[:high]
        rest, below = below, rest
    return words, zeros


def write_shard(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """The file of consecutive documents: their ids, tokens of each, and all tokens."""
    words, zeros = planes_of(ids)
    press = zstandard.ZstdCompressor(level=3)
    directory, blocks, at = [], [], 0
    for plane in words:
        by_block = plane.reshape(-1, _WORDS)
        before = np.cumsum(np.bitwise_count(by_block).sum(axis=1, dtype=np.uint64))
        for k, block in enumerate(by_block):
            raw = block.tobytes()
            short = press.compress(raw)
            blocks.append(short if len(short) < len(raw) else raw)
            directory.append((before[k - 1] if k else 0, at, len(blocks[-1])))
            at += len(blocks[-1])
    null = np.array([d is None for d in doc_ids], bool)
    sections = {
        "doc_ids": press.compress(np.array([d or 0 for d in doc_ids], "<i8").tobytes()),
        "nulls": press.compress(np.packbits(null, bitorder="little").tobytes()),
        "ends": press.compress(np.cumsum(sizes, dtype="<u8").tobytes()),
        "zeros": np.array(zeros, "<u8").tobytes(),
        "directory": np.array(directory, "<u8").tobytes(),
        "blocks": b"".join(blocks),
    }
    header = json.dumps({"n": len(ids), "planes": len(zeros), "documents": len(doc_ids),
                         "sections": {name: len(data) for name, data in sections.items()}}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *sections.values()])


class Shard:
    """Answers from one file, given as its bytes or a map of them."""

    def __init__(self, data: np.ndarray | bytes):
        self._data = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
        if bytes(self._data[:8]) != MAGIC:
            raise ValueError("not a shard of tokens")
        size = struct.unpack("<I", bytes(self._data[8:12]))[0]
        header = json.loads(bytes(self._data[12:12 + size]))
        self.n, self.planes, self.documents = header["n"], header["planes"], header["documents"]
        self._at, at = {}, 12 + size
        for name, length in header["sections"].items():
            self._at[name] = (at, at + length)
            at += length
        self._expand = zstandard.ZstdDecompressor()
        self.zeros = np.frombuffer(self._section("zeros"), "<u8").astype(np.int64)
        self._directory = np.frombuffer(self._section("directory"), "<u8").reshape(self.planes, -1, 3)
        self._held: dict[tuple[int, int], np.ndarray] = {}

    def _section(self, name: str) -> bytes:
        a, b = self._at[name]
        return bytes(self._data[a:b])

    def doc_ids(self) -> list[int | None]:
        ids = np.frombuffer(self._expand.decompress(self._section("doc_ids")), "<i8")
        null = np.unpackbits(np.frombuffer(self._expand.decompress(self._section("nulls")), np.uint8),
                             bitorder="little")[:len(ids)]
        return [None if absent else int(d) for d, absent in zip(ids, null)]

    def ends(self) -> np.ndarray:
        """Tokens up to and with each document."""
        return np.frombuffer(self._expand.decompress(self._section("ends")), "<u8").astype(np.int64)

    def _block(self, plane: int, k: int) -> np.ndarray:
        """Words of a block; a few stay at hand."""
        if (plane, k) not in self._held:
            if len(self._held) > 4 * self.planes:
                self._held.clear()
            _, at, size = (int(x) for x in self._directory[plane, k])
            start = self._at["blocks"][0] + at
            raw = bytes(self._data[start:start + size])
            self._held[plane, k] = np.frombuffer(
                raw if size == BLOCK_BITS // 8 else self._expand.decompress(raw, BLOCK_BITS // 8), "<u8")
        return self._held[plane, k]

    def _ones(self, plane: int, at: int) -> int:
        """Ones before a place of a plane."""
        blocks = self._directory.shape[1]
        k, rest = divmod(at, BLOCK_BITS)
        if k == blocks:
            return self.n - int(self.zeros[plane])
        words, out = self._block(plane, k), int(self._directory[plane, k, 0])
        full, bits = divmod(rest, 64)
        out += int(np.bitwise_count(words[:full]).sum())
        if bits:
            out += int(np.bitwise_count(words[full] & ((_ONE << np.uint64(bits)) - _ONE)))
        return out

    def _bit(self, plane: int, at: int) -> int:
        k, rest = divmod(at, BLOCK_BITS)
        return int(self._block(plane, k)[rest // 64] >> np.uint64(rest % 64) & _ONE)

    def _find(self, plane: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) bit of that value in a plane."""
        before = self._directory[plane, :, 0].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK_BITS - before
        block = int(np.searchsorted(before, k, "right")) - 1
        bits = np.unpackbits(self._block(plane, block).view(np.uint8), bitorder="little")
        return block * BLOCK_BITS + int(np.flatnonzero(bits == bit)[k - before[block]])

    def access(self, at: int) -> int:
        """The token at a place of the shard."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        token = 0
        for plane in range(self.planes):
            bit, ones = self._bit(plane, at), self._ones(plane, at)
            token = token << 1 | bit
            at = int(self.zeros[plane]) + ones if bit else at - ones
        return token

    def _range(self, token: int, stop: int) -> tuple[int, int]:
        """Where, below the last plane, the occurrences of a token before `stop` stand."""
        if token >> self.planes:
            return 0, 0
        a, b = 0, stop
        for plane in range(self.planes):
            ones_a, ones_b = self._ones(plane, a), self._ones(plane, b)
            if token >> (self.planes - 1 - plane) & 1:
                a, b = int(self.zeros[plane]) + ones_a, int(self.zeros[plane]) + ones_b
            else:
                a, b = a - ones_a, b - ones_b
        return a, b

    def rank(self, token: int, at: int) -> int:
        """Occurrences of a token before a place."""
        a, b = self._range(token, at)
        return b - a

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of a token."""
        a, b = self._range(token, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        at = a + k
        for plane in range(self.planes - 1, -1, -1):
            bit = token >> (self.planes - 1 - plane) & 1
            at = self._find(plane, bit, at - int(self.zeros[plane]) * bit)
        return at

    def tokens(self) -> np.ndarray:
        """All tokens, from the lowest plane up."""
        out = np.zeros(self.n, _narrow(self.planes))
        above = np.empty_like(out)
        for plane in range(self.planes - 1, -1, -1):
            low, high = 0, int(self.zeros[plane])
            out[high:] |= out.dtype.type(1 << self.planes - 1 - plane)
            for k in range(self._directory.shape[1]):
                here = above[k * BLOCK_BITS:(k + 1) * BLOCK_BITS]
                mask = np.unpackbits(self._block(plane, k).view(np.uint8), count=len(here), bitorder="little").view(bool)
                zero, one = np.flatnonzero(~mask), np.flatnonzero(mask)
                here[zero], here[one] = out[low:low + len(zero)], out[high:high + len(one)]
                low, high = low + len(zero), high + len(one)
            out, above = above, out
        return out
