"""SentencePiece encoding of merge-type (BPE) vocabularies, and decoding.

A text's symbols are its characters; adjacent pairs that form a piece wait in an
agenda ordered by score, then by place. The best pair is merged, its new
neighbours join the agenda, and pairs whose symbols are gone are skipped. What is
left is looked up; a symbol without a piece becomes its UTF-8 bytes.

A piece that spans two characters holds them side by side, so a text can be cut
wherever no piece of the vocabulary does: before a space, around a line break, and
before a character of the largest set (mostly punctuation) that no piece has after
any other character. Such segments recur; a worker encodes one once and keeps it in
two generations of bounded size, of which the older is dropped. Every segment that
enters is held against the sentencepiece library, a batch at a time; a difference
ends the job. Decoding is the library's.

NULL and empty texts give the begin and end ids only. Equal rows give equal results.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from millrace.llm.arrow import map_texts

SPACE = "▁"
CACHED_SEGMENTS = 250_000  # of each generation
CACHED_CHARS = 64  # longer segments are encoded each time
STRETCH = 50_000  # segments of a text looked up at once


def starters(pieces: list[str]) -> set[str]:
    """Characters that no piece has after a character outside this set (a leading space aside)."""
    pairs = {(a, b) for p in pieces for a, b in zip(p, p[1:]) if a != SPACE}
    found = {c for p in pieces for c in p if not c.isalpha() and c != SPACE}
    while bad := {b for a, b in pairs if b in found and a not in found}:
        found -= bad
    return found


class MergeEncoder:
    """Texts to packed ids (little-endian, 32 bits each), segment by segment."""

    def __init__(self, proto: bytes):
        sp = self.library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        if sp.normalize("  a  b ") != f"{SPACE * 3}a{SPACE * 2}b{SPACE}":
            raise ValueError("only models that keep the text as it is, with a space before it, are encoded here")
        every = range(sp.get_piece_size())
        plain = [i for i in every if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.ids = {sp.id_to_piece(i): i for i in plain}
        self.scores = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        self.bytes = {int(sp.id_to_piece(i)[1:-1], 16): i for i in every if sp.is_byte(i)}
        if len(self.bytes) < 256:
            raise ValueError("the model has no byte pieces")
        self.begin, self.end = (np.array([i], "<u4").tobytes() for i in (sp.bos_id(), sp.eos_id()))
        long = [p for p in self.ids if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in long):
            raise ValueError("the model has pieces that continue after a word or a line")
        first = "".join(map(re.escape, sorted(starters(long) - {"\n"}))) or "\n"
        self.segments = re.compile(f" *[{first}]*[^{first} \n]+| *[{first}]+| +|\n").findall
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merge(self, segment: str) -> list[int]:
        """Ids of one segment by the agenda."""
        symbols, scores = list(segment.replace(" ", SPACE)), self.scores
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(-scores[p], i, p) for i in range(n - 1) if (p := symbols[i] + symbols[i + 1]) in scores]
        heapify(agenda)
        while agenda:
            _, i, piece = heappop(agenda)
            j = after[i]
            if j >= n or symbols[i] is None or symbols[i] + symbols[j] != piece:
                continue
            symbols[i], symbols[j] = piece, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (p := piece + symbols[k]) in scores:
                    heappush(agenda, (-scores[p], i, p))
            h = before[i]
            if h >= 0 and (p := symbols[h] + piece) in scores:
                heappush(agenda, (-scores[p], h, p))
        ids = self.ids
        return list(chain.from_iterable(
            (ids[s],) if s in ids else [self.bytes[b] for b in s.encode()] for s in symbols if s is not None))

    def checked(self, segments: list[str]) -> list[bytes]:
        """Packed ids of segments, each equal to the library's."""
        ours = [self.merge(s) for s in segments]
        # A line break before a segment keeps the library's own leading space off it.
        theirs = self.library.encode(["\n" + s for s in segments], num_threads=1)
        for s, a, b in zip(segments, ours, theirs):
            if a != b[2:]:
                raise ValueError(f"the segment {s[:80]!r} is encoded as {a[:20]}, by the library as {b[2:22]}")
        return [struct.pack(f"<{len(a)}I", *a) for a in ours]

    def encode(self, text: str) -> bytes:
        """Packed ids of a text, with begin and end."""
        if not text:
            return self.begin + self.end
        segments = self.segments(" " + text.replace(SPACE, " "))
        return b"".join([self.begin, *(self._stretch(segments[k:k + STRETCH])
                                       for k in range(0, len(segments), STRETCH)), self.end])

    def _stretch(self, segments: list[str]) -> bytes:
        young, old = self.young, self.old
        if missing := [s for s in set(segments) if s not in young]:
            fresh = [s for s in missing if s not in old]
            young.update((s, old[s]) for s in missing if s in old)
            young.update(zip(fresh, self.checked(fresh)))
        packed = b"".join(map(young.__getitem__, segments))
        for s in missing:
            if len(s) > CACHED_CHARS:
                del young[s]
        if len(young) > CACHED_SEGMENTS:
            self.young, self.old = {}, young
        return packed

    def decode(self, packed: bytes) -> str:
        return self.library.decode(np.frombuffer(packed, "<u4").tolist())


@lru_cache(maxsize=2)
def encoder(proto: bytes) -> MergeEncoder:
    """One encoder, with its cache, per worker and model."""
    return MergeEncoder(proto)


def encode_decode(docs: DataFrame, model_path: str, keep: tuple[str, ...] = ("doc_id",),
                  text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: the columns `keep`, n_tokens, ids, decoded; `ids` is packed, 32 bits little-endian each.

    The model is read on the driver and sent along; vocabularies are below a few megabytes.
    """
    proto = Path(model_path).read_bytes()

    def start():
        pieces = encoder(proto)

        def work(texts: list[str]) -> list[list]:
            packed = [pieces.encode(t) for t in texts]
            return [[len(p) // 4 for p in packed], packed, [pieces.decode(p) for p in packed]]

        return work

    made = {"n_tokens": (pa.int64(), "long"), "ids": (pa.binary(), "binary"), "decoded": (pa.string(), "string")}
    return map_texts(docs, text_col, {c: c for c in keep}, made, start)
