"""Token ids of all documents, in order, as shards that answer from a wavelet matrix (`wavelet.py`).

Texts are encoded by the tokenizers library, with one end id after each document, and stand in
the order of their ids (NULL first; repeated ids by the hash of their text). Rows are dealt
by ranges of that order, so consecutive documents share a shard of about `SHARD_TOKENS`; a
longer document is not cut, and makes its shard longer. A task writes a shard under a draft name
and renames it, so a repeated task leaves the same file. What is known of a shard, and the tokens before it,
is a row of a table; readers get one file at a time, and a missing file ends the job.

Byte-level vocabularies without a normalizer never join what stands before a space with what
follows, unless white space stands before the space; nor a letter or digit with a mark after it, nor a line
break with what is no white space. Texts are cut there, all texts of a slice at once by their bytes; such segments recur, so
a slice's different ones are told apart in Arrow, and a worker keeps those it has encoded, in two generations of bounded size. New segments go through the library as
one text, whose ids fall to the segments by their bytes. Other vocabularies encode whole texts.

NULL and empty texts are the end id alone. Equal rows give equal results; an empty table has no shard. Other
columns of the table are not read, whatever their names.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.arrow import give_back, slices
from millrace.llm.mapped import map_array, write_array
from millrace.llm.wavelet import Shard, write_shard
from millrace.operators.positions import running_total
from millrace.session import ship_package, work_folder
from millrace.sources.tables import settle

SHARD_TOKENS = 1 << 22
CACHED_SEGMENTS = 500_000  # of each generation
CACHED_CHARS = 64  # longer segments are encoded each time
STRETCH = 50_000  # different segments looked up at once
ENCODED_BYTES = 8 << 20  # of texts whose segments are told apart at once
_SHARD = "place long, name string, n_docs long, n_tokens long"


_ALNUM, _MARK, _SOLID, _SPACE = 1, 2, 4, 8  # of bytes; what is solid is no white space and no part of a longer character
_KIND = np.array([_ALNUM * (c < 128 and chr(c).isalnum()) | _MARK * (chr(c) in ".,;:!?") | _SOLID * (32 < c < 128)
                  | _SPACE * (c == 32) for c in range(256)], np.uint8)
_CUT = np.array([[bool(a & _SOLID and b & _SPACE or a & _ALNUM and b & _MARK) for b in range(16)] for a in range(16)]).ravel()


def _segment_starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where segments start in the bytes of texts that follow each other, `ends` apart (0 first)."""
    kind = _KIND[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = _CUT[kind[:-1] << 4 | kind[1:]]
    at = np.flatnonzero((data[:-1] >= 128) & (data[1:] == 32))  # a space behind a longer character
    back = [data[np.maximum(at - k, 0)] for k in range(3)]  # its last bytes
    white = (back[1] == 0xC2) & ((back[0] == 0x85) | (back[0] == 0xA0))
    white |= (back[2] == 0xE2) & ((back[1] == 0x80) | (back[1] == 0x81))  # more than the white ones: not cut, which is right as well
    white |= ((back[2] == 0xE1) & (back[1] == 0x9A) | (back[2] == 0xE3) & (back[1] == 0x80)) & (back[0] == 0x80)
    cut[at[~white] + 1] = True
    at = np.flatnonzero(data[1:-1] == 10) + 1  # a line break between other characters
    at = at[(kind[at - 1] & _SOLID > 0) & (kind[at + 1] & _SOLID > 0)]
    cut[at + 1] = True
    cut[ends[:-1][np.diff(ends) > 0]] = True
    return np.flatnonzero(cut)


def _is_cut(token: str) -> bool:
    data = np.frombuffer(token.encode(), np.uint8)
    return " " in token or len(_segment_starts(data, np.array([0, len(data)]))) > 1


class SegmentEncoder:
    """Texts to packed ids (little-endian, 32 bits each)."""

    def __init__(self, model: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.library = Tokenizer.from_str(model)
        given = json.loads(model)
        before = given.get("pre_tokenizer") or {}
        own = given.get("added_tokens") or []
        self.cuts = (before.get("type") == "ByteLevel" and before.get("use_regex", True)
                     and not before.get("add_prefix_space") and given.get("normalizer") is None
                     and not any(_is_cut(t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in own))
        if self.cuts:  # a character of a byte-level token is a byte
            size = self.library.get_vocab_size(with_added_tokens=True)
            self.bytes = np.array([len(self.library.id_to_token(k) or "") for k in range(size)], np.int64)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encoded(self, segments: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.library.encode_batch_fast(segments, add_special_tokens=False)]

    def _new(self, segments: list[str]) -> dict[str, bytes]:
        """Segments that start at a space and end in no white space stand side by side as they do in a text."""
        chained = [s for s in segments if s[0] == " " and not s[-1].isspace()]
        alone = [s for s in segments if s[0] != " " or s[-1].isspace()]
        out = dict(zip(alone, self._encoded(alone)))
        if chained:
            packed = self._encoded(["".join(chained)])[0]
            token_ends = np.cumsum(self.bytes[np.frombuffer(packed, "<u4")])
            ends = np.cumsum([len(s.encode()) for s in chained])
            at = np.searchsorted(token_ends, ends)
            if (token_ends[at] != ends).any():
                raise ValueError("a token reaches over the end of a segment")
            cuts = [0, *((at + 1) * 4).tolist()]
            out.update((s, packed[a:b]) for s, a, b in zip(chained, cuts, cuts[1:]))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Segments are cut and told apart in Arrow; Python sees the different ones of `texts` once each."""
        if not self.cuts:
            return self._encoded(texts)
        given = pa.array(texts, pa.large_string())
        _, offsets, data = given.buffers()
        ends = np.frombuffer(offsets, "<i8")[:len(texts) + 1]
        if not ends[-1]:
            return [b""] * len(texts)
        starts = _segment_starts(np.frombuffer(data, np.uint8)[:ends[-1]], ends)
        bounds = pa.py_buffer(np.append(starts, ends[-1]))
        segments = pa.Array.from_buffers(pa.large_string(), len(starts), [None, bounds, data]).dictionary_encode()
        different = segments.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = [i for k in range(0, len(different), STRETCH) for i in self._looked_up(different[k:k + STRETCH])]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))[segments.indices.to_numpy()]
        packed = pa.array(ids, pa.large_binary()).take(segments.indices).buffers()[2]
        cuts = np.concatenate(([0], np.cumsum(sizes)))[np.searchsorted(starts, ends)].tolist()
        packed = memoryview(packed or b"")
        return [bytes(packed[a:b]) for a, b in zip(cuts, cuts[1:])]

    def _looked_up(self, segments: list[str]) -> list[bytes]:
        """The ids of each of some different segments; what is new goes through the library in one call."""
        young, old = self.young, self.old
        found = list(map(young.get, segments))
        gaps = [k for k, ids in enumerate(found) if ids is None]
        missing = [segments[k] for k in gaps]
        if missing:
            young.update((s, old[s]) for s in missing if s in old)
            young.update(self._new([s for s in missing if s not in old]))
            for k, s in zip(gaps, missing):
                found[k] = young[s]
            for s in missing:
                if len(s) > CACHED_CHARS:
                    del young[s]
            if len(young) > CACHED_SEGMENTS:
                self.young, self.old = {}, young
        return found


@lru_cache(maxsize=2)
def encoder(model: str) -> SegmentEncoder:
    return SegmentEncoder(model)


def _write(folder: str, model: str, end_id: int):
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part = encoder(model), TaskContext.get().partitionId()
        ids, packed, held, made = [], [], 0, 0

        def flush() -> pa.RecordBatch:
            name = f"tokens-{part:08d}-{made:06d}"
            sizes = np.array([len(p) // 4 for p in packed], np.int64)
            data = write_shard(ids, sizes, np.frombuffer(b"".join(packed), "<u4"))
            write_array(folder, name, np.frombuffer(data, np.uint8))
            row = [part << 32 | made, name, len(ids), int(sizes.sum())]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=["place", "name", "n_docs", "n_tokens"])

        for batch in batches:
            for some, texts in slices(batch, batch.column(1), ENCODED_BYTES):
                for doc, coded in zip(some.column(0).to_pylist(), code.encode(texts.to_pylist())):
                    ids.append(doc)
                    packed.append(coded + end)
                    held += len(packed[-1]) // 4
                    if held >= SHARD_TOKENS:
                        yield flush()
                        ids, packed, held, made = [], [], 0, made + 1
        if ids:
            yield flush()
        give_back()

    return run


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int = 0, folder: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> tuple[str, DataFrame]:
    """Encode and write all documents (runs jobs); returns the folder and (place, name, n_docs, n_tokens, start) per shard."""
    spark = docs.sparkSession
    ship_package(spark)
    folder = folder or work_folder(spark, "token-shards")
    model = Path(tokenizer_path).read_text()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_hash"),
                       F.monotonically_increasing_id().alias("_row"))
    order = ["_id", "_hash", "_row"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("_id", "_text")
    shards = settle(dealt.mapInArrow(_write(folder, model, end_id), _SHARD), "shards")
    placed = running_total(shards, "n_tokens", "place")
    return folder, settle(placed.withColumn("start", F.col("upto") - F.col("n_tokens")).drop("upto"), "shard-starts")


def _spread(shards: DataFrame) -> DataFrame:
    """Shards dealt over the cluster: a row stands for a file."""
    tasks = max(1, min(shards.count(), 8 * shards.sparkSession.sparkContext.defaultParallelism))
    return shards.repartition(tasks, "place")


def _over_shards(folder: str, shards: DataFrame, work, schema: str, names: list[str]) -> DataFrame:
    """What `work` (shard, its first place) yields, as lists of columns, for every shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for columns in work(Shard(map_array(folder, name, np.uint8)), start):
                    yield pa.RecordBatch.from_arrays(columns, names=names)
        give_back()

    return _spread(shards).select("name", "start").mapInArrow(run, schema)


def read_documents(folder: str, shards: DataFrame, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files; with its packed `ids` if wanted."""
    def work(shard: Shard, start: int) -> Iterator[list[pa.Array]]:
        tokens, ends, doc_ids = shard.tokens(), shard.ends(), shard.doc_ids()
        begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
        for at in range(0, len(ends), 4096):
            stop = at + 4096
            packed = [tokens[a:b].astype("<u4").tobytes() for a, b in zip(begins[at:stop], ends[at:stop])]
            columns = [pa.array(doc_ids[at:stop], pa.int64()), pa.array(begins[at:stop] + start),
                       pa.array((ends - begins)[at:stop]), pa.array([zlib.crc32(p) for p in packed], pa.int64())]
            yield [*columns, pa.array(packed, pa.binary())] if with_ids else columns

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return _over_shards(folder, shards, work, schema, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:4 + with_ids])


def count_tokens(folder: str, shards: DataFrame, tokens: Sequence[int]) -> DataFrame:
    """(token, n): how often each occurs in all documents, by rank."""
    def work(shard: Shard, start: int) -> Iterator[list[pa.Array]]:
        yield [pa.array(list(tokens), pa.int64()), pa.array([shard.count(t) for t in tokens], pa.int64())]

    found = _over_shards(folder, shards, work, "token long, n long", ["token", "n"])
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def find_token(folder: str, shards: DataFrame, token: int) -> DataFrame:
    """(doc_id, place): every occurrence of a token, by select; `place` counts the tokens of all documents before it."""
    def work(shard: Shard, start: int) -> Iterator[list[pa.Array]]:
        ends, doc_ids = shard.ends(), shard.doc_ids()
        every = shard.count(token)
        for k in range(0, every, 4096):
            at = np.array([shard.select(token, j) for j in range(k, min(every, k + 4096))], np.int64)
            yield [pa.array([doc_ids[d] for d in np.searchsorted(ends, at, "right")], pa.int64()), pa.array(at + start)]

    return _over_shards(folder, shards, work, "doc_id long, place long", ["doc_id", "place"])
