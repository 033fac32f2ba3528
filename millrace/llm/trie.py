"""The trie of conversation prefixes, from range minima over sorted longest common prefixes.

A conversation is the string of its turns' digests (16 bytes of SHA-256 over role and text), so prefixes
stand side by side in the order of these strings. Rows are dealt by ranges of that order and taken in blocks
of bounded size. In a block, a sparse table over the common prefixes of neighbours
answers how far a prefix reaches: every candidate, a conversation and a depth, searches its left
and its right extent by halving steps, each on its own, no stack. A candidate that is its own left end is a node; its
subtree is a run of nodes, so sums over it are differences.

A node that touches an end of its block may go on beyond. Its numbers travel on the first and the last
conversation of the block, the edges, which are the conversations of the next level; levels follow until one block
holds all edges (two of a block of 32,768 conversations). A prefix that any share of all rows begin with is
so counted in parts. Members that end at a node are hashed in id order, in pieces, by a pass that
holds one batch: the digest of all ids is one string by definition.

NULL roles and texts are empty. Turns stand by number, NULL first, and of one number by digest. Conversations
without turns are members of the root; with no conversations there is no root. A NULL id is a conversation too,
which names no node and stands in no list of ids. Equal rows are equal turns; other columns are not read. One
conversation is one row, with 24 bytes for each turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.arrow import give_back
from millrace.session import ship_package
from millrace.sources.tables import settle

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_CONVS, BLOCK_TURNS = 1 << 15, 1 << 20  # a block ends at either
EDGES_AT_ONCE = 1 << 15  # edges that one block takes; more go through a level of their own
PIECE_IDS = 256
NODE, EDGE, PIECE = range(3)
_SIZE = 16
_NONE = np.iinfo(np.int64).max
_PARTS = ("counts", "least", "starts", "leaves", "saved")
_FACTS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
_OUT = {"kind": pa.int32(), **dict.fromkeys(_FACTS, pa.int64()), "ends_sha256": pa.string(), "hash": pa.binary(),
        "parent_hash": pa.binary(), "key": pa.binary(), "words": pa.list_(pa.int64()),
        **dict.fromkeys(_PARTS, pa.list_(pa.int64())), "ids": pa.string()}
_DDL = ", ".join(f"{n} " + {"int32": "int", "int64": "long", "string": "string", "binary": "binary"}.get(
    str(t), "array<long>") for n, t in _OUT.items())


def turn_sequences(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """One row per conversation: (id, turns), an array of (turn, digest, words) in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    digest = F.left(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), F.lit(2 * _SIZE))
    words = F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long")
    made = turns.select(F.col(id_col).alias("id"), F.struct(
        F.col(turn_col).alias("turn"), digest.alias("digest"), words.alias("words")).alias("one"))
    return made.groupBy("id").agg(F.sort_array(F.collect_list("one")).alias("turns"))


def share_heads(sequences: DataFrame, head: Column, base: Column) -> DataFrame:
    """The first `head` turns of every conversation replaced by those of the conversation `base`, none if that is absent."""
    heads = sequences.select(F.col("id").alias("_base"), F.col("turns").alias("_theirs"))
    joined = sequences.withColumns({"_h": head, "_of": base}).join(heads, F.col("_of") == F.col("_base"), "left")
    theirs = F.when(F.col("_theirs").isNull(), F.slice("turns", F.lit(1), F.lit(0))).otherwise(
        F.slice("_theirs", F.lit(1), F.col("_h")))
    return joined.select("id", F.concat(theirs, F.slice("turns", F.col("_h") + 1, F.size("turns"))).alias("turns"))


def _common(flat: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Common leading turns of each row and the one before it; -1 for the first row."""
    out = np.minimum(length[:-1], length[1:])
    owner = np.repeat(np.arange(len(out)), out)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(out) - out, out)
    differs = np.flatnonzero((flat[first[owner] + step] != flat[first[owner + 1] + step]).any(axis=1))
    rows, at = np.unique(owner[differs], return_index=True)
    out[rows] = step[differs[at]]
    return np.concatenate(([-1], out))


def _sparse(values: np.ndarray) -> list[np.ndarray]:
    """Minima of every run of 1, 2, 4 ... values."""
    table, k = [values], 1
    while 2 * k <= len(values):
        table.append(np.minimum(table[-1][:-k], table[-1][k:]))
        k *= 2
    return table


def extents(common: np.ndarray, row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last row that share the leading `depth` turns of each given row."""
    table = _sparse(common)
    left, right, last = row.copy(), row.copy(), len(common) - 1
    for k in range(len(table) - 1, -1, -1):
        step, top = 1 << k, len(table[k]) - 1
        go = (left >= step) & (table[k][np.clip(left - step + 1, 0, top)] >= depth)
        left = np.where(go, left - step, left)
        go = (right + step <= last) & (table[k][np.clip(right + 1, 0, top)] >= depth)
        right = np.where(go, right + step, right)
    return left, right


def _node_hash(key: bytes, depth: int) -> bytes:
    return hashlib.blake2b(key[:_SIZE * depth], digest_size=16).digest()


def _joined(ids: list[int | None]) -> str:
    return ",".join(str(i) for i in ids if i is not None)


def _block(keys: list[bytes], words: list[np.ndarray], parts: dict[str, np.ndarray], ids: list | None, whole: bool) -> dict[str, list]:
    """The rows that a block gives: nodes that end in it, edges, and pieces of the lists of ids.

    `parts` hold, for every row and each depth from 0 to its length, what lower levels know; `ids` are given on the
    lowest level. In the block of all edges every node ends.
    """
    out: dict[str, list] = {name: [] for name in _OUT}

    def put(**row) -> None:
        for name, column in out.items():
            column.append(row.get(name))

    n, length = len(keys), np.array([len(k) // _SIZE for k in keys], np.int64)
    first = np.cumsum(length) - length
    flat = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
    common = _common(flat, first, length)
    begin = np.cumsum(length + 1) - (length + 1)  # of a row's candidates
    row = np.repeat(np.arange(n), length + 1)
    depth = np.arange(len(row)) - begin[row]
    left, right = extents(common, row, depth)
    is_node = left == row
    node = (np.cumsum(is_node) - 1)[begin[left] + depth]  # of every candidate
    at = np.flatnonzero(is_node)
    start, d, end = row[at], depth[at], right[at]
    ends_here = np.ones(len(at), bool) if whole else (start > 0) & (end < n - 1)
    parent = np.where(d > 0, node[np.maximum(at - 1, 0)], -1)  # the candidate before is one turn shorter
    total = {}
    for name, values in parts.items():
        total[name] = np.full(len(at), _NONE) if name == "least" else np.zeros(len(at), np.int64)
        (np.minimum if name == "least" else np.add).at(total[name], node, values)
    inner = ends_here & (parent >= 0)
    np.add.at(total["starts"], parent[inner], 1)
    last_words = np.zeros(len(at), np.int64)
    spoken = np.concatenate(words) if words else np.empty(0, np.int64)
    last_words[d > 0] = spoken[(first[start] + d - 1)[d > 0]]
    own = {"leaves": ((total["starts"] == 0) & ends_here).astype(np.int64),
           "saved": np.where(ends_here, (total["counts"] - 1) * last_words, 0)}
    stop = np.searchsorted(start, end, "right")  # a subtree is a run of nodes
    for name, values in own.items():
        upto = np.concatenate(([0], np.cumsum(values)))
        total[name] = total[name] + upto[stop] - upto[np.arange(len(at))]

    digests: dict[int, str] = {}
    if ids is not None:
        final = node[begin + length]
        edges = np.flatnonzero(np.diff(final, prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:]):
            x = int(final[a])
            if ends_here[x]:
                digests[x] = hashlib.sha256(_joined(ids[a:b]).encode()).hexdigest()
                continue
            for k in range(a, b, PIECE_IDS):
                some = [i for i in ids[k:min(b, k + PIECE_IDS)] if i is not None]
                if some:
                    put(kind=PIECE, hash=_node_hash(keys[a], int(length[a])), conv_id=some[0], ids=_joined(some))
    nothing = hashlib.sha256(b"").hexdigest()
    for x in np.flatnonzero(ends_here).tolist():
        above, key = int(parent[x]), keys[start[x]]
        known = above >= 0 and ends_here[above]
        put(kind=NODE, conv_id=_name(total["least"][x]), depth=int(d[x]), n_convs=int(total["counts"][x]),
            parent_conv_id=_name(total["least"][above]) if known else None,
            parent_hash=None if known or above < 0 else _node_hash(key, int(d[x]) - 1),
            hash=_node_hash(key, int(d[x])) if ids is None else None,
            ends_sha256=digests.get(x, nothing) if ids is not None else None,
            n_children=int(total["starts"][x]), n_leaves=int(total["leaves"][x]), saved_tokens=int(total["saved"][x]))
    if not whole:
        for e in {0, n - 1}:
            mine = node[begin[e]:begin[e] + length[e] + 1]
            told = (start[mine] > 0) | (e == 0)  # what reaches from edge to edge travels on the first
            put(kind=EDGE, key=keys[e], words=words[e], **{
                name: np.where(told, total[name][mine], _NONE if name == "least" else 0) for name in _PARTS})
    return out


def _name(least: int) -> int | None:
    return None if least == _NONE else int(least)


def _batch(rows: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[c], t) for c, t in _OUT.items()], names=list(_OUT))


def _first_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted conversations (id, key, words), a block at a time."""
    ids, keys, words, turns = [], [], [], 0

    def flush() -> pa.RecordBatch:
        sizes = np.array([len(w) + 1 for w in words])
        parts = {name: np.zeros(int(sizes.sum()), np.int64) for name in _PARTS}
        parts["counts"] += 1
        parts["least"] = np.repeat(np.array([_NONE if i is None else i for i in ids], np.int64), sizes)
        return _batch(_block(keys, words, parts, ids, False))

    for batch in batches:
        for i, key, said in zip(*(batch.column(k).to_pylist() for k in range(3))):
            ids.append(i)
            keys.append(key)
            words.append(np.array(said, np.int64))
            turns += len(said)
            if len(ids) >= BLOCK_CONVS or turns >= BLOCK_TURNS:
                yield flush()
                ids, keys, words, turns = [], [], [], 0
    if ids:
        yield flush()
    give_back()


def _next_level(whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted edges (key, words and what is known at each depth) of one block."""
        keys, words, parts = [], [], {name: [] for name in _PARTS}
        for batch in batches:
            keys += batch.column(0).to_pylist()
            words += [np.array(w, np.int64) for w in batch.column(1).to_pylist()]
            for k, name in enumerate(_PARTS, 2):
                parts[name] += [np.array(p, np.int64) for p in batch.column(k).to_pylist()]
        if keys:
            yield _batch(_block(keys, words, {name: np.concatenate(p) for name, p in parts.items()}, None, whole))
        give_back()

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (hash, ids) in order to one digest per hash."""
    now, state = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], names=["_of", "_ends"])

    for batch in batches:
        for of, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if of != now:
                if state is not None:
                    yield row()
                now, state = of, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if state is not None:
        yield row()


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row per node of the conversations' trie: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. `sequences` is what `turn_sequences` gives (runs jobs).
    """
    ship_package(sequences.sparkSession)
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    rows = sequences.select("id", key.alias("key"), F.transform("turns", lambda t: t["words"]).alias("words"))
    schema = StructType.fromDDL(_DDL)
    dealt = rows.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    levels = [settle(dealt.mapInArrow(_first_level, schema), "trie-blocks")]
    while True:
        edges = levels[-1].filter(F.col("kind") == EDGE).select("key", "words", *_PARTS)
        n = edges.count()
        whole = n <= EDGES_AT_ONCE
        placed = edges.repartition(1) if whole else edges.repartitionByRange(max(1, n // (EDGES_AT_ONCE // 8)), "key")
        levels.append(settle(placed.sortWithinPartitions("key").mapInArrow(_next_level(whole), schema), "trie-edges"))
        if whole:
            break
    low, *upper = levels
    high = upper[0]
    for level in upper[1:]:
        high = high.unionByName(level)
    pieces = low.filter(F.col("kind") == PIECE).select("hash", "ids", "conv_id")
    in_order = pieces.repartition("hash").sortWithinPartitions("hash", "conv_id").select("hash", "ids")
    digests = in_order.mapInArrow(_digests, "_of binary, _ends string")
    nodes = high.filter(F.col("kind") == NODE)
    ended = settle(nodes.join(digests, F.col("hash") == F.col("_of"), "left").withColumn(
        "ends_sha256", F.coalesce("_ends", F.lit(hashlib.sha256(b"").hexdigest()))).drop("_of", "_ends"), "trie-top")
    names = ended.select(F.col("hash").alias("_above"), F.col("conv_id").alias("_name"))
    every = low.filter(F.col("kind") == NODE).unionByName(ended)
    return every.join(names, F.col("parent_hash") == F.col("_above"), "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "_name")).select(*_FACTS, "ends_sha256")
