"""Jaccard join of documents on their word shingles, by prefix trees.

Shingles are ordered by the number of different sets that hold them, rare ones first. Two sets that
link agree in one of their first `n - ceil(t n) + 1` shingles, so a set whose first
ones all occur nowhere else links with nothing and leaves at once; that number is counted over all
shingles of all documents. Sets that share an early shingle are of one family.

A family's sets, common shingles first, are stored in a trie. It is traversed once, with
the overlaps of the path so far with every other set: sets with the same beginning share
that work, and partners, then whole subtrees, are dropped when what remains of their length
cannot reach the overlap that a link needs. A family of more than `BLOCK_SETS` sets, or
`BLOCK_BYTES` of shingles, is cut by length classes (only neighbouring ones can link) and salted by
whichever asks for more; blocks are joined two by two. A set larger than that is a block of its own.

Equal sets are one class from the start. Links are returned as a number per set and
as spanning stars, not as pairs. Documents without words, or without text, have the empty
set, which links with nothing. Rows that repeat an id are separate members of their
classes; a component is named by its smallest id, NULL only if it has no other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import give_back, map_rows, map_texts, slices
from millrace.llm.components import connected
from millrace.llm.mapped import THIN, look_up, range_of, thin, wide, write_array, write_places, write_thin
from millrace.llm.shingles import shingle_sets, signature
from millrace.session import work_folder
from millrace.sources.tables import settle

TASK_SHINGLES = 1_500_000  # shingles that a task combines before it passes them on
RANGE_BYTES = 16 << 20  # text per range of shingle hashes
BLOCK_SETS = 512
BLOCK_BYTES = 16 << 20  # of shingles, on average of the blocks of a length class
TABLE_BYTES = 96 << 20  # of the table of shingles by sets; a larger one is kept as lists of sets
STEP = 128  # shingles of a path between two looks at what remains
COPY = np.dtype([("rest", "<u8"), ("owner", "<i8")])
NO_ID = -(1 << 63)
_U = np.uint64


def needed(a, b, percent: int):
    """The smallest intersection with which sets of sizes a and b link."""
    return -(-percent * (a + b) // (100 + percent))


def _early(n: int, percent: int) -> int:
    """Of how many first shingles two linked sets share one."""
    return n + percent * n // -100 + 1


class _Copies:
    """Which documents stand for their class: those without copies, and of copies the one named in the files."""

    def __init__(self, folder: str, ranges: int):
        self.folder, self.ranges = folder, ranges

    def own(self, ids: list[int], names: list[bytes]) -> list[bool]:
        halves = np.frombuffer(b"".join(names), "<u8").reshape(-1, 2)
        order = np.argsort(halves[:, 0])
        keys = halves[order, 0]
        found = look_up(self.folder, keys, range_of(keys, self.ranges), ("copy-keys", "<u8"), ("copies", COPY))
        mine = (found["rest"] != halves[order, 1]) | (found["owner"] == np.array(ids, np.int64)[order])
        out = np.empty(len(ids), bool)
        out[order] = mine
        return out.tolist()


def _write_copies(members: DataFrame, folder: str, ranges: int) -> None:
    """Files of the classes with several members and the id that stands for each."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        halves = np.frombuffer(b"".join(frame["cls"]), "<u8").reshape(-1, 2)
        order = np.argsort(halves[:, 0])
        values = np.zeros(len(frame), COPY)
        values["rest"], values["owner"] = halves[order, 1], frame["owner"].to_numpy()[order]
        place = int(frame["place"].iloc[0])
        write_array(folder, f"copy-keys-{place}", halves[order, 0])
        write_array(folder, f"copies-{place}", values)
        return pd.DataFrame({"place": [place]})

    def place(halves: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in halves:
            keys = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u8")[::2]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(range_of(keys, ranges))], names=["cls", "owner", "place"])

    owners = members.filter("n > 0").groupBy("cls").agg(F.min("id").alias("owner"), F.count(F.lit(1)).alias("_m"))
    placed = owners.filter("_m > 1").select("cls", "owner").mapInArrow(place, "cls binary, owner long, place long")
    written = settle(placed.groupBy("place").applyInPandas(run, "place long"), "copy-files")
    write_places(folder, "copy-keys", [row.place for row in written.collect()])  # one per file


def _count_shingles(rows: DataFrame, size: int, folder: str, ranges: int, copies: _Copies) -> None:
    """Files of all shingles that several classes hold, with their number of classes."""
    names, types = ["place", "first", "width", "gaps", "counts"], [
        pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        shingles, counts = np.unique(np.concatenate(held), return_counts=True)
        place = range_of(shingles, ranges)
        edges = np.flatnonzero(np.diff(place, prepend=-1, append=ranges))
        packed = [(int(place[a]), shingles[a:a + 1].tobytes(), *thin(np.diff(shingles[a:b])),
                   counts[a:b].astype("<u4").tobytes()) for a, b in zip(edges[:-1], edges[1:])]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*packed), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            for part, texts in slices(batch, batch.column(1), 1 << 20):
                sets = shingle_sets(texts.to_pylist(), size)
                full = [(i, s) for i, s in zip(part.column(0).to_pylist(), sets) if len(s)]
                mine = copies.own([i for i, _ in full], [signature(s) for _, s in full]) if full else []
                held += [s for (_, s), m in zip(full, mine) if m]
                total += sum(len(s) for (_, s), m in zip(full, mine) if m)
                if total >= TASK_SHINGLES:
                    yield flush(held)
                    held, total = [], 0
        if held:
            yield flush(held)
        del held
        give_back()

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        place = int(frame["place"].iloc[0])
        parts = []
        for first, width, gaps in zip(frame["first"], frame["width"], frame["gaps"]):
            parts.append(np.cumsum(np.concatenate((np.frombuffer(first, "<u8"), wide(width, gaps))), dtype=np.uint64))
        shingles = np.concatenate(parts)
        counts = np.concatenate([np.frombuffer(c, "<u4") for c in frame["counts"]]).astype(np.uint64)
        order = np.argsort(shingles)
        shingles = shingles[order]
        start = np.flatnonzero(np.concatenate(([True], shingles[1:] != shingles[:-1])))
        totals = np.add.reduceat(counts[order], start)
        write_array(folder, f"shingles-{place}", shingles[start][totals > 1])
        write_thin(folder, f"holders-{place}", totals[totals > 1])
        give_back()
        return pd.DataFrame({"place": [place]})

    packed = rows.mapInArrow(run, "place long, first binary, width long, gaps binary, counts binary")
    written = settle(packed.groupBy("place").applyInPandas(merge, "place long"), "shingle-files")
    write_places(folder, "shingles", [row.place for row in written.collect()])


def _candidates(rows: DataFrame, size: int, percent: int, folder: str, ranges: int, copies: _Copies) -> DataFrame:
    """(cls, n, shingles, early): classes with an early shingle that others hold.

    `shingles` are packed with the most common first, `early` holds those shared early ones.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, batch.column(1), 1 << 20):
                sets = shingle_sets(texts.to_pylist(), size)
                full = [(i, s, signature(s)) for i, s in zip(part.column(0).to_pylist(), sets) if len(s)]
                if not full:
                    continue
                mine = copies.own([i for i, _, _ in full], [c for _, _, c in full])
                full = [f for f, m in zip(full, mine) if m]
                every, at = np.unique(np.concatenate([s for _, s, _ in full] or [np.empty(0, _U)]), return_inverse=True)
                holders = np.maximum(look_up(folder, every, range_of(every, ranges), ("shingles", "<u8"),
                                             ("holders", THIN, 1))[:, 0].astype(np.int64), 1)[at]
                out, start = [], 0
                for _, s, name in full:
                    h = holders[start:start + len(s)]
                    start += len(s)
                    order = np.argsort(h, kind="stable")  # equal numbers stay in the order of the hash
                    first = order[:_early(len(s), percent)]
                    shared = s[first[h[first] > 1]]
                    if len(shared):
                        out.append((name, len(s), s[order[::-1]].tobytes(), shared.astype(np.int64).tolist()))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), [pa.binary(), pa.int64(), pa.binary(),
                                                                   pa.list_(pa.int64())])],
                        names=["cls", "n", "shingles", "early"])
        give_back()

    return rows.mapInArrow(run, "cls binary, n long, shingles binary, early array<long>")


def _families(found: DataFrame) -> DataFrame:
    """(cls, family): classes that are joined by shared early shingles."""
    postings = settle(found.select("cls", F.explode("early").alias("s")), "early-postings")
    heads = settle(postings.groupBy("s").agg(F.min("cls").alias("head"), F.count(F.lit(1)).alias("_m"))
                   .filter("_m > 1").select(F.col("s").alias("_s"), "head"), "early-heads")
    edges = postings.join(heads, F.col("s") == F.col("_s")).select("cls", "head").distinct()
    groups = connected(settle(edges, "family-edges"), "cls", "head")
    return groups.select(F.col("node").alias("cls"), F.col("component").alias("family"))


def _units(found: DataFrame, families: DataFrame, percent: int) -> DataFrame:
    """Rows of every pair of blocks (family, i, j) that can hold a link."""
    sets = settle(found.select("cls", "n", "copies", "shingles").join(families, "cls"), "family-sets")

    def blocks():
        return F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") * 8 / BLOCK_BYTES)).cast("int")

    sizes = sets.groupBy("family").agg(blocks().alias("_blocks"))
    classed = settle(sets.select("cls", "family", "n").join(
        settle(sizes.withColumnRenamed("family", "_f"), "family-sizes"), F.col("family") == F.col("_f")).select(
        "cls", "family", "n", F.when(F.col("_blocks") > 1, F.floor(F.log(F.col("n").cast("double")) / F.lit(
            1.0001 * math.log(100 / percent)))).otherwise(0).cast("int").alias("band")), "family-bands")
    salts = settle(classed.groupBy(F.col("family").alias("_f"), F.col("band").alias("_b")).agg(
        blocks().alias("_salts")), "family-salts")
    # A band is a little wider than the logarithm of the largest ratio of linked sizes.
    near = settle(salts.alias("a").join(salts.alias("b"), (F.col("a._f") == F.col("b._f")) & (
        F.abs(F.col("a._b") - F.col("b._b")) <= 1)).select(
        F.col("a._f").alias("_f"), F.col("a._b").alias("_b"), F.col("a._salts").alias("_salts"),
        F.struct(F.col("b._b").alias("band"), F.col("b._salts").alias("salts")).alias("other"))
        .groupBy("_f", "_b", "_salts").agg(F.collect_list("other").alias("_near")), "family-near")
    def block(band, salt):
        return F.concat_ws(":", band.cast("string"), salt.cast("string"))

    blocked = classed.join(near, (F.col("family") == F.col("_f")) & (F.col("band") == F.col("_b"))).select(
        "cls", "family", F.explode("_near").alias("_o"),
        block(F.col("band"), F.pmod(F.xxhash64("cls"), F.col("_salts"))).alias("own"))
    spread = blocked.select("cls", "family", "own", F.col("_o.band").alias("_ob"), F.explode(
        F.sequence(F.lit(0), F.col("_o.salts") - 1)).alias("_os")).withColumn(
        "other", block(F.col("_ob"), F.col("_os")))
    units = spread.select("cls", F.col("family").alias("unit"), "own", F.least("own", "other").alias("i"),
                          F.greatest("own", "other").alias("j"))
    return units.join(sets.select(F.col("cls").alias("_c"), "copies", "shingles"), F.col("cls") == F.col("_c")).drop("_c")


def _held(at: np.ndarray, own: np.ndarray, shingles: int, sets: int):
    """A function from shingles and sets to how many of the shingles each of the sets holds; set own[k] holds at[k]."""
    if shingles * sets <= TABLE_BYTES:
        member = np.zeros((shingles, sets), bool)
        member[at, own] = True
        return lambda some, alive: member[some][:, alive].sum(axis=0)
    holders = own[np.argsort(at, kind="stable")].astype(np.int32)
    ends = np.cumsum(np.bincount(at, minlength=shingles))

    def held(some: np.ndarray, alive: np.ndarray) -> np.ndarray:
        lists = [holders[ends[k - 1] if k else 0:ends[k]] for k in some.tolist()]
        return np.bincount(np.concatenate(lists), minlength=sets)[alive]

    return held


def trie_links(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number of a set, numbers of the sets that link with it), for sets given in one order of all shingles.

    Shingles of one set only lie on no shared path and reach no partner: they count in the sizes alone.
    """
    sizes = np.array([len(s) for s in sets])
    every, at, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = holders > 1
    number = np.cumsum(common) - 1
    own = np.repeat(np.arange(len(sets)), sizes)[common[at]]
    at = number[at[common[at]]]
    held = _held(at, own, int(common.sum()), len(sets))
    lengths = np.bincount(own, minlength=len(sets))
    paths = np.split(at, np.cumsum(lengths)[:-1])
    rows = sorted(range(len(sets)), key=lambda k: paths[k].tolist())
    shared = np.zeros(len(rows) + 1, np.int64)  # with the path before, in the order of the trie
    for k in range(1, len(rows)):
        a, b = paths[rows[k - 1]], paths[rows[k]]
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[:m] != b[:m])
        shared[k] = differ[0] if len(differ) else m

    def walk(path, start, stop, alive, overlap, longest, least):
        """Overlaps after shingles start to stop, of the partners that a path of `longest` can still link."""
        for k in range(start, stop, STEP):
            end = min(stop, k + STEP)
            overlap = overlap + held(path[k:end], alive)
            reach = overlap + np.minimum(longest - end, lengths[alive] - overlap) >= needed(least, sizes[alive], percent)
            if not reach.all():
                alive, overlap = alive[reach], overlap[reach]
            if not len(alive):
                break
        return alive, overlap

    nodes = [(0, np.arange(len(sets)), np.zeros(len(sets), np.int64))]  # depth, partners, their overlaps
    k = 0
    while k < len(rows):
        while nodes[-1][0] > shared[k]:
            nodes.pop()
        row, path = rows[k], paths[rows[k]]
        depth, alive, overlap = nodes[-1]
        fork = int(shared[k + 1])
        if fork > depth:  # the next path leaves this one here: both go on from this node
            below = k + 1 + int(np.argmax(shared[k + 1:] < fork))  # end of the subtree
            under = rows[k:below]
            alive, overlap = walk(path, depth, fork, alive, overlap, lengths[under].max(), sizes[under].min())
            if not len(alive):
                k = below
                continue
            depth = fork
            nodes.append((depth, alive, overlap))
        alive, overlap = walk(path, depth, len(path), alive, overlap, len(path), sizes[row])
        linked = alive[overlap >= needed(sizes[row], sizes[alive], percent)]
        linked = linked[linked != row]
        if len(linked):
            yield row, linked
        k += 1


def _join_unit(percent: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """Links inside one unit: per class the weight of its partners, and the smallest class of its group."""
        frame = frame.sort_values("cls", ignore_index=True)
        copies = frame["copies"].to_numpy()
        apart = frame["i"].iloc[0] != frame["j"].iloc[0]
        side = (frame["own"] == frame["i"].iloc[0]).to_numpy()
        links, group = np.zeros(len(frame), np.int64), np.arange(len(frame))
        for row, partners in trie_links([np.frombuffer(s, "<u8") for s in frame["shingles"]], percent):
            if apart:  # pairs within a block belong to the block's own unit
                partners = partners[side[partners] != side[row]]
            links[row] = copies[partners].sum()
            groups = np.unique(np.append(group[partners], group[row]))
            if len(groups) > 1:
                group[np.isin(group, groups)] = groups[0]
        rows = [(frame["cls"][k], int(links[k]), frame["cls"][group[k]]) for k in np.flatnonzero(links)]
        return pd.DataFrame(rows, columns=["cls", "links", "root"])

    return run


def similar_documents(docs: DataFrame, shingle_words: int = 4, percent: int = 85, id_col: str = "doc_id",
                      text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, classes): (id, n, cls) of every row, and (_cls, links, component, keeper) of every class.

    `cls` names the set (NULL: empty), `links` counts the other rows linked with a row of the
    class, `component` is the smallest id that links reach (NO_ID: there are only NULL ids),
    `keeper` the first class that has it.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col), F.lit(NO_ID)).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def start():
        def work(texts: list[str]) -> list[list]:
            sets = shingle_sets(texts, shingle_words)
            return [[len(s) for s in sets], [signature(s) if len(s) else None for s in sets]]
        return work

    made = {"n": (pa.int64(), "long"), "cls": (pa.binary(), "binary")}
    members = settle(map_texts(rows, "text", {"id": "id"}, made, start), "shingle-members")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    ranges = max(2, int(size // RANGE_BYTES))
    folder = work_folder(spark, "shingles")
    _write_copies(members, folder, ranges)
    copies = _Copies(folder, ranges)
    _count_shingles(rows, shingle_words, folder, ranges, copies)
    found = settle(_candidates(rows, shingle_words, percent, folder, ranges, copies), "shingle-candidates")
    found = found.dropDuplicates(["cls"])
    own = settle(members.filter("n > 0").groupBy("cls").agg(
        F.count(F.lit(1)).alias("copies"),
        F.coalesce(F.min(F.when(F.col("id") != NO_ID, F.col("id"))), F.lit(NO_ID)).alias("least")), "shingle-classes")
    weighed = settle(found.join(own.select(F.col("cls").alias("_c"), "copies"), F.col("cls") == F.col("_c")).drop("_c"),
                     "weighed-candidates")
    units = _units(weighed, _families(weighed), percent)
    linked = settle(units.groupBy("unit", "i", "j").applyInPandas(
        _join_unit(percent), "cls binary, links long, root binary"), "shingle-links")
    groups = connected(linked.select("cls", "root"), "cls", "root")
    totals = settle(linked.groupBy("cls").agg(F.sum("links").alias("links")), "shingle-link-counts")
    named = settle(own.join(groups, F.col("cls") == F.col("node"), "left").select(
        "cls", "copies", "least", F.coalesce("component", "cls").alias("group")), "shingle-groups")
    first = F.min(F.struct((F.col("least") == NO_ID).alias("none"), "least", "cls"))
    names = settle(named.groupBy(F.col("group").alias("_g")).agg(first.alias("f")).select(
        "_g", F.col("f.least").alias("component"), F.col("f.cls").alias("keeper")), "shingle-names")
    classes = named.join(names, F.col("group") == F.col("_g")).join(
        totals.select(F.col("cls").alias("_c"), "links"), F.col("cls") == F.col("_c"), "left").select(
        F.col("cls").alias("_cls"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "component",
        "keeper")
    return members, settle(classes, "shingle-result")


def jaccard_join(docs: DataFrame, shingle_words: int = 4, percent: int = 85, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: (id, n_shingles, component_id, n_links)."""
    members, classes = similar_documents(docs, shingle_words, percent, id_col, text_col)
    joined = members.join(classes, F.col("cls") == F.col("_cls"), "left")
    shown = [F.when(F.col(c) != NO_ID, F.col(c)) for c in ("id", "component")]
    return joined.select(
        shown[0].alias(id_col), F.col("n").alias("n_shingles"), F.coalesce(shown[1], shown[0]).alias("component_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))


def drop_similar(docs: DataFrame, shingle_words: int = 4, percent: int = 85, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """The rows of `docs` without those that a component keeps another one for.

    The row with the component's id stays (of several classes with it, the first; of its
    equal rows, all). Documents with the empty set stay.
    """
    members, classes = similar_documents(docs, shingle_words, percent, id_col, text_col)
    gone = settle(members.join(classes, F.col("cls") == F.col("_cls")).filter(
        (F.col("cls") != F.col("keeper")) | (F.col("id") != F.col("component"))).select(
        F.col("cls").alias("_gone_cls"), F.col("id").alias("_gone_id")).distinct(), "similar-rows")

    def start():
        def work(texts: list[str]) -> list[list]:
            return [[signature(s) if len(s) else None for s in shingle_sets(texts, shingle_words)]]
        return work

    named = map_rows(docs, text_col, {"_own_cls": (pa.binary(), "binary")}, start)
    own_id = F.coalesce(F.col("_doc").getField(id_col), F.lit(NO_ID))
    same = (F.col("_own_cls") == F.col("_gone_cls")) & (own_id == F.col("_gone_id"))
    return named.join(gone, same, "left_anti").select("_doc.*")
