"""Near-duplicate vectors by a forest of random-projection trees.

Every tree splits its rows at the median of their projection on a random direction,
again and again; rows within a margin of the median go to both sides, so that few
close pairs are parted, and other trees find those. A node is a leaf when it is
small, or so dense that half its rows project closer together than a close pair may; a dense
leaf may be of any size. Within a leaf all pairs are compared, exactly and in double precision, in
blocks of bounded size that are spread over the cluster.

A pair that shares several leaves counts in the first of them only. Equal vectors
are one class from the start and are never compared. Blocks return a number per vector
and a spanning star per group, not pairs; the stars are united.

Vectors that are NULL, empty, zero or hold NULL or non-finite components link with
nothing, nor do vectors of different length. Components of any size, down to 1e-300 and up to 1e300, count. A NULL id names no component of its own: its row
keeps NULL, and other members are named by the smallest id that is not NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import connected
from millrace.session import ship_package
from millrace.sources.tables import settle

TREES, LEVELS, LEAF_ROWS, BLOCK_ROWS = 8, 24, 512, 1024
# In units of the spread that a pair at the threshold has along a random direction. The margin sends about a tenth
# of the rows to both sides of a split, so a tree's rows grow slowly with its depth.
MARGIN, DENSE = 0.3, 1.0
SEED = 20_011


@lru_cache(maxsize=8)
def directions(size: int) -> np.ndarray:
    """Unit directions for every tree and level, one per row."""
    drawn = np.random.default_rng((SEED, size)).standard_normal((TREES * LEVELS, size))
    return drawn / np.linalg.norm(drawn, axis=1, keepdims=True)


def _project(classes: DataFrame) -> DataFrame:
    """(cls, tree, node, p, margin) for every tree: projections of the unit vector, level by level."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                ids = np.array(part.column(0).to_pylist(), np.int64)
                vectors = part.column(1).to_pylist()
                sizes = np.array([len(v) for v in vectors])
                for size in np.unique(sizes):
                    picked = np.flatnonzero(sizes == size)
                    rows = np.array([vectors[k] for k in picked], np.float64)
                    rows /= np.abs(rows).max(axis=1, keepdims=True)
                    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
                    p = (rows @ directions(int(size)).T).astype(np.float32).reshape(-1, LEVELS)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat(ids[picked], TREES)), pa.array(np.tile(np.arange(TREES), len(picked))),
                        pa.array(np.full(len(p), size, np.int64)), pa.array(list(p), pa.list_(pa.float32()))],
                        names=["cls", "tree", "node", "p"])

    return classes.select("cls", "vec").mapInArrow(run, "cls long, tree long, node long, p array<float>")


def _leaves(placed: DataFrame, spread: float) -> DataFrame:
    """(cls, tree, node): the leaves of every tree, grown level by level over all rows."""
    done = []
    unit = F.lit(spread) / F.sqrt("size")
    width = MARGIN * unit
    rows = placed.withColumn("size", F.col("node").cast("double"))
    for level in range(LEVELS):
        here = F.get("p", F.lit(level))
        stats = rows.groupBy(F.col("tree").alias("_t"), F.col("node").alias("_n")).agg(
            F.count(F.lit(1)).alias("_rows"),
            F.percentile_approx(here, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(1000)).alias("_q"))
        stats = settle(stats, "tree-nodes")
        judged = rows.join(stats, (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n")))
        splits = (F.col("_rows") > LEAF_ROWS) & (F.col("_q")[2] - F.col("_q")[0] >= DENSE * unit)
        sides = F.filter(F.array(F.when(here <= F.col("_q")[1] + width, F.lit(0)),
                                 F.when(here >= F.col("_q")[1] - width, F.lit(1))), lambda s: s.isNotNull())
        grown = settle(judged.select("cls", "tree", "node", "p", "size", splits.alias("_open"), sides.alias("_sides")),
                       "tree-level")
        done.append(grown.filter("not _open").select("cls", "tree", "node"))
        going = grown.filter("_open")
        if going.isEmpty():
            break
        rows = going.select("cls", "tree", "p", "size", "node", F.explode("_sides").alias("_s")).withColumn(
            "node", F.xxhash64("node", F.lit(level), "_s")).drop("_s")
    else:
        done.append(rows.select("cls", "tree", "node"))
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out


def _blocks(leaves: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of every comparison unit (leaf, i, j): chunk i against chunk j of a leaf."""
    code = F.shiftleft(F.col("tree"), 56).bitwiseOR(F.xxhash64("tree", "node").bitwiseAND(F.lit((1 << 56) - 1)))
    coded = settle(leaves.select("cls", code.alias("leaf")), "leaves")
    codes = coded.groupBy("cls").agg(F.sort_array(F.collect_set("leaf")).alias("codes"))
    rows = settle(classes.select("cls", "vec", "copies").join(codes, "cls"), "coded-vectors")
    sizes = settle(coded.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("chunks")),
                   "leaf-sizes")
    own = F.pmod(F.xxhash64("cls", "leaf"), F.col("chunks")).cast("int")
    spread = coded.join(sizes, "leaf").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    units = spread.select("cls", "leaf", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    return units.join(rows, "cls")


def _compare(threshold: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """Links inside one unit: per vector their number, and the smallest class of its group."""
        leaf, i, j = int(frame["leaf"].iloc[0]), frame["i"].iloc[0], frame["j"].iloc[0]
        frame = frame.sort_values("cls", ignore_index=True)
        ids, copies = frame["cls"].to_numpy(), frame["copies"].to_numpy()
        vectors = np.array(frame["vec"].tolist(), np.float64)
        # By powers of two, so no product overflows or vanishes and no digit changes.
        vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])
        norms = np.linalg.norm(vectors, axis=1)
        near = vectors @ vectors.T >= threshold * np.outer(norms, norms)
        np.fill_diagonal(near, False)
        if i != j:  # pairs within a chunk belong to the chunk's own unit
            side = frame["own"].to_numpy() == i
            near &= side[:, None] != side[None, :]
        if near.any():
            earlier = [[c for c in codes if c < leaf] for codes in frame["codes"]]
            known = {c: n for n, c in enumerate(sorted({c for e in earlier for c in e}))}
            member = np.zeros((len(ids), len(known)), np.float32)
            for row, e in enumerate(earlier):
                member[row, [known[c] for c in e]] = 1
            near &= (member @ member.T) == 0
        linked = near.any(axis=1)
        root = np.arange(len(ids))
        while True:
            best = np.where(near, root[None, :], len(ids)).min(axis=1, initial=len(ids))
            new = np.minimum(root, best)
            new = new[new]
            if (new == root).all():
                break
            root = new
        return pd.DataFrame({"cls": ids, "n": near @ copies, "root": ids[root]})[linked]

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id",
                 vec_col: str = "embedding") -> DataFrame:
    """One row per row of `vectors`: (id, n_links, component_id, kept)."""
    ship_package(vectors.sparkSession)
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    sound = F.forall("_vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("_vec", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("_id"), vec.alias("_vec")).withColumn(
        "_ok", F.coalesce(F.col("_vec").isNotNull() & sound & some, F.lit(False)))
    good = rows.filter("_ok")
    classes = settle(good.groupBy(F.col("_vec").alias("vec")).agg(
        F.count(F.lit(1)).alias("copies"), F.min("_id").alias("first_id"),
    ).withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    placed = settle(_project(classes), "projections")
    units = _blocks(_leaves(placed, (2 * (1 - threshold)) ** 0.5), classes)
    found = settle(units.groupBy("leaf", "i", "j").applyInPandas(_compare(threshold), "cls long, n long, root long"),
                   "leaf-links")
    groups = connected(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    counts = settle(found.groupBy("cls").agg(F.sum("n").alias("n")), "link-counts")
    named = settle(classes.join(groups, F.col("cls") == F.col("node"), "left").select(
        "cls", "vec", "copies", "first_id", F.coalesce("component", "cls").alias("group")), "named-classes")
    names = settle(named.groupBy(F.col("group").alias("_g")).agg(F.min("first_id").alias("name")), "group-names")
    known = settle(named.join(names, F.col("group") == F.col("_g")).join(counts, "cls", "left").select(
        F.col("vec").alias("_v"), "name", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links")), "class-links")
    joined = rows.join(known, F.col("_ok") & (F.col("_vec") == F.col("_v")), "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("name", "_id"))
    return joined.select(
        F.col("_id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("_id").eqNullSafe(component).alias("kept"))
