"""Document quality by votes of the nearest labelled documents in a latent semantic space.

A text becomes counts of its words, of their shapes (runs of small letters,
capitals, digits; other characters as they are) and of repetitions, hashed to a
fixed width. Words are weighted by inverse document frequency and the blocks are
balanced; the leading singular directions of the labelled rows are the latent space.
The labelled vectors, at most `FIT_ROWS` times `DIMENSIONS`, are broadcast. Every
document is held against all of them in blocks of exact cosine products, and its
nearest `NEIGHBOURS` vote with their labels, weighted by similarity.

Only labelled rows that the caller passes are learned from: of those, the `FIT_ROWS`
with the smallest hash of their id, so the fit is bounded and repeatable. Rows
without a label are ignored; a document labelled twice counts by its mean label.
Empty and NULL texts score 0, as nothing in them is worth keeping. A text unlike every
labelled row, or any text where nothing is labelled, scores the share of label 1.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import partial
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import map_rows, map_texts

FIT_ROWS, DIMENSIONS, NEIGHBOURS, SHARPNESS = 4000, 48, 15, 4
WORDS, SHAPES = 2048, 1024
WIDTH = WORDS + SHAPES + 2
BLOCK_WEIGHTS = (0.5, 1.0, 1.0)  # words, shapes, repetitions

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SHAPE = bytes(
    97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))
_RUNS = partial(re.compile(rb"(.)\1+", re.DOTALL).sub, rb"\1")


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray  # of every feature
    directions: np.ndarray  # WIDTH x DIMENSIONS
    vectors: np.ndarray  # labelled rows x DIMENSIONS, of length 1
    labels: np.ndarray
    prior: float


def counts(text: str) -> np.ndarray:
    """Feature counts of a text, by rate and square root."""
    data = text.encode()
    words = data.translate(_LOWER).split()
    out = np.zeros(WIDTH, np.float32)
    if not words:
        return out
    distinct = Counter(words)
    for at, width, found in ((0, WORDS, distinct), (WORDS, SHAPES, Counter(_RUNS(data.translate(_SHAPE)).split()))):
        places = np.fromiter(map(zlib.crc32, found), np.int64, len(found)) % width + at
        out += np.bincount(places, np.fromiter(found.values(), np.float64, len(found)), WIDTH).astype(np.float32)
    out[-2] = sum(map(eq, words, words[1:]))
    out[-1] = max(0, len(words) - len(distinct) - 0.5 * len(words))
    return np.sqrt(out / len(words))


def _latent(rows: np.ndarray, weights: np.ndarray, directions: np.ndarray | None) -> np.ndarray:
    """Weighted rows with balanced blocks, in the latent space if it is known."""
    rows = rows * weights
    for (a, b), w in zip(((0, WORDS), (WORDS, WORDS + SHAPES)), BLOCK_WEIGHTS):
        rows[:, a:b] *= w / np.maximum(np.linalg.norm(rows[:, a:b], axis=1, keepdims=True), 1e-9)
    rows[:, WORDS + SHAPES:] *= BLOCK_WEIGHTS[2]
    if directions is None:
        return rows
    rows = rows @ directions
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def _leading(rows: np.ndarray, k: int) -> np.ndarray:
    """The k leading right singular directions, by seeded power iteration."""
    basis = np.random.default_rng(7).standard_normal((rows.shape[1], k + 8)).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    _, _, vt = np.linalg.svd(rows @ basis, full_matrices=False)
    return (basis @ vt.T)[:, :k].astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> QualityModel:
    """Learn from the labelled rows among `docs`; see the module for the bound."""
    per_doc = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("_lid")).agg(F.avg(label_col).alias("_y"))
    known = docs.select(F.col(id_col).alias("_id")).filter("_id is not null").distinct()
    chosen = per_doc.join(known, F.col("_lid") == F.col("_id"), "left_semi").orderBy(
        F.xxhash64("_lid"), "_lid").limit(FIT_ROWS)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(
        F.broadcast(chosen), F.col("_id") == F.col("_lid"))

    def start():
        def work(texts: list[str]) -> list[list]:
            found = [counts(t) for t in texts]
            places = [np.flatnonzero(f) for f in found]
            return [[p.astype(np.int32) for p in places], [f[p] for f, p in zip(found, places)]]
        return work

    made = {"places": (pa.list_(pa.int32()), "array<int>"), "values": (pa.list_(pa.float32()), "array<float>")}
    features = map_texts(rows, "_t", {"_id": "id", "_y": "y"}, made, start)
    once = features.groupBy("id").agg(F.max(F.struct("places", "values", "y")).alias("f")).select("id", "f.*")
    sample = sorted(once.collect(), key=lambda r: r.id)  # at most FIT_ROWS rows of at most WIDTH numbers
    dense = np.zeros((len(sample), WIDTH), np.float32)
    for n, r in enumerate(sample):
        dense[n, r.places] = r["values"]
    y = np.array([r.y for r in sample])
    idf = np.log((1 + len(sample)) / (1 + (dense > 0).sum(axis=0))).astype(np.float32) + 1
    idf[WORDS:] = 1
    if not len(sample):
        return QualityModel(idf, np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), y, 0.5)
    directions = _leading(_latent(dense, idf, None), min(DIMENSIONS, len(sample)))
    return QualityModel(idf, directions, _latent(dense, idf, directions), y, float(y.mean()))


def vote(model: QualityModel, texts: list[str]) -> np.ndarray:
    """Scores of a block of texts."""
    features = np.array([counts(t) for t in texts])
    said = features.any(axis=1)
    scores = np.where(said, model.prior, 0.0)
    if not len(model.vectors):
        return scores
    cosine = _latent(features, model.weights, model.directions) @ model.vectors.T
    k = min(NEIGHBOURS, len(model.vectors))
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** SHARPNESS
    total = weight.sum(axis=1)
    voted = said & (total > 0)
    scores[voted] = ((weight * model.labels[near]).sum(axis=1)[voted] / total[voted]).clip(0, 1)
    return scores


def classify(docs: DataFrame, model: QualityModel, keep: dict[str, str], text_col: str = "text") -> DataFrame:
    """The columns `keep` ({column: new name}) and the score of every row."""
    return map_texts(docs, text_col, keep, *_voting(docs, model))


def _voting(docs: DataFrame, model: QualityModel):
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return {"score": (pa.float64(), "double")}, lambda: lambda texts: [vote(shared.value, texts)]


def keep_good(docs: DataFrame, model: QualityModel, at_least: float, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose score reaches `at_least`, with their columns as they are."""
    return map_rows(docs, text_col, *_voting(docs, model)).filter(F.col("score") >= at_least).select("_doc.*")
