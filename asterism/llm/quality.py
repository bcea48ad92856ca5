"""Quality by nearest-neighbour voting in a latent-semantic space.

A text becomes a few weighted blocks of counts: hashed words (log counts times
inverse document frequency), bytes, and how much repeats. A truncated singular
value decomposition, fitted on the labelled sample, turns them into a short
dense vector. The labelled vectors are broadcast, their number being a
parameter; every document is compared with all of them by exact cosine
products, block by block, and its nearest neighbours vote with their labels,
weighted by similarity.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import add_columns
from asterism.llm.words import hash_words


@dataclass(frozen=True)
class Settings:
    """``per_class`` bounds the labelled rows learned from, those of lowest hash of the id."""

    per_class: int = 2500
    buckets: int = 1024
    dims: int = 48
    neighbours: int = 15
    seed: int = 7


# Weights of the blocks: words, bytes, repetition.
BLOCKS = (0.5, 1.0, 1.5)
LEVELS = 16
BLOCK_ROWS = 512  # documents whose cosines are held at a time


def _levels(values: np.ndarray) -> np.ndarray:
    """Values of 0 to 1 as weights of the two nearest of ``LEVELS`` places."""
    out = np.zeros((len(values), LEVELS))
    place = np.clip(values, 0, 1) * (LEVELS - 1)
    low = np.minimum(place.astype(int), LEVELS - 2)
    rows = np.arange(len(values))
    out[rows, low] = 1 - (place - low)
    out[rows, low + 1] = place - low
    return out


def features(texts: list[str | None], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed words, and the other blocks, of every text."""
    hashes, counts = hash_words(texts)
    n = len(texts)
    row = np.repeat(np.arange(n), counts)
    place = row * buckets + (hashes % np.uint64(buckets)).astype(np.int64)
    words = np.bincount(place, minlength=n * buckets).reshape(n, buckets).astype(np.float32)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    order = np.lexsort((hashes, row))
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1])
    size = np.maximum(counts, 1)
    distinct = np.where(counts, np.bincount(row[order][new], minlength=n) / size, 1.0)
    repeated = np.bincount(row[again], minlength=n) / size
    length = np.log1p(counts) / np.log(1e6)
    coded = [(t or "").encode() for t in texts]
    lengths = np.fromiter(map(len, coded), np.int64, n)
    raw = np.frombuffer(b"".join(coded), np.uint8).astype(np.int64)
    raw += np.repeat(np.arange(n) * 256, lengths)
    byte = np.bincount(raw, minlength=n * 256).reshape(n, 256)
    byte = np.sqrt(byte / np.maximum(lengths, 1)[:, None])
    # By length, so that a long text's natural repetition stands beside its like.
    levels = [_levels(distinct), _levels(repeated), _levels(length), _levels(distinct ** 0.3 * length)]
    other = np.hstack([BLOCKS[1] * byte, BLOCKS[2] / 2 * np.hstack(levels)])
    return words, other.astype(np.float32)


def _nearest(cosines: np.ndarray, k: int) -> np.ndarray:
    """The k nearest columns of every row; of equally near ones at the border the first."""
    near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    least = np.take_along_axis(cosines, near, 1).min(1)
    for row in np.flatnonzero((cosines >= least[:, None]).sum(1) > k):
        near[row] = np.lexsort((np.arange(cosines.shape[1]), -cosines[row]))[:k]
    return near


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    mean: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    settings: Settings

    def weighted(self, words: np.ndarray, other: np.ndarray) -> np.ndarray:
        weighted = np.log1p(words) * self.idf
        norms = np.linalg.norm(weighted, axis=1, keepdims=True)
        return np.hstack([BLOCKS[0] * weighted / np.maximum(norms, 1e-9), other])

    def embed(self, words: np.ndarray, other: np.ndarray) -> np.ndarray:
        dense = (self.weighted(words, other) - self.mean) @ self.axes
        return dense / np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)

    def shares(self) -> np.ndarray:
        """Weight of each labelled row's vote: the classes count alike, however many rows they have."""
        good = max(self.labels.mean(), 1e-9)
        return np.where(self.labels == 1, 0.5 / good, 0.5 / max(1 - good, 1e-9))

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Similarity-weighted share of good neighbours; 0.5 with nothing to compare with."""
        out = np.full(len(texts), 0.5)
        k = min(self.settings.neighbours, len(self.labels))
        if not k:
            return out
        for at in range(0, len(texts), BLOCK_ROWS):
            part = texts[at : at + BLOCK_ROWS]
            cosines = self.embed(*features(part, self.settings.buckets)) @ self.vectors.T
            near = _nearest(cosines, k)
            weights = np.maximum(np.take_along_axis(cosines, near, 1), 1e-6).astype(float)
            weights *= self.shares()[near]
            out[at : at + BLOCK_ROWS] = (weights * self.labels[near]).sum(1) / weights.sum(1)
        return out


def fit(texts_features: tuple[np.ndarray, np.ndarray], labels: np.ndarray, settings: Settings) -> Model:
    """Latent-semantic axes and vectors of a labelled sample."""
    words, other = texts_features
    n = len(labels)
    idf = (np.log((1 + n) / (1 + (words > 0).sum(0))) + 0.1).astype(np.float32)
    empty = np.zeros((0, settings.dims), np.float32)
    model = Model(idf, np.zeros(0), np.zeros(0), empty, labels, settings)
    if not n:
        return model
    weighted = model.weighted(words, other)
    mean = weighted.mean(0)
    # Right singular vectors, by way of the small matrix of products.
    centred = (weighted - mean).astype(np.float64)
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = np.ascontiguousarray(axes[:, ::-1][:, : settings.dims], np.float32)
    model = Model(idf, mean, axes, empty, labels, settings)
    return Model(idf, mean, model.axes, model.embed(words, other), labels, settings)


def train(documents: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    """Fit on at most ``per_class`` labelled rows of each class.

    ``documents`` has id and text, ``labels`` id and label (0 or 1). Labels
    that are null, or whose document is missing, are not used; an id that has
    several labels or texts counts once, with the largest.
    """
    settings = settings or Settings()
    known = labels.filter("id IS NOT NULL AND label IS NOT NULL").groupBy("id")
    known = known.agg(F.max(F.col("label").cast("int")).alias("label"))
    chosen = None
    for label in (0, 1):
        hashed = F.xxhash64("id", F.lit(settings.seed))
        some = known.filter(F.col("label") == label).orderBy(hashed, "id").limit(settings.per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    buckets = settings.buckets

    def compute(texts: list) -> list[pa.Array]:
        words, other = features(texts, buckets)
        lines = [np.hstack(pair).astype("<f4").tobytes() for pair in zip(words, other, strict=True)]
        return [pa.array(lines, pa.binary())]

    # At most 2 * per_class ids, so the broadcast has a fixed bound.
    sample = documents.select("id", "text").join(F.broadcast(chosen), "id")
    sample = sample.groupBy("id", "label").agg(F.max("text").alias("text"))
    rows = sorted(add_columns(sample, "text", "line binary", compute).drop("text").collect())
    width = buckets + 256 + 4 * LEVELS
    matrix = np.frombuffer(b"".join(r["line"] for r in rows), "<f4").reshape(len(rows), width)
    marks = np.array([r["label"] for r in rows], float)
    return fit((matrix[:, :buckets], matrix[:, buckets:]), marks, settings)


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Add the score (0 to 1, higher is better) of every whole text.

    Null and empty texts have a vector too, that of a text without words, and
    get the vote of the shortest texts. Of equally near neighbours those of the
    smaller ids vote. Without labelled rows all scores are 0.5. Rows that repeat score alike. A column named like the output is
    replaced, others are kept.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def compute(texts: list) -> list[pa.Array]:
        return [pa.array(shared.value.score(texts), pa.float64())]

    return add_columns(df, text, f"`{out}` double", compute)
