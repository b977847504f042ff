"""Quality scores by votes of labelled neighbours in a latent-semantic space.

Terms are shapes (runs of three character classes), hashed words, and counts of words and lines
that repeat. Document frequencies are counted over all documents; the latent space is fitted to
a bounded sample of labelled rows. The sample's vectors are broadcast and every document is
compared with all of them, in blocks: a matrix product gives the exact cosines, and the nearest
neighbours vote with their similarity. Neither language, source, id nor labels enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardline.llm.hashing import PIECE_BYTES, mix, word_hashes
from yardline.llm.text import map_batches, materialise

#: Labelled rows that the space is fitted to and that vote, chosen by a hash of their id.
MAX_LABELLED = 3000
DIMENSIONS = 48
NEIGHBOURS = 25
#: A similarity is raised to this power to make a vote.
SHARPNESS = 8
THRESHOLD = 0.7
SHAPE_TERMS, WORD_TERMS, REPEAT_TERMS = 1024, 512, 3
TERMS = SHAPE_TERMS + WORD_TERMS + REPEAT_TERMS
#: Weight of each kind of term: shapes tell most, single words little.
WEIGHTS = np.concatenate([np.full(SHAPE_TERMS, 1.0), np.full(WORD_TERMS, 0.2), np.full(REPEAT_TERMS, 4.0)]).astype(np.float32)
BLOCK = 256
_SEED = 7


def _byte_classes() -> np.ndarray:
    """Letters by case, digits and bytes beyond ASCII are one class each, other bytes their own."""
    classes = np.arange(256)
    classes[97:123], classes[65:91], classes[48:58], classes[128:] = 97, 65, 48, 128
    return np.unique(classes, return_inverse=True)[1].astype(np.int64)


_CLASSES = _byte_classes()
_COUNT = int(_CLASSES.max()) + 1


def _shape_table() -> np.ndarray:
    codes = np.arange(_COUNT**3, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return (mix(codes + np.uint64(_SEED)) % np.uint64(SHAPE_TERMS)).astype(np.int32)


_SHAPES = _shape_table()


def _shapes(data: bytes) -> np.ndarray:
    total = np.zeros(SHAPE_TERMS, np.int64)
    for at in range(0, len(data), PIECE_BYTES):
        kinds = _CLASSES[np.frombuffer(data[at : at + PIECE_BYTES + 2], np.uint8)]
        codes = (kinds[:-2] * _COUNT + kinds[1:-1]) * _COUNT + kinds[2:]
        total += np.bincount(_SHAPES[codes], minlength=SHAPE_TERMS)
    return total


def term_counts(texts: list[str]) -> np.ndarray:
    """Counts of all terms, one row for each text."""
    out = np.zeros((len(texts), TERMS), np.float32)
    for row, text, words in zip(out, texts, word_hashes(texts), strict=True):
        row[:SHAPE_TERMS] = _shapes(text.encode())
        if len(words):
            row[SHAPE_TERMS : SHAPE_TERMS + WORD_TERMS] = np.bincount(
                (words >> np.uint64(32)).astype(np.int64) % WORD_TERMS, minlength=WORD_TERMS
            )
            lines = text.split("\n")
            row[-3] = np.count_nonzero(words[1:] == words[:-1])
            row[-2] = len(words) - len(np.unique(words)) if len(words) >= 20 else 0
            row[-1] = len(lines) - len(set(lines))
    return out


@dataclass
class Space:
    """What is broadcast; its size is bounded by the parameters alone."""

    inverse_frequency: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        return unit(np.log1p(counts) * self.inverse_frequency * WEIGHTS)

    def scores(self, counts: np.ndarray, neighbours: int, sharpness: int) -> np.ndarray:
        """Label votes of the nearest labelled vectors; 0 without any term or any similar vector."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        cosines = unit(self.weighted(counts) @ self.projection) @ self.vectors.T
        k = min(neighbours, cosines.shape[1])
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        votes = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64) ** sharpness
        total = votes.sum(axis=1)
        return np.where(total > 0, (votes * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-300), 0.0).clip(0, 1)


def unit(rows: np.ndarray) -> np.ndarray:
    norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norms > 0, norms, 1)


def document_frequencies(docs: DataFrame, *, text: str) -> tuple[np.ndarray, int]:
    """Documents that hold each term, and documents, over the whole table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for at in range(0, len(texts), BLOCK):
                total += np.count_nonzero(term_counts(texts[at : at + BLOCK]), axis=0)
            rows += len(texts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(TERMS + 1), pa.int32()), pa.array([*total.tolist(), rows], pa.int64())], names=["term", "n"]
        )

    parts = map_batches(docs.select(F.col(f"`{text}`").cast("string")), run, "term int, n bigint")
    sums = {r["term"]: r["n"] for r in parts.groupBy("term").agg(F.sum("n").alias("n")).collect()}  # a row per term
    return np.array([sums.get(k, 0) for k in range(TERMS)]), sums.get(TERMS, 0)


def held_out(key: str) -> Column:
    """Rows never learnt from: crc32 of the id as text leaves 2 when divided by 4. Null ids are among them."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def fit(
    docs: DataFrame, labels: DataFrame, *, key: str, text: str, label: str, max_labelled: int, dimensions: int
) -> Space:
    frequency, n = document_frequencies(docs, text=text)
    inverse = np.log((1 + n) / (1 + frequency)).astype(np.float32) + 1
    marked = labels.filter(~held_out(key) & F.col(f"`{label}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("__key"))
    chosen = marked.agg(F.avg(F.col(f"`{label}`").cast("double")).alias("__label")).orderBy(F.xxhash64("__key"), "__key").limit(max_labelled)
    chosen = materialise(chosen, "labelled")
    found = docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").cast("string").alias("__text")).join(chosen, "__key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for at in range(0, len(texts), BLOCK):
                counts = [row.tobytes() for row in term_counts(texts[at : at + BLOCK])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(counts, pa.binary()), batch.column(1).slice(at, BLOCK), batch.column(2).slice(at, BLOCK)],
                    names=["counts", "label", "key"],
                )

    kind = docs.schema[key].dataType.simpleString()
    sample = map_batches(found.select("__text", "__label", "__key"), run, f"counts binary, label double, key {kind}")
    # Rows that repeat an id are no more than the sample allows either.
    rows = sample.orderBy("key", "counts").limit(max_labelled).toArrow()
    counts = np.frombuffer(b"".join(rows.column("counts").to_pylist()), np.float32).reshape(-1, TERMS)
    given = rows.column("label").to_numpy()
    space = Space(inverse, np.zeros((TERMS, 0), np.float32), np.zeros((0, 0), np.float32), given)
    if len(given):
        weighted = space.weighted(counts)
        width = min(dimensions + 16, *weighted.shape)
        basis = weighted.T @ np.random.default_rng(_SEED).standard_normal((len(given), width)).astype(np.float32)
        for _ in range(4):  # power iterations towards the leading right singular vectors
            basis, _ = np.linalg.qr(weighted.T @ (weighted @ basis))
        _, _, turn = np.linalg.svd(weighted @ basis, full_matrices=False)
        space.projection = np.ascontiguousarray((basis @ turn.T)[:, : min(dimensions, width)])
        space.vectors = np.ascontiguousarray(unit(weighted @ space.projection))
    return space


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_labelled: int = MAX_LABELLED,
    dimensions: int = DIMENSIONS,
    neighbours: int = NEIGHBOURS,
    sharpness: int = SHARPNESS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row: key, held_out, score (0 to 1), predicted (1 if score >= ``threshold``).

    A null or empty text has no terms and scores 0; without any labelled row every score is
    0.5. Several labels of one id are averaged; repeated rows are scored one by one; an empty table
    gives an empty result; other columns are not read.
    """
    space = fit(docs, labels, key=key, text=text, label=label, max_labelled=max_labelled, dimensions=dimensions)
    shared = docs.sparkSession.sparkContext.broadcast(space)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            blocks = [
                shared.value.scores(term_counts(texts[at : at + BLOCK]), neighbours, sharpness) for at in range(0, len(texts), BLOCK)
            ]
            scores = np.concatenate([*blocks, np.zeros(0)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))],
                names=[key, "held_out", "score", "predicted"],
            )

    chosen = docs.select(F.col(f"`{key}`"), held_out(key).alias("held_out"), F.col(f"`{text}`").cast("string").alias("__text"))
    return map_batches(chosen, run, f"`{key}` {kind}, held_out boolean, score double, predicted int")
