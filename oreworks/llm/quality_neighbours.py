"""Quality of texts by a vote of their nearest labelled neighbours in a latent-semantic space.

A text is a bag of terms, each hashed to a column: its words; the shapes of its words (runs of
lower-case, upper-case, digits and each other sign) and of pairs of them; whether a word repeats
the one before it; and how long the text is. Columns weigh by the square root of their count and
their inverse document frequency, words and the rest each to a length of their own. The leading
singular vectors of the labelled texts, found by subspace iteration, fold a text's columns to
a short vector.

Labelled vectors are bounded in number (a parameter) and broadcast with the singular vectors.
Every text is compared with all of them, a block of texts at a time, by exact cosines; the
nearest vote with their labels, weighted by a power of their similarity.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.llm.lineage import cut
from oreworks.llm.words import (
    BLANK_SEPARATED,
    batched,
    hash_words,
    mix,
    text_bytes,
)

#: Labelled texts that vote, at most about so many.
LABELLED = 8_192
#: Columns for words, and for everything else.
WORDS, STYLE = 1 << 12, 1 << 12
COLUMNS = WORDS + STYLE
#: What words weigh beside the rest.
WORD_WEIGHT = 0.5
DIMENSIONS, SPARE, ROUNDS = 48, 16, 5
NEIGHBOURS, POWER = 32, 8
SEED = 11
#: Parts that the labelled texts are worked on in, and texts that are compared at a time.
PARTS, BLOCK = 8, 256
#: Score of a text if there is no label to learn from.
UNLEARNED = 0.5

_CLASSES = np.arange(256, dtype=np.uint8)
_CLASSES[ord("a") : ord("z") + 1] = ord("l")
_CLASSES[ord("A") : ord("Z") + 1] = ord("u")
_CLASSES[ord("0") : ord("9") + 1] = ord("d")
_CLASSES[0x80:] = ord("l")


def _shapes(data: np.ndarray) -> np.ndarray:
    """A hash of each word's shape: equal neighbours of one class count once."""
    kinds = np.where(BLANK_SEPARATED[data], _CLASSES[data], 0x20)
    keep = np.concatenate([[True], kinds[1:] != kinds[:-1]])
    return hash_words(kinds[keep])[2]


def _term(hashes: np.ndarray, kind: int) -> np.ndarray:
    """Columns of terms of a kind other than words."""
    spread = mix(hashes + np.uint64(kind * 0x9E3779B1)) % np.uint64(STYLE)
    return WORDS + spread.astype(np.int64)


def terms(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of whole texts: how many, and row, column and count of each term in them."""
    for numbers, ends, data in batched(text_bytes(column)):
        starts, _, words = hash_words(data)
        text = np.searchsorted(ends, starts, side="right")
        shapes = _shapes(data)
        first = np.concatenate([[True], text[1:] != text[:-1]])[: len(text)]
        before = np.where(first, np.uint64(1), np.roll(shapes, 1))
        pairs = mix(before) + shapes
        repeats = ~first & (words == np.roll(words, 1))
        length = np.bincount(text, minlength=len(numbers))
        sizes = np.frexp(length.astype(np.float64))[1].astype(np.uint64)
        rows = np.concatenate([text, text, text, text, np.arange(len(numbers))])
        columns = np.concatenate(
            [
                (words % np.uint64(WORDS)).astype(np.int64),
                _term(shapes, 1),
                _term(pairs, 2),
                _term(repeats.astype(np.uint64), 3),
                _term(sizes, 4),
            ]
        )
        kinds, counts = np.unique(rows * COLUMNS + columns, return_counts=True)
        yield len(numbers), kinds // COLUMNS, kinds % COLUMNS, counts


def weights(
    size: int, rows: np.ndarray, columns: np.ndarray, counts: np.ndarray, idf: np.ndarray
) -> np.ndarray:
    """Weight of each term: words and the rest of a text are each scaled to their length."""
    value = np.sqrt(counts) * idf[columns]
    group = rows * 2 + (columns >= WORDS)
    length = np.sqrt(np.bincount(group, value**2, 2 * size))
    value /= np.maximum(length, 1e-12)[group]
    return np.where(columns < WORDS, WORD_WEIGHT * value, value).astype(np.float32)


def _folded(
    size: int, rows: np.ndarray, columns: np.ndarray, value: np.ndarray, base: np.ndarray
) -> np.ndarray:
    """Unit vectors of texts, from terms in order of rows; a text without known terms is 0."""
    out = np.zeros((size, base.shape[1]), dtype=np.float32)
    at = 0
    while at < len(rows):  # some thousand terms at a time, in whole texts
        end = len(rows) if len(rows) - at <= 1 << 15 else int(
            np.searchsorted(rows, rows[at + (1 << 15)], side="right")
        )
        part = slice(at, end)
        new = np.flatnonzero(np.concatenate([[True], rows[part][1:] != rows[part][:-1]]))
        out[rows[part][new]] = np.add.reduceat(base[columns[part]] * value[part, None], new)
        at = end
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class Model:
    """idf and base: by column; vectors and labels: of the labelled texts; prior: their mean."""

    idf: np.ndarray
    base: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def scores(self, column: pa.Array, neighbours: int, power: float) -> Iterator[np.ndarray]:
        """Scores of the texts of a column, block after block."""
        for size, rows, columns, counts in terms(column):
            value = weights(size, rows, columns, counts, self.idf)
            yield self.vote(_folded(size, rows, columns, value, self.base), neighbours, power)

    def vote(self, texts: np.ndarray, neighbours: int, power: float) -> np.ndarray:
        """Mean label of each text's nearest neighbours, by similarity; a text that is similar
        to none has the mean of all labels."""
        if not len(self.labels):
            return np.full(len(texts), UNLEARNED)
        out = np.empty(len(texts))
        k = min(neighbours, len(self.labels))
        for at in range(0, len(texts), BLOCK):
            cosines = texts[at : at + BLOCK] @ self.vectors.T
            near = np.argpartition(cosines, -k, axis=1)[:, -k:]
            weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64)
            weight **= power
            total = weight.sum(axis=1)
            share = (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-300)
            out[at : at + len(cosines)] = np.where(total > 0, share, self.prior)
        return np.clip(out, 0.0, 1.0)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Label and terms of each text."""
    for batch in batches:
        labels = batch["label"].to_pylist()
        done = 0
        for size, rows, columns, counts in terms(batch["text"]):
            cuts = np.searchsorted(rows, np.arange(size + 1))
            parts = list(zip(cuts[:-1], cuts[1:]))
            yield pa.RecordBatch.from_pydict(
                {
                    "label": pa.array(labels[done : done + size], pa.int32()),
                    "terms": pa.array([columns[a:b].astype("<i4").tobytes() for a, b in parts]),
                    "counts": pa.array([counts[a:b].astype("<i4").tobytes() for a, b in parts]),
                }
            )
            done += size


def _sparse(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Labels and terms of some texts at a time, as `terms` gives them."""
    labels, bags, many = (batch[name].to_pylist() for name in ("label", "terms", "counts"))
    for at in range(0, len(labels), BLOCK):
        part = [np.frombuffer(x, "<i4").astype(np.int64) for x in bags[at : at + BLOCK]]
        counts = [np.frombuffer(x, "<i4") for x in many[at : at + BLOCK]]
        rows = np.repeat(np.arange(len(part)), [len(x) for x in part])
        yield labels[at : at + BLOCK], rows, np.concatenate(part), np.concatenate(counts)


def _texts_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts each column occurs, and how many texts there are."""
    total, texts = np.zeros(COLUMNS, dtype=np.int64), 0
    for batch in batches:
        for labels, _, columns, _ in _sparse(batch):
            total += np.bincount(columns, minlength=COLUMNS)
            texts += len(labels)
    yield pa.RecordBatch.from_pydict({"part": [total.tobytes()], "texts": [texts]})


def _times(idf: np.ndarray, base: np.ndarray) -> Callable:
    """X' X base, X being the labelled texts; some hundred of its rows at a time."""

    def times(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(base.shape)
        for batch in batches:
            for labels, rows, columns, counts in _sparse(batch):
                value = weights(len(labels), rows, columns, counts, idf)[:, None]
                new = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
                image = np.add.reduceat(base[columns] * value, new)
                back = np.repeat(image, np.diff(np.append(new, len(rows))), axis=0) * value
                order = np.argsort(columns, kind="stable")
                columns = columns[order]
                new = np.flatnonzero(np.concatenate([[True], columns[1:] != columns[:-1]]))
                total[columns[new]] += np.add.reduceat(back[order], new)
        yield pa.RecordBatch.from_pydict({"part": [total.astype("<f4").tobytes()], "texts": [0]})

    return times


def _vectors(idf: np.ndarray, base: np.ndarray) -> Callable:
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for labels, rows, columns, counts in _sparse(batch):
                value = weights(len(labels), rows, columns, counts, idf)
                vectors = _folded(len(labels), rows, columns, value, base)
                yield pa.RecordBatch.from_pydict(
                    {
                        "label": pa.array(labels, pa.int32()),
                        "vector": pa.array([v.astype("<f4").tobytes() for v in vectors]),
                    }
                )

    return fold


def fit(
    labelled: DataFrame,
    text: str = "text",
    label: str = "label",
    id: str = "doc_id",
    most: int = LABELLED,
    dimensions: int = DIMENSIONS,
) -> Model:
    """Labelled vectors, and the space that they lie in.

    About `most` of the labelled texts are used, or all if there are no more: those whose hash
    of id and text is smallest, each label by its share, with 256 of each at least. Labels are
    0 and 1; rows with others or without one teach nothing. Null texts are empty texts.
    """
    rows = labelled.select(
        F.col(label).cast("int").alias("label"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.xxhash64(F.col(id), F.col(text)).alias("slot"),
    ).where(F.col("label").isin(0, 1))
    known = dict(rows.groupBy("label").agg(F.count(F.lit(1))).collect())
    total = sum(known.values())
    empty = np.zeros((0, dimensions), dtype=np.float32)
    if not total:
        base = np.zeros((COLUMNS, dimensions), dtype=np.float32)
        return Model(np.ones(COLUMNS), base, empty, np.zeros(0), UNLEARNED)
    share = {k: min(1.0, max(most / total, 256 / n)) for k, n in known.items()}
    chosen = F.lit(False)
    for k, part in share.items():
        chosen |= (F.col("label") == k) & (
            F.pmod(F.col("slot"), F.lit(1 << 40)) < int(part * (1 << 40))
        )
    bags = cut(
        rows.where(chosen)
        .repartition(PARTS, "slot")
        .sortWithinPartitions("slot")
        .select("label", "text")
        .mapInArrow(_bags, "label int, terms binary, counts binary")
    )
    sums = "part binary, texts bigint"
    # However many partitions there are, the driver adds up few parts.
    parts = bags.coalesce(PARTS)
    found = parts.mapInArrow(_texts_with, sums).collect()
    texts = sum(r["texts"] for r in found)
    many = sum(np.frombuffer(r["part"], dtype=np.int64) for r in found)
    idf = np.log((1 + texts) / (1 + many)) + 0.1
    base = np.random.Generator(np.random.PCG64(SEED)).normal(size=(COLUMNS, dimensions + SPARE))
    base = np.linalg.qr(base)[0].astype(np.float32)
    for turn in range(ROUNDS):
        found = parts.mapInArrow(_times(idf, base), sums).collect()
        image = sum(np.frombuffer(r["part"], "<f4").reshape(base.shape).astype(float) for r in found)
        if turn < ROUNDS - 1:
            base = np.linalg.qr(image)[0].astype(np.float32)
    # Within the last subspace, the directions in which the texts differ most.
    turned = np.linalg.eigh(base.T.astype(float) @ image)[1][:, ::-1][:, :dimensions]
    base = (base @ turned).astype(np.float32)
    rows = parts.mapInArrow(_vectors(idf, base), "label int, vector binary").collect()
    vectors = np.array([np.frombuffer(r["vector"], "<f4") for r in rows]).reshape(-1, dimensions)
    labels = np.array([r["label"] for r in rows], dtype=np.float64)
    return Model(idf, base, vectors, labels, float(labels.mean()))


def scored(
    text: Column, model: Model, neighbours: int = NEIGHBOURS, power: float = POWER
) -> Column:
    """Score of each text, from 0 to 1, the higher the likelier its label is 1."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = list(model.scores(batch, neighbours, power))
            yield pa.array(np.concatenate(parts) if parts else [], pa.float64())

    return score(text)


def classify(
    docs: DataFrame,
    model: Model,
    threshold: float,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """id, score, predicted of every row: predicted is 1 from a score of threshold on, else 0.

    Whole texts are read; null texts are empty. Empty texts have a length and are scored by it.
    Without any label all scores are 0.5. Neighbours of equal similarity at the last place are
    taken in any order. Repeated rows stay, an empty table gives an empty result, and other
    columns are not read, whatever their names.
    """
    rows = docs.select(
        F.col(id).alias("id"), scored(F.coalesce(F.col(text), F.lit("")), model).alias("score")
    )
    return rows.select(
        F.col("id").alias(id), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
