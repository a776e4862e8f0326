"""The language of a text, by high-dimensional profiles of its letter n-grams.

Every letter has a random vector of +1 and -1. An n-gram's vector binds (multiplies) the
vectors of its letters, each permuted (rotated) by its place. A text's vector bundles (adds)
those of all its n-grams, and a language's prototype bundles the texts known to be in it.
The predicted language is that of the prototype with the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
SEED = 7
DIMENSIONS = 1024
LETTERS = 3
#: Labelled texts that a language's prototype is fitted on, about; see `fit`.
TEXTS_PER_LANGUAGE = 5_000
#: Languages that may be learned: bounds what is collected and sent with the function.
MOST_LANGUAGES = 1_000
#: n-grams whose vectors a worker remembers; above it, it forgets all and starts anew.
REMEMBERED = 12_000
#: Prototypes are added up as whole numbers, so that order does not matter.
UNIT = 1 << 20


@dataclass(frozen=True)
class Model:
    """Language names in order and their prototypes, as rows of length one."""

    languages: tuple[str, ...]
    prototypes: np.ndarray


class Profiler:
    """Makes the vectors of texts."""

    def __init__(self, dimensions: int = DIMENSIONS, letters: int = LETTERS):
        self.dimensions, self.letters = dimensions, letters
        self._is_letter: np.ndarray | None = None
        self._letter_vectors: dict[int, np.ndarray] = {}
        self._forget()

    def _forget(self) -> None:
        self._places: dict[int, int] = {}
        self._vectors = np.empty((REMEMBERED, self.dimensions), dtype=np.int8)

    def _codes(self, text: str) -> np.ndarray:
        """Lower-case letters, with one 0 for each run of anything else and at both ends."""
        if self._is_letter is None:
            self._is_letter = np.fromiter(
                (chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000
            )
        codes = np.frombuffer(
            f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32
        )
        codes = np.where(self._is_letter[codes], codes, 0)
        keep = codes != 0
        keep[1:] |= codes[:-1] != 0
        keep[0] = True
        return codes[keep].astype(np.int64)

    def _letter_vector(self, code: int) -> np.ndarray:
        if code not in self._letter_vectors:
            rng = np.random.Generator(np.random.PCG64([SEED, code]))
            self._letter_vectors[code] = rng.integers(0, 2, self.dimensions, dtype=np.int8) * 2 - 1
        return self._letter_vectors[code]

    def _bind(self, gram: int) -> np.ndarray:
        vector = np.ones(self.dimensions, dtype=np.int8)
        for place in range(self.letters):
            letter = self._letter_vector(gram >> (21 * place) & 0x1FFFFF)
            vector *= np.roll(letter, place)
        return vector

    def __call__(self, text: str | None) -> np.ndarray | None:
        """Bundle of the text's n-grams, not scaled; None for a text without letters."""
        codes = self._codes(text or "")
        if len(codes) < self.letters:
            return None if not codes.any() else self._bundle(codes)
        return self._bundle(codes) if codes.any() else None

    def _bundle(self, codes: np.ndarray) -> np.ndarray:
        while len(codes) < self.letters:
            codes = np.append(codes, 0)
        grams = np.zeros(len(codes) - self.letters + 1, dtype=np.int64)
        for place in range(self.letters):
            start = self.letters - 1 - place
            grams |= codes[start : start + len(grams)] << (21 * place)
        kinds, counts = np.unique(grams, return_counts=True)
        total = np.zeros(self.dimensions, dtype=np.float32)
        for at in range(0, len(kinds), 2048):
            rows = self._rows(kinds[at : at + 2048].tolist())
            total += counts[at : at + 2048].astype(np.float32) @ self._vectors[rows].astype(
                np.float32
            )
        return total

    def _rows(self, grams: list[int]) -> list[int]:
        places = self._places
        if len(places) + len(grams) > REMEMBERED:
            self._forget()
            places = self._places
        for gram in grams:
            if gram not in places:
                self._vectors[len(places)] = self._bind(gram)
                places[gram] = len(places)
        return [places[g] for g in grams]


def _partial_prototypes(dimensions: int, letters: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profile = Profiler(dimensions, letters)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                vector = profile(text)
                if vector is not None and (length := np.linalg.norm(vector)):
                    whole = np.rint(vector / length * UNIT).astype(np.int64)
                    sums[lang] = sums.get(lang, 0) + whole
        for lang, total in sums.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.repeat(lang, dimensions),
                    "place": pa.array(range(dimensions), pa.int32()),
                    "value": total,
                }
            )

    return add


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    id: str = "doc_id",
    texts_per_language: int = TEXTS_PER_LANGUAGE,
    dimensions: int = DIMENSIONS,
    letters: int = LETTERS,
) -> Model:
    """Prototypes of the languages of labelled texts.

    Every language is fitted on about texts_per_language of its texts, or on all if it has
    fewer; a hash of id and text picks them, so that rows without ids are picked one by one. Rows without language, text or letters teach
    nothing. A table that teaches nothing gives a model without languages.
    """
    rows = labelled.select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(id).alias("id")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in column {lang}")
    if not counts:
        return Model((), np.zeros((0, dimensions), dtype=np.float32))
    slots = 1 << 30
    share = F.create_map(
        *[
            F.lit(x)
            for row in counts
            for x in (row["lang"], int(min(1.0, texts_per_language / row["count"]) * slots))
        ]
    )
    slot = F.pmod(F.xxhash64("id", "text"), F.lit(slots))
    sums = (
        rows.where(slot < share[F.col("lang")])
        .select("lang", "text")
        .mapInArrow(
            _partial_prototypes(dimensions, letters), "lang string, place int, value bigint"
        )
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("vector"))
        .select("lang", F.col("vector.value").alias("vector"))
        .collect()
    )
    sums.sort(key=lambda row: row["lang"])
    vectors = np.array([row["vector"] for row in sums], dtype=np.float64).reshape(-1, dimensions)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    return Model(tuple(row["lang"] for row in sums), vectors.astype(np.float32))


def predicted(text: Column, model: Model, letters: int = LETTERS) -> Column:
    """struct<lang, score> of each text; `und` and 0 for null, or without a letter.

    The score is the cosine with the language's prototype, 0 if it is negative. Of equal
    languages the first by name is taken.
    """

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        profile = Profiler(model.prototypes.shape[1], letters)
        for batch in batches:
            langs, scores = [], []
            for value in batch.to_pylist():
                vector = profile(value) if value and model.languages else None
                length = 0.0 if vector is None else float(np.linalg.norm(vector))
                if vector is None:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                cosines = model.prototypes @ vector / max(length, 1e-12)
                best = int(np.argmax(cosines))
                langs.append(model.languages[best])
                scores.append(min(1.0, max(0.0, float(cosines[best]))))
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"]
            )

    return predict(text)


def held_out(id: str, parts: int, part: int) -> Column:
    """Is the row's part, by CRC-32 of its id as text, the one that is held out? Null id: of ''."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit(""))) % parts == part


def identify(
    docs: DataFrame,
    model: Model,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of docs: id, lang_pred, score.

    Whole texts are read. Null texts and texts without letters are `und` with score 0.
    Repeated rows stay; other columns are left out; an empty table gives an empty one.
    """
    found = docs.select(F.col(id), predicted(F.col(text), model).alias("found"))
    return found.select(
        id, F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )
