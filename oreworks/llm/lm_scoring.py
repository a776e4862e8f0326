"""Log probabilities of texts under a language model fitted by deleted interpolation.

A word's probability after another mixes the maximum-likelihood estimate of the two, its share
of what follows the other, with that of the word alone; the weight depends on a bucket of the
other word's frequency. A text's first word follows the end of a text. The word alone mixes its
share of all training tokens with the probability of spelling it: the product over its bytes,
and the blank after it, of byte probabilities. A byte's probability mixes the maximum-likelihood
estimates of its trigram, bigram and unigram and a uniform one, weighted by buckets of the
context's frequency as well. All weights are learned by expectation-maximisation on a tenth of
the training texts, whose counts are left out meanwhile; then all training texts are counted.

Counts of words and of pairs have no bound, so they never leave the executors. Texts are worked
on in chunks, each kept as the numbers of its words. A chunk asks once for each of its distinct
words and pairs, by ranges of hashes; such a bucket adds up what all have counted and answers each. A frequent word or pair
thus weighs one entry a chunk. Byte trigrams have at most 2**24 kinds, and the driver mixes them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from oreworks.llm.language_id import held_out
from oreworks.llm.lineage import TOLD, cut, release
from oreworks.llm.words import BLANK_SEPARATED, batched, hash_words, mix, text_bytes

#: One in so many training texts is left out of the counts that weights are learned on.
DELETED = 10
ROUNDS = 30
#: Bytes of text in a chunk, unless a single text is longer.
CHUNK_BYTES = 8 << 20
#: Texts for which there is a bucket at least, so that a bucket does not grow with the table.
TEXTS_PER_BUCKET = 5_000
#: Stands for the end of a text among the words; it is spelled as a line break.
END_WORD = np.uint64(0xE7D0F1E7D0F1E7D1)
END_BYTE = 0x0A
BLANK = 0x20
#: Bins per power of ten, and their range, for the ratio of an estimate to the one below it.
BINS, LOW_BIN, HIGH_BIN = 10, -200, 4000


@dataclass(frozen=True)
class Spelling:
    """trigrams: codes in order and the probability that they add; rest: by context, the weight
    of the bigram; bigrams: by context and byte, the mixed probability."""

    trigrams: np.ndarray
    added: np.ndarray
    rest: np.ndarray
    bigrams: np.ndarray

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        lower = self.rest[codes >> 8] * self.bigrams[codes & 0xFFFF]
        if not len(self.trigrams):
            return lower
        at = np.minimum(np.searchsorted(self.trigrams, codes), len(self.trigrams) - 1)
        return lower + np.where(self.trigrams[at] == codes, self.added[at], 0.0)


def byte_events(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and trigram codes of all bytes of words and the blank after each.

    Each word is spelled on its own: what comes before it counts as two blanks.
    """
    inside = BLANK_SEPARATED[data]
    low = np.where((data >= 65) & (data <= 90), data + 32, data)
    low = np.where(inside, low, BLANK).astype(np.int64)
    one = np.concatenate([[BLANK], low[:-1]])
    two = np.concatenate([[BLANK], one[:-1]])
    two[one == BLANK] = BLANK
    places = np.flatnonzero(inside | (one != BLANK))
    return places, (two << 16 | one << 8 | low)[places]


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(codes, return_counts=True)


def _count_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram codes of the training texts, counted apart for those that are left out."""
    totals: dict[bool, tuple[np.ndarray, np.ndarray]] = {}

    def add(deleted: bool, codes: np.ndarray, counts: np.ndarray) -> None:
        if deleted in totals:
            codes = np.concatenate([totals[deleted][0], codes])
            counts = np.concatenate([totals[deleted][1], counts])
        kinds, at = np.unique(codes, return_inverse=True)
        totals[deleted] = kinds, np.bincount(at, counts, len(kinds)).astype(np.int64)

    for batch in batches:
        for deleted in (False, True):
            chosen = batch.filter(pa.compute.equal(batch["deleted"], deleted))
            if chosen.num_rows:
                ends = (BLANK << 16) | (BLANK << 8) | END_BYTE
                after = (BLANK << 16) | (END_BYTE << 8) | BLANK
                add(deleted, np.array([ends, after]), np.full(2, chosen.num_rows))
            for _, _, data in batched(text_bytes(chosen["text"])):
                add(deleted, *_counted(byte_events(data)[1]))
    for deleted, (codes, counts) in totals.items():
        yield pa.RecordBatch.from_pydict(
            {"deleted": pa.repeat(deleted, len(codes)), "code": codes, "n": counts}
        )


def _em(weight_of: np.ndarray, n: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Weights of the high estimate, by bucket, for events seen n times."""
    weights = np.full(int(weight_of.max(initial=0)) + 1, 0.5)
    seen = np.bincount(weight_of, n, len(weights))
    for _ in range(ROUNDS):
        w = weights[weight_of]
        mixed = w * high + (1 - w) * low
        share = np.where(mixed > 0, w * high / np.maximum(mixed, 1e-300), 0.0)
        got = np.bincount(weight_of, n * share, len(weights))
        weights = np.where(seen > 0, got / np.maximum(seen, 1), weights)
    return weights


def fit_spelling(codes: np.ndarray, kept: np.ndarray, deleted: np.ndarray) -> Spelling:
    """The byte model from trigram counts: kept, and left out."""
    uniform = np.full(256, 1 / 256)
    weights: list[np.ndarray] = []

    def mixed(counts: np.ndarray, learn: np.ndarray | None) -> Spelling:
        lower = uniform[codes & 0xFF]
        for order in (1, 2, 3):
            mask = (1 << (8 * order)) - 1
            kinds, at = np.unique(codes & mask, return_inverse=True)
            own = np.bincount(at, counts, len(kinds))
            contexts, where = np.unique(kinds >> 8, return_inverse=True)
            total = np.bincount(where, own, len(contexts))
            bucket = np.where(total > 0, np.log2(np.maximum(total, 1)).astype(int) + 1, 0)
            best = np.where(total[where] > 0, own / np.maximum(total[where], 1), 0.0)
            if learn is not None:
                weights.append(_em(bucket[where][at], learn, best[at], lower))
            w = weights[order - 1]
            of_context = np.where(total > 0, w[np.minimum(bucket, len(w) - 1)], 0.0)
            if order == 3:
                rest = np.ones(1 << 16)
                rest[contexts] = 1 - of_context
                return Spelling(kinds, of_context[where] * best, rest, bigrams)
            if order == 1:
                unigrams = (1 - of_context[0]) * uniform if len(of_context) else uniform
                unigrams = unigrams.copy()
                unigrams[kinds] += of_context[where] * best
                lower = unigrams[codes & 0xFF]
            else:
                keep = np.ones(256)
                keep[contexts] = 1 - of_context
                bigrams = (keep[:, None] * unigrams[None, :]).reshape(-1)
                bigrams[kinds] += of_context[where] * best
                lower = bigrams[codes & 0xFFFF]
        raise AssertionError

    mixed(kept, deleted)
    return mixed(kept + deleted, None)


class _Chunk:
    """Texts that are counted together."""

    def __init__(self):
        self.ids: list = []
        self.held: list[bool] = []
        self.deleted: list[bool] = []
        self.words: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.spelled: list[np.ndarray] = []
        self.bytes = 0

    def pack(self, number: int, spelled_end: float) -> dict:
        """The chunk's row: its text as numbers of words, which are ordered by frequency."""
        sizes = np.array(self.sizes) + 1
        hashes = np.empty(sizes.sum(), dtype=np.uint64)
        spelled = np.empty(len(hashes), dtype=np.float32)
        is_end = np.zeros(len(hashes), dtype=bool)
        is_end[np.cumsum(sizes) - 1] = True
        hashes[is_end], spelled[is_end] = END_WORD, spelled_end
        hashes[~is_end] = np.concatenate(self.words)
        spelled[~is_end] = np.concatenate(self.spelled)
        words, first, at, n = np.unique(
            hashes, return_index=True, return_inverse=True, return_counts=True
        )
        # Frequent words have small numbers, so that the text packs well.
        order = np.argsort(-n, kind="stable")
        number_of = np.empty(len(order), dtype=np.uint32)
        number_of[order] = np.arange(len(order))
        return {
            "chunk": number,
            "ids": self.ids,
            "held": self.held,
            "deleted": self.deleted,
            "tokens": sizes.tolist(),
            "text": _packed(number_of[at]),
            "known": words[order].tobytes(),
            "spelling": _packed(spelled[first][order]),
        }


def _packed(values: np.ndarray) -> bytes:
    """Numbers, all first bytes before all second ones, compressed; their size comes first."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], size, "zstd", asbytes=True), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).reshape(-1).view(kind)


def _pairs(at: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of words that follow each other, as numbers; which one ends at each word;
    and their hashes. The first word of a text follows the end of the one before it, and that
    of all the end of the last."""
    kinds, pair_at = np.unique(np.roll(at, 1) << 32 | at, return_inverse=True)
    odd = np.uint64(0x9E3779B97F4A7C15)
    return kinds, pair_at, mix(words[kinds >> 32] * odd + words[kinds & 0xFFFFFFFF])


class _Text:
    """A chunk's words in order, and the distinct words and pairs of it."""

    def __init__(self, row):
        self.sizes = np.asarray(row["tokens"], dtype=np.int64)
        self.at = _unpacked(row["text"], np.uint32).astype(np.int64)
        self.words = np.frombuffer(row["known"], np.uint64)
        self.spelled = _unpacked(row["spelling"], np.float32)
        kinds, self.pair_at, self.pairs = _pairs(self.at, self.words)
        self.before, self.word = kinds >> 32, kinds & 0xFFFFFFFF
        held, deleted = (np.asarray(row[c], dtype=bool) for c in ("held", "deleted"))
        self.kept, self.left = np.repeat([~held & ~deleted, ~held & deleted], self.sizes, axis=1)


def _questions(buckets: int, schema: pa.Schema):
    """What each chunk asks of each bucket, a range of hashes: these, as steps from one to the
    next, with the chunk's own counts."""
    edges = np.array([(k << 64) // buckets for k in range(buckets)], dtype=np.uint64)

    def of(row: dict) -> list[dict]:
        x = _Text(row)
        asked = [{"chunk": row["chunk"], "bucket": k} for k in range(buckets)]
        for names, hashes, at in (
            (("words", "kept", "left"), x.words, x.at),
            (("pairs", "pair_kept", "pair_left"), x.pairs, x.pair_at),
        ):
            order = np.argsort(hashes)
            counts = [np.bincount(at, chosen, len(hashes)).astype(np.uint32) for chosen in (x.kept, x.left)]
            columns = dict(zip(names, [hashes, *counts]))
            if names[0] == "words":
                columns["spelled"] = x.spelled
            bounds = np.append(np.searchsorted(hashes[order], edges), len(order))
            for k, question in enumerate(asked):
                chosen = order[bounds[k] : bounds[k + 1]]
                for name, values in columns.items():
                    part = values[chosen]
                    if values is hashes:
                        part = np.diff(part, prepend=np.uint64(0))
                    question[name] = _packed(part)
                question["any"] = question.get("any", False) or len(chosen) > 0
        return [question for question in asked if question.pop("any")]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                (row,) = batch.slice(k, 1).to_pylist()
                yield pa.RecordBatch.from_pylist(of(row), schema=schema)

    return make


def _spelled_words(data: np.ndarray, starts, ends, spelling: Spelling) -> np.ndarray:
    """log10 of each word's probability by its letters."""
    places, codes = byte_events(np.append(data, np.uint8(BLANK)))
    sums = np.concatenate([[0.0], np.cumsum(np.log10(np.maximum(spelling(codes), 1e-300)))])
    at = np.searchsorted(places, starts)
    return (sums[at + (ends - starts) + 1] - sums[at]).astype(np.float32)


def _chunks(spelling: Spelling, schema: pa.Schema):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        made = (context.partitionId() if context else 0) << 32
        end = np.array([BLANK << 16 | BLANK << 8 | END_BYTE, BLANK << 16 | END_BYTE << 8 | BLANK])
        spelled_end = float(np.log10(spelling(end)).sum())
        chunk = _Chunk()

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([chunk.pack(made, spelled_end)], schema=schema)

        for batch in batches:
            ids, held = batch["id"].to_pylist(), batch["held"].to_pylist()
            deleted = batch["deleted"].to_pylist()
            for numbers, bounds, data in batched(text_bytes(batch["text"])):
                starts, ends, hashes = hash_words(data)
                spelled = _spelled_words(data, starts, ends, spelling)
                cuts = np.searchsorted(starts, bounds)
                chunk.words.append(hashes)
                chunk.spelled.append(spelled)
                chunk.sizes += np.diff(cuts, prepend=0).tolist()
                for k in numbers:
                    chunk.ids.append(ids[k])
                    chunk.held.append(held[k])
                    chunk.deleted.append(deleted[k])
                chunk.bytes += len(data)
                if chunk.bytes >= CHUNK_BYTES:
                    yield packed()
                    made, chunk = made + 1, _Chunk()
        if chunk.ids:
            yield packed()

    return make


def _bin(kept: np.ndarray, spelled: np.ndarray) -> np.ndarray:
    ratio = np.floor((np.log10(np.maximum(kept, 1)) - spelled) * BINS).astype(np.int64)
    return np.where(kept > 0, np.clip(ratio, LOW_BIN, HIGH_BIN), LOW_BIN - 1)


def _added_up(table: pa.Table, keys: str, kept: str, left: str):
    """Distinct keys of all chunks' questions: which of them each is, where each chunk's end,
    the first of each, and how often texts that are kept, and left out, have them."""
    parts = [np.cumsum(_unpacked(x, np.uint64), dtype=np.uint64) for x in table[keys].to_pylist()]
    kinds, first, at = np.unique(np.concatenate(parts), return_index=True, return_inverse=True)
    sums = [
        np.bincount(
            at, np.concatenate([_unpacked(x, np.uint32) for x in table[c].to_pylist()]), len(kinds)
        ).astype(np.int64)
        for c in (kept, left)
    ]
    return at, np.cumsum([len(p) for p in parts])[:-1], first, *sums


def _answers(table: pa.Table) -> pa.Table:
    """All chunks' counts of a bucket's words and pairs, added up and sent back to each chunk."""
    spelled = np.concatenate([_unpacked(x, np.float32) for x in table["spelled"].to_pylist()])
    at, ends, first, kept_all, left_all = _added_up(table, "words", "kept", "left")
    total = kept_all + left_all
    answers = {
        "counts": [_packed(total[a]) for a in np.split(at, ends)],
        "kept_counts": [_packed(kept_all[a]) for a in np.split(at, ends)],
    }
    pair_at, pair_ends, _, pair_kept, pair_left = _added_up(table, "pairs", "pair_kept", "pair_left")
    both = pair_kept + pair_left
    answers["pair_counts"] = [_packed(both[a]) for a in np.split(pair_at, pair_ends)]
    answers["pair_kept_counts"] = [_packed(pair_kept[a]) for a in np.split(pair_at, pair_ends)]
    bins, where = np.unique(_bin(kept_all, spelled[first]), return_inverse=True)
    seen = np.bincount(where, left_all, len(bins)).astype(np.int64)
    by_letters = 10.0 ** spelled[first].astype(np.float64)
    rows = table.num_rows
    return pa.table(
        {
            "chunk": pa.array([*table["chunk"].to_pylist(), None], pa.int64()),
            "bucket": pa.array([int(table["bucket"][0].as_py())] * (rows + 1), pa.int32()),
            **{c: pa.array([*x, None], pa.binary()) for c, x in answers.items()},
            "tokens": pa.array([None] * rows + [int(total.sum())], pa.int64()),
            "kept": pa.array([None] * rows + [int(kept_all.sum())], pa.int64()),
            "kinds": pa.array([None] * rows + [int((total > 0).sum())], pa.int64()),
            "known": pa.array([None] * rows + [float(by_letters[total > 0].sum())], pa.float64()),
            "bins": pa.array([None] * rows + [bins.tolist()], pa.list_(pa.int64())),
            "seen": pa.array([None] * rows + [seen.tolist()], pa.list_(pa.int64())),
        }
    )


def word_weight(bins: np.ndarray, seen: np.ndarray, kept: int) -> float:
    """Weight of a word's share of the tokens against its spelling, from the words left out.

    A word alone has no context, so there is one; ``context_weights`` are for a word after another.
    """
    if not kept or not seen.sum():
        return 0.0 if not kept else 0.5
    ratio = 10.0 ** np.minimum((bins + 0.5) / BINS - np.log10(kept), 300)
    share = np.where(bins < LOW_BIN, 0.0, ratio)
    return float(_em(np.zeros(len(bins), dtype=int), seen, share, np.ones(len(bins)))[0])


def context_bucket(counts: np.ndarray) -> np.ndarray:
    """Words as contexts, by their frequency: 0 for those never seen, then a bucket per doubling."""
    return np.where(counts > 0, np.log2(np.maximum(counts, 1)).astype(np.int64) + 1, 0)


def context_weights(buckets: np.ndarray, bins: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Weight of a word's share of what follows the word before it against the word alone, by
    the latter's bucket, from the pairs left out; where there are none, that of the bucket below.

    One more pair that is new counts in each bucket, so that no weight leaves nothing to others.
    """
    if not seen.sum():
        return np.zeros(1)
    share = np.where(bins < LOW_BIN, 0.0, 10.0 ** np.minimum((bins + 0.5) / BINS, 300))
    each = np.unique(buckets)
    weights = _em(
        np.append(buckets, each),
        np.append(seen, np.ones(len(each))),
        np.append(share, np.zeros(len(each))),
        np.ones(len(bins) + len(each)),
    )
    learned = np.bincount(buckets, seen, len(weights)) > 0
    learned[0], weights[0] = True, 0.0
    return weights[np.maximum.accumulate(np.where(learned, np.arange(len(weights)), 0))]


class _Answered(_Text):
    """A chunk with the counts that it asked for: of words, and of pairs of them."""

    def __init__(self, chunk: pd.DataFrame, answers: pd.DataFrame):
        self.row = chunk.iloc[0]
        super().__init__(self.row)
        answers = answers.sort_values("bucket")

        def placed(column: str, hashes: np.ndarray) -> np.ndarray:
            counts = np.empty(len(hashes), dtype=np.int64)
            parts = [_unpacked(x, np.int64) for x in answers[column]]
            counts[np.argsort(hashes)] = np.concatenate(parts)
            return counts

        self.counts = placed("counts", self.words)
        self.kept_counts = placed("kept_counts", self.words)
        self.pair_counts = placed("pair_counts", self.pairs)
        self.pair_kept_counts = placed("pair_kept_counts", self.pairs)


def _alone(weight: float, counts: np.ndarray, tokens: int, spelled: np.ndarray) -> np.ndarray:
    return weight * counts / max(tokens, 1) + (1 - weight) * 10.0 ** spelled.astype(np.float64)


def _pair_events(weight: float, kept: int):
    """Pairs in texts left out, by context and by how much likelier the pair makes the word."""

    def events(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        x = _Answered(chunk, answers)
        n = np.bincount(x.pair_at, x.left, len(x.pairs)).astype(np.int64)
        found = np.flatnonzero(n)
        alone = _alone(weight, x.kept_counts, kept, x.spelled)
        before = x.kept_counts[x.before[found]]
        lower = np.log10(np.maximum(before * alone[x.word[found]], 1e-300))
        bins = _bin(x.pair_kept_counts[found], lower)
        table = pd.DataFrame({"context": context_bucket(before), "bin": bins, "n": n[found]})
        return table.groupby(["context", "bin"], as_index=False).sum()

    return events


def _scores(weight: float, weights: np.ndarray, tokens: int, kinds: int, unknown: float):
    floor = np.log10(tokens + kinds + 1)

    def score(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        x = _Answered(chunk, answers)
        alone = np.where(x.counts > 0, _alone(weight, x.counts, tokens, x.spelled), unknown)
        before = x.counts[x.before]
        w = weights[np.minimum(context_bucket(before), len(weights) - 1)]
        mixed = w * x.pair_counts / np.maximum(before, 1) + (1 - w) * alone[x.word]
        owner = np.repeat(np.arange(len(x.sizes)), x.sizes)

        def summed(values: np.ndarray) -> np.ndarray:
            return np.bincount(owner, values, len(x.sizes))

        return pd.DataFrame(
            {
                "id": x.row["ids"],
                "held_out": x.row["held"],
                "n_tokens": x.sizes,
                "n_known": summed((x.counts > 0)[x.at]).astype(np.int64),
                "train_tokens": tokens,
                "base_score": summed(np.log10(x.counts + 1)[x.at]) - x.sizes * floor,
                "score": summed(np.log10(np.maximum(mixed, 1e-300))[x.pair_at]),
            }
        )

    return score


def score(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Texts whose id's CRC-32 leaves 2 by 7 are held out: nothing is learned from them. Tokens
    are the words between blanks, ASCII upper case as lower, and an end. base_score uses
    add-one word counts, score the mixed model, in which the order of words counts; both are sums
    of log10, and in both all words that no training text has are one unknown token. The mixed
    model gives it what it leaves to all spellings that are not known words. Null texts are empty and have the end alone.
    A null id counts as '' and stays null. Repeated rows count each; other columns are left
    out; an empty table gives an empty one. Without training texts all tokens are unknown, and
    certain.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, docs.count() // TEXTS_PER_BUCKET)
    crc = F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")))
    rows = docs.select(
        F.col(id).alias("id"),
        F.col(text).alias("text"),
        held_out(id, 7, 2).alias("held"),
        (F.floor(crc / 7) % DELETED == 0).alias("deleted"),
    )
    grams = (
        rows.where("NOT held")
        .select("text", "deleted")
        .mapInArrow(_count_bytes, "deleted boolean, code bigint, n bigint")
        .groupBy("code")
        .agg(
            F.sum(F.when(F.col("deleted"), 0).otherwise(F.col("n"))).alias("kept"),
            F.sum(F.when(F.col("deleted"), F.col("n")).otherwise(0)).alias("left"),
        )
        .toArrow()
        .sort_by("code")
    )
    codes, kept, left = (grams[c].to_numpy() for c in ("code", "kept", "left"))
    spelling = fit_spelling(codes, kept, left)

    kind = docs.schema[id].dataType.simpleString()
    chunk_kind = (
        f"chunk bigint, ids array<{kind}>, held array<boolean>, deleted array<boolean>,"
        " tokens array<bigint>, text binary, known binary, spelling binary"
    )
    question_kind = "chunk bigint, bucket int, words binary, kept binary, `left` binary," + (
        " spelled binary, pairs binary, pair_kept binary, pair_left binary"
    )

    def arrow(kind: str) -> pa.Schema:
        return to_arrow_schema(spark.createDataFrame([], kind).schema)

    whole = cut(rows.mapInArrow(_chunks(spelling, arrow(chunk_kind)), chunk_kind))
    asked = whole.mapInArrow(_questions(buckets, arrow(question_kind)), question_kind)
    answers = cut(
        asked.groupBy("bucket").applyInArrow(
            _answers,
            "chunk bigint, bucket int, counts binary, kept_counts binary, pair_counts binary,"
            " pair_kept_counts binary, tokens bigint, kept bigint, kinds bigint, known double,"
            " bins array<bigint>, seen array<bigint>",
        )
    )
    release(spark, TOLD)  # the questions, before whole chunks are shuffled
    told = answers.where("chunk IS NULL")
    tokens, kept_tokens, kinds, known = told.agg(
        *[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "kept", "kinds", "known")]
    ).first()
    seen = (
        told.select(F.explode(F.arrays_zip("bins", "seen")).alias("x"))
        .groupBy("x.bins")
        .agg(F.sum("x.seen").alias("n"))
        .orderBy("bins")
        .collect()
    )
    weight = word_weight(
        np.array([r[0] for r in seen], dtype=np.int64), np.array([r[1] for r in seen]), kept_tokens
    )
    counts = ["counts", "kept_counts", "pair_counts", "pair_kept_counts"]
    told_chunks = answers.where("chunk IS NOT NULL").select("chunk", "bucket", *counts)

    def with_answers() -> PandasCogroupedOps:
        return whole.groupBy("chunk").cogroup(told_chunks.groupBy("chunk"))

    pairs = (
        with_answers()
        .applyInPandas(_pair_events(weight, kept_tokens), "context bigint, bin bigint, n bigint")
        .groupBy("context", "bin")
        .agg(F.sum("n").alias("n"))
        .orderBy("context", "bin")
        .toPandas()
    )
    weights = context_weights(*(pairs[c].to_numpy(np.int64) for c in ("context", "bin", "n")))
    release(spark, TOLD)  # the chunks that were shuffled, before they are once more
    unknown = (1 - weight) * max(0.0, 1 - known)
    scored = with_answers().applyInPandas(
        _scores(weight, weights, tokens, kinds, unknown),
        f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,"
        " base_score double, score double",
    )
    return scored.withColumnRenamed("id", id)
