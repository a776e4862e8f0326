"""Benchmark decontamination: training texts that hold a test item.

The test items are indexed by BM25: an inverted list per term, in blocks with the largest
score of each. Terms are pairs of neighbouring words, since texts of one language share most
of their single words. Every passage of every text is a query. Block-max WAND finds all items that
score at least `threshold` of what the item scores against itself, without scoring items whose
bound lies below. What it finds is verified on the whole text: the runs of five words of the
item's question, and those that reach into its answer, must occur in it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.llm.words import ALPHANUMERIC, hash_words, hashed_batches, shingle_hashes

K1, B = 1.2, 0.75
#: Share of an item's score against itself at which a passage's match is verified.
THRESHOLD = 0.6
SHINGLE_WORDS = 5
OVERLAP = 0.8
TERM_WORDS = 2
BLOCK = 64
#: An item is indexed in pieces of at most so many terms.
PIECE_TERMS = 256
#: Characters of items that are collected and sent to the executors at a time. More items are
#: worked off in several passes over the texts.
INDEX_CHARS = 32 << 20


@dataclass(frozen=True)
class Item:
    """Hashes of an item's runs of words: of its question, and of those with answer words."""

    id: int
    width: int
    question: np.ndarray
    answer: np.ndarray


@dataclass(frozen=True)
class Posting:
    """Pieces with a term, their scores, and for each block its last piece and largest score."""

    pieces: np.ndarray
    scores: np.ndarray
    block_last: np.ndarray
    block_score: np.ndarray
    most: float


@dataclass(frozen=True)
class Index:
    """Pieces of up to `longest` words and over half of that: a short piece's terms weigh more,
    so bounds are tighter if pieces of a kind are indexed together."""

    terms: np.ndarray
    postings: list[Posting]
    most: np.ndarray
    owner: np.ndarray
    longest: int


def answer_start(text: str) -> int:
    """Where the answer begins: after the last question mark, else the last line, else the
    last sentence; 0 if the item has only one part."""
    body = text.rstrip()
    for mark in (r"\?\s", r"\n", r"[.!]\s"):
        ends = [m.end() for m in re.finditer(mark, body)]
        if ends:
            return ends[-1]
    return 0


def _words(text: str) -> np.ndarray:
    return hash_words(np.frombuffer(text.encode(), dtype=np.uint8), ALPHANUMERIC)[2]


def _item(id: int, text: str) -> Item | None:
    words = _words(text)
    if len(words) < TERM_WORDS:
        return None
    cut = len(_words(text[: answer_start(text)]))
    width = min(SHINGLE_WORDS, len(words))
    shingles = shingle_hashes(words, width)
    first = max(0, cut - width + 1)
    question, answer = shingles[:first], shingles[first:]
    return Item(id, width, np.unique(question), np.unique(answer))


def build_indexes(items: list[tuple[int, str | None]]) -> tuple[list[Item], list[Index]]:
    """Items with terms, and an index for each order of magnitude of their pieces' length."""
    kept: list[Item] = []
    pieces: dict[int, list[tuple[int, np.ndarray]]] = {}
    for id, text in sorted(items, key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")):
        item = _item(id, text or "")
        if item is None:
            continue
        words = _words(text)
        terms = shingle_hashes(words, TERM_WORDS)
        for part in np.array_split(terms, -(-len(terms) // PIECE_TERMS)):
            longest = max(4, 1 << (len(part) - 1).bit_length())
            pieces.setdefault(longest, []).append((len(kept), part))
        kept.append(item)
    return kept, [_index(longest, found) for longest, found in sorted(pieces.items())]


def _index(longest: int, owned: list[tuple[int, np.ndarray]]) -> Index:
    entries: dict[int, list[tuple[int, int]]] = {}
    for k, (_, part) in enumerate(owned):
        for term, count in zip(*np.unique(part, return_counts=True)):
            entries.setdefault(int(term), []).append((k, int(count)))
    lengths = np.array([len(part) for _, part in owned], dtype=np.float64)
    terms = np.array(sorted(entries), dtype=np.uint64)
    raw, own = [], np.zeros(len(owned))
    for term in terms.tolist():
        found = np.array(entries[term])
        numbers, counts = found[:, 0], found[:, 1]
        rarity = np.log(1 + (len(owned) - len(found) + 0.5) / (len(found) + 0.5))
        length = 1 - B + B * lengths[numbers] / lengths.mean()
        scores = rarity * counts * (K1 + 1) / (counts + K1 * length)
        own[numbers] += scores
        raw.append((numbers, scores))
    postings = []
    for numbers, scores in raw:
        share = scores / own[numbers]
        starts = np.arange(0, len(numbers), BLOCK)
        lasts = numbers[np.minimum(starts + BLOCK, len(numbers)) - 1]
        postings.append(
            Posting(numbers, share, lasts, np.maximum.reduceat(share, starts), float(share.max()))
        )
    most = np.array([p.most for p in postings])
    return Index(terms, postings, most, np.array([o for o, _ in owned]), longest)


class _Cursor:
    __slots__ = ("at", "piece", "posting")

    def __init__(self, posting: Posting):
        self.posting, self.at = posting, 0
        self.piece = int(posting.pieces[0])

    def seek(self, piece: int) -> bool:
        """To the first entry that is not before piece; False at the end."""
        pieces = self.posting.pieces
        self.at += int(np.searchsorted(pieces[self.at :], piece))
        if self.at >= len(pieces):
            return False
        self.piece = int(pieces[self.at])
        return True

    def block(self, piece: int) -> tuple[float, int]:
        """Largest score in the block where piece would be, and the block's last piece."""
        k = int(np.searchsorted(self.posting.block_last, piece))
        if k >= len(self.posting.block_last):
            return 0.0, 1 << 62
        return float(self.posting.block_score[k]), int(self.posting.block_last[k])


def retrieve(index: Index, terms: list[int], threshold: float) -> list[tuple[int, float]]:
    """All pieces whose score for the distinct terms reaches the threshold: block-max WAND."""
    slack = threshold - 1e-9
    cursors = [_Cursor(index.postings[t]) for t in terms]
    found = []
    while cursors:
        cursors.sort(key=lambda c: c.piece)
        bound, pivot = 0.0, -1
        for k, cursor in enumerate(cursors):
            bound += cursor.posting.most
            if bound >= slack:
                pivot = k
                break
        if pivot < 0:
            break
        piece = cursors[pivot].piece
        while pivot + 1 < len(cursors) and cursors[pivot + 1].piece == piece:
            pivot += 1
        blocks = [c.block(piece) for c in cursors[: pivot + 1]]
        if sum(score for score, _ in blocks) < slack:
            target = min(last for _, last in blocks) + 1
            if pivot + 1 < len(cursors):
                target = min(target, cursors[pivot + 1].piece)
            target = max(target, piece + 1)
        elif cursors[0].piece == piece:
            score = sum(float(c.posting.scores[c.at]) for c in cursors[: pivot + 1])
            if score >= slack:
                found.append((piece, score))
            target = piece + 1
        else:
            target = piece
        moved = [c for c in cursors[: pivot + 1] if c.piece >= target or c.seek(target)]
        cursors = moved + cursors[pivot + 1 :]
    return found


def _passages(
    terms: np.ndarray, ends: np.ndarray, index: Index, threshold: float
) -> Iterator[tuple[int, np.ndarray]]:
    """Passages that could reach the threshold: the text's number and its distinct terms.

    terms has the terms of several texts, one after another, and ends says where each ends.
    Passages are five quarters of the longest piece and begin every quarter, so that every
    stretch of a piece's length lies within one; a passage of two texts is cut in two.
    """
    step = index.longest // 4
    sums = np.concatenate([[0.0], np.cumsum(np.where(terms >= 0, index.most[terms], 0.0))])
    starts = np.arange(0, max(1, len(terms)), step)
    stops = np.minimum(starts + index.longest + step, len(terms))
    least = threshold - 1e-6
    for k in np.flatnonzero(sums[stops] - sums[starts] >= least):
        at, stop = int(starts[k]), int(stops[k])
        text = int(np.searchsorted(ends, at, side="right"))
        while at < stop:
            end = min(stop, int(ends[text]))
            passage = np.unique(terms[at:end])
            passage = passage[passage >= 0]
            if index.most[passage].sum() >= least:
                yield text, passage
            at, text = end, text + 1


def check_texts(
    items: list[Item],
    indexes: list[Index],
    words: np.ndarray,
    ends: np.ndarray,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
) -> list[tuple[int, int, float, float, float]]:
    """Text, item, score, question and answer overlap of each item that one of the texts holds."""
    best: dict[tuple[int, int], float] = {}
    pairs = np.append(shingle_hashes(words, TERM_WORDS), np.uint64(0))[: len(words)]
    last = ends[ends > 0] - 1
    for index in indexes:
        places = np.minimum(np.searchsorted(index.terms, pairs), len(index.terms) - 1)
        terms = np.where(index.terms[places] == pairs, places, -1)
        terms[last] = -1  # would pair words of two texts
        for text, passage in _passages(terms, ends, index, threshold):
            for piece, score in retrieve(index, passage.tolist(), threshold):
                key = (text, int(index.owner[piece]))
                best[key] = max(best.get(key, 0.0), score)
    found = []
    sets: dict[tuple[int, int], np.ndarray] = {}
    for (text, number), score in sorted(best.items()):
        item = items[number]
        if (text, item.width) not in sets:
            own = words[ends[text - 1] if text else 0 : ends[text]]
            sets[text, item.width] = shingle_hashes(own, item.width)
        parts = [
            float(np.isin(part, sets[text, item.width]).mean()) if len(part) else 1.0
            for part in (item.question, item.answer)
        ]
        if min(parts) >= overlap:
            found.append((text, number, score, *parts))
    return found


def _searcher(
    items: list[Item], indexes: list[Index], threshold: float, overlap: float, kind: pa.DataType
):
    schema = pa.schema(
        [
            ("doc", kind),
            ("text_key", pa.int64()),
            ("item", pa.int64()),
            ("score", pa.float64()),
            ("question_overlap", pa.float64()),
            ("answer_overlap", pa.float64()),
        ]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for numbers, ends, words in hashed_batches(batch["text"], ALPHANUMERIC):
                hits = check_texts(items, indexes, words, ends, threshold, overlap)
                if hits:
                    rows = pa.array([numbers[text] for text, *_ in hits])
                    docs, keys = batch["doc"].take(rows), batch["text_key"].take(rows)
                    ids = pa.array([items[i].id for _, i, *_ in hits], pa.int64())
                    rest = [pa.array(c, pa.float64()) for c in list(zip(*hits))[2:]]
                    yield pa.RecordBatch.from_arrays([docs, keys, ids, *rest], schema=schema)

    return search


def find_items(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
) -> DataFrame:
    """A row per text and test item that it holds: id, item, score, both overlaps, text_key.

    An item's answer is what follows its last question mark, else its last line, else its
    last sentence; the question is the rest. Both overlaps must reach `overlap`; a part
    without words of its own counts as found. Words are compared without case and
    punctuation. The score is the BM25 score of the best passage for a piece of the item, as
    a share of the piece's score for itself.

    Items are collected in parts of INDEX_CHARS characters at most, or of one item, and each
    part is one pass over the texts. Items of one word have no terms and match nothing. Null
    and empty texts and items match nothing; repeated
    rows of docs give repeated rows; equal items each give a row; other columns are left out;
    with no items or texts the result is empty. text_key is xxhash64 of the text: with the id,
    it finds the row again.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(
        F.col(id).alias("doc"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text")
    )
    tests = items.select(F.col(item).cast("long").alias("item"), F.col(item_text).alias("text"))
    tests = tests.where(F.col("text").isNotNull())
    chars = tests.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-chars // INDEX_CHARS))
    kind = docs.schema[id].dataType
    schema = (
        f"doc {kind.simpleString()}, text_key bigint, item bigint, score double,"
        " question_overlap double, answer_overlap double"
    )
    found = None
    for part in range(parts):
        chosen = tests
        if parts > 1:
            chosen = tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part)
        kept, indexes = build_indexes([tuple(r) for r in chosen.collect()])
        if not kept:
            continue
        search = _searcher(kept, indexes, threshold, overlap, to_arrow_type(kind))
        hits = rows.mapInArrow(search, schema)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    return found.select(
        F.col("doc").alias(id),
        F.col("item").alias(item),
        "score",
        "question_overlap",
        "answer_overlap",
        "text_key",
    )
