"""Tokens of a text under a byte-level pair vocabulary, without making identifiers."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: how a byte-level vocabulary of this kind cuts text before merging.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Pieces whose counts a worker remembers; above it, it forgets all and starts anew.
REMEMBERED = 500_000

@dataclass(frozen=True)
class Merges:
    """ranks: pair of symbols, as left << 32 | right, to its rank. made: symbol by rank."""

    ranks: dict[int, int]
    made: list[int]


def _byte_names() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {b: chr(b) for b in shown}
    for k, b in enumerate(b for b in range(256) if b not in names):
        names[b] = chr(256 + k)
    return [names[b] for b in range(256)]


def read_vocabulary(path: str) -> tuple[Merges, list[str]]:
    """Merges and special strings of a byte-level vocabulary file. Symbols 0 to 255 are bytes."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    symbols = {name: b for b, name in enumerate(_byte_names())}
    ranks: dict[int, int] = {}
    made: list[int] = []
    for rank, pair in enumerate(file["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        made.append(symbols.setdefault(left + right, len(symbols)))
        ranks[symbols[left] << 32 | symbols[right]] = rank
    return Merges(ranks, made), [t["content"] for t in file["added_tokens"]]


def count_piece(piece: bytes, merges: Merges) -> int:
    """Symbols left after merging: the first number of them less the merges done.

    The heap holds adjacent pairs as rank << 32 | place, the lowest rank first and of equal
    ones the leftmost. A popped pair whose symbols have changed meanwhile is passed over.
    """
    n = len(piece)
    rank_of, made = merges.ranks.get, merges.made
    symbols = [*piece, 0]
    heap = [
        rank << 32 | k
        for k, rank in enumerate(
            [rank_of(a << 32 | b) for a, b in zip(piece, piece[1:])]
        )
        if rank is not None
    ]
    heapify(heap)
    after = list(range(1, n + 2))
    before = list(range(-1, n))
    done = 0
    while heap:
        entry = heappop(heap)
        rank, k = entry >> 32, entry & 0xFFFFFFFF
        right = after[k]
        if right >= n or symbols[k] < 0 or rank_of(symbols[k] << 32 | symbols[right]) != rank:
            continue
        done += 1
        symbol = symbols[k] = made[rank]
        symbols[right] = -1
        after[k] = right = after[right]
        before[right] = k
        if right < n and (found := rank_of(symbol << 32 | symbols[right])) is not None:
            heappush(heap, found << 32 | k)
        left = before[k]
        if left >= 0 and (found := rank_of(symbols[left] << 32 | symbol)) is not None:
            heappush(heap, found << 32 | left)
    return n - done


def text_counter(merges: Merges, special: list[str]) -> Callable[[str], int]:
    """Counts a text; a special string in it is one token.

    A piece never reaches over a single blank, except from the blank on. So a text is cut at
    its blanks, and what lies between two is counted once, with the blank before it. Texts in
    which a blank stands within or after other white space are cut by the pattern alone.
    A bounded number of pieces is remembered.
    """
    cut = regex.compile(PIECES).findall
    stops = regex.compile("|".join(map(regex.escape, special))) if special else None
    mixed = regex.compile(r"\s \s|\s \Z").search
    pieces: dict[str, int] = {}
    units: dict[str, int] = {}

    def by_pattern(text: str) -> int:
        found = cut(text)
        for piece in found:
            if piece not in pieces:
                if len(pieces) > REMEMBERED:
                    pieces.clear()
                pieces[piece] = count_piece(piece.encode(), merges)
        return sum(pieces[p] if p in pieces else count_piece(p.encode(), merges) for p in found)

    def plain(text: str) -> int:
        if mixed(text):
            return by_pattern(text)
        first, *rest = text.split(" ")
        if len(units) > REMEMBERED:
            units.clear()
        for unit in set(rest).difference(units):
            units[unit] = by_pattern(" " + unit)
        return by_pattern(first) + sum(map(units.__getitem__, rest))

    def count(text: str | None) -> int:
        if not text:
            return 0
        if stops is None or not stops.search(text):
            return plain(text)
        parts = stops.split(text)
        return len(parts) - 1 + sum(map(plain, parts))

    return count


def token_count(text: Column, merges: Merges, special: list[str]) -> Column:
    """Tokens of each text; null and empty: 0. The vocabulary travels with the function."""

    @F.arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = text_counter(merges, special)
        for batch in batches:
            yield pa.array((count(t) for t in batch.to_pylist()), type=pa.int64(), size=len(batch))

    return counted(text)


def count_tokens(
    docs: DataFrame, vocabulary: str, limit: int = 512, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_tokens, over_limit (more than limit tokens).

    vocabulary: path of a byte-level pair vocabulary, which the driver reads. Its size is
    that of the file, whatever the data. Null and empty texts have 0 bytes and 0 tokens.
    A null id stays, repeated rows stay, other columns of docs are left out, an empty table
    gives an empty one. Time grows with n log n of a single piece, however long.
    """
    merges, special = read_vocabulary(vocabulary)
    return docs.select(
        F.col(id),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(F.col(text), merges, special).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
