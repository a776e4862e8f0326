"""Passages that occur in several documents: all but one of each are removed.

Paragraphs (lines) are compared by MinHash banding, tuned for recall: colliding ones are
verified by the exact Jaccard similarity of their five-word runs and clustered by components,
and one paragraph of each cluster stays. A passage that starts or ends inside a
paragraph makes neither a near copy, so paragraphs, sentences and seeds are compared as well,
as they are. Seeds are runs of `SEED_WORDS` words, picked by the least hash of every
`SEED_WINDOW` that follow each other, wherever sentences and lines end: equal passages of
`SEED_WORDS + SEED_WINDOW - 1` words have a seed in common. Sentences of under five words
are compared as runs of them that reach `RUN_WORDS` words, one from each. From the outer ones the passage is
extended word by word, as far as the kept document has the same words. What is removed is a
run of all of these of at least `RUN_WORDS` words; sentences of under five words count only
between others and within seeds.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.llm.hot import meet
from oreworks.llm.jaccard_join import odd_sketch
from oreworks.llm.lineage import cut
from oreworks.llm.linking import group
from oreworks.llm.words import batched, hash_words, mix, shingle_hashes, text_bytes

SHINGLE_WORDS = 5
SIMILARITY = 80  # in hundredths
RECALL = 0.99
HASHES = 40
#: Shorter paragraphs are compared by their sentences only.
PARAGRAPH_WORDS = 20
#: Words in the shortest passage that is removed.
RUN_WORDS = 25
SEED_WORDS, SEED_WINDOW = 26, 25
FEW_CANDIDATES = 1_000_000
#: Lists of words beside seeds (some 500 bytes each) up to which they are broadcast.
FEW_CONTEXTS = 100_000
#: What a hash in the table of equal stretches of words stands for.
SENTENCE, LINE, SEED, SHORT = 0, 1, 2, 3


def tune(similarity: float, recall: float, hashes: int) -> tuple[int, int]:
    """Bands and rows: the longest bands with which pairs at the similarity still collide
    with the wanted probability."""
    for rows in range(hashes, 0, -1):
        bands = hashes // rows
        if 1 - (1 - similarity**rows) ** bands >= recall:
            return bands, rows
    raise ValueError("too few hashes for this recall")


BANDS, ROWS = tune(SIMILARITY / 100, RECALL, HASHES)


class Units:
    """Sentences and paragraphs of several texts, one after another."""

    def __init__(self, bounds: np.ndarray, data: np.ndarray):
        starts, ends, self.words = hash_words(data)
        breaks = np.cumsum(data == 10)
        self.cuts = np.searchsorted(starts, bounds)
        n = len(starts)
        self.text = text = np.searchsorted(bounds, starts, side="right")
        line = breaks[starts] if n else starts
        last = data[ends - 1] if n else data
        new_line = np.ones(n, dtype=bool)
        new_line[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
        new_sentence = new_line.copy()
        new_sentence[1:] |= np.isin(last[:-1], np.frombuffer(b".!?", dtype=np.uint8))
        self.line_first = np.flatnonzero(new_line)
        self.sentence_first = np.flatnonzero(new_sentence)
        self.line_of = np.cumsum(new_line) - 1
        self.n = n

    def hashes_of(self, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and length of each stretch of words that begins at one of the places."""
        stops = np.append(firsts[1:], self.n)
        return self._stretches(firsts, stops), stops - firsts

    def _stretches(self, firsts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        odd = np.uint64(0x9E3779B97F4A7C15)
        powers = np.full(self.n + 1, odd, dtype=np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        back = np.full(self.n + 1, np.uint64(pow(int(odd), -1, 1 << 64)), dtype=np.uint64)
        back[0] = 1
        back = np.multiply.accumulate(back)
        sums = np.zeros(self.n + 1, dtype=np.uint64)
        np.cumsum(self.words * powers[: self.n], out=sums[1:])
        raw = (sums[stops] - sums[firsts]) * back[firsts]
        return mix(raw + (stops - firsts).astype(np.uint64)).view(np.int64)

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of the seeds.

        Of one seed that follows itself (repetitive text) some are left out, but the words from
        the first to the last remain covered.
        """
        reach = SEED_WORDS + SEED_WINDOW - 1
        if self.n < reach:
            none = np.zeros(0, dtype=np.int64)
            return none, none
        firsts = np.arange(self.n - SEED_WORDS + 1)
        made = self._stretches(firsts, firsts + SEED_WORDS)
        windows = np.lib.stride_tricks.sliding_window_view(made, SEED_WINDOW)
        least = np.arange(len(windows)) + windows.argmin(axis=1)
        places = np.unique(least[self.text[: len(windows)] == self.text[reach - 1 :]])
        hashes, text = made[places], self.text[places]
        new = np.ones(len(places), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        last = np.append(new[1:], True)[: len(places)]
        begin = places[np.flatnonzero(new)][np.cumsum(new) - 1]
        step = (places - begin) // ((SEED_WINDOW + 1) // 2)
        keep = new | last
        keep[1:] |= step[1:] != step[:-1]
        return places[keep], hashes[keep]

    def short_runs(self) -> tuple[np.ndarray, np.ndarray]:
        """From each sentence of under five words on, the shortest run of such sentences that
        has RUN_WORDS words: its first sentence and its hash."""
        firsts = self.sentence_first
        stops = np.append(firsts[1:], self.n)[: len(firsts)]
        last = np.searchsorted(stops, firsts + RUN_WORDS)
        found = np.flatnonzero(last < len(firsts))
        last = last[found]
        others = np.append(0, np.cumsum(stops - firsts >= SHINGLE_WORDS))
        fits = (others[last + 1] == others[found]) & (
            self.text[firsts[last]] == self.text[firsts[found]]
        )
        found, last = found[fits], last[fits]
        return found, self._stretches(firsts[found], stops[last])

    def shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of runs of words within a paragraph, and their paragraph."""
        if self.n < SHINGLE_WORDS:
            none = np.zeros(0, dtype=np.int64)
            return none.view(np.uint64), none
        made = shingle_hashes(self.words, SHINGLE_WORDS)
        first = self.line_of[: len(made)]
        within = first == self.line_of[SHINGLE_WORDS - 1 :]
        return made[within], first[within]


def _factors() -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(11))
    return rng.integers(1, 1 << 62, size=(HASHES, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A row of band keys for each set; sets lie one after another and begin at starts."""
    if not len(starts):
        return np.zeros((0, BANDS), dtype=np.int64)
    keys = np.zeros((len(starts), BANDS), dtype=np.uint64)
    for k, (a, b) in enumerate(_factors()[: BANDS * ROWS]):
        least = np.minimum.reduceat(mix(hashes * a + b), starts)
        band = k // ROWS
        keys[:, band] = mix(keys[:, band] * np.uint64(31) + least + np.uint64(band))
    return keys.view(np.int64)


def _list_column(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _repeated(values: np.ndarray) -> np.ndarray:
    """Which values occur earlier in the array."""
    again = np.ones(len(values), dtype=bool)
    again[np.unique(values, return_index=True)[1]] = False
    return again


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for numbers, bounds, data in batched(text_bytes(batch["text"])):
            units = Units(bounds, data)
            hashes, sizes = units.hashes_of(units.sentence_first)
            line_hashes, line_sizes = units.hashes_of(units.line_first)
            line_of = units.line_of[units.sentence_first]
            shingles, owner = units.shingles()
            long = np.flatnonzero(line_sizes >= PARAGRAPH_WORDS)
            keep = np.isin(owner, long)
            keys = band_keys(shingles[keep], np.searchsorted(owner[keep], long))
            places, seeds = units.seeds()
            seeds_by_text = np.searchsorted(places, units.cuts)
            by_text = np.searchsorted(units.sentence_first, units.cuts)
            short, short_hashes = units.short_runs()
            short_by_text = np.searchsorted(short, by_text)
            lines_by_text = np.searchsorted(units.line_first, units.cuts)
            long_by_text = np.searchsorted(long, lines_by_text)
            columns: dict[str, list[np.ndarray]] = {
                c: []
                for c in (
                    "hashes", "sizes", "again", "lines", "long", "long_hashes", "bands", "places",
                    "seeds", "short", "short_hashes",
                )
            }
            a = p = q = t = word = u = 0
            for b, q2, p2, t2, word2, u2 in zip(
                by_text, long_by_text, lines_by_text, seeds_by_text, units.cuts, short_by_text
            ):
                columns["hashes"].append(hashes[a:b])
                columns["sizes"].append(sizes[a:b])
                columns["again"].append(_repeated(hashes[a:b]))
                columns["lines"].append(line_of[a:b] - p)
                columns["long"].append(long[q:q2] - p)
                columns["long_hashes"].append(line_hashes[long[q:q2]])
                columns["bands"].append(keys[q:q2].reshape(-1))
                columns["places"].append(places[t:t2] - word)
                columns["seeds"].append(seeds[t:t2])
                columns["short"].append(short[u:u2] - a)
                columns["short_hashes"].append(short_hashes[u:u2])
                a, p, q, t, word, u = b, p2, q2, t2, word2, u2
            picked = batch.take(pa.array(numbers))
            kinds = {"hashes": pa.int64(), "again": pa.bool_(), "long_hashes": pa.int64()}
            kinds["bands"] = kinds["seeds"] = kinds["short_hashes"] = pa.int64()
            yield pa.RecordBatch.from_arrays(
                [picked["id"], picked["text_key"]]
                + [_list_column(v, kinds.get(c, pa.int32())) for c, v in columns.items()],
                ["id", "text_key", *columns],
            )


def _paragraph_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, bounds, data in batched(text_bytes(batch["text"])):
            units = Units(bounds, data)
            hashes, sizes = units.hashes_of(units.line_first)
            shingles, owner = units.shingles()
            rows = []
            for k in np.flatnonzero(sizes >= PARAGRAPH_WORDS):
                at, end = np.searchsorted(owner, [k, k + 1])
                items = np.unique(shingles[at:end]).view(np.int64)
                rows.append((int(hashes[k]), len(items), odd_sketch(items), items))
            if rows:
                nodes, counts, sketches, items = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(nodes, pa.int64()),
                        pa.array(counts, pa.int64()),
                        _list_column(list(sketches), pa.int64()),
                        _list_column(list(items), pa.int64()),
                    ],
                    ["node", "size", "sketch", "items"],
                )


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words before (last one first) and after the seeds that are asked for, as hashes."""
    for batch in batches:
        for numbers, bounds, data in batched(text_bytes(batch["text"])):
            units = Units(bounds, data)
            places, hashes = units.seeds()
            a, rows = 0, []
            for number, b in zip(numbers, units.cuts):
                words = units.words[a:b].view(np.int64)
                s, t = np.searchsorted(places, [a, b])
                first = dict(zip(hashes[s:t][::-1].tolist(), (places[s:t][::-1] - a).tolist()))
                for ask in batch["asks"][number].as_py():
                    at = ask["place"] if ask["place"] >= 0 else first.get(ask["hash"])
                    if at is not None:
                        before = words[max(0, at - SEED_WINDOW) : at][::-1]
                        after = words[at + SEED_WORDS :][:SEED_WINDOW]
                        doc = batch["doc"][number].as_py()
                        rows.append((doc, ask["hash"], ask["place"], before, after))
                a = b
            if rows:
                docs, found, asked, before, after = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs, pa.int64()),
                        pa.array(found, pa.int64()),
                        pa.array(asked, pa.int32()),
                        _list_column(list(before), pa.int64()),
                        _list_column(list(after), pa.int64()),
                    ],
                    ["doc", "hash", "place", "before", "after"],
                )


def runs(
    sizes: list[int], pieces: list[tuple[int, int, int]], least: int
) -> list[tuple[int, int, int]]:
    """First word, words and kept row of each run of pieces that is long enough.

    A piece has its first word, the place after its last, and the kept row. Sentences of under
    five words do not end a run and belong to it if it goes on.
    """
    starts = [0, *accumulate(sizes)]

    def short(first: int, stop: int) -> bool:
        k = bisect_right(starts, first) - 1
        while starts[k] < stop:
            if sizes[k] >= SHINGLE_WORDS:
                return False
            k += 1
        return True

    merged: list[list[int]] = []
    for first, stop, kept in sorted(pieces):
        if merged and (first <= merged[-1][1] or short(merged[-1][1], first)):
            merged[-1][1] = max(merged[-1][1], stop)
        else:
            merged.append([first, stop, kept])
    return [(a, b - a, kept) for a, b, kept in merged if b - a >= least]


SPAN = "array<struct<first_word:bigint,n_words:bigint,kept_row:bigint>>"


EDGE = "array<struct<hash:bigint,place:int,kept:bigint,left:boolean>>"


def _edges():
    """The first and the last of each row of seeds that leave no word between them."""

    @F.arrow_udf(EDGE)
    def made(marks: pa.Array) -> pa.Array:
        out = []
        for mark in marks.to_pylist():
            seeds = sorted((m["at"], m["hash"], m["kept"]) for m in mark or [] if m["kind"] == SEED)
            found = []
            for k, (at, hash, kept) in enumerate(seeds):
                edge = {"hash": hash, "place": at, "kept": kept}
                if k == 0 or seeds[k - 1][0] + SEED_WORDS < at:
                    found.append(edge | {"left": True})
                if k + 1 == len(seeds) or at + SEED_WORDS < seeds[k + 1][0]:
                    found.append(edge | {"left": False})
            out.append(found)
        kind = [("hash", pa.int64()), ("place", pa.int32()), ("kept", pa.int64()), ("left", pa.bool_())]
        return pa.array(out, pa.list_(pa.struct(kind)))

    return made


def _spans(least: int):
    @F.arrow_udf(SPAN)
    def made(
        sizes: pa.Array, lines: pa.Array, again: pa.Array, marks: pa.Array, line_marks: pa.Array,
        extents: pa.Array, row: pa.Array,
    ) -> pa.Array:
        out = []
        for size, line, repeat, mark, line_mark, extent, own in zip(
            *(x.to_pylist() for x in (sizes, lines, again, marks, line_marks, extents, row))
        ):
            kept = {m["at"]: m["kept"] for m in mark or [] if m["kind"] == SENTENCE}
            kept_lines = {m["at"]: m["kept"] for m in line_mark or []}
            kept_lines |= {m["at"]: m["kept"] for m in mark or [] if m["kind"] == LINE}
            for k, (n, r) in enumerate(zip(size, repeat)):
                if r and n >= SHINGLE_WORDS:
                    kept.setdefault(k, own)
            pieces = [
                (m["at"], m["at"] + SEED_WORDS, m["kept"])
                for m in mark or []
                if m["kind"] == SEED
            ]
            for e in extent or []:
                first, stop = e["place"], e["place"] + SEED_WORDS
                if e["left"]:
                    pieces.append((first - e["n"], stop, e["kept"]))
                else:
                    pieces.append((first, stop + e["n"], e["kept"]))
            short = {m["at"]: m["kept"] for m in mark or [] if m["kind"] == SHORT}
            at = 0
            for k, n in enumerate(size):
                if k in short:
                    words = next(x for x in accumulate(size[k:]) if x >= RUN_WORDS)
                    pieces.append((at, at + words, short[k]))
                if k in kept or line[k] in kept_lines:
                    pieces.append((at, at + n, kept.get(k, kept_lines.get(line[k]))))
                at += n
            out.append(
                [
                    {"first_word": first, "n_words": words, "kept_row": keeper}
                    for first, words, keeper in runs(size, pieces, least)
                ]
            )
        kind = pa.struct(
            [("first_word", pa.int64()), ("n_words", pa.int64()), ("kept_row", pa.int64())]
        )
        return pa.array(out, pa.list_(kind))

    return made


def _extents(marked: DataFrame, units: DataFrame, source: DataFrame) -> DataFrame:
    """row, place, left, kept, n: by how many words a passage goes on beside its outer seed."""
    doc = F.xxhash64("id", "text_key")
    edges = marked.select("row", doc.alias("doc"), F.explode(_edges()("marks")).alias("e"))
    keepers = units.select(F.col("row").alias("kept"), doc.alias("kept_doc"))
    edges = cut(edges.select("row", "doc", "e.*").join(keepers, "kept"))
    asks = edges.select("doc", "hash", "place").unionByName(
        edges.select(F.col("kept_doc").alias("doc"), "hash", F.lit(-1).alias("place"))
    )
    wanted = cut(asks.groupBy("doc").agg(F.collect_set(F.struct("hash", "place")).alias("asks")))
    if wanted.count() <= FEW_CONTEXTS:
        wanted = F.broadcast(wanted)
    contexts = cut(
        source.select(doc.alias("doc"), "text")
        .join(wanted, "doc")
        .mapInArrow(
            _contexts,
            "doc bigint, hash bigint, place int, before array<bigint>, after array<bigint>",
        )
        .dropDuplicates(["doc", "hash", "place"])
    )
    theirs = contexts.where("place < 0").select(
        F.col("doc").alias("kept_doc"), "hash", F.struct("before", "after").alias("y")
    )
    if theirs.count() <= FEW_CONTEXTS:
        theirs = F.broadcast(theirs)
    mine = contexts.select("doc", "hash", "place", F.struct("before", "after").alias("x"))
    both = edges.join(mine, ["doc", "hash", "place"]).join(theirs, ["kept_doc", "hash"])

    def side(name: str) -> Column:
        return F.when(F.col("left"), F.col(f"{name}.before")).otherwise(F.col(f"{name}.after"))

    equal = F.zip_with(side("x"), side("y"), lambda a, b: a.eqNullSafe(b))
    other = F.array_position(equal, False)
    n = F.when(other == 0, F.size(equal)).otherwise(other - 1).cast("int")
    return both.select("row", "place", "left", "kept", n.alias("n")).where("n > 0")


def _near_lines(units: DataFrame, source: DataFrame) -> DataFrame:
    """row, line, kept of paragraphs that are near copies of one in another document."""
    lines = units.select(
        "row", F.posexplode(F.arrays_zip("long", "long_hashes")).alias("k", "line"), "bands"
    )
    paragraphs = lines.select(
        "row",
        F.col("line.long").alias("at"),
        F.col("line.long_hashes").alias("node"),
        F.slice("bands", F.col("k") * BANDS + 1, BANDS).alias("keys"),
    )
    # Equal paragraphs have equal bands, so one stands for all.
    kinds = paragraphs.groupBy("node").agg(F.min("row").alias("row"), F.first("keys").alias("keys"))
    keyed = kinds.select("row", "node", F.explode(F.array_distinct("keys")).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    index = cut(meet(keyed, cut(shared), "key").select("key", "node", "row"))
    nodes = index.select("node", "row").distinct()
    wanted = cut(
        nodes.select("row").distinct().join(units.select("row", "id", "text_key"), "row")
    )
    if wanted.count() <= FEW_CANDIDATES:
        wanted = F.broadcast(wanted)
    texts = source.alias("d").join(
        wanted.alias("w"), (F.col("d.text_key") == F.col("w.text_key")) & F.expr("d.id <=> w.id")
    )
    sets = cut(
        texts.select("text")
        .mapInArrow(
            _paragraph_sets,
            "node bigint, size bigint, sketch array<bigint>, items array<bigint>",
        )
        .join(nodes.select("node"), "node", "left_semi")
        .dropDuplicates(["node"])
    )

    def may(x: Column, y: Column, differ: Column) -> Column:
        return (100 * F.least(x, y) >= SIMILARITY * F.greatest(x, y)) & (
            differ * (100 + SIMILARITY) <= (100 - SIMILARITY) * (x + y)
        )

    def linked(x: Column, y: Column, common: Column) -> Column:
        return 100 * common >= SIMILARITY * (x + y - common)

    def lacking(size: Column) -> Column:
        return F.floor(size * (100 - SIMILARITY) / 100)

    labels = group(index.select("key", "node"), sets, may, linked, lacking)
    linked_rows = paragraphs.select("row", "at", "node").join(labels, "node")
    kept = linked_rows.groupBy("label").agg(F.min("row").alias("kept"))
    return linked_rows.join(kept, "label").where("row <> kept").select("row", "at", "kept")


def find_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = RUN_WORDS
) -> DataFrame:
    """A row per passage to remove: row, id, first_word, n_words, kept (an id), text_key.

    Words are those between blanks, counted from 0. The document that comes first in the
    table keeps its passage; kept is its id. Null and empty texts hold no passages; repeated
    rows are repeats of the first; other columns are left out; an empty table gives an empty
    one. text_key is the 64-bit hash of the text: with the id, it finds the document again.
    """
    kind = docs.schema[id].dataType.simpleString()
    source = docs.select(
        F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_key")
    )
    units = cut(
        source.mapInArrow(
            _units,
            f"id {kind}, text_key bigint, hashes array<bigint>, sizes array<int>,"
            " again array<boolean>, lines array<int>, long array<int>,"
            " long_hashes array<bigint>, bands array<bigint>, places array<int>,"
            " seeds array<bigint>, short array<int>, short_hashes array<bigint>",
        ).withColumn("row", F.monotonically_increasing_id())
    )

    def stretches(kind: int, at: Column, hashes: str) -> DataFrame:
        found = F.posexplode(F.arrays_zip(at.alias("at"), F.col(hashes).alias("hash")))
        rows = units.select("row", found.alias("k", "x"))
        return rows.select("row", F.lit(kind).alias("kind"), "k", "x.*")

    sentences = stretches(SENTENCE, F.col("sizes"), "hashes").where(F.col("at") >= SHINGLE_WORDS)
    stretch = (
        sentences.withColumn("at", F.col("k"))
        .unionByName(stretches(LINE, F.col("long"), "long_hashes"))
        .unionByName(stretches(SEED, F.col("places"), "seeds"))
        .unionByName(stretches(SHORT, F.col("short"), "short_hashes"))
        .drop("k")
    )
    repeated = (
        stretch.groupBy("hash")
        .agg(
            F.min("row").alias("kept"), F.max("row").alias("last"), F.count(F.lit(1)).alias("n")
        )
        .where("kept < last")
        .select("hash", "kept", "n")
    )
    marks = (
        meet(stretch, cut(repeated), "hash")
        .where("row <> kept")
        .groupBy("row")
        .agg(F.collect_list(F.struct("kind", "at", "kept", "hash")).alias("marks"))
    )
    line_marks = cut(
        _near_lines(units, source)
        .groupBy("row")
        .agg(F.collect_list(F.struct("at", "kept")).alias("line_marks"))
    )
    marks = cut(marks)
    seeded = marks.where(F.exists("marks", lambda m: m["kind"] == SEED))
    extents = cut(
        _extents(seeded.join(units.select("row", "id", "text_key"), "row"), units, source)
        .groupBy("row")
        .agg(F.collect_list(F.struct("place", "left", "kept", "n")).alias("extents"))
    )
    marked = (
        units.select("row", "id", "text_key", "sizes", "lines", "again")
        .join(marks, "row", "left")
        .join(extents, "row", "left")
        .join(line_marks, "row", "left")
        .where("marks IS NOT NULL OR line_marks IS NOT NULL OR array_contains(again, true)")
    )
    spans = marked.select(
        "row",
        "id",
        "text_key",
        F.explode(
            _spans(least)("sizes", "lines", "again", "marks", "line_marks", "extents", "row")
        ).alias("s"),
    ).select("row", "id", "text_key", "s.*")
    keepers = units.select(F.col("row").alias("kept_row"), F.col("id").alias("kept"))
    return spans.join(keepers, "kept_row").select(
        "row", F.col("id").alias(id), "first_word", "n_words", "kept", "text_key"
    )


def without_spans(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without words first to first + n - 1 of each span, and the blanks after them."""
    if not text or not spans:
        return text
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    starts, _, _ = hash_words(data)
    edges = np.append(starts, len(data))
    keep = np.ones(len(data), dtype=bool)
    for first, n in spans:
        keep[edges[first] : edges[min(first + n, len(starts))]] = False
    return data[keep].tobytes().decode()


def removed(text: Column, spans: Column) -> Column:
    """Each text without its spans (array of structs with first_word and n_words)."""

    @F.arrow_udf("string")
    def cleaned(texts: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array(
            [
                without_spans(t, [(s["first_word"], s["n_words"]) for s in f or []])
                for t, f in zip(texts.to_pylist(), found.to_pylist())
            ],
            pa.string(),
        )

    return cleaned(text, spans)
