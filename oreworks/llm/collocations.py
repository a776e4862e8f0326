"""Phrases of words that occur together more often than apart, per language.

Two passes over all texts. The first finds out which runs of words can be frequent, without
keeping a count for each run: runs are dealt by hash into buckets, and each bucket keeps a
Misra-Gries summary. Its capacity exceeds the bucket's mass (the number of runs that fall into
it) divided by the least count that is asked for, so whatever is subtracted when the summary is
full stays below that count, and every frequent run survives. A bucket learns its mass before
its first run, from rows that sort before the others. Summaries know runs by the hash of the
bucket and 32 more bits; runs that share them are taken for one, which can only add survivors.

The survivors of all buckets make a bitmap of a bounded size, in which each bucket owns a slice.
The second pass counts, by their text, the runs that the bitmap lets through; those that it
lets through by mistake are found to be rare then. Counts are thus exact, whatever the hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from hashlib import blake2b
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreworks.llm.lineage import cut, release
from oreworks.llm.rows import sized
from oreworks.llm.words import byte_class, hash_words, mix, text_bytes

UNKNOWN = "und"
MAX_WORDS = 3
MIN_COUNT = 10
#: A candidate goes if a longer one has at least this percentage of its count.
CONTAINED_PCT = 50
TOP = 2_000

#: Bytes that end a piece, and bytes between the words of a piece.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BETWEEN_WORDS = b" \t"
IN_WORD = byte_class(PIECE_ENDS + BETWEEN_WORDS)
IN_PIECE = byte_class(PIECE_ENDS)

#: Bytes of text that are counted together before anything is sent.
CHUNK_BYTES = 4 << 20
#: Bytes of text for each bucket, and the least and greatest number of buckets.
BUCKET_BYTES, LEAST_BUCKETS, MOST_BUCKETS = 32 << 20, 64, 1 << 16
#: Bits of the bitmap for each run that may survive, and the least and greatest size. The
#: bitmap is all that is broadcast: 32 MB at most. A full one only lets more through.
BITS_A_SURVIVOR, LEAST_BITS, MOST_BITS = 4, 1 << 20, 1 << 28
#: Phrases that are made and sent at a time.
ROWS = 20_000
#: Parts in which a language is ranked before the best of all parts are.
RANK_PARTS = 256

DEALT = "bucket int, kind int, mass bigint, keys binary, counts binary"
KEY, COUNT = np.dtype("<u4"), np.dtype("<i8")


def _pieces(text: np.ndarray) -> Iterator[np.ndarray]:
    """The text, or if it is longer than a chunk parts of it, cut where a piece ends."""
    at = 0
    while len(text) - at > CHUNK_BYTES:
        ends = np.flatnonzero(~IN_PIECE[text[at : at + CHUNK_BYTES]])
        if len(ends):
            end = at + int(ends[-1]) + 1
        else:  # a piece longer than a chunk
            rest = np.flatnonzero(~IN_PIECE[text[at + CHUNK_BYTES :]])
            end = at + CHUNK_BYTES + int(rest[0]) + 1 if len(rest) else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


class Chunk:
    """Texts on end, with the runs of up to max_words words in their pieces.

    Runs are given by number of words: places of the first words, and hashes that also tell
    languages apart.
    """

    def __init__(self, texts: list[np.ndarray], langs: list[str], max_words: int):
        stop = np.frombuffer(b"\n", dtype=np.uint8)
        self.data = np.concatenate([part for text in texts for part in (text, stop)])
        ends = np.cumsum([len(text) + 1 for text in texts])
        self.langs = langs
        self.starts, self.ends, words = hash_words(self.data, IN_WORD)
        self.text_of = np.searchsorted(ends, self.starts, side="right")
        kinds, at = np.unique(np.array(langs, dtype=object), return_inverse=True)
        seeds = [int.from_bytes(blake2b(k.encode(), digest_size=8).digest()) for k in kinds]
        seed = np.array(seeds, dtype=np.uint64)[at][self.text_of]
        piece = np.cumsum(~IN_PIECE[self.data], dtype=np.int32)[self.starts]
        # How many words of its piece begin with this one.
        left = np.searchsorted(piece, piece, side="right") - np.arange(len(piece))
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        hashes = mix(words + seed)
        for n in range(1, max_words + 1):
            if n > 1:
                hashes = hashes[: len(words) - n + 1] if len(words) >= n else hashes[:0]
                hashes = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + words[n - 1 :])
            first = np.flatnonzero(left[: len(hashes)] >= n)
            self.runs.append((first, hashes[first]))

    def phrase(self, first: int, words: int) -> str:
        at = range(first, first + words)
        return b" ".join(
            self.data[self.starts[k] : self.ends[k]].tobytes().lower() for k in at
        ).decode("utf-8", "replace")


def _chunks(batches: Iterator[pa.RecordBatch], max_words: int) -> Iterator[Chunk]:
    texts: list[np.ndarray] = []
    langs: list[str] = []
    size = 0
    for batch in batches:
        names = batch["lang"].to_pylist()
        for lang, text in zip(names, text_bytes(batch["text"])):
            for piece in _pieces(text):
                if texts and size + len(piece) > CHUNK_BYTES:
                    yield Chunk(texts, langs, max_words)
                    texts, langs, size = [], [], 0
                texts.append(piece)
                langs.append(lang)
                size += len(piece) + 1
        # What follows may lie in memory that the next batch reuses.
        texts = [np.array(t) for t in texts] if texts else texts
    if texts:
        yield Chunk(texts, langs, max_words)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def _key(hashes: np.ndarray) -> np.ndarray:
    return hashes.astype(KEY)


def _bit(buckets: np.ndarray, keys: np.ndarray, slots: int) -> np.ndarray:
    """Places in the bitmap: the bucket's slice, and a slot in it by a hash of the key."""
    slot = mix(keys.astype(np.uint64) + np.uint64(0x51ED270B)) % np.uint64(slots)
    return buckets.astype(np.int64) * slots + slot.astype(np.int64)


def _deal(max_words: int, buckets: int) -> Callable:
    """Runs of each chunk, counted and packed by bucket."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = np.zeros(buckets, dtype=np.int64)
        for chunk in _chunks(batches, max_words):
            hashes = np.concatenate([h for _, h in chunk.runs])
            if not len(hashes):
                continue
            # In order of bucket and key.
            order = (_bucket(hashes, buckets).astype(np.uint64) << np.uint64(32)) | _key(hashes)
            order.sort()
            new = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]]))
            counts = np.diff(np.append(new, len(order)))
            kinds = order[new]
            bucket, key = (kinds >> np.uint64(32)).astype(np.int32), kinds.astype(KEY)
            mass += np.bincount(bucket, counts, buckets).astype(np.int64)
            edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
            rows: list[tuple] = []
            for low, high in zip(edges[:-1], edges[1:]):
                part, n = key[low:high], counts[low:high]
                # Most runs occur once: their counts are not sent.
                part = np.concatenate([part[n == 1], part[n > 1]])
                many = n[n > 1].astype(COUNT)
                rows.append((int(bucket[low]), part.tobytes(), many.astype("<u4").tobytes()))
            yield _packed([r[0] for r in rows], 1, None, [r[1] for r in rows], [r[2] for r in rows])
        held = np.flatnonzero(mass)
        yield _packed(held.tolist(), 0, mass[held].tolist(), None, None)

    return deal


def _packed(buckets: list, kind: int, mass, keys, counts) -> pa.RecordBatch:
    size = len(buckets)
    return pa.RecordBatch.from_pydict(
        {
            "bucket": pa.array(buckets, pa.int32()),
            "kind": pa.array([kind] * size, pa.int32()),
            "mass": pa.array(mass or [0] * size, pa.int64()),
            "keys": pa.array(keys or [b""] * size, pa.binary()),
            "counts": pa.array(counts or [b""] * size, pa.binary()),
        }
    )


class Summary:
    """Misra-Gries summary of a stream of counted keys of a known total mass.

    Holds at most capacity = mass // least + 1 keys after each merge. A full summary loses the
    same amount on every key, and (capacity + 1) times that amount of its mass, so all losses
    together are at most mass / (capacity + 1), below least.
    """

    def __init__(self, mass: int, least: int):
        self.least = least
        self.capacity = mass // least + 1
        self.keys = np.zeros(0, dtype=KEY)
        self.counts = np.zeros(0, dtype=COUNT)
        self.lost = 0
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((keys, counts))
        self._size += len(keys)
        if self._size > max(self.capacity, 1 << 16):
            self._merge()

    def _merge(self) -> None:
        parts = [(self.keys, self.counts), *self._waiting]
        self._waiting, self._size = [], 0
        keys = np.concatenate([k for k, _ in parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate([c for _, c in parts])[order]
        if len(keys):
            new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            keys, counts = keys[new], np.add.reduceat(counts, new)
        if len(keys) > self.capacity:
            place = len(keys) - self.capacity - 1
            loss = int(np.partition(counts, place)[place])
            self.lost += loss
            keep = counts > loss
            keys, counts = keys[keep], counts[keep] - loss
        self.keys, self.counts = keys, counts

    def survivors(self) -> np.ndarray:
        """All keys that occur at least `least` times, and others that may."""
        self._merge()
        return self.keys[self.counts + self.lost >= self.least]


def _summarise(least: int, slots: int) -> Callable:
    """The slice of the bitmap of each bucket. Rows come in order of bucket and kind."""

    def sliced(bucket: int, summary: Summary) -> pa.RecordBatch:
        keys = summary.survivors()
        bits = np.zeros(slots, dtype=bool)
        bits[_bit(np.zeros(len(keys), dtype=np.int64), keys, slots)] = True
        return pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array([bucket], pa.int32()),
                "survivors": pa.array([len(keys)], pa.int64()),
                "lost": pa.array([summary.lost], pa.int64()),
                "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
            }
        )

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, mass, summary = None, 0, None
        for batch in batches:
            columns = [batch[name].to_pylist() for name in ("bucket", "kind", "mass", "keys", "counts")]
            for bucket, kind, part, keys, counts in zip(*columns):
                if bucket != now:
                    if summary is not None:
                        yield sliced(now, summary)
                    now, mass, summary = bucket, 0, None
                if kind == 0:
                    mass += part
                    continue
                if summary is None:
                    summary = Summary(mass, least)
                keys = np.frombuffer(keys, dtype=KEY)
                many = np.frombuffer(counts, dtype="<u4").astype(COUNT)
                summary.add(keys, np.concatenate([np.ones(len(keys) - len(many), COUNT), many]))
        if summary is not None:
            yield sliced(now, summary)

    return summarise


def _count(max_words: int, buckets: int, slots: int, bitmap) -> Callable:
    """Text and count of each chunk's runs that the bitmap lets through; words: how many words
    the run has. Words 0: all word occurrences of the language."""

    def found(chunk: Chunk, bits: np.ndarray) -> Iterator[tuple[str, str, int, int]]:
        kinds, at = np.unique(np.array(chunk.langs, dtype=object), return_inverse=True)
        total = np.bincount(at[chunk.text_of], minlength=len(kinds))
        yield from ((lang, "", 0, int(n)) for lang, n in zip(kinds, total) if n)
        for words, (first, hashes) in enumerate(chunk.runs, 1):
            place = _bit(_bucket(hashes, buckets), _key(hashes), slots)
            through = np.flatnonzero(bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1)
            _, one, times = np.unique(hashes[through], return_index=True, return_counts=True)
            one = first[through[one]]
            for low in range(0, len(one), ROWS):
                for k, n in zip(one[low : low + ROWS].tolist(), times[low : low + ROWS].tolist()):
                    yield chunk.langs[chunk.text_of[k]], chunk.phrase(k, words), words, n

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, dtype=np.uint8)
        types = [pa.string(), pa.string(), pa.int32(), pa.int64()]
        for chunk in _chunks(batches, max_words):
            rows = found(chunk, bits)
            while part := list(islice(rows, ROWS)):
                columns = [pa.array(column, kind) for column, kind in zip(zip(*part), types)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "words", "n"])

    return count


def frequent_runs(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    max_words: int = MAX_WORDS,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """lang, phrase, words, n: every run of up to max_words words that a language has at least
    min_count times, with its exact count; and for each language a row with words 0, an
    empty phrase and the number of its word occurrences.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, size // BUCKET_BYTES))
    # A text of n bytes has at most n / 2 words, each the first of max_words runs.
    most = size // 2 * max_words // min_count * BITS_A_SURVIVOR
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << max(0, most).bit_length()))
    slots = max(8, bits // buckets // 8 * 8)

    dealt = (
        rows.mapInArrow(_deal(max_words, buckets), DEALT)
        .repartition(min(buckets, _partitions(spark)), "bucket")
        .sortWithinPartitions("bucket", "kind")
    )
    slices = dealt.mapInArrow(
        _summarise(min_count, slots), "bucket int, survivors bigint, lost bigint, bits binary"
    ).select("bucket", "bits")
    bitmap = bytearray(buckets * slots // 8)
    for row in slices.collect():
        at = row["bucket"] * slots // 8
        bitmap[at : at + len(row["bits"])] = row["bits"]
    del dealt, slices
    release(spark)
    shared = spark.sparkContext.broadcast(bytes(bitmap))
    counted = rows.mapInArrow(
        _count(max_words, buckets, slots, shared), "lang string, phrase string, words int, n bigint"
    )
    return (
        counted.groupBy("lang", "phrase", "words")
        .agg(F.sum("n").alias("n"))
        .where((F.col("n") >= min_count) | (F.col("words") == 0))
    )


def _partitions(spark) -> int:
    return max(LEAST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _exact_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)) in decimals of 38 digits: exact for counts below 10^15,
    and an error beyond."""
    a, left, right = (x.cast("decimal(15,0)") for x in (a, left, right))
    million = F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", million * (a * a), left * right).cast("bigint")


def _scored(runs: DataFrame) -> DataFrame:
    """Candidates with a, l, r and score of the cut that scores lowest."""
    phrases = runs.where("words > 0")
    counts = phrases.select("lang", "phrase", "n")
    cuts = (
        phrases.where("words > 1")
        .withColumn("parts", F.split("phrase", " "))
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
        .select(
            "lang",
            "phrase",
            "words",
            F.col("n").alias("a"),
            "k",
            F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ").alias("first"),
            F.array_join(
                F.slice("parts", F.col("k") + 1, F.col("words") - F.col("k")), " "
            ).alias("rest"),
        )
    )
    # Counts of phrases have no bound: Spark broadcasts them only if their bytes are few.
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    joined = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    scored = joined.withColumn("score", _exact_score(F.col("a"), F.col("l"), F.col("r")))
    best = scored.groupBy("lang", "phrase", "words", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    return best.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def _without_contained(scored: DataFrame, max_words: int, contained_pct: int) -> DataFrame:
    """Without candidates that lie in a longer one that is frequent enough."""
    parts = F.split("phrase", " ")
    inner = [
        scored.where(F.col("words") > size)
        .withColumn("parts", parts)
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - size + 1)))
        .select(
            "lang",
            F.array_join(F.slice("parts", F.col("at"), F.lit(size)), " ").alias("phrase"),
            F.col("a").alias("longer"),
        )
        for size in range(2, max_words)
    ]
    if not inner:
        return scored
    longest = (
        reduce(DataFrame.unionByName, inner)
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    kept = F.col("longer").isNull() | (100 * F.col("longer") < contained_pct * F.col("a"))
    return scored.join(longest, ["lang", "phrase"], "left").where(kept).drop("longer")


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    """The first rows of each language. Each of many parts of a language is ranked first, so
    that no task gets all phrases of one language."""
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    in_part = Window.partitionBy("lang", "part").orderBy(*best)
    in_lang = Window.partitionBy("lang").orderBy(*best)
    first = (
        rows.withColumn("part", part)
        .withColumn("rank", F.row_number().over(in_part))
        .where(F.col("rank") <= top)
    )
    ranked = first.drop("part").withColumn("rank", F.row_number().over(in_lang).cast("bigint"))
    return ranked.where(F.col("rank") <= top)


def mine(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    max_words: int = MAX_WORDS,
    min_count: int = MIN_COUNT,
    contained_pct: int = CONTAINED_PCT,
    top: int = TOP,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best collocations of each language.

    Texts are lower-cased (A-Z), cut into pieces at . , ; : ! ? and line ends, and pieces into
    words at spaces and tabs. A candidate is a run of 2 to max_words words that a language has
    a >= min_count times. Cut after k words, its parts occur l and r times; the cut with the
    least floor(1000000 a a / (l r)) counts, of equal ones the first. A candidate inside a
    longer one goes if the longer one has at least contained_pct percent of its count. n is the
    number of the language's word occurrences.

    Null texts are empty, a null language is `und`; texts of any length are read whole, cut
    between pieces only to be worked on. Repeated rows count each time. Ties go by count, then
    by phrase in the order of its bytes. An empty table gives an empty result. Other columns
    are not read, whatever their names.
    """
    runs = cut(frequent_runs(docs, text, lang, max_words, min_count))
    totals = runs.where("words = 0").select("lang", F.col("n"))
    scored = cut(_scored(runs))
    ranked = _ranked(_without_contained(scored, max_words, contained_pct), top)
    return ranked.join(sized(totals), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
