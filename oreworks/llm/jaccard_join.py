"""Groups of documents whose sets of word n-grams have a large Jaccard similarity.

Every document's n-grams are ordered by hash, and its prefix is the part of them that decides:
for a similarity s two linked sets differ in at most D = floor(n (1 - s) / s) elements, so among
the first 2 D + 2 of their union, D + 2 are common and two of these are neighbours. Hence
a document is a candidate only if D + 2 elements of its prefix are in other prefixes, and two
linked candidates share either a rare element of the prefix, or two frequent ones that are
neighbours in both. Those are the keys of the index: single elements for the rare class,
combinations of two for the frequent one. Members of a bucket are verified on whole sets.

Long prefixes are sent only for documents that a shorter one leaves: the first
floor(n (1 - s)) + k elements of two linked sets have k in common, so a document that shares
fewer of them with any other has no link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreworks.llm.hot import meet
from oreworks.llm.lineage import cut
from oreworks.llm.linking import SKETCH, group
from oreworks.llm.rows import sized
from oreworks.llm.words import hashed_texts, mix, shingle_hashes

SHINGLE_WORDS = 3
SIMILARITY = 90  # in hundredths
#: Elements in the prefixes of more documents are of the frequent class.
RARE = 8
#: Candidates up to which their ids (some 50 bytes each) are broadcast to fetch their texts.
FEW_CANDIDATES = 1_000_000


def most_different(size: int, similarity: int) -> int:
    """Elements in which a set of this size and a linked one differ at most, together."""
    return size * (100 - similarity) // similarity


def _set(words: np.ndarray, width: int) -> np.ndarray:
    return np.unique(shingle_hashes(words, width)).view(np.int64)


def set_key(items: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    if not len(items):
        return 0, 0
    x = items.view(np.uint64)
    a = mix(x + np.uint64(len(x)))
    b = mix(x ^ np.uint64(0x9E3779B97F4A7C15))
    return int(a.sum(dtype=np.uint64).view(np.int64)), int(b.sum(dtype=np.uint64).view(np.int64))


def odd_sketch(items: np.ndarray) -> np.ndarray:
    places = (items.view(np.uint64) >> np.uint64(7)).astype(np.int64) % (64 * SKETCH)
    parity = np.bincount(places, minlength=64 * SKETCH).astype(np.uint8) & 1
    return np.packbits(parity).view(np.int64)


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int64)))


def _prefixes(width: int, similarity: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, highs, lows, prefixes = [], [], [], []
            for _, words in hashed_texts(batch["text"]):
                items = _set(words, width)
                high, low = set_key(items)
                sizes.append(len(items))
                highs.append(high)
                lows.append(low)
                in_order = np.sort(items.view(np.uint64)).view(np.int64)
                prefixes.append(in_order[: 2 * most_different(len(items), similarity) + 2])
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    batch["text_key"],
                    pa.array(sizes, pa.int64()),
                    pa.array(highs, pa.int64()),
                    pa.array(lows, pa.int64()),
                    _lists(prefixes),
                ],
                ["id", "text_key", "size", "high", "low", "prefix"],
            )

    return make


def _whole_sets(width: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                items = [_set(words, width) for _, words in hashed_texts(part["text"])]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["node"],
                        pa.array([len(x) for x in items], pa.int64()),
                        _lists([odd_sketch(x) for x in items]),
                        _lists(items),
                    ],
                    ["node", "size", "sketch", "items"],
                )

    return make


def _found_twice(prefixes: DataFrame) -> DataFrame:
    """item, n of the elements that two or more prefixes have. What counting has shuffled is
    free before the prefixes themselves are sent."""
    return cut(prefixes.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))


def _shared(prefixes: DataFrame) -> DataFrame:
    """node, at, item, often of the elements that two or more prefixes have."""
    met = meet(prefixes, _found_twice(prefixes), "item")
    return met.select("node", "at", "item", (F.col("n") > RARE).alias("often"))


def _enough(shared: DataFrame, needs: DataFrame) -> DataFrame:
    """Only nodes of which enough of the prefix is shared; a node's list is part of its prefix."""
    return (
        shared.groupBy("node")
        .agg(F.collect_list(F.struct("at", "item", "often")).alias("found"))
        .join(needs, "node")
        .where(F.size("found") >= F.col("need"))
        .select("node", F.inline("found"))
    )


def _more(size: Column, similarity: int) -> Column:
    """By how many elements short prefixes are longer than any two linked sets differ by."""
    return F.floor(F.floor(size * (100 - similarity) / similarity) / 3) + 1


def _likely(nodes: DataFrame, similarity: int) -> DataFrame:
    """The nodes (row, size, prefix) whose short prefix shares enough with others.

    Prefixes of floor(n (1 - s)) + k elements of two linked sets have at least k in common, for
    the smaller k of both; the smallest linked set has ceil(n s) elements.
    """
    length = F.floor(F.col("size") * (100 - similarity) / 100) + _more(F.col("size"), similarity)
    smallest = F.ceil(F.col("size") * similarity / 100)
    short = nodes.select("row", F.explode(F.slice("prefix", 1, length.cast("int"))).alias("item"))
    shares = (
        meet(short, _found_twice(short), "item").groupBy("row").agg(F.count(F.lit(1)).alias("has"))
    )
    needs = nodes.select("row", _more(smallest, similarity).alias("need"))
    left = sized(cut(shares.join(needs, "row").where("has >= need").select("row")))
    return nodes.join(left, "row", "left_semi")


def _keys(shared: DataFrame) -> DataFrame:
    """key, node: single rare elements, and pairs of frequent neighbours in the prefix."""
    in_order = Window.partitionBy("node").orderBy("at")
    beside = F.lead(F.struct("at", "item", "often")).over(in_order)
    seen = shared.withColumn("beside", beside)
    pair = F.when(
        (F.col("beside.at") == F.col("at") + 1) & F.col("beside.often"),
        F.xxhash64("item", "beside.item"),
    )
    key = F.when(F.col("often"), pair).otherwise(F.col("item"))
    return seen.select(key.alias("key"), "node").where("key IS NOT NULL")


def _group(kind: int, x: Column, y: Column) -> Column:
    """What the rows of a component have in common: nothing but the row, a label, or a set."""
    return F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"))


def _grouped(docs: DataFrame, id: str, text: str, width: int, similarity: int) -> DataFrame:
    """row, id, text_key, size, group of every row of docs; one group per component."""
    kind = docs.schema[id].dataType.simpleString()
    source = docs.select(
        F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_key")
    )
    made = cut(
        source.mapInArrow(
            _prefixes(width, similarity),
            f"id {kind}, text_key bigint, size bigint, high bigint, low bigint,"
            " prefix array<bigint>",
        ).withColumn("row", F.monotonically_increasing_id())
    )
    # Of equal sets one row stands for all.
    firsts = (
        made.where("size > 0").groupBy("high", "low").agg(F.min("row").alias("row")).select("row")
    )
    nodes = made.select("row", "size", "prefix").join(sized(cut(firsts)), "row", "left_semi")
    exploded = _likely(nodes, similarity).select(
        F.col("row").alias("node"), F.posexplode("prefix").alias("at", "item")
    )
    different = F.floor(F.col("size") * (100 - similarity) / similarity)
    needs = made.select(
        F.col("row").alias("node"), F.least(different + 2, F.size("prefix")).alias("need")
    )
    once = cut(_enough(_shared(exploded), needs))
    # Elements may be shared with nodes only that are left out by now.
    candidates = cut(_enough(_shared(once.drop("often")), needs))
    wanted = cut(
        candidates.select("node")
        .distinct()
        .join(made.select(F.col("row").alias("node"), "id", "text_key"), "node")
    )
    if wanted.count() <= FEW_CANDIDATES:
        wanted = F.broadcast(wanted)
    texts = source.alias("d").join(
        wanted.alias("w"),
        (F.col("d.text_key") == F.col("w.text_key")) & F.expr("d.id <=> w.id"),
    )
    sets = cut(
        texts.select("node", "text")
        .mapInArrow(
            _whole_sets(width),
            "node bigint, size bigint, sketch array<bigint>, items array<bigint>",
        )
        .dropDuplicates(["node"])
    )

    def may(x: Column, y: Column, differ: Column) -> Column:
        return (
            (100 * F.least(x, y) >= similarity * F.greatest(x, y))
            & (differ * (100 + similarity) <= (100 - similarity) * (x + y))
        )

    def linked(x: Column, y: Column, common: Column) -> Column:
        return 100 * common >= similarity * (x + y - common)

    def lacking(size: Column) -> Column:
        return F.floor(size * (100 - similarity) / 100)

    labels = group(_keys(candidates), sets, may, linked, lacking)
    groups = labels.join(made.select(F.col("row").alias("node"), "high", "low"), "node").select(
        "high", "low", "label"
    )
    none = F.lit(0).cast("long")
    return (
        made.drop("prefix")
        .join(groups, ["high", "low"], "left")
        .withColumn(
            "group",
            F.when(F.col("size") == 0, _group(0, F.col("row"), none))
            .when(F.col("label").isNotNull(), _group(1, F.col("label"), none))
            .otherwise(_group(2, F.col("high"), F.col("low"))),
        )
    )


def link(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE_WORDS,
    similarity: int = SIMILARITY,
) -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id.

    A document's set has the distinct runs of `width` words, ASCII upper case as lower; with
    fewer words the whole text is one. Two documents link if 100 |A and B| >= similarity
    |A or B|. component_id is the smallest id that links reach, the document's own included.
    Documents with equal sets are one node from the start. Null, empty and blank texts have
    no shingles and link with nothing. A null id counts as no id: it stays null unless links
    lead to another. Repeated rows stay; other columns are left out; an empty table gives an
    empty one.
    """
    named = _grouped(docs, id, text, width, similarity)
    smallest = named.groupBy("group").agg(F.min("id").alias("component_id"))
    return named.join(smallest, "group").select(
        F.col("id").alias(id), F.col("size").alias("n_shingles"), "component_id"
    )


def superseded(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE_WORDS,
    similarity: int = SIMILARITY,
) -> DataFrame:
    """id, text_key of the documents that are in a component with one of a smaller id.

    text_key is xxhash64 of the text. A null id is larger than any other. Rows with equal id
    and text count as one, of rows with equal ids one stays.
    """
    named = cut(
        _grouped(docs, id, text, width, similarity).select("row", "id", "text_key", "group")
    )
    smallest = named.groupBy("group").agg(F.min("id").alias("least"))
    firsts = (
        named.join(smallest, "group")
        .where("id <=> least")
        .groupBy("group")
        .agg(F.min("row").alias("row"))
    )
    return named.join(firsts, "row", "left_anti").select("id", "text_key")
