"""Mixing sources to target weights, by a low-discrepancy schedule of equal blocks of words.

Slot i of the schedule belongs to the source in whose share of [0, 1) the i-th golden-ratio
point lies. The r-th slot of a source takes its r-th block: its documents, in shuffled order,
are cut into blocks of equally many words. After the last block the source starts again.
A source leaves the schedule when its target is met, which cuts its last block; what the
points leave short, by at most a few blocks, closes the schedule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreworks.llm.lineage import cut

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
BLOCK_WORDS = 1024
WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = 0.6180339887498949
#: Cells of [0, 1) on which points meet the sources' shares.
CELLS = 1024
#: Slots that are ranked by one window; the ranks before them are added up beforehand.
SLOTS_TOGETHER = 4096
#: Sources up to which their table (some 100 bytes each) is broadcast.
FEW_SOURCES = 20_000


def _sources(sized: DataFrame, weights: tuple[int, ...], share: float) -> DataFrame:
    """A row per source: number by code point (null last), size, weight, target, share of slots.

    A target is its weight times a level, or twice the source's size if that is less. The
    level is the largest of those at which the sources before it, by size over weight, are
    full and the others share the rest.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1).cast("int")
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = totals.withColumn("number", turn).withColumn(
        "weight", F.get(cycle, F.col("number") % len(weights))
    )
    all_rows = Window.partitionBy()
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), "number").rowsBetween(
        Window.unboundedPreceding, -1
    )
    full = MOST_EPOCHS * F.coalesce(F.sum("source_size").over(by_room), F.lit(0))
    left = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(by_room), F.lit(0))
    level = (share * F.sum("source_size").over(all_rows) - full) / left
    return (
        weighed.withColumn("level", level)
        .withColumn("level", F.max("level").over(all_rows))
        .withColumn(
            "target",
            F.least(
                (MOST_EPOCHS * F.col("source_size")).cast("double"),
                F.col("weight") * F.col("level"),
            ),
        )
        .select("source", "number", "source_size", "target")
    )


def _quota(block: int) -> Column:
    """Blocks that a source's target reaches into; the last of each round may be short."""
    size, words = F.col("source_size"), F.floor("target")
    rounds = F.when(size > 0, F.floor((words - 1) / size)).otherwise(F.lit(0))
    rounds = F.when(words > 0, rounds).otherwise(F.lit(0))
    return (rounds * F.ceil(size / block) + F.ceil((words - rounds * size) / block)).cast("long")


def schedule(sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """The slots: slot, number (of the source), rank (in the source, from 0).

    Closing slots have no point and a null slot.
    """
    spark = sources.sparkSession
    planned = sources.withColumn("quota", _quota(block))
    in_order = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    everything = F.sum("target").over(Window.partitionBy())
    before = F.coalesce(F.sum("target").over(in_order), F.lit(0.0)) / everything
    shares = (
        planned.where("quota > 0")
        .select("number", "quota", before.alias("low"))
        .withColumn(
            "high", F.coalesce(F.lead("low").over(Window.orderBy("number")), F.lit(1.0))
        )
    )
    cells = shares.select(
        "number",
        "quota",
        "low",
        "high",
        F.explode(
            F.sequence(
                F.floor(F.col("low") * CELLS),
                F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)),
            )
        ).alias("cell"),
    )
    count = planned.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    points = (
        spark.range(count)
        .withColumn("point", F.pmod((F.col("id") + 1) * F.lit(GOLDEN), F.lit(1.0)))
        .withColumn("cell", F.floor(F.col("point") * CELLS))
    )
    placed = cut(
        points.join(cells, "cell").where("point >= low AND point < high").select(
            F.col("id").alias("slot"),
            "number",
            "quota",
            F.floor(F.col("id") / SLOTS_TOGETHER).alias("chunk"),
        )
    )
    earlier = Window.partitionBy("number").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        placed.groupBy("number", "chunk")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "number", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")
        )
    )
    within = Window.partitionBy("number", "chunk").orderBy("slot")
    ranked = (
        placed.withColumn("place", F.row_number().over(within) - 1)
        .join(starts, ["number", "chunk"])
        .select("slot", "number", "quota", (F.col("first") + F.col("place")).alias("rank"))
        .where("rank < quota")
        .select("slot", "number", "rank")
    )
    taken = placed.groupBy("number").agg(F.count(F.lit(1)).alias("had"))
    closing = (
        shares.join(taken, "number", "left")
        .withColumn("had", F.coalesce("had", F.lit(0)))
        .where("had < quota")
        .select(
            F.lit(None).cast("long").alias("slot"),
            "number",
            F.explode(F.sequence("had", F.col("quota") - 1)).alias("rank"),
        )
    )
    return ranked.unionByName(closing)


def _blocks(slots: DataFrame, sources: DataFrame, block: int) -> DataFrame:
    """A row per block that is taken: up to which word of the source, in each round."""
    size = F.col("source_size")
    per_round = F.ceil(size / block)
    placed = (
        slots.join(sources, "number")
        .withColumn("round", F.floor(F.col("rank") / per_round))
        .withColumn("block", F.col("rank") - F.col("round") * per_round)
        .withColumn(
            "stop",
            F.least(
                (F.col("block") + 1) * block,
                size,
                F.floor("target") - F.col("round") * size,
            ),
        )
    )
    return placed.groupBy("number", "block").agg(
        *[
            F.coalesce(F.max(F.when(F.col("round") == k, F.col("stop"))), F.lit(0)).alias(f"stop{k}")
            for k in range(MOST_EPOCHS)
        ]
    )


def _mixed(
    docs: DataFrame,
    id: str,
    text: str,
    source: str,
    weights: tuple[int, ...],
    share: float,
    block: int,
) -> DataFrame:
    key = F.md5(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary"))
    sized = cut(
        docs.select(
            F.col(id).alias("id"),
            F.col(source).alias("source"),
            F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD))
            .cast("long")
            .alias("size"),
            key.alias("key"),
            F.xxhash64(text).alias("text_key"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    sources = cut(_sources(sized, weights, share))
    known = F.broadcast(sources) if sources.count() <= FEW_SOURCES else sources
    numbered = (
        sized.alias("d")
        .join(known.alias("s"), F.expr("d.source <=> s.source"))
        .select("d.*", "number", "source_size", "target", F.substring("key", 1, 3).alias("part"))
    )
    parts = numbered.groupBy("number", "part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("number").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = parts.select(
        "number", "part", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("first")
    )
    within = (
        Window.partitionBy("number", "part")
        .orderBy("key", "id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        numbered.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(starts, ["number", "part"])
        .withColumn("start", F.col("first") + F.col("before"))
        .drop("key", "part", "first", "before")
    )
    last = F.col("start") + F.greatest(F.col("size"), F.lit(1)) - 1
    cuts = placed.withColumn(
        "block",
        F.explode(F.sequence(F.floor(F.col("start") / block), F.floor(last / block))),
    )
    blocks = cut(_blocks(schedule(sources, block), known, block))
    begins = F.greatest("start", F.col("block") * block)
    ends = F.col("start") + F.col("size")
    words = sum(
        F.greatest(F.least(ends, F.coalesce(F.col(f"stop{k}"), F.lit(0))) - begins, F.lit(0))
        for k in range(MOST_EPOCHS)
    )
    return (
        cuts.join(blocks, ["number", "block"], "left")
        .groupBy("row", "id", "text_key", "source", "size", "source_size", "target")
        .agg(F.sum(words).cast("long").alias("taken"))
    )


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    block: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per row of docs: id, source, size, source_size, target, taken.

    Sources, by code point with null last, weigh weights in turn and share `share` times all
    words; none is taken more than twice, and what it would get above that goes to the others
    by weight. taken is the number of words the mix takes of the document, repeats counted:
    all of it in as many rounds as its blocks are in, in part where a round ends. A source's
    taken words are its target, rounded down. Null texts have no words and are never taken.

    The order of documents is that of the MD5 of their id, so reruns agree; rows with equal
    ids go by size. Other columns are left out, an empty table gives an empty one. A source's
    words are added up in 4096 parts by the MD5's first digits, so that none is ordered whole.
    """
    return _mixed(docs, id, text, source, weights, share, block).select(
        F.col("id").alias(id),
        F.col("source").alias(source),
        "size",
        "source_size",
        "target",
        "taken",
    )


def chosen(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """id, text_key, size, source_size, target, taken of the documents that the mix takes.

    text_key is xxhash64 of the text; rows with equal id and text should occur once.
    """
    mixed = _mixed(docs, id, text, source, WEIGHTS, SHARE, BLOCK_WORDS)
    return mixed.where("taken > 0").select(
        "id", "text_key", "size", "source_size", "target", "taken"
    )
