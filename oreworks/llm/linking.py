"""Groups of linked nodes, from buckets of nodes that may be linked, without all pairs.

Only the groups are wanted, not every link. In each round every bucket compares its members
with some of them, the pivots, and links join the groups. Members of one group need not be
compared any more. What is left after the rounds, the members of a bucket that are outside its
largest group, is compared with all of the bucket that are in other groups. Where that would be
many pairs, as with texts that share a template and little else, the bucket's members get
new buckets first: one for each of the rarest items of their whole sets, as many as linked sets
need to have one in common. A template is frequent, so it makes no such bucket.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.llm.components import ties
from oreworks.llm.hot import meet
from oreworks.llm.lineage import cut

STAR_ROUNDS = 2
#: Pivots of a bucket in the first round, when all of its members meet them, and in later ones.
FIRST_PIVOTS, LATER_PIVOTS = 1, 3
#: Buckets with more pairs left than this are dealt anew by rare items.
FEW_PAIRS = 4_096
#: 64-bit numbers of a sketch.
SKETCH = 8

#: Tells from two nodes' sizes and a lower bound of what they differ by if they may be linked.
MayLink = Callable[[Column, Column, Column], Column]
#: How many items of a set of this size a linked set may lack.
Lacking = Callable[[Column], Column]
#: Tells from two nodes' sizes and the size of their intersection if they are linked.
Linked = Callable[[Column, Column, Column], Column]


def differing(left: str, right: str) -> Column:
    """Odd sketches keep the parity of the elements in each of their bits, so two of them
    differ in no more bits than their sets differ in elements."""
    return sum(
        F.bit_count(F.col(f"{left}.sketch")[k].bitwiseXOR(F.col(f"{right}.sketch")[k]))
        for k in range(SKETCH)
    )


def same_members_once(index: DataFrame) -> DataFrame:
    """Of buckets with the same members, one; none with a single member."""
    member = F.xxhash64("node").cast("decimal(20,0)")
    other = F.xxhash64("node", F.lit(1)).cast("decimal(20,0)")
    kinds = (
        index.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(member).alias("x"), F.sum(other).alias("y"))
        .where("n > 1")
        .groupBy("n", "x", "y")
        .agg(F.min("key").alias("key"))
        .select("key")
    )
    return index.join(kinds, "key")


def _verified(pairs: DataFrame, sets: DataFrame, linked: Linked) -> DataFrame:
    """Links (a, b) between the groups of the pairs that are linked."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("x", "y"))
    found = both.where(linked(F.size("x"), F.size("y"), common))
    return found.select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()


def _apply(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after joining linked groups."""
    roots = ties(links)
    return cut(
        labels.join(roots, labels["label"] == roots["node"], "left").select(
            labels["node"], F.coalesce("root", "label").alias("label")
        )
    )


def _star_pairs(members: DataFrame, turns: range, may: MayLink) -> DataFrame:
    """Pairs of each bucket's pivots, one for each turn, with its members."""

    def pivot(turn: int) -> Column:
        order = F.xxhash64("node", F.lit(turn)).alias("h")
        least = F.min(F.struct(order, "node", "label", "size", "sketch"))
        return least.alias(f"p{turn}")

    chosen = members.groupBy("key").agg(*[pivot(turn) for turn in turns])
    pivots = chosen.select("key", F.explode(F.array(*[f"p{turn}" for turn in turns])).alias("p"))
    return _pairs(members, pivots.select("key", "p.*"), may, F.lit(True))


def _ranked(members: DataFrame) -> DataFrame:
    """Members of mixed buckets with the largest group of the bucket, and the number of pairs
    of its members with those outside that group."""
    largest = (
        members.groupBy("key", "label")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("key")
        .agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all"))
        .where(F.col("top.n") < F.col("all"))
        .select(
            "key",
            F.col("top.label").alias("top"),
            (F.col("all") * (F.col("all") - F.col("top.n"))).alias("work"),
        )
    )
    return members.join(largest, "key")


def _rest_pairs(ranked: DataFrame, may: MayLink) -> DataFrame:
    """Pairs of different groups, at least one of them outside its bucket's largest group."""
    outside = ranked.where("label <> top")
    once = (F.col("m.label") == F.col("m.top")) | (F.col("m.node") < F.col("p.node"))
    return _pairs(ranked, outside, may, once)


def _pairs(members: DataFrame, partners: DataFrame, may: MayLink, once: Column) -> DataFrame:
    met = members.alias("m").join(
        partners.alias("p"),
        (F.col("m.key") == F.col("p.key"))
        & (F.col("m.label") != F.col("p.label"))
        & once
        & may(F.col("m.size"), F.col("p.size"), differing("m", "p")),
    )
    in_order = F.col("m.node") < F.col("p.node")
    return met.select(
        F.least("m.node", "p.node").alias("a"),
        F.greatest("m.node", "p.node").alias("b"),
        F.when(in_order, F.col("m.label")).otherwise(F.col("p.label")).alias("la"),
        F.when(in_order, F.col("p.label")).otherwise(F.col("m.label")).alias("lb"),
    ).distinct()


def _by_rare_items(nodes: DataFrame, sets: DataFrame, lacking: Lacking) -> DataFrame:
    """The nodes as members of buckets by their rarest items.

    If a linked set lacks at most k items of a set, both have an item in common among their
    k + 1 first, in any order that is the same for all sets. Items are ordered by the number of
    these nodes that have them. Items of a single node come first and make no bucket.
    """
    items = nodes.select("node").join(sets.select("node", F.explode("items").alias("item")), "node")
    counts = cut(items.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    shared = (
        meet(items, counts, "item")
        .groupBy("node")
        .agg(F.array_sort(F.collect_list(F.struct("n", "item"))).alias("found"))
        .join(nodes, "node")
    )
    single = F.col("size") - F.size("found")
    wanted = F.greatest(lacking(F.col("size")) + 1 - single, F.lit(0)).cast("int")
    first = F.transform(F.slice("found", 1, wanted), lambda x: x["item"])
    return shared.select(F.explode(first).alias("key"), *nodes.columns)


def _rest(
    ranked: DataFrame, sets: DataFrame, may: MayLink, lacking: Lacking
) -> DataFrame:
    """Pairs that hold every link between groups."""
    few = F.col("work") <= FEW_PAIRS
    pairs = _rest_pairs(ranked.where(few), may)
    crowded = ranked.where(~few).select("node", "label", "size", "sketch")
    crowded = cut(crowded.dropDuplicates(["node"]))
    if crowded.isEmpty():
        return pairs
    dealt = _ranked(cut(_by_rare_items(crowded, sets, lacking)))
    return pairs.union(_rest_pairs(dealt, may)).distinct()


def group(
    index: DataFrame, sets: DataFrame, may: MayLink, linked: Linked, lacking: Lacking
) -> DataFrame:
    """node, label of every node of sets; nodes have one label if links connect them.

    index: key, node, for each bucket its members. sets: node, size, sketch, items (distinct).
    Nodes are whole numbers, and a label is the smallest node of a group. Every pair of a
    bucket that links two groups is found, so groups are exact if every link has a bucket.
    """
    facts = sets.select("node", "size", "sketch")
    index = same_members_once(index).join(facts, "node")
    members = cut(index.withColumn("label", F.col("node")))
    labels = sets.select("node", F.col("node").alias("label"))
    ranked = None
    turn = 0
    for round in range(STAR_ROUNDS):
        turns = range(turn, turn + (LATER_PIVOTS if round else FIRST_PIVOTS))
        turn = turns.stop
        links = cut(_verified(_star_pairs(members, turns, may), sets, linked))
        if links.isEmpty():
            continue
        labels = _apply(labels, links)
        # A bucket of one group stays one, so only what is left is looked at again.
        members = members.select("key", "node", "size", "sketch").join(labels, "node")
        members = ranked = cut(_ranked(members))
        if ranked.isEmpty():
            return labels
    if ranked is None:
        ranked = cut(_ranked(members))
    links = cut(_verified(_rest(ranked, sets, may, lacking), sets, linked))
    return labels if links.isEmpty() else _apply(labels, links)
