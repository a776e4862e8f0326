"""License scan: ordered signature rules on whole texts, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.llm.license_rules import BASE, CONFIDENCE, ROOTS, Rule, rules
from oreworks.llm.quality_rules import let

#: Fixed value: a word, in either case.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE_PRIORITY = 9
#: Characters that no normalised text has; they mark where a rule matches.
BEGIN, END = "\x01", "\x02"

DETECTION = (
    "array<struct<start:int,stop:int,priority:int,label:string,confidence:double>>"
)


def _normal(text: Column) -> Column:
    """Lower-case words with one blank between them and at both ends."""
    return F.concat(
        F.lit(" "), F.trim(F.regexp_replace(F.lower(text), SEPARATORS, " ")), F.lit(" ")
    )


def _may_match(text: Column) -> Column:
    """A cheap test that all texts with a detection pass."""

    def test(low: Column) -> Column:
        found = low.rlike("(?:^|" + SEPARATORS + ")cc" + SEPARATORS + "(?:by|0)")
        for root in ROOTS:
            found = found | F.contains(low, F.lit(root))
        return found

    return let(F.lower(text), test)


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _matches(normal: Column, rule: Column) -> Column:
    """The places of a rule: matches are marked, and blanks before them counted."""
    pattern = F.concat(F.lit("(?<= )(?:"), rule["regex"], F.lit(")(?= )"))
    marked = F.regexp_replace(normal, pattern, F.lit(f"{BEGIN}$0{END}"))

    def step(state: Column, part: Column) -> Column:
        hit = F.trim(F.substring_index(part, END, 1))
        here = F.struct(
            (state["words"] - 1).alias("start"),
            (state["words"] + _blanks(hit)).alias("stop"),
            rule["priority"].alias("priority"),
            rule["label"].alias("label"),
            rule["confidence"].alias("confidence"),
        )
        return F.struct(
            (state["words"] + _blanks(part)).alias("words"),
            F.when(F.contains(part, F.lit(END)), F.concat(state["found"], F.array(here)))
            .otherwise(state["found"])
            .alias("found"),
        )

    empty = F.struct(
        F.lit(0).alias("words"), F.array().cast(DETECTION).alias("found")
    )
    return F.when(
        F.contains(marked, F.lit(BEGIN)),
        F.aggregate(F.split(marked, BEGIN), empty, step, lambda s: s["found"]),
    ).otherwise(F.array().cast(DETECTION))


def _detections(text: Column, table: Column) -> Column:
    def all_rules(normal: Column) -> Column:
        tried = F.filter(table, lambda r: F.contains(normal, r["keyword"]))
        return F.flatten(F.transform(tried, lambda r: _matches(normal, r)))

    return let(_normal(text), all_rules)


def _kept(found: Column) -> Column:
    """Detections that do not lie within one of the same or a higher priority.

    Sorted by start, longest first, so an interval lies within an earlier one if and only
    if the largest end so far is not before its own. Base phrases always stay.
    """
    levels = sorted(CONFIDENCE)

    def comes_first(a: Column, b: Column) -> Column:
        keys = [
            (a["start"], b["start"]),
            (b["stop"], a["stop"]),
            (b["priority"], a["priority"]),
            (a["label"], b["label"]),
        ]
        order = F.lit(0)
        for x, y in reversed(keys):
            order = F.when(x < y, F.lit(-1)).when(x > y, F.lit(1)).otherwise(order)
        return order

    def step(state: Column, d: Column) -> Column:
        reached = F.lit(-1)
        for level in levels:
            reached = F.when(d["priority"] == level, state[f"to{level}"]).otherwise(reached)
        stays = (d["priority"] == BASE_PRIORITY) | (d["stop"] > reached)
        ends = [
            F.when(
                (d["priority"] >= level) & (d["priority"] < BASE_PRIORITY),
                F.greatest(state[f"to{level}"], d["stop"]),
            )
            .otherwise(state[f"to{level}"])
            .alias(f"to{level}")
            for level in levels
        ]
        kept = F.when(stays, F.concat(state["kept"], F.array(d))).otherwise(state["kept"])
        return F.struct(*ends, kept.alias("kept"))

    start = F.struct(
        *[F.lit(-1).alias(f"to{level}") for level in levels],
        F.array().cast(DETECTION).alias("kept"),
    )
    return F.aggregate(F.array_sort(found, comes_first), start, step, lambda s: s["kept"])


def _table(chosen: list[Rule]) -> Column:
    """All rules as one literal."""
    rows = [(phrase, phrase, label, BASE_PRIORITY, 0.9) for label, phrase in BASE]
    rows += [(r.keyword, r.regex, r.label, r.priority, CONFIDENCE[r.priority]) for r in chosen]
    return F.array(
        *[
            F.struct(
                F.lit(keyword).alias("keyword"),
                F.lit(regex).alias("regex"),
                F.lit(label).alias("label"),
                F.lit(priority).alias("priority"),
                F.lit(confidence).alias("confidence"),
            )
            for keyword, regex, label, priority, confidence in rows
        ]
    )


def scan(
    docs: DataFrame, id: str = "doc_id", text: str = "text", chosen: list[Rule] | None = None
) -> DataFrame:
    """One row per row of docs: id, n_words, detections.

    A detection has the place of its first word, the place after its last, priority, label
    and confidence, words being counted from 0. Detections within one of the same or a higher
    priority are left out, those of base phrases never. Only texts with a rule's keyword meet
    its pattern. Null and empty texts have no words and no detections; repeated rows stay,
    other columns are left out, an empty table gives an empty one. A text's detections are
    ordered within its row.
    """
    table = _table(rules() if chosen is None else chosen)
    whole = F.coalesce(F.col(text), F.lit(""))
    found = F.when(_may_match(whole), let(_detections(whole, table), _kept)).otherwise(
        F.array().cast(DETECTION)
    )
    return docs.select(
        F.col(id),
        F.regexp_count(whole, F.lit(WORD)).cast("long").alias("n_words"),
        found.alias("detections"),
    )


def summary(scanned: DataFrame, id: str = "doc_id") -> DataFrame:
    """One row per row of scanned: id, n_words, n_base, first_word, last_word, base_labels,
    labels, score (the largest confidence, 0 without a detection)."""
    base = F.filter("detections", lambda d: d["priority"] == BASE_PRIORITY)

    def joined(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(found["label"])), ",")

    starts = base["start"]
    return scanned.select(
        id,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("detections")).alias("labels"),
        F.coalesce(F.array_max(F.col("detections")["confidence"]), F.lit(0.0)).alias("score"),
    )
