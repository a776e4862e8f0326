"""Quality rules: a table of thresholds, compiled into one projection of built-in functions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the be to of and that have with a in is for on are this it as was by from or not at an"
    " der die das und ist nicht ein eine zu den mit von sich auf für im dem des"
    " le la les et est un une que des du de en dans pour qui sur au par ne pas avec"
    " el los las y es no por con para una su al lo como más del se"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes if low <= measure <= high; None: no bound."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("enough_words", "n_words", low=50),
    Rule("not_too_many_words", "n_words", high=1_000_000),
    Rule("word_length", "mean_word_chars", low=2, high=15),
    Rule("symbols", "symbols_per_word", high=0.1),
    Rule("repeated_words", "repeat_word_share", high=0.5),
    Rule("repeated_lines", "dup_line_share", high=0.5),
    Rule("bullet_lines", "bullet_line_share", high=0.9),
    Rule("cut_lines", "ellipsis_line_share", high=0.3),
    Rule("stop_words", "n_stop_words", low=2),
)

BLANK = r"[\x20\x09-\x0D]"
NOT_BLANK = r"[^\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once for the row, however often use mentions it."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def words_of(text: Column) -> Column:
    """The words of a text; null and blank: none."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(inner) > 0, F.split(inner, BLANK + "+")).otherwise(
        F.array().cast("array<string>")
    )


def repeated_words(words: Column, width: int = 3) -> Column:
    """How many words stand in a window of so many words that occurs twice or more in the text.

    Windows are compared by a 64-bit hash of their words' hashes. They are sorted by hash and
    place; equal neighbours are repeated. Each window then adds the words that the one before
    it has not covered. n log n of the text's length.
    """

    def covered(starts: Column) -> Column:
        gaps = F.transform(
            starts,
            lambda at, k: F.when(k == 0, F.lit(width)).otherwise(
                F.least(F.lit(width), at - starts[k - 1])
            ),
        )
        return F.aggregate(gaps, F.lit(0), lambda total, x: total + x)

    def marked(pairs: Column) -> Column:
        same = lambda j, h: F.coalesce(F.get(pairs, j)["h"] == h, F.lit(False))
        kept = F.filter(pairs, lambda p, j: same(j - 1, p["h"]) | same(j + 1, p["h"]))
        return let(F.sort_array(F.transform(kept, lambda p: p["at"])), covered)

    def repeats(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, k: F.struct(h.alias("h"), k.alias("at"))))
        return F.when(
            F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)
        ).otherwise(let(placed, marked))

    def windows_of(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - width)
        made = F.transform(starts, lambda k: F.xxhash64(*[hashes[k + j] for j in range(width)]))
        return let(made, repeats)

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > width, let(hashed, windows_of)).otherwise(F.lit(0))


def _word_counts(words: Column) -> Column:
    either_case = STOP_WORDS + [w.capitalize() for w in STOP_WORDS]
    return F.struct(
        F.size(words).alias("n_words"),
        repeated_words(words).alias("n_repeat_words"),
        F.size(F.filter(words, lambda w: w.isin(either_case))).alias("n_stop_words"),
    )


def _line_counts(lines: Column) -> Column:
    bullet = r"^[\x20\x09-\x0D]*[-*\u2022\u2023\u25aa]"
    cut = r"(?:\.\.\.|\u2026)[\x20\x09-\x0D]*$"
    return F.struct(
        F.size(lines).alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        F.size(F.filter(lines, lambda x: x.rlike(bullet))).alias("n_bullet_lines"),
        F.size(F.filter(lines, lambda x: x.rlike(cut))).alias("n_ellipsis_lines"),
    )


def _measured(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Whole numbers; the text is cut into words once and into lines once."""
    empty = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(empty, "\n"), lambda x: x.rlike(NOT_BLANK))
    counted = docs.select(
        F.col(id).alias("id"),
        let(words_of(empty), _word_counts).alias("words"),
        let(lines, _line_counts).alias("lines"),
        F.length(F.regexp_replace(empty, BLANK + "+", "")).alias("word_chars"),
        F.regexp_count(empty, F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
    )
    return counted.select("id", "words.*", "lines.*", "word_chars", "n_symbols")


COUNTS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words"
    " n_lines n_bullet_lines n_ellipsis_lines n_stop_words"
).split()


def _ratio(part: str, whole: str) -> Column:
    """0 where there is nothing to divide by."""
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "repeat_word_share": ("n_repeat_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "bullet_line_share": ("n_bullet_lines", "n_lines"),
    "ellipsis_line_share": ("n_ellipsis_lines", "n_lines"),
}


def _passes(rule: Rule) -> Column:
    measure = _ratio(*RATIOS[rule.measure]) if rule.measure in RATIOS else F.col(rule.measure)
    tests = [measure >= rule.low] if rule.low is not None else []
    tests += [measure <= rule.high] if rule.high is not None else []
    return tests[0] & tests[1] if len(tests) == 2 else tests[0]


def apply_rules(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of docs: id, the counts, base_failed, failed_rules, kept.

    base_failed: under 50 words, or more than half of the words in repeated windows. kept:
    not base_failed, and no rule is broken. failed_rules names the broken ones in the order
    of the table. Null and blank texts have no words and fail. Ratios of nothing are 0.
    Repeated rows stay, other columns are left out, an empty table gives an empty one.
    """
    counted = _measured(docs, id, text).select(
        F.col("id").alias(id), *[F.col(name).cast("long").alias(name) for name in COUNTS]
    )
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    failed = F.array_compact(
        F.array(*[F.when(~_passes(rule), F.lit(rule.name)) for rule in rules])
    )
    return counted.select(
        "*", base.alias("base_failed"), F.array_join(failed, ",").alias("failed_rules")
    ).withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))
