"""A corpus pipeline: documents in, a mixed and cleaned set of documents out.

Every stage takes the documents that the one before it has kept, with the columns doc_id,
text, lang, source and n_chars. Of rows with equal doc_id and text the stages from the second
on keep one.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreworks.llm import decontamination, jaccard_join, language_id, mixing, substring_dedup
from oreworks.llm.lineage import TOLD, cut, release
from oreworks.llm.rows import once, same_row, sized, small_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts with a language: with letters, and on the side of some language's prototype.

    A text of a word or two has a small cosine with any language, so no larger one is asked for.
    """
    small_batches(spark)
    model = language_id.fit(docs.where(~language_id.held_out("doc_id", 4, 2)))
    rows = docs.select(
        F.struct("*").alias("doc"), language_id.predicted(F.col("text"), model).alias("found")
    )
    known = (F.col("found.lang") != language_id.UNDETERMINED) & (
        F.col("found.score") > 0
    )
    return rows.where(known).select("doc.*")


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of linked ones.

    Near copies share 80 of 100 runs of five words; op10's query has a stricter limit.
    """
    small_batches(spark)
    docs = once(docs)
    gone = sized(cut(jaccard_join.superseded(docs, width=5, similarity=80)))
    return docs.alias("d").join(
        gone.alias("f"), same_row("d", "f", "doc_id", "text"), "left_anti"
    )


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages out of texts; a document of which no word is left goes."""
    small_batches(spark)
    release(spark, TOLD)  # what the stage before has shuffled
    docs = once(docs)
    found = substring_dedup.find_repeats(docs)
    spans = sized(
        cut(
            found.groupBy(F.col("doc_id").alias("id"), "text_key").agg(
                F.collect_list(F.struct("first_word", "n_words")).alias("spans")
            )
        )
    )
    joined = docs.alias("d").join(
        spans.alias("f"), same_row("d", "f", "doc_id", "text"), "left"
    )
    rows = joined.select(
        F.struct("d.*").alias("doc"),
        F.col("f.spans").isNotNull().alias("changed"),
        substring_dedup.removed(F.col("d.text"), F.col("f.spans")).alias("left"),
    )
    rows = rows.where(~F.col("changed") | F.col("left").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("left"), "n_chars": F.length("left").cast("long")}
    return rows.select(
        *[
            F.when(F.col("changed"), new[c]).otherwise(F.col(f"doc.{c}")).alias(c)
            if c in new
            else F.col(f"doc.{c}").alias(c)
            for c in docs.columns
        ]
    )


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a test item."""
    small_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.find_items(docs, items)
    held = sized(cut(found.select(F.col("doc_id").alias("id"), "text_key").distinct()))
    return docs.alias("d").join(
        held.alias("f"), same_row("d", "f", "doc_id", "text"), "left_anti"
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target and taken.

    taken tells how many of the document's words the mix holds, up to twice its size.
    """
    small_batches(spark)
    docs = once(docs)
    added = ["size", "source_size", "target", "taken"]
    chosen = cut(mixing.chosen(docs))
    rows = docs.alias("d").join(
        sized(chosen).alias("f"), same_row("d", "f", "doc_id", "text")
    )
    return rows.select(
        *[F.col(f"d.{c}") for c in docs.columns if c not in added],
        *[F.col(f"f.{c}") for c in added],
    )


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("jaccard_join", join_near_copies),
    ("substring_dedup", remove_repeats),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
]

#: Language profiles and banding are beyond SQL; tests/llm compares stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    shared = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"
    )
    folder = f"{shared.rstrip('/')}/pipeline-{uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
