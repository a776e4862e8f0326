"""Finding rows of a table of documents again, by id and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts that a Python worker gets at a time, where the session has not set a number: Spark's
#: own default of 10,000 texts takes hundreds of megabytes if they are long.
TEXTS_AT_A_TIME = 1_000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Rows up to which a table of ids and 64-bit keys (some 50 bytes each) is broadcast.
FEW_ROWS = 1_000_000


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python workers in small batches, unless the session says otherwise."""
    if spark.conf.get(BATCH_SETTING) == "10000":
        spark.conf.set(BATCH_SETTING, str(TEXTS_AT_A_TIME))


def sized(found: DataFrame) -> DataFrame:
    """found, to be broadcast if it has few rows; otherwise both sides are shuffled."""
    return F.broadcast(found) if found.count() <= FEW_ROWS else found


def same_row(docs: str, found: str, id: str, text: str) -> Column:
    """Do the aliased tables mean the same document? found has id and text_key."""
    return (F.xxhash64(F.col(f"{docs}.{text}")) == F.col(f"{found}.text_key")) & F.col(
        f"{docs}.{id}"
    ).eqNullSafe(F.col(f"{found}.id"))


def once(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one of the rows that have equal id and text: the first by its other columns,
    as JSON, so that it does not depend on how rows are dealt."""
    others = [c for c in docs.columns if c not in (id, text)]
    if not others:
        return docs.dropDuplicates([id, text])
    keys = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("text_key"))
    repeated = keys.groupBy("id", "text_key").count().where("count > 1").drop("count")
    if repeated.isEmpty():
        return docs
    match = same_row("d", "f", id, text)
    left, right = docs.alias("d"), repeated.alias("f")
    single = left.join(right, match, "left_anti")
    rest = F.struct(*others)
    first = (
        left.join(right, match, "left_semi")
        .groupBy(id, text)
        .agg(F.min_by(rest, F.to_json(rest)).alias("first"))
    )
    columns = [F.col(c) if c in (id, text) else F.col("first")[c].alias(c) for c in docs.columns]
    return single.unionByName(first.select(*columns))
