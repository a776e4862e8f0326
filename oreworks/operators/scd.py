"""Slowly changing dimensions.

Both apply functions join the (wide) dimension once with the batch, as a left join,
and the batch once with the dimension's keys. A small batch is broadcast and leaves
the dimension unshuffled; with a large one, adaptive execution splits hot keys, which
it could not do in a full outer join. NULL keys equal each other. A batch that repeats a
key makes the query fail, and columns that the dimension lacks are refused.

``scd2_insert`` takes changes in any order of time and puts versions between others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreworks.operators.dedup import unique_by_key
from oreworks.operators.upsert import same_keys, without_keys

HISTORY = ("valid_from", "valid_to", "is_current")
AUDIT = ("created_at", "updated_at")
#: In the steps of a type 2 merge: does the row close a version, or open one?
CLOSES = "closes_version"


def _now(as_of: Column | None) -> Column:
    return (F.current_timestamp() if as_of is None else as_of).cast("timestamp")


def scd1_stamp(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """First load of a type 1 dimension."""
    return df.withColumns(dict.fromkeys(AUDIT, _now(as_of)))


def scd1_apply(
    dimension: DataFrame, batch: DataFrame, keys: Sequence[str], as_of: Column | None = None
) -> DataFrame:
    """Overwrite what the batch holds, keeping ``created_at``; insert what is new."""
    _require_known(dimension, batch)
    now = _now(as_of)
    attributes = [c for c in dimension.columns if c not in (*keys, *AUDIT)]
    matched = F.col("incoming").isNotNull()

    def newer(name: str) -> Column:
        return F.when(matched, F.col("incoming")[name]).otherwise(F.col(name)).alias(name)

    updated = _with_incoming(dimension, batch, keys, attributes).select(
        *keys,
        *[newer(a) for a in attributes],
        "created_at",
        F.when(matched, now).otherwise(F.col("updated_at")).alias("updated_at"),
    )
    inserted = scd1_stamp(_unmatched(batch, dimension, keys, attributes), now)
    return updated.unionByName(inserted).select(*dimension.columns)


def scd2_stamp(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """First load of a type 2 dimension: every row is current from now on."""
    return df.withColumns(dict(zip(HISTORY, _open(_now(as_of)))))


def scd2_apply(
    dimension: DataFrame, batch: DataFrame, keys: Sequence[str], as_of: Column | None = None
) -> DataFrame:
    """Close the current version of each key whose attributes changed, open the new one,
    open new keys, keep everything else.

    NULLs compare as values. Applying a batch twice changes nothing. A change dated at
    or before the version it replaces fails: intervals would overlap. A row whose
    ``is_current`` is NULL is kept as one of the past.
    """
    _require_known(dimension, batch)
    now = _now(as_of)
    attributes = [c for c in dimension.columns if c not in (*keys, *HISTORY)]
    current = dimension.filter("is_current")
    past = dimension.filter("NOT coalesce(is_current, false)")

    old = F.struct(*attributes)
    changed = F.col("incoming").isNotNull() & ~old.eqNullSafe(F.col("incoming"))
    closing = F.when(F.col("valid_from") < now, now).otherwise(
        F.raise_error(F.lit("change is not later than the version it replaces")).cast("timestamp")
    )
    kept = _version(old, [F.col(h) for h in HISTORY])
    closed = _version(old, [F.col("valid_from"), closing, F.lit(False)])
    opened = _version(F.col("incoming"), _open(now))
    versions = F.when(changed, F.array(closed, opened)).otherwise(F.array(kept))

    updated = (
        _with_incoming(current, batch, keys, attributes)
        .select(*keys, F.explode(versions).alias("v"))
        .select(*keys, "v.row.*", *[f"v.{h}" for h in HISTORY])
    )
    inserted = scd2_stamp(_unmatched(batch, current, keys, attributes), now)
    return past.unionByName(updated).unionByName(inserted)


def scd2_steps(
    dimension: DataFrame, batch: DataFrame, keys: Sequence[str], as_of: Column | None = None
) -> DataFrame:
    """What ``scd2_apply`` would do, as rows for one MERGE statement: the batch's columns and
    ``closes_version``, true to close a key's current version and false to open one. A changed
    key has both, a new one the latter, any other none."""
    _require_known(dimension, batch)
    now = _now(as_of)
    attributes = [c for c in dimension.columns if c not in (*keys, *HISTORY)]
    current = dimension.filter("is_current").select(
        *keys, F.struct("valid_from", F.struct(*attributes).alias("old")).alias("version")
    )
    incoming = unique_by_key(batch.select(*keys, *attributes), keys)
    met = incoming.alias("r").join(current.alias("o"), same_keys(keys), "left")
    version = F.col("o.version")
    late = F.raise_error(F.lit("change is not later than the version it replaces"))
    both = F.when(version["valid_from"] < now, F.array(F.lit(True), F.lit(False))).otherwise(late)
    steps = (
        F.when(version.isNull(), F.array(F.lit(False)))
        .when(~version["old"].eqNullSafe(F.col("r.row")), both)
        .otherwise(F.array().cast("array<boolean>"))
    )
    return met.select("r.*", F.explode(steps).alias(CLOSES)).select(*keys, "row.*", CLOSES)


def scd2_insert(
    dimension: DataFrame, changes: DataFrame, keys: Sequence[str], changed_at: str
) -> DataFrame:
    """Put dated changes into the history, whatever order they come in.

    ``changed_at`` names the column of ``changes`` that tells from when on a row's attributes
    hold; a key may change any number of times. The version in force at that time is split:
    it ends there, and the new one lasts until the next known change or, where the version
    it splits had an end, until that. A change before all versions lasts until the first. A
    change at the very start of a version replaces its attributes; of changes of one key and
    time the last by attributes counts. A version with the attributes of the one before it,
    which it follows without a gap, is no version, so a change that comes later and lies between
    the two lasts until the next one kept. Applying changes twice changes nothing.

    Histories of other keys, and rows whose ``is_current`` is NULL, stay as they are and are
    not sorted. Those that change are read in order, key by key, without being held.
    """
    attributes = [c for c in dimension.columns if c not in (*keys, *HISTORY)]
    _require_known(dimension, changes.drop(changed_at))
    row = F.struct(*attributes)
    start = F.col(changed_at).cast("timestamp")
    new = (
        changes.filter(start.isNotNull())
        .groupBy(*keys, start.alias("valid_from"))
        .agg(F.max(row).alias("row"))
    )
    touched = new.select(*keys).distinct()
    known = F.col("is_current").isNotNull()
    histories = dimension.filter(known).alias("r")
    versions = histories.join(touched.alias("o"), same_keys(keys), "left_semi").select(
        *keys, "valid_from", row.alias("row"), "valid_to", F.lit(False).alias("is_new")
    )
    moments = versions.unionByName(
        new.withColumns({"valid_to": F.lit(None).cast("timestamp"), "is_new": F.lit(True)})
    )
    in_time = Window.partitionBy(*keys).orderBy("valid_from", "is_new")
    until_now = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    # The end of the version in force, which a new one inside of it takes over.
    end = F.last(F.when(~F.col("is_new"), F.struct("valid_to")), ignorenulls=True).over(until_now)
    placed = moments.select(
        *keys,
        "valid_from",
        "row",
        F.when(F.col("valid_from") < end["valid_to"], end["valid_to"]).alias("valid_to"),
        (F.lead("valid_from").over(in_time) == F.col("valid_from")).alias("replaced"),
    ).filter("NOT coalesce(replaced, false)")
    before = F.lag(F.struct("row", "valid_to")).over(in_order := Window.partitionBy(*keys).orderBy("valid_from"))
    repeated = before["row"].eqNullSafe(F.col("row")) & F.coalesce(
        before["valid_to"] >= F.col("valid_from"), F.lit(True)
    )
    following = F.lead("valid_from").over(in_order)
    done = (
        placed.withColumn("repeated", F.coalesce(repeated, F.lit(False)))
        .filter("NOT repeated")
        .withColumn("valid_to", F.least("valid_to", following))
        .select(*keys, "row.*", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))
    )
    others = without_keys(dimension.filter(known), touched, keys)
    unknown = dimension.filter(~known)
    return others.unionByName(unknown).unionByName(done).select(*dimension.columns)


def _open(now: Column) -> list[Column]:
    return [now, F.lit(None).cast("timestamp"), F.lit(True)]


def _version(row: Column, history: Sequence[Column]) -> Column:
    return F.struct(row.alias("row"), *[c.alias(h) for h, c in zip(HISTORY, history)])


def _with_incoming(
    dimension: DataFrame, batch: DataFrame, keys: Sequence[str], attributes: Sequence[str]
) -> DataFrame:
    """The dimension, with the batch's attributes as ``incoming``, NULL where unmatched."""
    incoming = _unique(batch, keys, attributes)
    joined = dimension.alias("r").join(incoming.alias("o"), same_keys(keys), "left")
    return joined.select("r.*", F.col("o.row.attributes").alias("incoming"))


def _unmatched(
    batch: DataFrame, dimension: DataFrame, keys: Sequence[str], attributes: Sequence[str]
) -> DataFrame:
    """The batch's rows of new keys.

    Keys come out of the row, not of the join: Spark 4.1 takes a union of two joins by one key
    for partitioned by it, reads a join with that union without a shuffle, and then fails
    on unequal numbers of partitions, when a dimension is merged twice in one query.
    """
    incoming = _unique(batch, keys, attributes)
    return without_keys(incoming, dimension, keys).select("row.key.*", "row.attributes.*")


def _unique(batch: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """The batch as keys and ``row``, a struct of ``key`` and ``attributes``."""
    parts = F.struct(*keys).alias("key"), F.struct(*attributes).alias("attributes")
    rows = batch.select(*[F.col(k).alias(f"by_{n}") for n, k in enumerate(keys)], *parts)
    unique = unique_by_key(rows, [f"by_{n}" for n in range(len(keys))])
    return unique.select(*[F.col(f"by_{n}").alias(k) for n, k in enumerate(keys)], "row")


def _require_known(dimension: DataFrame, batch: DataFrame) -> None:
    extra = [c for c in batch.columns if c not in dimension.columns]
    if extra:
        raise ValueError(f"columns {extra} are not in the dimension")
