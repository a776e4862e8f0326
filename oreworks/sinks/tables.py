"""Replace, append and upsert of catalog tables.

In a catalog with its own table format, each is that format's atomic operation. In
the session catalog, where tables are Parquet, a replaced or merged table is written
whole to a new directory, outside of any table's own, and counted there. Only then does the
name move: a table of the same columns, without partitions, is pointed at the directory;
otherwise the new version, complete under a name of its own, is renamed, after the old one
has been set aside under `<name>__replaced`. A merge into a partitioned table writes only the
partitions that it changes, and points these, one after the other, at their new files. A failed or retried write leaves the old
table as it was; if the driver is lost between the two renames, the next replace puts the
old table back first. Directories of old versions stay until someone removes them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from oreworks.operators.dedup import require_unique_keys
from oreworks.operators.scd import AUDIT, CLOSES, HISTORY, scd2_steps
from oreworks.operators.upsert import only_new_keys, same_keys, upsert, without_keys

PARQUET = "parquet"
CLUSTER_PROPERTY = "oreworks.cluster_by"
COMPRESSION_PROPERTY = "oreworks.compression"
ASIDE = "__replaced"
ASIDE_PROPERTY = "oreworks.set_aside"


class MissingTable(ValueError):
    """The table to be changed does not exist yet."""


class RowCountMismatch(RuntimeError):
    """A table does not hold the rows that were written."""


@dataclass(frozen=True)
class Layout:
    """How rows are spread over files.

    ``partition_by`` makes a directory per value, for columns of few values. Empty text
    comes back from such a column as NULL.
    ``cluster_by`` makes files that each cover a narrow range of the columns, so that
    file statistics skip most of them; right for dates and other columns of many values.
    """

    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    compression: str = "zstd"

    def arrange(self, df: DataFrame) -> DataFrame:
        """Shuffle rows to where they are written; adaptive execution sets the sizes.

        A value that holds much of the table is split over tasks both ways: rebalancing
        does so by itself, ranges by the hash of the row as last column.
        """
        columns = [*self.partition_by, *self.cluster_by]
        if self.cluster_by:
            hashed = [name for name, kind in df.dtypes if "map<" not in kind]
            return df.repartitionByRange(*columns, F.xxhash64(*hashed)).sortWithinPartitions(
                *columns
            )
        if self.partition_by:
            return df.hint("rebalance", *columns)
        return df


@dataclass(frozen=True)
class Written:
    """What a sink did: rows it was given and rows it finds in the table."""

    table: str
    expected: int
    actual: int


def replace_table(
    df: DataFrame, name: str, layout: Layout | None = None, provider: str = PARQUET
) -> Written:
    """Create the table, or replace its rows and schema. Without a layout, it keeps its own."""
    spark = df.sparkSession
    if layout is None:
        layout = current_layout(spark, name) if spark.catalog.tableExists(name) else Layout()
    if in_session_catalog(spark, name):
        return _replace_version(layout.arrange(df), name, layout)

    def write(rows: DataFrame) -> None:
        writer = rows.writeTo(name).using(provider)
        writer = writer.tableProperty("write.parquet.compression-codec", layout.compression)
        if layout.partition_by:
            writer = writer.partitionedBy(*[F.col(c) for c in layout.partition_by])
        writer.createOrReplace()

    return _counted(layout.arrange(df), name, 0, write)


def replace_split(
    df: DataFrame,
    rejected: str,
    name: str,
    rejects: str,
    extra: Sequence[str],
    layout: Layout | None = None,
) -> tuple[Written, Written]:
    """Replace two tables in one pass over the rows: ``rejects`` by those for which the boolean
    column ``rejected`` is true, ``name`` by all others.

    Both kinds of files are written by the same tasks, and counted there. Neither table has the
    column ``rejected``; the columns ``extra`` are in ``rejects`` only. For tables in the session
    catalog; a catalog of its own takes one statement for each.
    """
    spark = df.sparkSession
    layout = layout or Layout()
    location = _new_version(spark, name)
    seen = Observation()
    counted = df.withColumn(rejected, F.coalesce(rejected, F.lit(False))).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(rejected).alias("rejects")
    )
    counted.write.option("compression", layout.compression).partitionBy(
        rejected, *layout.partition_by
    ).parquet(location)
    bad = seen.get["rejects"]
    done = []
    for table, flag, rows in ((name, "false", seen.get["rows"] - bad), (rejects, "true", bad)):
        gone = {rejected, *(extra if table == name else ())}
        columns = StructType(
            [StructField(f.name, f.dataType) for f in df.schema.fields if f.name not in gone]
        )
        place = f"{location}/{rejected}={flag}"
        if not rows:
            spark.createDataFrame([], columns).write.parquet(place)
        found = spark.read.schema(columns).parquet(place).count() if rows else 0
        done.append(_reconciled(table, rows, found))
        _adopt(spark, table, columns, place, layout)
    return tuple(done)


def append_table(
    df: DataFrame,
    name: str,
    new_keys: Sequence[str] = (),
    layout: Layout | None = None,
    *,
    ignore_extra: bool = False,
) -> Written:
    """Add rows, matched by column name. With ``new_keys``, only rows whose key the table
    does not hold yet, so that a repeated append adds nothing. Columns that the table lacks
    are an error, or left out with ``ignore_extra``."""
    spark = df.sparkSession
    _require_table(spark, name)
    table = spark.table(name)
    if not ignore_extra:
        require_known_columns(df, table.columns)
    rows = only_new_keys(df, table, new_keys) if new_keys else df
    rows = (layout or current_layout(spark, name)).arrange(rows.select(*table.columns))

    if in_session_catalog(spark, name):
        before = set(table.inputFiles())
        expected = _observed(rows, lambda r: r.write.insertInto(name))
        added = [f for f in spark.table(name).inputFiles() if f not in before]
        actual = spark.read.parquet(*added).count() if added else 0
        return _reconciled(name, expected, actual)
    before = table.count()
    return _counted(rows, name, before, lambda r: r.writeTo(name).append())


def upsert_table(
    df: DataFrame, name: str, keys: Sequence[str], layout: Layout | None = None
) -> Written:
    """Update rows whose key the table holds, insert the others."""
    if not keys:
        raise ValueError("an upsert needs keys")
    spark = df.sparkSession
    _require_table(spark, name)
    require_unique_keys(df, keys)
    if in_session_catalog(spark, name):
        return merge_rows(df, name, keys, lambda table: upsert(table, df, keys), layout)
    table = spark.table(name)
    before, inserted = table.count(), only_new_keys(df, table, keys).count()
    merge_into(df, name, keys)
    return _reconciled(name, before + inserted, spark.table(name).count())


def merge_rows(
    batch: DataFrame,
    name: str,
    keys: Sequence[str],
    merged: Callable[[DataFrame], DataFrame],
    layout: Layout | None = None,
) -> Written:
    """Replace the rows of a table by ``merged`` of them, which may change only rows with a key
    of the batch and add rows in partitions that the batch's rows lie in.

    A probe of keys and partition columns alone, without other columns, finds the partitions
    that hold a key of the batch. These, and those that the batch's rows go to, are written anew
    and pointed to; all other files stay where they are. A table without partitions, with a
    NULL or empty one among those values, or whose layout changes, is written whole. What is
    returned counts the rows of what was written.
    """
    spark = batch.sparkSession
    now = current_layout(spark, name)
    columns = list(now.partition_by)
    table = spark.table(name)
    if not columns or (layout not in (None, now)) or any(c not in batch.columns for c in columns):
        return replace_table(merged(table), name, layout or now)

    held = table.select(*keys, *columns).alias("r").join(
        batch.select(*keys).alias("o"), same_keys(keys), "left_semi"
    )
    touched = held.select(*columns).union(
        batch.select(*[F.col(c).cast(table.schema[c].dataType) for c in columns])
    )
    values = [tuple(row) for row in touched.distinct().collect()]
    if any(v is None or v == "" for row in values for v in row):
        return replace_table(merged(table), name, now)
    if not values:
        return Written(name, 0, 0)
    chosen = reduce(or_, [_in_partition(table, columns, row) for row in values])
    return _replace_partitions(merged(table.where(chosen)), name, now, values)


def _in_partition(table: DataFrame, columns: Sequence[str], values: Sequence) -> Column:
    """Is a row in the partition? As plain comparisons, which prune the others' files."""
    kinds = [table.schema[c].dataType for c in columns]
    tests = [F.col(c) == F.lit(v).cast(k) for c, v, k in zip(columns, values, kinds)]
    return reduce(and_, tests)


def _replace_partitions(
    df: DataFrame, name: str, layout: Layout, touched: Sequence[tuple]
) -> Written:
    """Write a new version of some partitions, count it, and point the table at it."""
    spark = df.sparkSession
    columns = list(layout.partition_by)
    location = _new_version(spark, name)
    expected, written = _write_version(layout.arrange(df), location, layout)
    paths, actual = {}, 0
    if expected:
        shown = written.groupBy(*columns).agg(
            F.min("_metadata.file_path").alias("path"), F.count(F.lit(1)).alias("n")
        )
        for *values, path, n in shown.collect():
            paths[tuple(values)] = unquote(path.rsplit("/", 1)[0])
            actual += n
    done = _reconciled(name, expected, actual)
    beyond = sorted(set(paths) - set(touched), key=str)
    if beyond:
        raise ValueError(f"{name}: rows for partitions that the batch has none in: {beyond}")
    for values in touched:
        part = ", ".join(f"`{c}` = {_literal(v)}" for c, v in zip(columns, values))
        known = _partition_exists(spark, name, part)
        if values in paths:
            place = _literal(paths[values])
            if known:
                spark.sql(f"ALTER TABLE {name} PARTITION ({part}) SET LOCATION {place}")
            else:
                spark.sql(f"ALTER TABLE {name} ADD PARTITION ({part}) LOCATION {place}")
        elif known:
            spark.sql(f"ALTER TABLE {name} DROP PARTITION ({part})")
    spark.catalog.refreshTable(name)
    return done


def _partition_exists(spark: SparkSession, name: str, part: str) -> bool:
    return not spark.sql(f"SHOW PARTITIONS {name} PARTITION ({part})").isEmpty()


def _literal(value: object) -> str:
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def merge_into(df: DataFrame, name: str, keys: Sequence[str]) -> None:
    """The catalog's own merge: update what has the same key, insert the rest."""
    target = name.split(".")[-1]
    merge = df.alias("source").mergeInto(name, _same_key(target, keys))
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


def merge_dimension(
    df: DataFrame, name: str, keys: Sequence[str], scd_type: int, as_of: Column | None = None
) -> Written:
    """A batch of unique keys into a stamped dimension by the catalog's own merge, with the
    rows compared that come and go."""
    table = df.sparkSession.table(name)
    now = (F.current_timestamp() if as_of is None else as_of).cast("timestamp")
    if scd_type == 2:
        opened = scd2_steps(table, df, keys, now).filter(f"NOT {CLOSES}")
    else:
        opened = without_keys(df, table, keys)
    expected = table.count() + opened.count()
    (merge_type2 if scd_type == 2 else merge_type1)(df, name, keys, now)
    return _reconciled(name, expected, df.sparkSession.table(name).count())


def merge_type1(df: DataFrame, name: str, keys: Sequence[str], now: Column) -> None:
    """The catalog's own merge into a stamped type 1 dimension, in one statement: matched rows
    take the batch's attributes and keep when they were created."""
    target = name.split(".")[-1]
    taken = _from_source(c for c in df.columns if c not in keys)
    merge = df.alias("source").mergeInto(name, _same_key(target, keys))
    merge = merge.whenMatched().update(taken | {"updated_at": now})
    inserted = _from_source(keys) | taken | dict.fromkeys(AUDIT, now)
    merge.whenNotMatched().insert(inserted).merge()


def merge_type2(df: DataFrame, name: str, keys: Sequence[str], now: Column) -> None:
    """The catalog's own merge into a type 2 dimension, in one statement: current versions of
    changed keys are closed, and what is changed or new is opened."""
    target = name.split(".")[-1]
    source = scd2_steps(df.sparkSession.table(name), df, keys, now)
    known = _same_key(target, keys) & F.expr(f"{target}.is_current AND source.{CLOSES}")
    merge = source.alias("source").mergeInto(name, known)
    merge = merge.whenMatched().update({"valid_to": now, "is_current": F.lit(False)})
    history = dict(zip(HISTORY, (now, F.lit(None).cast("timestamp"), F.lit(True))))
    merge.whenNotMatched().insert(_from_source(df.columns) | history).merge()


def _from_source(columns: Iterable[str]) -> dict[str, Column]:
    return {f"`{c}`": F.col(f"source.`{c}`") for c in columns}


def _same_key(target: str, keys: Sequence[str]) -> Column:
    return F.expr(" AND ".join(f"{target}.`{k}` <=> source.`{k}`" for k in keys))


def in_session_catalog(spark: SparkSession, name: str) -> bool:
    parts = name.split(".")
    return len(parts) < 3 or parts[0] == "spark_catalog"


def current_layout(spark: SparkSession, name: str) -> Layout:
    """The layout an existing table was written with; of another's table, its partitions."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    columns = spark.catalog.listColumns(name)
    clustered = found.get(CLUSTER_PROPERTY, "")
    return Layout(
        partition_by=tuple(c.name for c in columns if c.isPartition),
        cluster_by=tuple(filter(None, clustered.split(","))),
        compression=found.get(COMPRESSION_PROPERTY, Layout.compression),
    )


def _require_table(spark: SparkSession, name: str) -> None:
    if not spark.catalog.tableExists(name):
        raise MissingTable(f"table {name} does not exist; replace it first")


def require_known_columns(df: DataFrame, known: Sequence[str]) -> None:
    """Fail if df has columns that would be dropped."""
    extra = [c for c in df.columns if c not in known]
    if extra:
        raise ValueError(f"columns {extra} are not in the table")


def _replace_version(df: DataFrame, name: str, layout: Layout) -> Written:
    spark = df.sparkSession
    location = _new_version(spark, name)
    expected, written = _write_version(df, location, layout)
    columns = written.schema
    done = _reconciled(name, expected, written.count())

    _adopt(spark, name, columns, location, layout)
    return done


def _adopt(
    spark: SparkSession, name: str, columns: StructType, location: str, layout: Layout
) -> None:
    """Make the files in a directory the table of that name."""
    aside = name + ASIDE
    if not spark.catalog.tableExists(name) and _is_ours(spark, aside):
        spark.sql(f"ALTER TABLE {aside} UNSET TBLPROPERTIES IF EXISTS ('{ASIDE_PROPERTY}')")
        spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
    if _only_moves(spark, name, columns, layout):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_properties(layout)})")
        spark.catalog.refreshTable(name)
        return

    following = f"{name}__{uuid4().hex}"
    partitioned = ", ".join(f"`{c}`" for c in layout.partition_by)
    spark.sql(
        f"CREATE TABLE {following} ({columns.toDDL()}) USING {PARQUET}"
        f" OPTIONS (compression '{layout.compression}')"
        + (f" PARTITIONED BY ({partitioned})" if partitioned else "")
        + f" LOCATION '{location}' TBLPROPERTIES ({_properties(layout)})"
    )
    if partitioned:
        spark.catalog.recoverPartitions(following)
    exists = spark.catalog.tableExists(name)
    if exists:
        _drop_own_aside(spark, aside)
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{ASIDE_PROPERTY}' = 'true')")
        spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {name}")
    if exists:
        spark.sql(f"DROP TABLE {aside}")


def _is_ours(spark: SparkSession, aside: str) -> bool:
    """Is there such a table, written or set aside by a replace?"""
    if not spark.catalog.tableExists(aside):
        return False
    told = {r["key"] for r in spark.sql(f"SHOW TBLPROPERTIES {aside}").collect()}
    return bool(told & {ASIDE_PROPERTY, CLUSTER_PROPERTY})


def _drop_own_aside(spark: SparkSession, aside: str) -> None:
    """Drop what an earlier replace has set aside, but no table of somebody else's."""
    if _is_ours(spark, aside):
        spark.sql(f"DROP TABLE {aside}")
    elif spark.catalog.tableExists(aside):
        raise ValueError(f"table {aside} is in the way and was not set aside by a replace")


def _new_version(spark: SparkSession, name: str) -> str:
    """A new directory for files of a table, outside of any table's own."""
    schema, _, table = name.rpartition(".")
    root = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase()).locationUri
    return f"{root}/_versions/{table}/{uuid4().hex}"


def _write_version(df: DataFrame, location: str, layout: Layout) -> tuple[int, DataFrame]:
    """Rows that were written to the directory, and what is to be read there."""
    expected = _observed(
        df,
        lambda rows: rows.write.option("compression", layout.compression)
        .partitionBy(*layout.partition_by)
        .parquet(location),
    )
    columns = StructType([StructField(f.name, f.dataType) for f in df.schema.fields])
    return expected, df.sparkSession.read.schema(columns).parquet(location)


def _properties(layout: Layout) -> str:
    return (
        f"'{CLUSTER_PROPERTY}' = '{','.join(layout.cluster_by)}',"
        f" '{COMPRESSION_PROPERTY}' = '{layout.compression}'"
    )


def _only_moves(
    spark: SparkSession, name: str, columns: StructType, layout: Layout
) -> bool:
    """Can the table be replaced by pointing it at other files?"""
    if layout.partition_by or not spark.catalog.tableExists(name):
        return False
    told = {
        r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()
    }
    fields = [(f.name, f.dataType) for f in spark.table(name).schema.fields]
    return (
        told.get("Type") == "EXTERNAL"
        and told.get("Provider") == PARQUET
        and not current_layout(spark, name).partition_by
        and fields == [(f.name, f.dataType) for f in columns.fields]
    )


def _observed(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write, and the number of rows that went in.

    The write itself counts, so the source is not read twice. The counter sits in the last
    stage, after any shuffle: there Spark counts each task once, even when executors are
    lost and tasks run again.
    """
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def _reconciled(name: str, expected: int, actual: int) -> Written:
    if expected != actual:
        raise RowCountMismatch(f"{name}: {expected} rows expected, {actual} found")
    return Written(name, expected, actual)


def _counted(
    df: DataFrame, name: str, before: int, write: Callable[[DataFrame], None]
) -> Written:
    """Write, and compare the rows that went in with those that the table has gained."""
    expected = _observed(df, write)
    return _reconciled(name, expected, df.sparkSession.table(name).count() - before)
