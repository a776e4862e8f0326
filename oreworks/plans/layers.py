"""One function per layer, each driven by a description of the table to build.

Nothing here runs a job for its own information: no previews, no counts but the
sink's. Quality reports cost nothing until someone asks for them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oreworks.lake import Lake
from oreworks.operators.clean import clean
from oreworks.operators.dedup import require_unique_keys
from oreworks.operators.quality import quality_report
from oreworks.operators.scd import scd1_apply, scd1_stamp, scd2_apply, scd2_stamp
from oreworks.operators.unify import merge_sources, union_by_name
from oreworks.sinks.tables import (
    Layout,
    MissingTable,
    Written,
    append_table,
    in_session_catalog,
    merge_dimension,
    merge_rows,
    replace_split,
    replace_table,
    upsert_table,
)
from oreworks.sources.files import list_data_files, read_typed
from oreworks.sources.sampling import key_hash_sample
from oreworks.sources.tables import read_tables

Transform = Callable[[DataFrame], DataFrame]


# Columns of rejected records.
CORRUPT, SOURCE_FILE, REJECTED = "_corrupt_record", "source_file", "_rejected"


class EmptySource(ValueError):
    """A raw folder without data files."""


@dataclass(frozen=True)
class BronzeSpec:
    """A raw folder to be typed and stored as it is. ``derive`` adds partition columns;
    ``keys`` are those that cleaning will make unique.

    With ``rejects``, records that do not fit the schema go to a table `<table>_rejects` instead,
    with their text and file, in the same pass. The text is in ``corrupt_column``, whose name
    is then `_corrupt_record` unless told otherwise."""

    table: str
    schema: StructType
    keys: tuple[str, ...]
    file_format: str = "csv"
    header: bool = True
    strict_header: bool = False
    corrupt_column: str | None = None
    rejects: bool = False
    derive: Transform | None = None
    layout: Layout | None = None


@dataclass(frozen=True)
class SilverSpec:
    """A cleaned table. Several ``sources`` are put together by ``merge``, which then also
    has to shape them: ``not_null``, ``prepare`` and ``transform`` are for a single source.

    ``mode`` "append" adds to a table that another source started; ``append_keys``
    then keep a repeated run from adding its rows again.
    """

    table: str
    sources: tuple[str, ...]
    keys: tuple[str, ...]
    order_by: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    prepare: Transform | None = None
    transform: Transform | None = None
    merge: Callable[[Sequence[DataFrame]], DataFrame] = union_by_name
    drop: tuple[str, ...] = ()
    mode: str = "overwrite"
    append_keys: tuple[str, ...] = ()
    partition: str | None = None
    layout: Layout | None = None

    def __post_init__(self) -> None:
        if len(self.sources) > 1 and (self.not_null or self.prepare or self.transform):
            raise ValueError(f"{self.table}: shape several sources in merge")


@dataclass(frozen=True)
class GoldSpec:
    """A dimension or fact. ``logic`` gets its sources by short name and the run's date.

    ``mode``: "overwrite", "append", or "merge" on ``keys``. Merging a type 1 dimension
    keeps when a row was created; merging a type 2 one keeps its history.
    """

    table: str
    sources: tuple[tuple[str, str], ...]
    logic: Callable[[Mapping[str, DataFrame], Column], DataFrame]
    keys: tuple[str, ...]
    scd_type: int = 1
    mode: str = "overwrite"
    stamped: bool = True
    layout: Layout | None = None


@dataclass(frozen=True)
class LayerReport:
    """What was written, and how to get a quality report of the rows that were read
    (silver) or written (bronze, gold). ``rejected``: what went to the table of rejects."""

    written: Written
    quality: Callable[[], DataFrame] = field(compare=False)
    rejected: Written | None = None


def ingest_bronze(spark: SparkSession, lake: Lake, spec: BronzeSpec) -> LayerReport:
    """Raw files to a bronze table, with the row counts compared."""
    path = lake.raw_path(spec.table)
    if list_data_files(spark, path).filter(F.col("format") == spec.file_format).isEmpty():
        raise EmptySource(f"no {spec.file_format} files in {path}")
    corrupt = spec.corrupt_column or (CORRUPT if spec.rejects else None)
    rows = read_typed(
        spark,
        path,
        spec.schema,
        spec.file_format,
        header=spec.header,
        strict_header=spec.strict_header,
        corrupt_column=corrupt,
    )
    name = lake.table("bronze", spec.table)
    if spec.rejects:
        if not in_session_catalog(spark, name):
            raise ValueError(f"{name}: rejects need a table in the session catalog")
        text = F.col(corrupt) if corrupt in rows.columns else F.lit(None).cast("string")
        rows = rows.withColumns({corrupt: text, SOURCE_FILE: F.col("_metadata.file_path")})
        if spec.derive:
            rows = rows.transform(spec.derive)
        written, rejected = replace_split(
            rows.withColumn(REJECTED, F.col(corrupt).isNotNull()),
            REJECTED,
            name,
            f"{name}_rejects",
            (corrupt, SOURCE_FILE),
            spec.layout,
        )
        return LayerReport(written, lambda: quality_report(spark.table(name), spec.keys), rejected)
    if spec.derive:
        rows = rows.transform(spec.derive)
    written = replace_table(rows, name, spec.layout, lake.provider)
    return LayerReport(written, lambda: quality_report(spark.table(name), spec.keys))


def refine_silver(
    spark: SparkSession,
    lake: Lake,
    spec: SilverSpec,
    as_of: Column | None = None,
    sample_fraction: float | None = None,
) -> LayerReport:
    """Bronze tables to a silver table. The report is about the bronze rows, all of them
    or those of a fraction of the keys."""
    names = [lake.table("bronze", s) for s in spec.sources]
    sources = [spark.table(name) for name in names]
    if len(sources) == 1:
        rows = clean(
            sources[0],
            spec.keys,
            source=names[0],
            order_by=spec.order_by,
            not_null=spec.not_null,
            prepare=spec.prepare,
            transform=spec.transform,
            drop=spec.drop,
        )
    else:
        rows = merge_sources(
            sources, spec.keys, order_by=spec.order_by, merge=spec.merge, drop=spec.drop
        )
    now = F.current_timestamp() if as_of is None else as_of.cast("timestamp")
    rows = rows.withColumn("ingested_at", now)

    name = lake.table("silver", spec.table)
    if spec.mode == "append":
        written = append_table(rows, name, spec.append_keys, spec.layout)
    else:
        written = replace_table(rows, name, spec.layout, lake.provider)
    checked = sources[0] if len(sources) == 1 else spec.merge(sources)
    if sample_fraction is not None:
        checked = key_hash_sample(checked, spec.keys, sample_fraction)
    return LayerReport(written, lambda: quality_report(checked, spec.keys, spec.partition))


def build_gold(
    spark: SparkSession, lake: Lake, spec: GoldSpec, as_of: Column | None = None
) -> LayerReport:
    """Silver (or gold) tables to a gold table. The report is about the result."""
    names = {short: lake.table(layer, short) for layer, short in spec.sources}
    tables = read_tables(spark, names.values())
    sources = {short: tables[name] for short, name in names.items()}
    today = F.current_date() if as_of is None else as_of.cast("date")
    rows = spec.logic(sources, today)

    name = lake.table("gold", spec.table)
    if spec.mode == "merge":
        written = _merge_gold(rows, name, spec, as_of)
    else:
        rows = _stamp(rows, spec, as_of)
        if spec.mode == "append":
            written = append_table(rows, name, layout=spec.layout)
        else:
            written = replace_table(rows, name, spec.layout, lake.provider)
    return LayerReport(written, lambda: quality_report(spark.table(name), spec.keys))


def _stamp(rows: DataFrame, spec: GoldSpec, as_of: Column | None) -> DataFrame:
    if spec.scd_type == 2:
        return scd2_stamp(rows, as_of)
    return scd1_stamp(rows, as_of) if spec.stamped else rows


def _merge_gold(
    rows: DataFrame, name: str, spec: GoldSpec, as_of: Column | None
) -> Written:
    spark = rows.sparkSession
    if spec.scd_type == 1 and not spec.stamped:
        return upsert_table(rows, name, spec.keys, spec.layout)
    if not spark.catalog.tableExists(name):
        raise MissingTable(f"table {name} does not exist; replace it first")
    require_unique_keys(rows, spec.keys)
    apply = scd2_apply if spec.scd_type == 2 else scd1_apply

    def merged(table: DataFrame) -> DataFrame:
        return apply(table, rows, spec.keys, as_of)

    if in_session_catalog(spark, name):
        return merge_rows(rows, name, spec.keys, merged, spec.layout)
    return merge_dimension(rows, name, spec.keys, spec.scd_type, as_of)
