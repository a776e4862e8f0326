"""Where the layers of a lake are stored and what their tables are called."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class Lake:
    """Names and places; holds no data.

    ``root`` is any storage Spark can write to. ``catalog`` names a catalog with
    its own table format (``provider``), as set by ``spark.sql.catalog.<name>``;
    without one, tables are Parquet in the session catalog.
    """

    root: str
    catalog: str | None = None
    provider: str = "parquet"
    schemas: Mapping[str, str] = field(default_factory=dict)
    roots: Mapping[str, str] = field(default_factory=dict)
    raw_folders: Mapping[str, str] = field(default_factory=dict)

    def layer_root(self, layer: str) -> str:
        return self.roots.get(layer, f"{self.root}/{layer}")

    def raw_path(self, table: str) -> str:
        raw_root = self.roots.get("raw", f"{self.root}/raw")
        return f"{raw_root}/{self.raw_folders.get(table, table)}"

    def schema(self, layer: str) -> str:
        name = self.schemas.get(layer, layer)
        return f"{self.catalog}.{name}" if self.catalog else name

    def table(self, layer: str, table: str) -> str:
        return f"{self.schema(layer)}.{table}"

    def create_schemas(self, spark: SparkSession) -> None:
        for layer in LAYERS:
            spark.sql(
                f"CREATE SCHEMA IF NOT EXISTS {self.schema(layer)}"
                f" LOCATION '{self.layer_root(layer)}'"
            )

    def use(self, spark: SparkSession, layer: str) -> None:
        """Make a layer the one that table names without a schema mean."""
        spark.sql(f"USE {self.schema(layer)}")
