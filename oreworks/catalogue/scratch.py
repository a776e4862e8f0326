"""Places for the tables that queries write."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession

from oreworks.lake import Lake

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """A new directory below the one the cluster shares for such data, or, where none is
    set, below the warehouse, which is shared as well."""
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{shared.rstrip('/')}/oreworks-{uuid4().hex}"


def scratch_lake(spark: SparkSession) -> Lake:
    """A lake of its own for one query: no other query sees its tables."""
    root = scratch_root(spark)
    tag = root.rsplit("-", 1)[-1]
    names = {layer: f"{layer}_{tag}" for layer in ("bronze", "silver", "gold")}
    lake = Lake(root, schemas=names)
    lake.create_schemas(spark)
    return lake
