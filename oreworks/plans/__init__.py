"""Whole layers: raw files to bronze, bronze to silver, silver to gold."""

from oreworks.plans.layers import (
    BronzeSpec,
    GoldSpec,
    LayerReport,
    SilverSpec,
    build_gold,
    ingest_bronze,
    refine_silver,
)
from oreworks.plans.tables import BRONZE, GOLD, SILVER, build_lake, date_dimension

__all__ = [
    "BRONZE",
    "GOLD",
    "SILVER",
    "BronzeSpec",
    "GoldSpec",
    "LayerReport",
    "SilverSpec",
    "build_gold",
    "build_lake",
    "date_dimension",
    "ingest_bronze",
    "refine_silver",
]
