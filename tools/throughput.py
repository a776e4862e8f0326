"""Build the whole lake from many copies of the given tables, and report rows per second.

    python tools/throughput.py /root/testdata/sf0.1 <new scratch folder> <copies> <threads>

Keys of each copy are shifted, so copies are different orders, customers and sellers.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from oreworks.catalogue.inputs import Inputs
from oreworks.catalogue.queries import write_raw
from oreworks.lake import Lake
from oreworks.plans import BRONZE, GOLD, SILVER, build_gold, ingest_bronze, refine_silver

STRIDE = 10_000_000
KEYS = {
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"],
    "nation": [],
}


def multiply(spark: SparkSession, sf_dir: str, out: str, copies: int) -> None:
    for table, keys in KEYS.items():
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        if keys:
            copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
            rows = rows.repartition(copies).withColumn("copy", copy)
            shifted = {k: F.col(k) + F.col("copy").cast("bigint") * F.lit(STRIDE) for k in keys}
            rows = rows.withColumns(shifted).drop("copy")
        rows.write.parquet(f"{out}/{table}.parquet")


def main(sf_dir: str, out: str, copies: str, threads: str) -> None:
    spark = (
        SparkSession.builder.master(f"local[{threads}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "10g")
        .config("spark.sql.shuffle.partitions", "64")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    multiply(spark, sf_dir, f"{out}/given", int(copies))
    lake = Lake(f"{out}/lake")
    for name, df in Inputs(spark, f"{out}/given").raw().items():
        write_raw(df, lake.raw_path(name))

    lake.create_schemas(spark)
    seconds: dict[str, float] = {}
    raw_rows = 0
    start = time.perf_counter()
    for layer, specs, build in (
        ("bronze", BRONZE, ingest_bronze),
        ("silver", SILVER, refine_silver),
        ("gold", GOLD, build_gold),
    ):
        for name, spec in specs.items():
            began = time.perf_counter()
            report = build(spark, lake, spec)
            seconds[f"{layer}.{name}"] = round(time.perf_counter() - began, 2)
            raw_rows += report.written.actual if layer == "bronze" else 0
    total = time.perf_counter() - start
    print(
        json.dumps(
            {
                "threads": int(threads),
                "raw_rows": raw_rows,
                "seconds": round(total, 1),
                "rows_per_sec": round(raw_rows / total),
                "steps": seconds,
            }
        )
    )


if __name__ == "__main__":
    main(*sys.argv[1:])
