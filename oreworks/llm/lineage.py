"""Intermediate results that other stages read again."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame, SparkSession


#: Seconds after which the JVM has heard of what Python has let go; it is told once a second.
TOLD = 1.2


def release(spark: SparkSession, wait: float = 0.0) -> None:
    """Let Spark delete what queries without a reference have shuffled and kept.

    It does so when the driver's garbage is collected, which would otherwise happen only when
    the driver runs short of memory. Without a wait of TOLD seconds, what was let go just before
    is deleted by the next call only.
    """
    gc.collect()
    time.sleep(wait)
    spark.sparkContext._jvm.System.gc()


def cut(df: DataFrame, free: bool = True) -> DataFrame:
    """df, computed once and kept in the checkpoint folder that all executors share.

    The folder is the session's (spark.checkpoint.dir). Only where none is set, it lies below
    the warehouse, which is shared as well. What earlier steps have shuffled is then out of use,
    and freed at once. Small steps that follow each other closely leave that (free=False) to the
    next one: the driver takes more memory if most of its time goes into collecting garbage.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints")
    done = df.checkpoint(eager=True)
    del df
    if free:
        release(spark)
    return done
