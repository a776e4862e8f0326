"""Every exchange of a running query takes threads and memory of the driver until its job ends."""

import random

import pytest
from pyspark.sql.classic.dataframe import DataFrame

import corpus_pipeline
from oreworks.llm import components

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture
def planned(monkeypatch):
    """Exchanges in the plan of each intermediate result."""
    found = []

    def kept(df, *args, **more):
        plan = df._jdf.queryExecution().executedPlan().toString()
        found.append(sum("Exchange " in x and "ReusedExchange" not in x for x in plan.split("\n")))
        return checkpoint(df, *args, **more)

    checkpoint = DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", kept)
    return found


def near_copies():
    """Groups of near copies and texts that share a line with others, so buckets stay mixed."""
    rng = random.Random(5)
    line = " ".join(f"s{x}" for x in range(60))
    rows = []
    for base in range(4):
        words = [f"b{base}w{x}" for x in range(120)]
        for _ in range(10):
            copy = list(words)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = f"n{rng.randint(0, 10**6)}"
            own = " ".join(f"o{rng.randint(0, 10**6)}" for _ in range(20))
            rows.append(" ".join(copy) + ".\n" + line + " " + own)
    return rows


@pytest.mark.parametrize(
    "stage,most,total", [("jaccard_join", 12, 110), ("substring_dedup", 12, 120), ("mixing", 12, 22)]
)
def test_a_stage_plans_few_exchanges_at_a_time(spark, make, planned, stage, most, total):
    STAGES[stage](spark, make(near_copies()), "").collect()
    assert max(planned) <= most
    assert sum(planned) <= total


def test_a_step_of_components_reads_what_is_made_once(spark, planned):
    edges = spark.createDataFrame([(k, k + 1) for k in range(9)], "a long, b long")
    assert components.components(edges).count() == 10
    assert max(planned) <= 4
