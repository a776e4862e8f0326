import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from oreworks import operators as op
from oreworks.functions import as_date
from oreworks.operators.clean import clean
from oreworks.operators.dedup import DuplicateKeys
from oreworks.sources import key_hash_sample

T0, T1, T2 = (dt.datetime(2024, m, 1) for m in (1, 2, 3))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def at(moment):
    return F.lit(str(moment)).cast("timestamp")


# One row per key


def test_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    assert rows(op.dedup_by_key(df, ["k"])) == [(1, 3), (None, 1)]


def test_order_decides_then_all_columns(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 9, None)], "k int, o int, v string")
    assert rows(op.dedup_by_key(df, ["k"], ["o"])) == [(1, 5, "a")]
    assert rows(op.dedup_by_key(df, ["k"], ["o"], keep="last")) == [(1, 9, None)]


def test_copies_are_counted(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert rows(op.dedup_by_key(df, ["k"], copies="n")) == [(1, "a", 2), (2, "c", 1)]
    assert rows(op.dedup_by_key(df.select("k"), ["k"], copies="n")) == [(1, 2), (2, 1)]


def test_empty_input_stays_empty(spark):
    df = spark.createDataFrame([], "k int, v int")
    assert rows(op.dedup_by_key(df, ["k"])) == []
    report = op.duplicate_report(df, ["k"]).first()
    assert tuple(report) == (0, 0, 0, 0.0)
    assert {tuple(r) for r in op.null_report(df).collect()} == {("k", 0, 0.0), ("v", 0, 0.0)}
    assert tuple(op.skew_stats(op.partition_sizes(df, "k")).first()) == (
        0, None, None, None, None, None,
    )
    assert rows(op.skewed_partitions(op.partition_sizes(df, "k"))) == []


def test_hot_key_against_brute_force(spark):
    """A third of the rows share a key, and another third are copies of one row."""
    rng = random.Random(1)
    data = [(0, rng.randrange(10**6), rng.choice("abc")) for _ in range(4000)]
    data += [(1, 7, "copy")] * 4000
    data += [(rng.randrange(2, 3000), rng.randrange(5), rng.choice("abc")) for _ in range(4000)]
    best = {}
    for k, o, v in data:
        best[k] = min(best.get(k, (o, v)), (o, v))
    df = spark.createDataFrame(data, "k int, o int, v string").repartition(16)
    want = sorted(((k, *ov) for k, ov in best.items()), key=repr)
    assert rows(op.dedup_by_key(df, ["k"], ["o"])) == want
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert rows(op.dedup_by_key(df.repartition(5), ["k"], ["o"])) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    report = op.duplicate_report(df, ["k"]).first()
    assert report.total_rows == len(data) and report.unique_rows == len(best)


def test_unique_keys_with_nulls(spark):
    op.require_unique_keys(spark.createDataFrame([(None,), (1,)], "k int"), ["k"])
    for repeated in ([(1,), (1,)], [(None,), (None,)]):
        with pytest.raises(DuplicateKeys):
            op.require_unique_keys(spark.createDataFrame(repeated, "k int"), ["k"])


# Cleaning


def test_clean_runs_its_steps_in_order(spark):
    df = spark.createDataFrame(
        [(" A", 1, 9), ("a", 2, 8), (None, 3, 7), ("b", 4, None)], "k string, v int, extra int"
    )
    got = clean(
        df,
        ["k"],
        source="s",
        not_null=["k"],
        prepare=lambda d: d.withColumn("k", F.lower(F.trim("k"))),
        transform=lambda d: d.withColumn("w", F.col("extra") + 1),
        drop=["extra"],
    )
    assert got.columns == ["k", "v", "w", "data_source"]
    assert rows(got) == [("a", 1, 10, "s"), ("b", 4, None, "s")]


def test_not_null_filter_reaches_the_scan(spark):
    raw = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = plan_of(clean(raw, ["o_orderkey"], source="s", not_null=["o_custkey"]))
    assert "PushedFilters: [IsNotNull(o_custkey)]" in plan, plan


def test_rejects_are_counted(spark):
    df = spark.createDataFrame([("1999-01-01",), ("31/12/1999",), (None,), ("x",)], "d string")
    assert rows(op.reject_counts(df, {"d": as_date})) == [("d", 2)]


# Unions


def test_union_by_name_fills_missing_columns(spark):
    a = spark.createDataFrame([(1,)], "id int")
    b = spark.createDataFrame([("x", 2)], "z string, id int")
    assert op.union_by_name([a, b]).columns == ["id", "z"]
    assert rows(op.union_by_name([a, b])) == [(1, None), (2, "x")]


def test_merge_sources_with_its_own_merge(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    b = spark.createDataFrame([(2, "B")], "id int, v string")
    got = op.merge_sources([a, b], ["id"], merge=lambda dfs: dfs[1].union(dfs[0]))
    assert rows(got) == [(1, "a", "merged"), (2, "B", "merged")]


# Upsert


def test_upsert_of_known_new_and_null_keys(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], "k int, v string")
    source = spark.createDataFrame([(2, "new"), (3, "new"), (None, "new")], "k int, v string")
    once = op.upsert(target, source, ["k"])
    assert rows(once) == [(1, "old"), (2, "new"), (3, "new"), (None, "new")]
    assert rows(op.upsert(once, source, ["k"])) == rows(once)


def test_dimensions_repeat_no_null_keys_and_lose_no_rows(spark):
    batch = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    first = op.scd1_stamp(batch.limit(0), at(T0))
    once = op.scd1_apply(first, batch, ["k"], at(T1))
    assert rows(op.scd1_apply(once, batch, ["k"], at(T1))) == rows(once)
    opened = op.scd2_apply(op.scd2_stamp(batch.limit(0), at(T0)), batch, ["k"], at(T1))
    assert rows(op.scd2_apply(opened, batch, ["k"], at(T1))) == rows(opened)
    unknown = opened.withColumn("is_current", F.lit(None).cast("boolean"))
    assert op.scd2_apply(unknown, batch, ["k"], at(T1)).count() == 4


@pytest.mark.parametrize("stamp, apply", [(op.scd1_stamp, op.scd1_apply), (op.scd2_stamp, op.scd2_apply)])
def test_dimensions_too_large_to_broadcast_are_merged_twice_in_one_query(spark, stamp, apply):
    batch = spark.createDataFrame([(None, "a"), (1, "b"), (3, "d")], "key int, v string")
    first = stamp(spark.createDataFrame([(1, "a"), (2, "c")], "key int, v string"), at(T0))
    want = rows(apply(first, batch, ["key"], at(T1)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        once = apply(first, batch, ["key"], at(T1))
        assert rows(apply(once, batch, ["key"], at(T1))) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("key", [None, 1])
def test_dimensions_refuse_batches_that_repeat_a_key(spark, key):
    one = spark.createDataFrame([(key, "a"), (7, "x")], "k int, v string")
    two = spark.createDataFrame([(key, "b"), (key, "c")], "k int, v string")
    for stamp, apply in ((op.scd1_stamp, op.scd1_apply), (op.scd2_stamp, op.scd2_apply)):
        with pytest.raises(Exception, match="not unique"):
            apply(stamp(one, at(T0)), two, ["k"], at(T1)).collect()
        with pytest.raises(Exception, match="not unique"):
            apply(stamp(one.limit(0), at(T0)), two, ["k"], at(T1)).collect()
        # A batch with one such row may come any number of times.
        once = apply(stamp(one, at(T0)), two.limit(1), ["k"], at(T1))
        assert rows(apply(once, two.limit(1), ["k"], at(T1))) == rows(once)


def test_dimensions_refuse_columns_they_lack(spark):
    batch = spark.createDataFrame([(1, "b", 2)], "k int, v string, extra int")
    narrow = batch.drop("extra")
    with pytest.raises(ValueError, match="extra"):
        op.scd1_apply(op.scd1_stamp(narrow, at(T0)), batch, ["k"], at(T1))
    with pytest.raises(ValueError, match="extra"):
        op.scd2_apply(op.scd2_stamp(narrow, at(T0)), batch, ["k"], at(T1))


# Slowly changing dimensions


def test_scd1_keeps_creation_and_untouched_rows(spark):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    got = op.scd1_apply(op.scd1_stamp(first, at(T0)), batch, ["k"], at(T1))
    assert got.columns == ["k", "v", "created_at", "updated_at"]
    assert rows(got) == [(1, "a", T0, T0), (2, None, T0, T1), (3, "c", T1, T1)]


def test_scd2_history(spark):
    first = spark.createDataFrame(
        [(1, "same", 1), (2, "old", 1), (4, "gone", 1), (5, "value", None)],
        "k int, v string, w int",
    )
    batch = spark.createDataFrame(
        [(1, "same", 1), (2, "new", 1), (3, "first", 1), (5, None, None)], "k int, v string, w int"
    )
    loaded = op.scd2_stamp(first, at(T0))
    got = op.scd2_apply(loaded, batch, ["k"], at(T1))
    assert got.columns == ["k", "v", "w", "valid_from", "valid_to", "is_current"]
    want = sorted(
        [
            (1, "same", 1, T0, None, True),
            (2, "old", 1, T0, T1, False),
            (2, "new", 1, T1, None, True),
            (3, "first", 1, T1, None, True),
            (4, "gone", 1, T0, None, True),
            (5, "value", None, T0, T1, False),
            (5, None, None, T1, None, True),
        ],
        key=repr,
    )
    assert rows(got) == want
    assert rows(op.scd2_apply(got, batch, ["k"], at(T1))) == want
    assert rows(op.scd2_apply(got, batch, ["k"], at(T2))) == want


def test_scd2_rejects_changes_out_of_order(spark):
    first = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1, "b")], "k int, v string")
    with pytest.raises(Exception, match="not later"):
        op.scd2_apply(op.scd2_stamp(first, at(T1)), batch, ["k"], at(T0)).collect()


def test_scd2_against_brute_force(spark):
    """Many batches; every key has one current row and intervals that meet."""
    rng = random.Random(2)
    dimension = op.scd2_stamp(
        spark.createDataFrame([(k, rng.randrange(3)) for k in range(50)], "k int, v int"), at(T0)
    )
    for day in range(2, 5):
        batch = [(k, rng.randrange(3)) for k in rng.sample(range(80), 40)]
        moment = at(dt.datetime(2024, 1, day))
        applied = op.scd2_apply(
            dimension, spark.createDataFrame(batch, "k int, v int"), ["k"], moment
        )
        dimension = spark.createDataFrame(applied.collect(), applied.schema)
    versions = {}
    for k, v, start, end, current in rows(dimension):
        versions.setdefault(k, []).append((start, end, current, v))
    for history in versions.values():
        history.sort(key=lambda h: h[0])
        assert [h[2] for h in history] == [False] * (len(history) - 1) + [True]
        for before, after in zip(history, history[1:]):
            assert before[1] == after[0] and before[3] != after[3]


def day(n):
    return dt.datetime(2024, 1, n)


def test_late_changes_split_intervals(spark):
    schema = "k int, v string, valid_from timestamp, valid_to timestamp, is_current boolean"
    dimension = spark.createDataFrame(
        [
            (1, "a", day(5), day(10), False),
            (1, "b", day(10), None, True),
            (2, "gone", day(1), day(4), False),
            (3, "other", day(1), None, True),
            (None, "n", day(1), None, True),
            (1, "odd", day(1), None, None),
        ],
        schema,
    )
    changes = spark.createDataFrame(
        [
            (1, "c", day(7)),  # between two
            (1, "first", day(2)),  # before all
            (1, "last", day(20)),  # after all
            (1, "b", day(12)),  # no change
            (2, "inside", day(2)),  # of a version with an end
            (2, "later", day(6)),  # after that end
            (4, "new", day(3)),
            (None, "m", day(5)),
            (4, "new", day(9)),
            (9, "undated", None),
        ],
        "k int, v string, since timestamp",
    )
    got = op.scd2_insert(dimension, changes, ["k"], "since")
    assert got.columns == dimension.columns
    want = [
        (1, "first", day(2), day(5), False),
        (1, "a", day(5), day(7), False),
        (1, "c", day(7), day(10), False),
        (1, "b", day(10), day(20), False),
        (1, "last", day(20), None, True),
        (2, "gone", day(1), day(2), False),
        (2, "inside", day(2), day(4), False),
        (2, "later", day(6), None, True),
        (3, "other", day(1), None, True),
        (4, "new", day(3), None, True),
        (None, "n", day(1), day(5), False),
        (None, "m", day(5), None, True),
        (1, "odd", day(1), None, None),
    ]
    assert rows(got) == sorted(want, key=repr)
    assert rows(op.scd2_insert(got, changes, ["k"], "since")) == sorted(want, key=repr)


def test_many_changes_of_a_key_at_once(spark):
    rng = random.Random(7)
    changes = [(k, rng.choice("ab"), day(d)) for k in (1, 2) for d in rng.sample(range(1, 28), 5)]
    schema = "k int, v string, since timestamp"
    empty = op.scd2_stamp(spark.createDataFrame([], "k int, v string"), at(T0))
    want = []
    for k in (1, 2):
        states = sorted((d, v) for key, v, d in changes if key == k)
        kept = [s for n, s in enumerate(states) if n == 0 or states[n - 1][1] != s[1]]
        ends = [d for d, _ in kept[1:]] + [None]
        want += [(k, v, d, end, end is None) for (d, v), end in zip(kept, ends)]
    at_once = op.scd2_insert(empty, spark.createDataFrame(changes, schema), ["k"], "since")
    assert rows(at_once) == sorted(want, key=repr)


# Facts


def test_missing_prices_are_zero_and_marked(spark):
    raw = spark.createDataFrame(
        [("a", "1", "2", T0, None, "card", "new_system"), ("b", "1", "2", T0, 5.5, "card", "legacy")],
        "order_id string, customer_id string, seller_id string, order_date timestamp,"
        " order_total_price double, payment_method string, source_system string",
    )
    got = rows(op.fact_orders(raw).select("order_key", "order_amount", "is_amount_missing"))
    assert got == [("a", 0.0, True), ("b", 5.5, False)]
    summary = op.fact_sales_summary(raw.withColumn("source_system", F.lit("legacy"))).first()
    assert tuple(summary)[3:] == (2, 5.5, 5.5, 5.5, 5.5)
    without = op.fact_sales_summary(
        raw.filter("order_id = 'a'").withColumn("source_system", F.lit("legacy"))
    )
    assert tuple(without.first())[3:] == (1, None, None, None, None)


# Quality


def test_median_of_even_count_and_skew(spark):
    data = [c for c, n in {"a": 1, "b": 2, "c": 3, "d": 10}.items() for _ in range(n)]
    sizes = op.partition_sizes(spark.createDataFrame([(c,) for c in data], "p string"), "p")
    assert tuple(op.skew_stats(sizes).first()) == (4, 10, 1, 4.0, 2.5, 4.0)
    assert rows(op.skewed_partitions(sizes)) == [("d", 10, 4.0)]
    assert rows(op.skewed_partitions(sizes, 1.0)) == [("c", 3, 1.2), ("d", 10, 4.0)]


def test_value_ranges(spark):
    df = spark.createDataFrame([(1, -2.0, "x"), (3, None, "y")], "i int, d double, s string")
    got = {r.column: tuple(r)[1:] for r in op.value_range_report(df).collect()}
    assert got["i"] == (2, 2.0, pytest.approx(2**0.5), 1.0, 3.0, 0)
    assert got["d"] == (1, -2.0, None, -2.0, -2.0, 1)
    assert "s" not in got


def test_key_sample_keeps_or_leaves_all_copies(spark):
    df = spark.range(2000).select((F.col("id") % 500).alias("k"), "id")
    for portable in (False, True):
        kept = key_hash_sample(df, ["k"], 0.3, portable=portable)
        counts = {r.k: r["count"] for r in kept.groupBy("k").count().collect()}
        assert set(counts.values()) == {4}
        assert 100 < len(counts) < 200
        estimate = op.quality_estimate(df, ["k"], ["id"], 0.3, portable=portable)
        found = {r.metric: r.estimate for r in estimate.collect()}
        assert found["duplicate_rows"] == pytest.approx(1500, rel=0.25)
        assert found["nulls:id"] == 0
        assert key_hash_sample(df, ["k"], 1.0, portable=portable).count() == 2000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Estimates and exact figures


def test_row_estimates_bound_the_truth(spark):
    df = spark.range(40_000).selectExpr("id % 9000 AS k", "if(id % 40 = 0, NULL, id) AS v", "id AS w")
    exact = {"rows": 40_000, "nulls:v": 1_000, "nulls:w": 0, "distinct:k": 9_000}
    for seed in range(3):
        got = {r.metric: r for r in op.row_estimate(df, ["v", "w"], ["k"], 0.1, seed).collect()}
        assert set(got) == set(exact)
        for name, row in got.items():
            assert row.low <= exact[name] <= row.high and row.low <= row.estimate <= row.high
        assert got["rows"].high < 1.1 * exact["rows"]
    none = op.row_estimate(df.limit(0), ["v"], ["k"], 0.1).collect()
    assert {(r.metric, r.estimate) for r in none} == {("rows", 0), ("nulls:v", 0), ("distinct:k", 0)}


def test_exact_ranges(spark):
    df = spark.createDataFrame([(2**53 + 1, "x"), (-(2**62), "y"), (None, "z")], "big long, s string")
    got = op.exact_range_report(df, ["big"]).first()
    assert (got.n, got.min, got.max, got.negatives) == (2, str(-(2**62)), str(2**53 + 1), 1)
    assert got.total == str(2**53 + 1 - 2**62)
    assert op.exact_range_report(df.limit(0), ["big"]).first().max is None
    with pytest.raises(ValueError, match="hold no whole"):
        op.exact_range_report(df, ["s"])
