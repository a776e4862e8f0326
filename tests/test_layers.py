import datetime as dt
import threading
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from oreworks.catalogue.inputs import Inputs
from oreworks.catalogue.queries import write_raw
from oreworks.catalogue.scratch import scratch_lake
from oreworks.lake import Lake
from oreworks.plans import (
    BRONZE,
    GOLD,
    SILVER,
    GoldSpec,
    build_gold,
    build_lake,
    ingest_bronze,
    refine_silver,
)
from oreworks.plans import tables
from oreworks.plans.layers import EmptySource
from oreworks.sinks import MissingTable

SF = "/root/testdata/sf0.001"
AS_OF = "2025-01-01"


def moment(day=AS_OF):
    return F.lit(day).cast("timestamp")


@pytest.fixture(scope="module")
def lake(spark):
    lake = scratch_lake(spark)
    for name, df in Inputs(spark, SF).raw().items():
        write_raw(df, lake.raw_path(name))
    return lake


@pytest.fixture(scope="module")
def built(spark, lake):
    return build_lake(spark, lake, moment())


def gold(spark, lake, table):
    return spark.table(lake.table("gold", table))


def test_every_write_is_reconciled(built):
    assert len(built) == 15
    assert all(r.written.expected == r.written.actual > 0 for r in built.values())


def test_tables_wait_only_for_those_they_need(spark, monkeypatch):
    order_items, made = threading.Event(), []

    def build(layer):
        def step(spark, lake, spec, *as_of):
            if (layer, spec.table) == ("bronze", "sellers"):
                assert order_items.wait(10)
            made.append((layer, *getattr(spec, "sources", ())[:1], spec.table))
            if (layer, spec.table) == ("silver", "order_items"):
                order_items.set()

        return step

    for layer, name in (("bronze", "ingest_bronze"), ("silver", "refine_silver"), ("gold", "build_gold")):
        monkeypatch.setattr(tables, name, build(layer))
    assert len(build_lake(spark, scratch_lake(spark))) == len(made) == 15
    assert made.index(("silver", "orders", "orders")) < made.index(("silver", "orders_new", "orders"))
    facts = made.index(("gold", ("silver", "orders"), "fact_orders"))
    assert made.index(("silver", "orders_new", "orders")) < facts


def test_kept_sellers_are_those_of_each_order(spark, tmp_path):
    plain, kept = Inputs(spark, SF), Inputs(spark, SF)
    kept.keep_sellers(str(tmp_path / "sold"))
    for name in ("orders", "orders_new"):
        made, want = getattr(kept, name)(), getattr(plain, name)()
        assert made.schema == want.schema
        assert "lineitem" not in "".join(made.inputFiles())
        assert made.exceptAll(want).isEmpty() and want.exceptAll(made).isEmpty()


def test_keys_are_unique(spark, lake, built):
    for spec in GOLD.values():
        table = gold(spark, lake, spec.table)
        assert table.count() == table.select(*spec.keys).distinct().count()


def test_facts_have_no_orphans(spark, lake, built):
    facts = gold(spark, lake, "fact_orders")
    for dimension, key in (("dim_customers", "customer_key"), ("dim_sellers", "seller_key")):
        known = gold(spark, lake, dimension)
        orphans = facts.filter(F.col(key).isNotNull()).join(known, key, "left_anti")
        assert orphans.count() == 0


def test_summary_adds_up_to_the_legacy_orders(spark, lake, built):
    legacy = gold(spark, lake, "fact_orders").filter("source_system = 'legacy'")
    summary = gold(spark, lake, "fact_sales_summary")
    assert summary.groupBy().sum("order_count").first()[0] == legacy.count()
    total = legacy.agg(F.sum(F.col("order_amount").cast("decimal(18,2)"))).first()[0]
    assert summary.groupBy().sum("total_revenue").first()[0] == pytest.approx(float(total))


def test_stamps_and_dates(spark, lake, built):
    customer = gold(spark, lake, "dim_customers").filter("age IS NOT NULL").first()
    assert customer.created_at == customer.updated_at
    assert customer.age == 2025 - customer.dob.year
    silver = spark.table(lake.table("silver", "orders")).select("ingested_at", "data_source")
    assert silver.select("ingested_at").distinct().count() == 1
    assert silver.select("data_source").distinct().count() == 2
    assert "created_at" not in gold(spark, lake, "dim_date").columns


def test_tables_answer_sql(spark, lake, built):
    schema = lake.schema("gold")
    facts = spark.table(f"{schema}.fact_orders").select("customer_key", "order_amount").collect()
    homes = {
        r.customer_id: r.country for r in spark.table(f"{schema}.dim_customers").collect()
    }
    wanted = {}
    for fact in facts:
        if fact.customer_key in homes:
            home = homes[fact.customer_key]
            wanted[home] = wanted.get(home, 0.0) + fact.order_amount
    found = spark.sql(
        f"WITH spent AS (SELECT customer_key AS id, sum(order_amount) AS amount"
        f" FROM {schema}.fact_orders GROUP BY customer_key)"
        f" SELECT country, sum(amount) AS amount FROM spent"
        f" INNER JOIN {schema}.dim_customers ON customer_id = id GROUP BY country"
    )
    assert {r.country: r.amount for r in found.collect()} == pytest.approx(wanted)


def test_quality_reports_are_made_on_demand(built):
    bronze_orders = built["silver.orders_new"].quality()
    found = {(r.check, r.metric): r.value for r in bronze_orders.collect() if r.column == "order_id"}
    assert found["duplicates", "duplicate_rows"] > 0
    assert found["nulls", "null_count"] == 0
    buckets = built["silver.order_items"].quality().filter("check = 'skew'")
    assert buckets.count() == 6
    assert built["gold.fact_orders"].quality().filter("metric = 'duplicate_rows'").first().value == 0


def test_repeated_append_adds_nothing(spark, lake, built):
    before = spark.table(lake.table("silver", "orders")).count()
    report = refine_silver(spark, lake, SILVER["orders_new"], moment(), sample_fraction=0.5)
    assert report.written.actual == 0
    assert spark.table(lake.table("silver", "orders")).count() == before
    assert report.quality().count() > 0


def test_sources_merged_in_one_step(spark, lake, built):
    spec = replace(
        SILVER["orders"],
        table="all_orders",
        sources=("orders", "orders_new"),
        prepare=None,
        transform=None,
        merge=lambda dfs: dfs[0].unionByName(
            dfs[1].withColumns({c: F.col(c).cast("string") for c in ("order_id",)}), True
        ).drop("order_date"),
    )
    report = refine_silver(spark, lake, spec, moment())
    total = report.quality().filter("metric = 'total_rows'").first().value
    assert total == sum(spark.table(lake.table("bronze", s)).count() for s in spec.sources)
    with pytest.raises(ValueError):
        replace(spec, not_null=("order_id",))
    merged = spark.table(lake.table("silver", "all_orders"))
    assert merged.select("data_source").distinct().first()[0] == "merged"
    assert merged.count() == spark.table(lake.table("silver", "orders")).count()


def test_merged_dimension_keeps_its_creation_time(spark, lake, built):
    spec = replace(
        GOLD["dim_sellers"],
        table="dim_sellers_1",
    )
    build_gold(spark, lake, spec, moment())
    merge = replace(spec, mode="merge")
    report = build_gold(spark, lake, merge, moment("2025-02-01"))
    table = gold(spark, lake, "dim_sellers_1")
    assert report.written.actual == table.count()
    stamps = table.select("created_at", "updated_at").distinct().collect()
    assert [tuple(s) for s in stamps] == [(dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1))]


def test_merged_dimension_keeps_its_history(spark, lake, built):
    def ratings(raised):
        def logic(sources, as_of):
            up = F.when(F.col("seller_id") == "1", raised).otherwise(0)
            return sources["sellers"].select("seller_id", (F.col("seller_rating") + up).alias("rating"))

        return logic

    spec = GoldSpec(
        "sellers_2", (("silver", "sellers"),), ratings(0), keys=("seller_id",), scd_type=2
    )
    build_gold(spark, lake, spec, moment())
    n = gold(spark, lake, "sellers_2").count()
    later = replace(spec, logic=ratings(1), mode="merge")
    build_gold(spark, lake, later, moment("2025-02-01"))
    build_gold(spark, lake, later, moment("2025-03-01"))
    table = gold(spark, lake, "sellers_2")
    assert table.count() == n + 1
    assert table.filter("NOT is_current").first().seller_id == "1"
    assert table.filter("is_current").count() == n


def test_fact_merge_and_append(spark, lake, built):
    spec = replace(GOLD["fact_orders"], table="facts_2")
    with pytest.raises(MissingTable):
        build_gold(spark, lake, replace(spec, mode="merge"), moment())
    n = build_gold(spark, lake, spec, moment()).written.actual
    assert build_gold(spark, lake, replace(spec, mode="merge"), moment()).written.actual == n
    assert build_gold(spark, lake, replace(spec, mode="append"), moment()).written.actual == n
    assert gold(spark, lake, "facts_2").count() == 2 * n


def test_empty_raw_folder(spark, lake, tmp_path):
    (tmp_path / "notes.txt").write_text("nothing")
    with pytest.raises(EmptySource):
        elsewhere = {"roots": {"raw": str(tmp_path.parent)}, "raw_folders": {"orders": tmp_path.name}}
        ingest_bronze(spark, replace(lake, **elsewhere), BRONZE["orders"])


def test_rejects_go_to_a_table_of_their_own(spark, tmp_path):
    home = Lake(str(tmp_path), schemas={"bronze": f"rejects_{uuid.uuid4().hex}"})
    spark.sql(f"CREATE SCHEMA {home.schema('bronze')} LOCATION '{tmp_path}/bronze'")
    (tmp_path / "raw" / "orders_new").mkdir(parents=True)
    file = tmp_path / "raw" / "orders_new" / "a.csv"
    head = "order_id,customer_id,seller_id,order_date,payment_method\n"
    name = home.table("bronze", "orders_new")
    spec = replace(BRONZE["orders_new"], rejects=True)
    for text, good, bad in [
        ("1,2,3,2024-01-05,a\nx,2,3,2024-01-06,b\n4,5\n", 1, ["x,2,3,2024-01-06,b", "4,5"]),
        ("1,2,3,2024-01-05,a\n", 1, []),
        ("y,2,3,2024-01-05,a\n", 0, ["y,2,3,2024-01-05,a"]),
    ]:
        file.write_text(head + text)
        report = ingest_bronze(spark, home, spec)
        assert (report.written.actual, report.rejected.actual) == (good, len(bad))
        kept, rejected = spark.table(name), spark.table(f"{name}_rejects")
        assert kept.count() == good and "_corrupt_record" not in kept.columns
        assert sorted(r["_corrupt_record"] for r in rejected.collect()) == sorted(bad)
        assert all(r["source_file"].endswith("a.csv") for r in rejected.collect())
