"""What the plans must and must not contain at any scale."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from millrace.operators import demand
from millrace.operators.catalog import latest_reviews
from millrace.operators.changes import apply_changes, change_set, choose_sync_mode
from millrace.operators.joins import lookup_join
from millrace.plans.registry import load
from millrace.plans.shop import Shop
from millrace.session import cluster_settings
from millrace.sources import tables
from tests.conftest import DATA

STREAMS = {name for name in load() if name.endswith("_stream")}


def plan(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(load()) - STREAMS))
def test_no_pairs_and_no_udf(spark, no_broadcast, capsys, name):
    text = plan(queries()[name](spark, DATA), capsys)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert word not in text


def test_scans_are_pruned_and_filters_pushed(spark, folder, capsys):
    shop = Shop(spark, DATA)
    shop.bronze.withColumn("unused", F.lit(1)).write.parquet(f"{folder}/bronze")
    text = plan(demand.clean_events(spark.read.parquet(f"{folder}/bronze")), capsys)
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    assert "In(event_type, [add_to_cart,click,view])" in pushed
    assert "IsNotNull(product_id)" in pushed and "IsNotNull(event_ts)" in pushed
    assert "unused" not in text
    full = plan(queries()["product_demand"](spark, DATA), capsys)
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in full


def test_demand_counts_stay_where_they_are_joined(spark, no_broadcast, capsys):
    text = plan(queries()["product_demand"](spark, DATA), capsys)
    # Events by their four columns; then one shuffle per side by product.
    assert text.count("Exchange\n") - text.count("ReusedExchange\n") <= 2 * 5
    assert "hashpartitioning(cast(product_id" not in text


def test_latest_reviews_are_trimmed_before_the_shuffle(spark, capsys):
    shop = Shop(spark, DATA)
    assert "WindowGroupLimit" in plan(latest_reviews(shop.reviews, shop.customers), capsys)


def test_tables_stored_by_key_are_compared_without_a_shuffle(spark, no_broadcast, capsys):
    shop = Shop(spark, DATA)
    old = shop.orders.select("id", "total", "status")
    tables.store_keyed(old, "orders_old", "id", 8)
    tables.store_keyed(old.withColumn("status", F.lit("new")), "orders_new", "id", 8)
    before, after = spark.table("orders_old"), spark.table("orders_new")
    changed = change_set(before, after, "id")
    assert "Exchange" not in plan(changed, capsys)
    assert changed.count() == old.filter("status <> 'new'").count()
    text = plan(choose_sync_mode(before, after, "id"), capsys)
    assert "hashpartitioning" not in text


def test_partitions_follow_the_data():
    large = cluster_settings(20 << 40, 4000)
    assert large["spark.sql.shuffle.partitions"] == str(20 * 1024 * 4)
    assert cluster_settings(1 << 20, 4000)["spark.sql.shuffle.partitions"] == "8000"


def test_small_log_does_not_shuffle_the_table(spark, capsys):
    shop = Shop(spark, DATA)
    log = shop.order_changes.filter("op <> 'insert'").limit(50)
    merged = apply_changes(shop.orders.select("id", "total", "status"), log, "id", "seq")
    merged.collect()
    final = plan(merged, capsys).split("Initial Plan")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final


def test_hot_key_is_split_by_adaptive_execution(spark, no_broadcast, capsys):
    """A third of all facts has one key; its partition is read in pieces."""
    settings = {
        "spark.sql.shuffle.partitions": "20",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50000",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000)
        facts = spark.range(0, 300_000, 1, 8).select(key.alias("k"), "id", F.sha1(F.col("id").cast("string")).alias("v"))
        lookup = spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("name"))
        joined = lookup_join(facts, lookup, "k")
        joined.collect()
        assert "skewed" in plan(joined, capsys)
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
