"""Tables, type mapping, remote options and generators."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.quality import check_contract
from millrace.sources import generators, remote, serving, tables
from tests.conftest import rows


def test_table_life(spark):
    tables.recreate(spark, "t_life", schemas.LIVE_EVENTS, "it's live")
    tables.create_table(spark, "t_life", schemas.BRONZE)
    assert check_contract(spark.table("t_life"), schemas.LIVE_EVENTS) == []
    described = spark.sql("DESCRIBE TABLE EXTENDED t_life").filter("col_name = 'Comment'").first()
    assert described.data_type == "it's live"
    tables.append(tables.rows_to_df(spark, [("view", 1, "x")], schemas.LIVE_EVENTS), "t_life")
    # Replace the table by a query over itself, with another schema.
    tables.overwrite(spark.table("t_life").withColumn("n", F.lit(1)), "t_life")
    tables.overwrite(spark.table("t_life").unionAll(spark.table("t_life")), "t_life")
    assert rows(spark.table("t_life")) == [("view", 1, "x", 1)] * 2
    tables.recreate(spark, "t_life", schemas.BRONZE)
    assert spark.table("t_life").isEmpty()


def test_rows_with_inferred_types(spark):
    df = tables.rows_to_df(spark, [(1, 2.5, "a")], ["id", "price", "name"])
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "double", "string"]


def test_table_or_else(spark):
    spark.sql("DROP TABLE IF EXISTS t_else")
    assert tables.table_or_else(spark, "t_else", lambda s: s.range(3)).count() == 3
    assert tables.table_or_else(spark, "t_else", lambda s: s.range(9)).count() == 3


def columns(spark, *pairs):
    return spark.createDataFrame(list(pairs), "table_name string, column_name string")


@pytest.mark.parametrize(
    "present, expected",
    [
        (["promotions", "promotions_synced_prod"], "promotions_synced_prod"),
        (["promotions", "a_promotions"], "promotions"),
        (["z_Promotions", "my_promotions_2"], "my_promotions_2"),
        (["orders"], None),
    ],
)
def test_resolve_table(spark, present, expected):
    found = tables.resolve_table(columns(spark, *[(t, "id") for t in present]), *tables.PROMOTION_TABLES)
    assert found.first().table_name == expected


def test_feature_flags(spark):
    flags = tables.feature_flags(
        columns(spark, ("customers", "loyalty_points"), ("orders", "id"), ("orders", "priority"), ("x_promotions", "id"))
    ).first().asDict()
    on = {name for name, value in flags.items() if value}
    assert on == {"order_priority_active", "orders_available", "promotions_active"}
    assert len(flags) == 9
    assert not any(tables.feature_flags(columns(spark).limit(0)).first())


def test_serving_types(spark):
    df = spark.range(1).select(
        "id", F.array(F.lit(1)).alias("a"), F.create_map(F.lit("k"), F.lit(2)).alias("m"), F.struct(F.lit("x").alias("s")).alias("o")
    )
    assert rows(serving.to_serving_schema(df)) == [(0, "[1]", '{"k":2}', '{"s":"x"}')]
    with pytest.raises(TypeError, match="v \\(variant\\)"):
        serving.to_serving_schema(spark.sql("select parse_json('1') as v"))


def test_clean_null_bytes(spark):
    df = spark.createDataFrame([("a\x00b", 1, None)], "s string, i int, n string")
    assert rows(serving.clean_null_bytes(df)) == [("ab", 1, None)]


def test_partition_options():
    options = remote.partition_options("id", 5, 104, 64)
    assert options == {"partitionColumn": "id", "lowerBound": "5", "upperBound": "105", "numPartitions": "64"}


def test_foreign_catalog_settings(spark):
    remote.foreign_catalog(spark, "store", "jdbc:x", "some.Driver", fetchsize="1000")
    assert spark.conf.get("spark.sql.catalog.store").endswith("JDBCTableCatalog")
    assert spark.conf.get("spark.sql.catalog.store.pushDownAggregate") == "true"
    assert spark.conf.get("spark.sql.catalog.store.fetchsize") == "1000"


def test_clickstream_generator(spark):
    events = generators.generate_clickstream(spark, sessions=3000, seed=1).cache()
    counts = {r.event_type: r["count"] for r in events.groupBy("event_type").count().collect()}
    assert abs(counts["click"] / counts["view"] - 0.45) < 0.02
    assert abs(counts["add_to_cart"] / counts["click"] - 0.35) < 0.02
    per_session = events.filter("event_type = 'view'").groupBy("session_id").count()
    assert {r["count"] for r in per_session.collect()} == set(range(2, 9))
    assert per_session.count() == 3000
    # Time goes on within a session, and every cart follows its click and view.
    steps = events.groupBy("session_id").agg(F.count("*").alias("n"), F.count_distinct("event_ts").alias("times"))
    assert steps.filter("n <> times").isEmpty()
    category = F.floor((F.col("product_id") - 1) / 10)
    views = {r[0]: r[1] for r in events.filter("event_type = 'view'").groupBy(category.alias("c")).count().collect()}
    assert views[0] > views[1] > views[3] > views[2]
    again = generators.generate_clickstream(spark.newSession(), sessions=3000, seed=1).repartition(7)
    assert events.exceptAll(again).isEmpty() and again.exceptAll(events).isEmpty()
    assert not generators.generate_clickstream(spark, 100, seed=2).exceptAll(events).isEmpty()


def test_store_generator(spark):
    store = generators.generate_store(spark, customers=40, products=50, reviews=300)
    assert {name: store[name].count() for name in ("customers", "products", "inventory")} == {
        "customers": 40, "products": 50, "inventory": 50,
    }
    stock = store["inventory"].agg(F.min("quantity"), F.max("quantity"), F.count_distinct("warehouse")).first()
    assert 0 <= stock[0] and stock[1] <= 200 and stock[2] == 3
    assert {r[0] for r in store["products"].groupBy("category").count().collect()} == set(generators.CATEGORY_WEIGHTS)
    reviews = store["reviews"]
    assert reviews.count() == reviews.select("product_id", "customer_id").distinct().count()
    assert reviews.filter("rating not between 1 and 5").isEmpty()
    items = store["order_items"]
    assert items.filter("line_total <> unit_price * quantity or quantity not between 1 and 3").isEmpty()
    assert {r["count"] for r in items.groupBy("order_id").count().collect()} <= {1, 2, 3, 4}
    assert store["customers"].first().email == "user1@example.com"
    assert reviews.filter(F.col("review_date") < datetime(2024, 1, 1)).isEmpty()
