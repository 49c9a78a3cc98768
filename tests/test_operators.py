"""Joins, ordering, evolution and quality on hand-made tables."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import catalog, demand, evolve, finance, logs, loyalty, ordering, quality
from millrace.operators.joins import Child, insert_ignore, lookup_join, one_per_key, preaggregate_join, select_available, where_all
from millrace.operators.ordering import continue_ids, latest_per_key, number_rows, page, plain_running_totals, running_totals
from tests.conftest import rows


def test_spread_lookup_equals_plain_lookup(spark):
    facts = spark.range(500).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    lookup = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, name string")
    plain = lookup_join(facts, lookup, "k")
    assert rows(lookup_join(facts, lookup, "k", spread=8)) == rows(plain)
    assert plain.filter("name is null").count() == 166
    assert rows(lookup_join(facts, lookup, "k", "inner", spread=8)) == rows(plain.filter("name is not null"))


def test_preaggregate_join_does_not_multiply(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    sold = spark.createDataFrame([(1, 5), (1, 6)], "pid int, n int")
    rated = spark.createDataFrame([(1, 4), (1, 2), (1, 3)], "pid int, r int")
    joined = preaggregate_join(
        parent,
        "id",
        [Child(sold, "pid", [F.sum("n").alias("sold")], {"sold": 0}), Child(rated, "pid", [F.count("r").alias("reviews")])],
    )
    assert rows(joined) == [(1, 11, 3), (2, 0, None)]


def test_insert_ignore_keeps_the_held_row_and_is_repeatable(spark):
    target = spark.createDataFrame([(1, "old")], "id int, v string")
    new = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "id int, v string")
    once = insert_ignore(target, new, "id")
    assert rows(once) == [(1, "old"), (2, "a")]
    assert rows(insert_ignore(once, new, "id")) == rows(once)


def test_one_per_key_on_key_only_rows(spark):
    assert rows(one_per_key(spark.createDataFrame([(1,), (1,)], "id int"), "id")) == [(1,)]


def test_where_all_and_select_available(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, c string")
    assert where_all(df, [None, None]).count() == 2
    assert rows(where_all(df, [F.col("id") > 1, None])) == [(2, "y")]
    picked = select_available(df, ["id"], {"c": F.lit("none"), "d": F.lit(0)})
    assert picked.columns == ["id", "c", "d"] and rows(picked)[0] == (1, "x", 0)


def _skewed(spark, n=600):
    """A third of all rows in one group, with many equal order values."""
    group = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)
    return spark.range(n).select(
        group.alias("g"), (F.col("id") % 5).alias("t"), F.col("id"), (F.col("id") % 4 + 1).alias("v")
    )


@pytest.mark.parametrize("parts", [1, 5])
def test_number_rows_over_ties(spark, parts):
    df = _skewed(spark)
    numbered = number_rows(df, [F.desc("t"), F.asc("id")], "n", start=0, parts=parts)
    assert dict(numbered.dtypes)["n"] == "bigint"
    expected = sorted(((r.t, r.id) for r in df.collect()), key=lambda p: (-p[0], p[1]))
    got = {(r.t, r.id): r.n for r in numbered.collect()}
    assert [got[p] for p in expected] == list(range(600))


def test_ids_go_on_from_the_highest(spark):
    fresh = spark.createDataFrame([("b",), ("a",)], "v string")
    held = spark.createDataFrame([(7,), (3,)], "id bigint")
    assert rows(continue_ids(fresh, [F.asc("v")], held)) == [(8, "a"), (9, "b")]
    assert rows(continue_ids(fresh, [F.asc("v")], held.limit(0))) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("kind", ["bigint", "decimal(12,3)", "double"])
def test_running_totals_over_nulls_equal_a_window(spark, kind):
    df = _skewed(spark).withColumn("v", F.when(F.col("id") % 3 < 2, F.col("id") % 4).cast(kind))
    order, totals = [F.asc("t"), F.asc("id")], {"s": F.col("v")}
    plain = plain_running_totals(df, "g", order, totals)
    ranged = running_totals(df, "g", order, totals, parts=9)
    assert ranged.dtypes == plain.dtypes and rows(ranged) == rows(plain)
    assert not plain.filter("s is null").isEmpty()


def test_number_rows_reads_made_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    made = _skewed(spark).mapInArrow(count, "g bigint, t bigint, id bigint, v bigint").groupBy("id").agg(F.max("t").alias("t"))
    assert number_rows(made, [F.asc("t"), F.asc("id")]).count() == 600
    assert seen.value == 600


def test_running_totals_cross_ranges(spark):
    df = _skewed(spark)
    totals = {"s": F.col("v"), "n": F.lit(1)}
    result = running_totals(df, "g", [F.asc("t"), F.desc("id")], totals, parts=7)
    sums, expected = {}, {}
    for r in sorted(df.collect(), key=lambda r: (r.t, -r.id)):
        s, n = sums.get(r.g, (0, 0))
        sums[r.g] = expected[r.id] = (s + r.v, n + 1)
    assert {r.id: (r.s, r.n) for r in result.collect()} == expected
    assert result.columns == [*df.columns, "s", "n"]


@pytest.mark.parametrize("near", [100_000, 10])
def test_near_and_far_pages_agree(spark, near):
    shown = page(_skewed(spark), [F.asc("t"), F.asc("id")], 20, 130, near_rows=near)
    everything = sorted((r.t, r.id) for r in _skewed(spark).collect())
    assert [(r.t, r.id) for r in shown.collect()] == everything[130:150]


@pytest.mark.parametrize("n", [1, 20, 1500])
def test_latest_per_key(spark, n):
    df = _skewed(spark, 6000)
    got = sorted((r.g, r.position, r.id) for r in latest_per_key(df, "g", [F.desc("t"), F.asc("id")], n).collect())
    groups = {}
    for r in df.collect():
        groups.setdefault(r.g, []).append((-r.t, r.id))
    expected = [(g, i, x[1]) for g, xs in groups.items() for i, x in enumerate(sorted(xs)[:n], 1)]
    assert got == sorted(expected)


def test_running_totals_keep_the_null_group(spark):
    df = spark.range(300).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 2).alias("g"), "id")
    order, totals = [F.asc("id")], {"s": F.col("id")}
    found = running_totals(df, "g", order, totals, parts=7)
    assert rows(found) == rows(plain_running_totals(df, "g", order, totals))
    assert found.filter("g is null").count() == 100


def test_many_rows_of_a_hot_key(spark):
    """A third of all rows has one key, a sixth a null key; neither meets in one task."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    df = spark.range(0, 12_000, 1, 8).select(key.alias("g"), F.pmod(F.xxhash64("id"), F.lit(700)).alias("t"), "id")
    found = latest_per_key(df, "g", [F.desc("t"), F.asc("id")], 3_500, parts=12)
    got = {(r.g, r.position, r.id) for r in found.collect()}
    groups = {}
    for r in df.collect():
        groups.setdefault(r.g, []).append((-r.t, r.id))
    assert got == {(g, i, x[1]) for g, xs in groups.items() for i, x in enumerate(sorted(xs)[:3_500], 1)}
    spread = ordering._in_ranges(df, [F.col("g"), F.desc("t"), F.asc("id")], 12)
    largest = spread.groupBy("_range").count().agg(F.max("count")).first()[0]
    assert spread.filter("g = 'hot'").select("_range").distinct().count() >= 4
    assert largest <= 2 * 12_000 / 12


def test_totals_keep_the_scale_of_their_measure(spark):
    fine = spark.createDataFrame([("0.00000001",), ("0.00000002",)], "x string").select(F.col("x").cast("decimal(20,8)").alias("x"))
    whole = spark.range(3).select((F.col("id") + 5).alias("x"))
    found = evolve.table_figures({"fine": fine, "whole": whole, "none": whole}, {"fine": F.col("x"), "whole": F.col("x")})
    assert dict(found.dtypes)["total"] == "decimal(38,8)"
    totals = {r.table_name: (r.rows, r.total) for r in found.collect()}
    assert totals == {"fine": (2, Decimal("0.00000003")), "whole": (3, Decimal(18)), "none": (3, Decimal(0))}
    lost = evolve.reconcile({"t": fine}, {"t": fine.filter("x > 0.00000001").unionAll(fine.filter("x > 0.00000001"))}, {"t": F.col("x")})
    assert [r.matches for r in lost.collect()] == [False]


def test_means_of_money_round_half_up(spark):
    orders = spark.createDataFrame([("a", "0.01"), ("a", "0.02"), ("b", "1.00"), ("b", None)], "status string, total string")
    found = catalog.order_status_distribution(orders.withColumn("total", F.col("total").cast("decimal(12,2)")))
    assert {r.status: (r.orders, str(r.avg_total)) for r in found.collect()} == {"a": (2, "0.02"), "b": (2, "1.00")}


def test_update_where_sees_old_values_and_keeps_types(spark):
    df = spark.createDataFrame([(1, 10, None), (2, 20, 5), (None, 30, 6)], "id int, a int, b int")
    swapped = evolve.update_where(df, F.col("id") > 1, {"a": F.col("b"), "b": F.col("a")})
    assert rows(swapped) == rows(spark.createDataFrame([(1, 10, None), (2, 5, 20), (None, 30, 6)], df.schema))
    assert swapped.schema == df.schema


def test_add_column_once(spark):
    df = evolve.add_column(spark.createDataFrame([(1,)], "id int"), "p", "string", "normal")
    assert rows(evolve.add_column(df, "p", "string", "other")) == [(1, "normal")]


def test_require_not_null(spark):
    df = spark.createDataFrame([(1,), (None,)], "id int")
    assert evolve.require_not_null(df.dropna(), "id").count() == 1
    with pytest.raises(Exception, match="null in column id"):
        evolve.require_not_null(df, "id").collect()
    for other in (lambda x: x.count(), lambda x: x.select(F.lit(1)).collect()):
        with pytest.raises(Exception, match="null in column id"):
            other(evolve.require_not_null(df, "id"))


def test_decimals_that_nothing_holds_are_refused(spark):
    wide = spark.createDataFrame([], "a decimal(38,0)")
    with pytest.raises(TypeError):
        evolve.evolve(wide, spark.createDataFrame([], "a decimal(20,10)"))


def test_lists_keep_their_order_without_broadcasts(spark, shop):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sold = catalog.best_sellers(shop.products, shop.inventory, shop.order_items, n=50).collect()
        assert [(-r.units_sold, r.id) for r in sold] == sorted((-r.units_sold, r.id) for r in sold)
        cards = [r.id for r in catalog.catalog_page(shop.products, shop.inventory, limit=40).collect()]
        assert cards == sorted(cards)
        rated = catalog.top_rated(shop.products, shop.inventory, shop.reviews, n=30).collect()
        assert [-r.avg_rating for r in rated] == sorted(-r.avg_rating for r in rated)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_evolve_adds_drops_and_widens(spark):
    held = spark.createDataFrame([(1, "a")], "id int, old string")
    batch = spark.createDataFrame([(2**40, 1.5)], "id bigint, new double")
    both = evolve.evolve(held, batch)
    assert both.columns == ["id", "old", "new"]
    assert rows(both) == [(1, "a", None), (2**40, None, 1.5)]
    with pytest.raises(TypeError):
        evolve.evolve(held, spark.createDataFrame([("x",)], "id string"))
    narrow = evolve.evolve(batch.select("id"), held.select("id"))
    assert narrow.schema["id"].dataType == T.LongType()
    wider = evolve.evolve(
        spark.createDataFrame([(Decimal("1.23"),)], "m decimal(10,2)"),
        spark.createDataFrame([(Decimal("1.2345"),)], "m decimal(8,4)"),
    )
    assert wider.schema["m"].dataType == T.DecimalType(12, 4)


def test_schema_diff(spark):
    a = evolve.schema_rows(spark, {"t": spark.createDataFrame([], "id int, x string, gone int")})
    b = evolve.schema_rows(spark, {"t": spark.createDataFrame([], "id bigint, x string not null, fresh int")})
    found = {(r.column_name, r.drift) for r in evolve.schema_diff(a, b).collect()}
    assert found == {("id", "type"), ("x", "nullable"), ("gone", "only left"), ("fresh", "only right")}
    assert evolve.schema_diff(a, a).isEmpty()


def test_reconcile_notices_a_lost_table(spark):
    orders = spark.createDataFrame([(1, Decimal("5.00"))], "id int, total decimal(10,2)")
    report = evolve.reconcile({"orders": orders, "a": orders}, {"orders": orders}, {"orders": F.col("total")})
    assert {r.table_name: r.matches for r in report.collect()} == {"orders": True, "a": False}


def test_migrations_are_repeatable(spark):
    start = {"orders": spark.createDataFrame([(1, Decimal("600"))], "id int, total decimal(10,2)")}
    steps = [
        lambda t: {"orders": evolve.add_column(t["orders"], "priority", "string", "normal")},
        lambda t: {"orders": loyalty.with_priority(t["orders"])},
    ]
    once = evolve.apply_migrations(start, steps)
    assert rows(evolve.apply_migrations(once, steps)["orders"]) == rows(once["orders"]) == [(1, Decimal("600.00"), "high")]


def test_validate_every_rule(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    df = spark.createDataFrame(
        [(1, "ok", 1), (1, "ok", 2), (None, "toolong", 9), (None, "bad", None)], "id int, s string, p int"
    )
    report = quality.validate(
        df,
        [
            quality.NotNull("id"),
            quality.Unique(("id",)),
            quality.Check("s", F.col("s") == "ok"),
            quality.MaxLength("s", 3),
            quality.ForeignKey("p", parent, "id"),
        ],
    )
    assert {r.rule: r.violations for r in report.collect()} == {
        "not null id": 2, "unique id": 2, "check s": 2, "length s": 1, "foreign key p": 1,
    }


def test_check_passes_null_but_expectation_does_not(spark):
    df = spark.createDataFrame([(None,), ("view",)], "event_type string")
    rules = {"kind": F.col("event_type") == "view"}
    assert quality.validate(df, [quality.Check("k", rules["kind"])]).first().violations == 0
    good, seen = quality.expect_or_drop(df, rules)
    assert good.count() == 1
    assert seen.get == {"rows": 2, "kind": 1}
    assert rows(quality.violations(df, rules)) == [("kind", 2, 1)]


def test_check_contract(spark):
    contract = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    assert quality.check_contract(spark.createDataFrame([], "a int, b string"), contract) == []
    found = quality.check_contract(spark.createDataFrame([], "a string, c int"), contract)
    assert found == ["a: string instead of int", "b: missing", "c: not in the contract"]


def _events(spark, *events):
    kinds = "session_id string, event_type string, product_id int, event_ts timestamp_ntz"
    return spark.createDataFrame([(s, e, p, datetime(2024, 1, 1, 0, 0, t)) for s, e, p, t in events], kinds)


def test_demand_edge_cases(spark):
    bronze = _events(
        spark,
        ("a", "view", 1, 1), ("a", "view", 1, 1), ("b", "view", 1, 1), ("a", "add_to_cart", 2, 2),
        ("a", "view", None, 3), ("a", "signup", 1, 4), ("a", "click", 99, 5),
    )
    products = spark.createDataFrame([(1, "Lamp", "Home"), (2, "Hat", "Clothing")], "id int, name string, category string")
    items = spark.createDataFrame([(1, 3, Decimal("30"))], "product_id int, quantity int, line_total decimal(10,2)")
    stock = spark.createDataFrame([(1, 4, 10), (1, 5, 8)], "product_id int, quantity int, reorder_level int")
    expected = {
        1: ("Lamp", 2, 0, 0, Decimal("0.0"), 3, Decimal("30.00"), None, 9, 8, False),
        # Nobody viewed it, no inventory: the rate is null, the flag is up.
        2: ("Hat", 0, 0, 1, None, 0, Decimal("0.00"), Decimal("0.0"), 0, None, True),
        # Unknown products stay, without a name.
        99: (None, 0, 1, 0, None, 0, Decimal("0.00"), None, 0, None, False),
    }
    direct = demand.demand_from_bronze(bronze, products, items, stock)
    stored = demand.demand_from_silver(demand.silver_events(bronze, products), items, stock)
    for df in (direct, stored):
        assert {r.product_id: (r[1], *r[3:]) for r in df.collect()} == expected


def test_catalog_page_counts_all_matches(spark, shop):
    from millrace.operators.pricing import with_sale_price

    promotions = with_sale_price(shop.promotions, shop.products)
    shown = catalog.catalog_page(shop.products, shop.inventory, shop.reviews, promotions, limit=7, offset=3).collect()
    assert sorted(r.id for r in shown) == list(range(3, 10))
    assert {r.total for r in shown} == {200}
    none = catalog.catalog_page(shop.products, shop.inventory, shop.reviews, promotions, search="no such thing")
    assert none.isEmpty()


def test_pages_without_reviews_and_promotions(shop):
    cards = [
        catalog.catalog_page(shop.products, shop.inventory, limit=3),
        catalog.best_sellers(shop.products, shop.inventory, shop.order_items, n=3),
        catalog.product_detail(shop.products, shop.inventory).filter("id < 3"),
    ]
    for df in cards:
        found = df.collect()
        assert len(found) == 3
        assert {(r.avg_rating, r.badge_text, r.sale_price) for r in found} == {(0.0, None, None)}


def test_reviews_show_their_comment(spark):
    reviews = spark.createDataFrame(
        [(1, 5, 7, 4, "fine", datetime(2024, 1, 1))],
        "id int, product_id int, customer_id int, rating int, comment string, review_date timestamp_ntz",
    )
    people = spark.createDataFrame([(7, "Ann")], "id int, name string")
    assert rows(catalog.latest_reviews(reviews, people)) == [(5, 1, 1, 4, "fine", datetime(2024, 1, 1), "Ann")]


def test_order_history_of_one_customer_is_newest_first(shop):
    customer = shop.orders.first().customer_id
    history = catalog.order_history(shop.orders, shop.products, customer).collect()
    assert history == sorted(history, key=lambda r: (-r.order_date.toordinal(), r.id))
    assert {r.customer_id for r in history} == {customer}


def test_account_profile_without_optional_fields(spark):
    people = spark.createDataFrame([(1, "A", "a@x")], "id int, name string, email string")
    assert rows(catalog.account_profile(people)) == [(1, "A", "a@x", None, None)]


def test_enrolment_is_repeatable(spark, shop):
    people = loyalty.backfill_points(shop.customers, shop.orders)
    now, later = datetime(2024, 1, 1), datetime(2025, 1, 1)
    members = loyalty.enroll_members(people, now)
    assert rows(loyalty.enroll_members(people, later, members)) == rows(members)


def test_currency_migration_refuses_unknown_codes(spark):
    orders = spark.createDataFrame([(1, "USD"), (2, "XXX")], "id int, currency string")
    rates = spark.createDataFrame([(7, "USD")], "id int, currency_code string")
    with pytest.raises(Exception, match="null in column currency_id"):
        finance.migrate_currency(orders, rates).collect()


def test_attribution_without_campaigns(spark, shop):
    assert finance.attribution(shop.orders, shop.campaigns.limit(0)).isEmpty()


def test_working_set_sketch_is_close(shop):
    exact = {(r.minutes, r.window_end): r.distinct_keys for r in logs.working_set(shop.raw_events, "user_id").collect()}
    near = logs.working_set(shop.raw_events, "user_id", approximate=True).collect()
    assert {(r.minutes, r.window_end) for r in near} == set(exact)
    assert all(abs(r.distinct_keys - exact[r.minutes, r.window_end]) <= 1 for r in near)


def test_working_set_against_brute_force(spark):
    chance = random.Random(3)
    seconds = [(chance.randrange(4 * 3600), chance.choice([1, 1, 1, 2, 3, None])) for _ in range(300)]
    start = datetime(2024, 1, 1)
    df = spark.createDataFrame([(start.timestamp() + s, k) for s, k in seconds], "s double, k int").select(
        F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "k"
    )
    events = [(int(r.ts.replace(tzinfo=None).timestamp()) // 300, r.k) for r in df.collect() if r.k is not None]
    got = {
        (r.minutes, int(r.window_end.timestamp()) // 300): r.distinct_keys
        for r in logs.working_set(df, "k").collect()
    }
    expected = {}
    for minutes in (5, 15, 60):
        for end in range(min(c for c, _ in events), max(c for c, _ in events) + 20):
            seen = {k for c, k in events if end - minutes // 5 <= c < end}
            if seen:
                expected[minutes, end] = len(seen)
    assert got == expected
