"""Promotions, carts and checkout; checkout against a loop over the carts."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from millrace.operators import pricing
from tests.conftest import rows

START = datetime(2024, 1, 1)
CARTS = "customer_id int, product_id int, quantity bigint, added_at timestamp_ntz"
PROMOS = "id int, product_id int, badge_text string, discount_pct decimal(5,2), is_active boolean"


def shelf(spark, stock, price="9.99"):
    products = spark.createDataFrame(
        [(p, f"p{p}", Decimal(price), "c") for p in stock], "id int, name string, price decimal(10,2), category string"
    )
    inventory = spark.createDataFrame(list(stock.items()), "product_id int, quantity bigint")
    return products, inventory


def one_by_one(carts, stock):
    """Serve the carts in the order of their last addition; what an earlier cart
    asked for counts, also where that cart failed."""
    left, free, lines, last = dict(stock), dict(stock), {}, {}
    for customer, product, quantity, at in carts:
        lines.setdefault(customer, []).append((product, quantity))
        last[customer] = max(at, last.get(customer, at))
    accepted = []
    for customer in sorted(lines, key=lambda c: (last[c], c)):
        if any(stock.get(p, -1) < q for p, q in lines[customer]):
            continue
        fits = all(free[p] >= q for p, q in lines[customer])
        for p, q in lines[customer]:
            free[p] -= q
            left[p] -= q if fits else 0
        accepted += [customer] if fits else []
    return accepted, left


@pytest.mark.parametrize("seed", range(4))
def test_checkout_serves_carts_in_turn(spark, seed):
    chance = random.Random(seed)
    stock = {p: chance.randrange(0, 25) for p in range(12)}
    stock[0] = 60
    carts = []
    for customer in range(60):
        # Every third cart wants the same product, some carts an unknown one.
        wanted = {0} if customer % 3 == 0 else set()
        wanted |= set(chance.sample(range(13), chance.randrange(1, 5)))
        for product in wanted:
            minute = chance.randrange(20)
            carts.append((customer, product, chance.randrange(1, 6), START + timedelta(minutes=minute)))
    products, inventory = shelf(spark, stock)
    done = pricing.checkout_batch(spark.createDataFrame(carts, CARTS), products, inventory)
    accepted, left = one_by_one(carts, stock)
    assert 0 < len(accepted) < 60
    assert {r.customer_id for r in done.orders.collect()} == set(accepted)
    assert {r.customer_id for r in done.rejected.collect()} == set(range(60)) - set(accepted)
    assert {r.product_id: r.quantity for r in done.inventory.collect()} == left
    assert done.inventory.filter("unmet > 0").isEmpty()
    bought = {(c, p): q for c, p, q, _ in carts if c in accepted}
    assert {(r.customer_id, r.product_id): r.quantity for r in done.orders.collect()} == bought
    points = {}
    for (customer, _), quantity in bought.items():
        points[customer] = points.get(customer, 0) + 9 * quantity
    assert {r.customer_id: r.points for r in done.points.collect()} == points


def test_a_hopeless_cart_asks_for_nothing(spark):
    carts = [(1, 1, 5, START), (1, 2, 1, START), (2, 1, 5, START + timedelta(1))]
    products, inventory = shelf(spark, {1: 5, 2: 0})
    done = pricing.checkout_batch(spark.createDataFrame(carts, CARTS), products, inventory)
    assert [r.customer_id for r in done.orders.collect()] == [2]


def test_checkout_charges_list_price_unless_told_otherwise(spark):
    products, inventory = shelf(spark, {1: 5}, "10.00")
    promos = pricing.with_sale_price(
        spark.createDataFrame([(1, 1, "B", Decimal("25"), True)], PROMOS), products
    )
    carts = spark.createDataFrame([(1, 1, 2, START)], CARTS)
    plain = pricing.checkout_batch(carts, products, inventory).orders.first()
    promoted = pricing.checkout_batch(carts, products, inventory, promos).orders.first()
    assert (plain.unit_price, plain.total) == (Decimal("10.00"), Decimal("20.00"))
    assert (promoted.unit_price, promoted.total) == (Decimal("7.50"), Decimal("15.00"))


def test_best_promotion_is_deepest_then_oldest(spark):
    products, _ = shelf(spark, {1: 1, 2: 1}, "10.00")
    promos = spark.createDataFrame(
        [(1, 1, "a", Decimal("10"), True), (2, 1, "b", Decimal("30"), True), (3, 1, "c", Decimal("30"), True),
         (4, 1, "d", Decimal("90"), False), (5, 2, "e", Decimal("10"), False), (6, 77, "f", Decimal("10"), True)],
        PROMOS,
    )
    priced = pricing.with_sale_price(promos, products)
    best = {r.product_id: (r.badge_text, r.sale_price) for r in pricing.best_promotion(priced).collect()}
    assert best == {1: ("b", Decimal("7.00")), 77: ("f", None)}
    shown = {r.id: r.badge_text for r in pricing.overlay_promotions(products, priced).collect()}
    assert shown == {1: "b", 2: None}


def test_active_promotions_by_date(spark):
    promos = spark.createDataFrame(
        [(1, True, START, START + timedelta(14)), (2, True, None, None), (3, False, START, None)],
        "id int, is_active boolean, start_date timestamp_ntz, end_date timestamp_ntz",
    )
    assert {r.id for r in pricing.active_promotions(promos).collect()} == {1, 2}
    assert {r.id for r in pricing.active_promotions(promos, START + timedelta(15)).collect()} == {2}


def test_cart_lines_and_totals(spark):
    products, inventory = shelf(spark, {1: 5, 2: 0}, "10.00")
    promos = pricing.with_sale_price(spark.createDataFrame([(1, 1, "B", Decimal("25"), True)], PROMOS), products)
    prices = pricing.price_list(products, inventory, promos)
    carts = spark.createDataFrame([(1, 1, 2, START), (1, 2, 1, START), (1, 99, 4, START), (2, 99, 1, START)], CARTS)
    lines = {(r.customer_id, r.product_id): r for r in pricing.priced_lines(carts, prices).collect()}
    assert set(lines) == {(1, 1), (1, 2)}
    assert (lines[1, 1].line_total, lines[1, 1].in_stock, lines[1, 1].points_earned) == (Decimal("15.00"), True, 14)
    assert lines[1, 2].in_stock is False
    totals = rows(pricing.cart_totals(carts, prices))
    assert totals == [(1, 7, Decimal("25.00"), 24), (2, 1, Decimal("0.00"), 0)]


def test_two_warehouses_make_one_product(spark):
    products, _ = shelf(spark, {1: 0})
    inventory = spark.createDataFrame([(1, 3), (1, 4)], "product_id int, quantity bigint")
    assert [r.stock for r in pricing.price_list(products, inventory).collect()] == [7]


def test_reserve_stock_is_all_or_nothing(spark):
    inventory = spark.createDataFrame([(1, 5, "w"), (2, 1, "w"), (3, 9, "w")], "product_id int, quantity int, warehouse string")
    demand = spark.createDataFrame([(1, 2), (1, 3), (2, 2), (9, 1)], "product_id int, quantity int")
    found = {r.product_id: (r.quantity, r.unmet) for r in pricing.reserve_stock(inventory, demand).collect()}
    assert found == {1: (0, 0), 2: (1, 2), 3: (9, 0)}


def test_award_points(spark):
    people = spark.createDataFrame([(1, 10), (2, 20)], "id int, loyalty_points bigint")
    points = spark.createDataFrame([(1, 5), (1, 6)], "customer_id int, points bigint")
    assert rows(pricing.award_points(people, points)) == [(1, 21), (2, 20)]
