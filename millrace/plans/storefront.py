"""Promotion, catalog, cart, order and account queries."""

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import contains_text, repriced, safe_name
from millrace.operators import catalog as c
from millrace.operators import loyalty, pricing
from millrace.operators.changes import latest_change
from millrace.operators.evolve import update_where
from millrace.operators.joins import cascade_delete
from millrace.plans.registry import query
from millrace.plans.shop import NOW, Shop
from millrace.sources.serving import clean_null_bytes, to_serving_schema

CATEGORY, SEARCH = "ECONOMY", "r"


def priced(shop: Shop) -> DataFrame:
    return pricing.with_sale_price(shop.promotions, shop.products)


_PROMOTION = """id, product_id, badge_text, cast(discount_pct as double) as discount_pct,
    promo_type, is_active, cast(sale_price as double) as sale_price"""
_OVERLAY = """m.badge_text, cast(m.discount_pct as double) as discount_pct,
    cast(m.sale_price as double) as sale_price"""


@query(f"select {_PROMOTION} from priced_promotions")
def promotion_prices(shop: Shop):
    return priced(shop)


PROMOTION_UPDATE_SQL = f"""with extended as (
      select id, product_id, badge_text, discount_pct, promo_type, is_active, sale_price
      from priced_promotions
      union all
      select n.id, n.id, n.badge, n.pct, 'percentage', true,
        cast(round(p.price * (1 - n.pct * 0.01), 2) as decimal(10,2))
      from (values (1, 'FLASH SALE', cast(45 as decimal(5,2))), (2, 'FLASH SALE', cast(35 as decimal(5,2))),
        (3, 'MEGA DEAL', cast(60 as decimal(5,2)))) n(id, badge, pct)
      left join products p on p.id = n.id)
    select id, product_id, case when discount_pct = 20 then 'MEGA DEAL' else badge_text end as badge_text,
      cast(case when discount_pct = 20 then 35 else discount_pct end as double) as discount_pct,
      promo_type, is_active,
      cast(case when discount_pct = 20 then round(sale_price * 1.25 * 0.65, 2) else sale_price end as double)
        as sale_price
    from extended"""


@query(PROMOTION_UPDATE_SQL)
def promotion_update(shop: Shop):
    """Three new deals; every 20% deal becomes a 35% one."""
    held = priced(shop)
    deals = [(1, "FLASH SALE", "45.00"), (2, "FLASH SALE", "35.00"), (3, "MEGA DEAL", "60.00")]
    rows = [(i, i, badge, Decimal(pct), "percentage", True) for i, badge, pct in deals]
    kinds = "id bigint, product_id bigint, badge_text string, discount_pct decimal(5,2), promo_type string, is_active boolean"
    fresh = pricing.with_sale_price(shop.spark.createDataFrame(rows, kinds), shop.products)
    old, new = F.lit(Decimal("20")), F.lit(Decimal("35"))
    return update_where(
        held.unionByName(fresh),
        F.col("discount_pct") == 20,
        {
            "discount_pct": new,
            "badge_text": F.lit("MEGA DEAL"),
            "sale_price": repriced(F.col("sale_price"), old, new),
        },
    )


@query(f"select {_PROMOTION} from priced_promotions where is_active")
def active_promotions(shop: Shop):
    return pricing.active_promotions(priced(shop))


@query("""select p.id, p.name, cast(p.price as double) as price, p.category, m.id as promotion_id,
    m.badge_text, cast(m.discount_pct as double) as discount_pct, cast(m.sale_price as double) as sale_price,
    coalesce(s.stock, 0) as stock, cast(floor(p.price) as bigint) as loyalty_points_earned
    from priced_promotions m join products p on p.id = m.product_id
    left join stock s on s.product_id = p.id
    where m.is_active order by m.discount_pct desc, m.id limit 8""")
def promo_deals(shop: Shop):
    return c.promo_deals(shop.products, shop.inventory, priced(shop))


@query(f"""with matching as (select * from products where category = '{CATEGORY}' and lower(name) like '%{SEARCH}%')
    select p.id, p.name, cast(p.price as double) as price, p.category, coalesce(s.stock, 0) as stock,
      coalesce(r.avg_rating, 0) as avg_rating, coalesce(r.review_count, 0) as review_count, {_OVERLAY},
      cast(floor(p.price) as bigint) as loyalty_points_earned, (select count(*) from matching) as total
    from matching p left join stock s on s.product_id = p.id left join ratings r on r.product_id = p.id
    left join active_promotions m on m.product_id = p.id
    order by p.id limit 50 offset 5""")
def catalog_page(shop: Shop):
    return c.catalog_page(
        shop.products, shop.inventory, shop.reviews, priced(shop), CATEGORY, SEARCH, limit=50, offset=5
    )


@query("select id, name from products where lower(name) like '%ring%'")
def catalog_search(shop: Shop):
    return shop.products.filter(contains_text(F.col("name"), "RiNg")).select("id", "name")


@query("select distinct category from products")
def categories(shop: Shop):
    return c.categories(shop.products)


@query("select count(*) as total_products, count(distinct category) as total_categories from products")
def store_totals(shop: Shop):
    return c.store_totals(shop.products)


@query(f"""select p.id, p.name, cast(p.price as double) as price, p.category,
    cast(coalesce(i.quantity, 0) as bigint) as stock, i.warehouse, cast(i.reorder_level as bigint) as reorder_level,
    coalesce(r.avg_rating, 0) as avg_rating, coalesce(r.review_count, 0) as review_count,
    cast(floor(p.price) as bigint) as loyalty_points_earned, {_OVERLAY}
    from products p left join inventory i on i.product_id = p.id left join ratings r on r.product_id = p.id
    left join active_promotions m on m.product_id = p.id""")
def product_detail(shop: Shop):
    return c.product_detail(shop.products, shop.inventory, shop.reviews, priced(shop))


@query("select cast(product_id as bigint) as product_id, avg_rating, review_count from ratings")
def product_rating(shop: Shop):
    return c.product_rating(shop.reviews)


@query("""select cast(r.product_id as bigint) as product_id, position, r.id, cast(rating as bigint) as rating,
    review_date, k.name as reviewer from (
      select *, row_number() over (partition by product_id order by review_date desc, id) as position from reviews
    ) r join customers k on k.id = r.customer_id where position <= 20""")
def latest_reviews(shop: Shop):
    return c.latest_reviews(shop.reviews, shop.customers)


@query(f"""select p.id, p.name, cast(p.price as double) as price, p.category, coalesce(s.stock, 0) as stock,
    r.avg_rating, r.review_count, {_OVERLAY}, cast(floor(p.price) as bigint) as loyalty_points_earned
    from products p join ratings r on r.product_id = p.id left join stock s on s.product_id = p.id
    left join active_promotions m on m.product_id = p.id
    where r.review_count >= 2 order by r.avg_rating desc, r.review_count desc, p.id limit 8""")
def top_rated(shop: Shop):
    return c.top_rated(shop.products, shop.inventory, shop.reviews, priced(shop))


@query(f"""select p.id, p.name, cast(p.price as double) as price, p.category, coalesce(s.stock, 0) as stock,
    i.units_sold, coalesce(r.avg_rating, 0) as avg_rating, {_OVERLAY},
    cast(floor(p.price) as bigint) as loyalty_points_earned
    from products p
    join (select product_id, cast(sum(quantity) as bigint) as units_sold from order_items group by product_id) i
      on i.product_id = p.id
    left join stock s on s.product_id = p.id left join ratings r on r.product_id = p.id
    left join active_promotions m on m.product_id = p.id
    order by i.units_sold desc, p.id limit 8""")
def best_sellers(shop: Shop):
    return c.best_sellers(shop.products, shop.inventory, shop.order_items, shop.reviews, priced(shop))


def _prices(shop: Shop) -> DataFrame:
    return pricing.price_list(shop.products, shop.inventory, priced(shop))


_LINES = """select c.customer_id, c.product_id, p.name, p.category, p.price, m.sale_price, m.badge_text,
    m.discount_pct, coalesce(nullif(m.sale_price, 0), p.price) as unit_price, c.quantity,
    coalesce(s.stock, 0) as stock
    from carts c join products p on p.id = c.product_id left join stock s on s.product_id = c.product_id
    left join active_promotions m on m.product_id = c.product_id"""


@query(f"""with priced_lines as ({_LINES})
    select customer_id, cast(product_id as bigint) as product_id, name, category, cast(price as double) as price,
      cast(sale_price as double) as sale_price, badge_text, cast(discount_pct as double) as discount_pct,
      cast(unit_price as double) as unit_price, quantity as cart_quantity,
      cast(unit_price * quantity as double) as line_total, stock, stock >= quantity as in_stock,
      cast(floor(unit_price) as bigint) * quantity as points_earned
    from priced_lines""")
def cart_pricing(shop: Shop):
    return pricing.priced_lines(shop.carts, _prices(shop))


@query(f"""with priced_lines as ({_LINES})
    select t.customer_id, cast(t.item_count as bigint) as item_count,
      cast(coalesce(l.subtotal, 0) as double) as subtotal, cast(coalesce(l.points_earned, 0) as bigint) as points_earned,
      b.tier as loyalty_tier
    from (select customer_id, sum(quantity) as item_count from carts group by customer_id) t
    left join (select customer_id, sum(unit_price * quantity) as subtotal,
      sum(cast(floor(unit_price) as bigint) * quantity) as points_earned from priced_lines group by customer_id) l
      on l.customer_id = t.customer_id
    left join customers k on k.id = t.customer_id left join members b on b.email = k.email""")
def cart_totals(shop: Shop):
    members = loyalty.enroll_members(loyalty.backfill_points(shop.customers, shop.orders), NOW)
    return pricing.cart_totals(shop.carts, _prices(shop), shop.customers, members)


# A cart goes through when its lines fit behind the demand of all earlier carts.
_SERVED = """with turns as (
      select customer_id, max(added_at) as placed_at from carts group by customer_id),
    asked as (
      select c.customer_id, t.placed_at, c.product_id, c.quantity,
        case when p.id is null then -1 else coalesce(s.stock, -1) end as stock
      from carts c join turns t on t.customer_id = c.customer_id
      left join products p on p.id = c.product_id left join stock s on s.product_id = p.id),
    hopeless as (select distinct customer_id from asked where quantity > stock),
    ranked as (
      select customer_id, stock, sum(quantity) over (
        partition by product_id order by placed_at, customer_id rows unbounded preceding) as wanted
      from asked where customer_id not in (select customer_id from hopeless)),
    fitting as (select customer_id from ranked group by customer_id having bool_and(wanted <= stock)),
    outcome as (
      select customer_id, placed_at, customer_id in (select customer_id from fitting) as accepted from turns)"""


def _checkout(shop: Shop) -> pricing.Checkout:
    return pricing.checkout_batch(shop.carts, shop.products, shop.inventory)


@query(f"""{_SERVED}
    select c.customer_id, cast(c.product_id as bigint) as product_id, c.quantity, cast(p.price as double) as unit_price,
      cast(p.price * c.quantity as double) as total, 'USD' as currency, 'pending' as status, o.placed_at as order_date
    from carts c join outcome o on o.customer_id = c.customer_id join products p on p.id = c.product_id
    where o.accepted""")
def checkout_batch(shop: Shop):
    return _checkout(shop).orders


@query(f"""{_SERVED}
    select (select max(id) from shop_orders)
        + row_number() over (order by o.placed_at, c.customer_id, c.product_id) as order_id,
      cast(c.product_id as bigint) as product_id, c.quantity, cast(p.price as double) as unit_price,
      cast(p.price * c.quantity as double) as line_total
    from carts c join outcome o on o.customer_id = c.customer_id join products p on p.id = c.product_id
    where o.accepted""")
def checkout_order_items(shop: Shop):
    return pricing.place_orders(_checkout(shop), shop.orders).order_items


@query(f"""{_SERVED}
    select c.customer_id, count(*) as lines, cast(sum(c.quantity) as bigint) as items
    from carts c join outcome o on o.customer_id = c.customer_id where not o.accepted group by c.customer_id""")
def checkout_rejected(shop: Shop):
    return _checkout(shop).rejected


@query(f"""{_SERVED}
    select i.product_id, i.warehouse, cast(i.reorder_level as bigint) as reorder_level,
      cast(i.quantity - coalesce(x.sold, 0) as bigint) as quantity, cast(0 as bigint) as unmet
    from inventory i left join (
      select c.product_id, sum(c.quantity) as sold from carts c join outcome o on o.customer_id = c.customer_id
      where o.accepted group by c.product_id) x on x.product_id = i.product_id""")
def checkout_inventory(shop: Shop):
    return _checkout(shop).inventory


@query(f"""{_SERVED}
    select k.id, k.name, k.email, k.email_verified,
      cast(k.loyalty_points + coalesce(x.earned, 0) as bigint) as loyalty_points
    from points k left join (
      select c.customer_id, sum(cast(floor(p.price) as bigint) * c.quantity) as earned
      from carts c join outcome o on o.customer_id = c.customer_id join products p on p.id = c.product_id
      where o.accepted group by c.customer_id) x on x.customer_id = k.id""")
def checkout_points(shop: Shop):
    people = loyalty.backfill_points(shop.customers, shop.orders)
    return pricing.award_points(people, _checkout(shop).points)


@query("""select i.product_id, i.warehouse, cast(i.reorder_level as bigint) as reorder_level,
    cast(case when i.quantity >= coalesce(w.wanted, 0) then i.quantity - coalesce(w.wanted, 0) else i.quantity end
      as bigint) as quantity,
    cast(case when i.quantity >= coalesce(w.wanted, 0) then 0 else w.wanted end as bigint) as unmet
    from inventory i left join (select product_id, sum(quantity) as wanted from carts group by product_id) w
      on w.product_id = i.product_id""")
def stock_reservation(shop: Shop):
    return pricing.reserve_stock(shop.inventory, shop.carts)


@query("""select o.id, o.customer_id, p.name as product, cast(o.quantity as bigint) as quantity,
    cast(o.total as double) as total, o.currency, o.order_date, o.status,
    case when o.total > 500 then 'high' when o.total > 200 then 'medium' else 'normal' end as priority
    from shop_orders o join products p on p.id = o.product_id""")
def order_history(shop: Shop):
    return c.order_history(loyalty.with_priority(shop.orders), shop.products)


@query("""select o.id, o.customer_id, k.name as customer, o.order_date, o.status, cast(o.total as double) as total,
    o.currency from shop_orders o join customers k on k.id = o.customer_id""")
def order_headers(shop: Shop):
    return c.order_headers(shop.orders, shop.customers)


@query("""select i.product_id, i.order_id, cast(i.line_no as bigint) as line_no, cast(i.quantity as bigint) as quantity,
    cast(i.line_total as double) as line_total, p.name as product
    from order_items i join products p on p.id = i.product_id""")
def order_detail(shop: Shop):
    return c.order_lines(shop.order_items, shop.products)


@query("""select i.order_id, cast(i.line_no as bigint) as line_no, i.product_id, cast(i.quantity as bigint) as quantity,
    cast(i.line_total as double) as line_total
    from order_items i where exists (select 1 from orders_latest o where o.id = i.order_id)""")
def order_items_kept(shop: Shop):
    changes = shop.order_changes.select("id", "seq", "op")
    live = latest_change(changes, "id", "seq").filter(F.col("op") != "delete")
    return cascade_delete(shop.order_items, live, "order_id", "id").select(*shop.order_items.columns)


@query("""select k.id, k.name, k.email, k.loyalty_points, k.email_verified, b.tier as loyalty_tier,
    b.total_earned as loyalty_total_earned
    from points k left join members b on b.email = k.email""")
def account_profile(shop: Shop):
    people = loyalty.backfill_points(shop.customers, shop.orders)
    return c.account_profile(people, loyalty.enroll_members(people, NOW))


@query("""select status, count(*) as orders,
      (2 * sum(cast(total * 100 as bigint)) + count(total)) // (2 * count(total)) / 100.0 as avg_total
    from shop_orders group by status""")
def order_status_distribution(shop: Shop):
    return c.order_status_distribution(shop.orders)


@query("""select cast(coalesce(sum(total), 0) as double) as revenue, count(*) as orders, max(id) as last_id
    from shop_orders""")
def total_revenue(shop: Shop):
    return c.total_revenue(shop.orders)


@query("""select id, customer_id, status, cast(total as double) as total from shop_orders order by id limit 10""")
def federated_orders(shop: Shop):
    return c.first_orders(shop.orders)


@query("""select id, substr(coalesce(nullif(trim(regexp_replace(regexp_replace(lower(trim(concat(name, ' - ', category))),
    '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g'), '_'), ''), 'user'), 1, 19) as identifier from products""")
def product_identifiers(shop: Shop):
    label = F.concat("name", F.lit(" - "), "category")
    return shop.products.select("id", safe_name(label, length=19).alias("identifier"))


@query("""select id, name, concat('{"price":', cast(price as varchar), ',"category":"', category, '"}') as facts
    from products""")
def serving_rows(shop: Shop):
    nested = shop.products.select(
        "id",
        F.concat("name", F.lit("\x00")).alias("name"),
        F.struct("price", "category").alias("facts"),
    )
    return to_serving_schema(clean_null_bytes(nested))
