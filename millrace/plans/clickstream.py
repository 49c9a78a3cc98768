"""Clickstream, demand and supplier queries."""

from pyspark.sql import functions as F

from millrace.functions import epoch_seconds, event_time, iso_text, sale_end
from millrace.operators import demand as d
from millrace.plans.registry import query
from millrace.plans.shop import Shop
from millrace.streaming.clickstream import adapt_live_events, event_from_json, event_to_json

_DEMAND_COLUMNS = """product_id, product_name, category, cast(views as bigint) as views,
    cast(clicks as bigint) as clicks, cast(add_to_carts as bigint) as add_to_carts,
    cast(cart_rate as double) as cart_rate, cast(units_sold as bigint) as units_sold,
    cast(revenue as double) as revenue, cast(conversion_rate as double) as conversion_rate,
    cast(in_stock as bigint) as in_stock, cast(reorder_level as bigint) as reorder_level,
    restock_needed"""

SILVER_SQL = """select session_id, event_type, cast(product_id as bigint) as product_id, event_ts,
    product_name, category from silver"""
DEMAND_SQL = f"select {_DEMAND_COLUMNS} from demand"


@query(SILVER_SQL)
def clickstream_silver(shop: Shop):
    return d.silver_events(shop.bronze, shop.products)


@query(DEMAND_SQL)
def product_demand(shop: Shop):
    return d.demand_from_bronze(shop.bronze, shop.products, shop.order_items, shop.inventory)


@query(DEMAND_SQL)
def product_demand_from_silver(shop: Shop):
    silver = d.silver_events(shop.bronze, shop.products)
    return d.demand_from_silver(silver, shop.order_items, shop.inventory)


@query("""select product_id, product_name, category, cast(views as bigint) as views,
    cast(clicks as bigint) as clicks, cast(add_to_carts as bigint) as add_to_carts,
    cast(cart_rate as double) as cart_rate, cast(units_sold as bigint) as units_sold,
    cast(conversion_rate as double) as conversion_rate, cast(in_stock as bigint) as in_stock,
    restock_needed
    from demand order by views desc nulls last, product_id limit 20""")
def demand_top20(shop: Shop):
    return d.top_demand(product_demand(shop))


@query("""select cast(row_number() over (order by views desc nulls last, add_to_carts desc nulls last,
    product_id) as bigint) as rank, product_id,
    coalesce(nullif(product_name, ''), concat('Product #', cast(product_id as varchar))) as product,
    category, cast(coalesce(views, 0) as bigint) as views, cast(coalesce(clicks, 0) as bigint) as clicks,
    cast(coalesce(add_to_carts, 0) as bigint) as add_to_carts, cast(cart_rate as double) as cart_rate,
    cast(units_sold as bigint) as units_sold, cast(in_stock as bigint) as in_stock, restock_needed
    from demand""")
def supplier_demand(shop: Shop):
    return d.ranked_demand(product_demand(shop))


@query("""select cast(coalesce(sum(views), 0) as bigint) as total_views,
    cast(coalesce(sum(add_to_carts), 0) as bigint) as total_add_to_cart,
    count(*) filter (where restock_needed) as restock_count from demand""")
def supplier_totals(shop: Shop):
    return d.demand_totals(product_demand(shop))


@query("select event_type, count(*) as events from clickstream_bronze group by event_type")
def event_type_counts(shop: Shop):
    return d.event_type_counts(shop.bronze)


@query("""select event_type, cast(product_id as bigint) as product_id, event_ts, session_id
    from clickstream_bronze order by event_ts desc, session_id, event_type, product_id limit 20""")
def latest_events(shop: Shop):
    return d.latest_events(shop.bronze, 20).select("event_type", "product_id", "event_ts", "session_id")


@query("""select distinct event_type, cast(product_id as bigint) as product_id, event_ts
    from clickstream_bronze where event_type in ('view', 'click', 'add_to_cart')
    and product_id is not null and event_ts is not null""")
def live_events_adapted(shop: Shop):
    sent = iso_text(F.col("event_ts"))
    live = shop.bronze.select("event_type", "product_id", sent.alias("event_ts"))
    return d.clean_events(adapt_live_events(live)).select("event_type", "product_id", "event_ts")


@query("select session_id, event_type, cast(product_id as bigint) as product_id, event_ts from clickstream_bronze")
def event_json_round_trip(shop: Shop):
    texts = event_to_json(shop.bronze)
    fields = "session_id string, event_type string, product_id int, event_ts string"
    return event_from_json(texts, fields).withColumn("event_ts", event_time(F.col("event_ts")))


@query("""select id, order_date, order_date + interval 14 day as sale_end,
    cast(epoch(order_date) as bigint) as started_at from shop_orders""")
def sale_windows(shop: Shop):
    start = F.col("order_date")
    return shop.orders.select(
        "id", "order_date", sale_end(start).alias("sale_end"), epoch_seconds(start).alias("started_at")
    )
