"""Constraint, expectation and key queries."""

from pyspark.sql import functions as F

from millrace.functions import surrogate_key
from millrace.operators import quality as q
from millrace.operators.demand import EVENT_KEY
from millrace.plans.registry import query
from millrace.plans.shop import Shop
from millrace.schemas import EVENT_TYPES, ORDER_STATUSES


@query("""select 'events' as table_name, 'not null product_id' as rule, count(*) filter (where product_id is null) as violations from raw_events
    union all select 'events', 'check event_type', count(*) filter (where event_type not in ('view', 'click', 'add_to_cart')) from raw_events
    union all select 'events', 'foreign key product_id', count(*) from raw_events where product_id not in (select id from products)
    union all select 'orders', 'check status', count(*) filter (where status not in ('pending', 'confirmed', 'shipped', 'delivered', 'cancelled')) from shop_orders
    union all select 'orders', 'length currency', count(*) filter (where length(currency) > 3) from shop_orders
    union all select 'orders', 'unique id', (select coalesce(cast(sum(n) as bigint), 0) from (select count(*) as n from shop_orders group by id) where n > 1)
    union all select 'orders', 'foreign key customer_id', count(*) from shop_orders where customer_id not in (select id from customers)
    union all select 'order_items', 'unique order_id, line_no', (select coalesce(cast(sum(n) as bigint), 0) from (select count(*) as n from order_items group by order_id, line_no) where n > 1)
    union all select 'order_items', 'foreign key order_id', count(*) from order_items where order_id not in (select id from shop_orders)
    union all select 'reviews', 'check rating', count(*) filter (where rating not between 1 and 5) from reviews
    union all select 'customers', 'unique email', (select coalesce(cast(sum(n) as bigint), 0) from (select count(*) as n from customers group by email) where n > 1)
    union all select 'customers', 'length email', count(*) filter (where length(email) > 255) from customers""")
def constraint_report(shop: Shop):
    checks = {
        "events": (
            shop.raw_events,
            [
                q.NotNull("product_id"),
                q.Check("event_type", F.col("event_type").isin(*EVENT_TYPES)),
                q.ForeignKey("product_id", shop.products, "id"),
            ],
        ),
        "orders": (
            shop.orders,
            [
                q.Check("status", F.col("status").isin(*ORDER_STATUSES)),
                q.MaxLength("currency", 3),
                q.Unique(("id",)),
                q.ForeignKey("customer_id", shop.customers, "id"),
            ],
        ),
        "order_items": (
            shop.order_items,
            [q.Unique(("order_id", "line_no")), q.ForeignKey("order_id", shop.orders, "id")],
        ),
        "reviews": (shop.reviews, [q.Check("rating", F.col("rating").between(1, 5))]),
        "customers": (shop.customers, [q.Unique(("email",)), q.MaxLength("email", 255)]),
    }
    report = None
    for table, (df, rules) in checks.items():
        part = q.validate(df, rules).select(F.lit(table).alias("table_name"), "rule", "violations")
        report = part if report is None else report.unionByName(part)
    return report


@query("""with deliveries as (select distinct session_id, event_type, product_id, event_ts from clickstream_bronze)
    select 'valid_event_type' as rule, count(*) as rows,
      count(*) filter (where event_type is null or event_type not in ('view', 'click', 'add_to_cart')) as violations
    from deliveries
    union all select 'valid_product_id', count(*), count(*) filter (where product_id is null) from deliveries
    union all select 'valid_event_ts', count(*), count(*) filter (where event_ts is null) from deliveries""")
def dq_metrics(shop: Shop):
    return q.violations(shop.bronze.dropDuplicates(EVENT_KEY), q.clickstream_rules())


@query("""select sha1(concat(cast(ts as varchar), cast(ts + interval 7 minute as varchar),
      cast(cast(value as decimal(8,2)) as varchar))) as trip_id, event_id
    from events""")
def trip_keys(shop: Shop):
    pickup = F.col("ts")
    parts = [pickup, pickup + F.expr("interval 7 minutes"), F.col("value").cast("decimal(8,2)")]
    return shop.table("events").select(surrogate_key(parts).alias("trip_id"), "event_id")
