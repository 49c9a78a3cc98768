"""The shop's tables as views over the given input tables.

``SQL_VIEWS`` states the same views for the engine the results are checked
with; a view may use those before it.
"""

from __future__ import annotations

import re
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.evolve import Tables
from millrace.schemas import INPUTS

# A moment inside the order history, and the time at which members enrol.
RECOVERY_POINT = datetime(1998, 1, 1)
NOW = datetime(2024, 2, 1)

SQL_VIEWS = {
    "products": """select p_partkey as id, p_name as name, cast(p_retailprice as decimal(10,2)) as price, p_type as category from part""",
    "inventory": """select p_partkey as product_id, cast((p_partkey * 37) % 201 as int) as quantity, case p_partkey % 3 when 0 then 'US-East' when 1 then 'US-West' else 'EU-Central' end as warehouse, cast(5 + 5 * (p_partkey % 4) as int) as reorder_level from part""",
    "customers": """select c_custkey as id, c_name as name, concat('user', cast(c_custkey as varchar(20)), '@example.com') as email, (c_custkey % 3 = 0) as email_verified from customer""",
    "shop_orders": """select o_orderkey as id, o_custkey as customer_id, o_orderkey % 200 as product_id, cast(1 + o_orderkey % 3 as int) as quantity, cast(cast(o_totalprice as decimal(12,2)) * 0.002 as decimal(10,2)) as total, case o_custkey % 4 when 0 then 'USD' when 1 then 'EUR' when 2 then 'GBP' else 'JPY' end as currency, o_orderdate as order_date, case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'pending' end as status from orders""",
    "order_items": """select l_orderkey as order_id, l_linenumber as line_no, l_partkey as product_id, cast(l_quantity as int) as quantity, cast(l_extendedprice as decimal(10,2)) as line_total from lineitem""",
    "exchange_rates": """select * from (values (1,'USD','US Dollar',cast(1.000000 as decimal(12,6))),(2,'EUR','Euro',cast(1.085000 as decimal(12,6))),(3,'GBP','British Pound',cast(1.265000 as decimal(12,6))),(4,'JPY','Japanese Yen',cast(0.006700 as decimal(12,6)))) t(id, currency_code, currency_name, rate_to_usd)""",
    "campaigns": """select * from (values ('Spring Kickoff','spring_email'),('Loyalty Push','loyalty_push'),('Cross-Channel Demo','paid_social')) t(campaign, utm_source)""",
    "promotions": """select id, id as product_id, case id % 3 when 0 then 'SPRING SALE' when 1 then 'FLASH SALE' else 'CLEARANCE' end as badge_text, cast(10 + 5 * (id % 11) as decimal(5,2)) as discount_pct, 'percentage' as promo_type, (id % 12 <> 0) as is_active from products where id % 4 = 0""",
    "priced_promotions": """select m.*, cast(round(p.price * (1 - m.discount_pct * 0.01), 2) as decimal(10,2)) as sale_price from promotions m left join products p on p.id = m.product_id""",
    "active_promotions": """select * from (select *, row_number() over (partition by product_id order by discount_pct desc, id) as place from priced_promotions where is_active) where place = 1""",
    "raw_events": """select event_id, user_id, ts, case event_type when 'purchase' then 'add_to_cart' else event_type end as event_type, case when event_id % 97 = 0 then null else cast(regexp_extract(props, '[0-9]+', 0) as int) end as product_id from events""",
    "clickstream_bronze": """select concat('sess-', cast(user_id as varchar(20))) as session_id, event_type, product_id, ts as event_ts from raw_events union all select concat('sess-', cast(user_id as varchar(20))), event_type, product_id, ts from raw_events where event_id % 10 = 0""",
    "silver": """select d.session_id, d.event_type, d.product_id, d.event_ts, p.name as product_name, p.category from (select distinct session_id, event_type, product_id, event_ts from clickstream_bronze) d left join products p on p.id = d.product_id where d.event_type in ('view', 'click', 'add_to_cart') and d.product_id is not null and d.event_ts is not null""",
    "reviews": """select event_id as id, product_id, user_id as customer_id, cast(1 + event_id % 5 as int) as rating, ts as review_date from raw_events where event_type = 'signup' and product_id is not null""",
    "ratings": """select product_id, round(avg(rating), 1) as avg_rating, count(*) as review_count from reviews group by product_id""",
    "stock": """select product_id, cast(sum(quantity) as bigint) as stock from inventory group by product_id""",
    "carts": """select user_id as customer_id, product_id, cast(count(*) as bigint) as quantity, max(ts) as added_at from raw_events where event_type = 'add_to_cart' and product_id is not null group by user_id, product_id""",
    "orders_cdc": """select id, customer_id, total, status, 'insert' as op, id * 10 as seq, order_date as commit_ts from shop_orders union all select id, customer_id, total, 'cancelled', 'update', id * 10 + 1, order_date + interval 30 day from shop_orders where id % 5 = 0 union all select id, customer_id, total, status, 'delete', id * 10 + 2, order_date + interval 60 day from shop_orders where id % 11 = 0""",
    "orders_latest": """select id, customer_id, total, status from (select *, row_number() over (partition by id order by seq desc) as place from orders_cdc) where place = 1 and op <> 'delete'""",
    "orders_then": """select id, customer_id, total, status from (select *, row_number() over (partition by id order by seq desc) as place from orders_cdc where commit_ts <= timestamp '1998-01-01 00:00:00') where place = 1 and op <> 'delete'""",
    "points": """select c.id, c.name, c.email, c.email_verified, cast(coalesce(sum(floor(o.total)), 0) as bigint) as loyalty_points from customers c left join shop_orders o on o.customer_id = c.id group by c.id, c.name, c.email, c.email_verified""",
    "members": """select email, case when loyalty_points >= 3000 then 'Platinum' when loyalty_points >= 1500 then 'Gold' when loyalty_points >= 500 then 'Silver' else 'Bronze' end as tier, timestamp '2024-02-01 00:00:00' as enrolled_at, loyalty_points as total_earned from points where loyalty_points > 0""",
    "query_log": """select case o_orderpriority when '1-URGENT' then 'storefront' when '2-HIGH' then 'checkout' else 'reporting' end as role, case o_orderkey % 3 when 0 then concat('/* page */ SELECT * FROM orders  WHERE id = ', cast(o_orderkey as varchar(20))) when 1 then concat('SELECT id FROM orders WHERE status = ''it''''s ', o_orderstatus, ''' AND customer_id IN (', cast(o_custkey as varchar(20)), ', ', cast(o_custkey + 1 as varchar(20)), ') -- by hand') else concat('UPDATE orders2024 SET total = total - 1.25, rate = -2.5e-3 WHERE id = ', cast(o_orderkey as varchar(20))) end as query, cast(o_totalprice as decimal(12,2)) as duration_ms from orders""",
    "operation_log": """select event_type as operation, case event_id % 10 when 0 then 'Error' when 1 then 'In progress' else 'OK' end as status, cast(value as decimal(12,2)) as duration_ms from events""",
    "demand": """select c.product_id, p.name as product_name, p.category, c.views, c.clicks, c.add_to_carts, round(100.0 * c.add_to_carts / nullif(c.views, 0), 1) as cart_rate, coalesce(s.units_sold, 0) as units_sold, coalesce(s.revenue, 0) as revenue, round(100.0 * coalesce(s.units_sold, 0) / nullif(c.add_to_carts, 0), 1) as conversion_rate, coalesce(k.in_stock, 0) as in_stock, k.reorder_level, (coalesce(k.in_stock, 0) <= coalesce(k.reorder_level, 0) and c.add_to_carts > 0) as restock_needed from (select product_id, sum(case when event_type = 'view' then 1 else 0 end) as views, sum(case when event_type = 'click' then 1 else 0 end) as clicks, sum(case when event_type = 'add_to_cart' then 1 else 0 end) as add_to_carts from silver group by product_id) c left join products p on p.id = c.product_id left join (select product_id, sum(quantity) as units_sold, sum(line_total) as revenue from order_items group by product_id) s on s.product_id = c.product_id left join (select product_id, sum(quantity) as in_stock, min(reorder_level) as reorder_level from inventory group by product_id) k on k.product_id = c.product_id""",
}


def with_views(sql: str) -> str:
    """``sql`` with the views it uses, directly or not, put in front."""
    wanted: list[str] = []

    def collect(text: str) -> None:
        for name, body in SQL_VIEWS.items():
            if name not in wanted and re.search(rf"\b(from|join)\s+{name}\b", text):
                collect(body)
                wanted.append(name)

    collect(sql)
    views = [f"{name} as ({SQL_VIEWS[name]})" for name in wanted]
    text = sql.strip()
    recursive = text.startswith("with recursive ")
    if text.startswith("with "):
        text = text.removeprefix("with recursive ").removeprefix("with ")
        views.append(text)
        return f"with {'recursive ' if recursive else ''}" + ", ".join(views)
    return "with " + ", ".join(views) + " " + text if views else text


def raw_events(events: DataFrame) -> DataFrame:
    """Input events as shop events; holds for batches and streams."""
    return events.selectExpr(
        "event_id",
        "user_id",
        "ts",
        "case event_type when 'purchase' then 'add_to_cart' else event_type end as event_type",
        "case when event_id % 97 <> 0 then cast(regexp_extract(props, '[0-9]+', 0) as int) end as product_id",
    )


def clickstream_bronze(events: DataFrame) -> DataFrame:
    """The at-least-once feed: every tenth event arrives twice."""
    deliveries = "explode(case when event_id % 10 = 0 then array(1, 2) else array(1) end) as delivery"
    return (
        raw_events(events)
        .selectExpr("*", deliveries)
        .selectExpr("concat('sess-', user_id) as session_id", "event_type", "product_id", "ts as event_ts")
    )


def order_changes(orders: DataFrame) -> DataFrame:
    """A change log of the orders: inserts, cancellations, deletions."""

    def change(status: str, op: str, place: int, days: int, condition: str) -> str:
        row = f"named_struct('status', {status}, 'op', '{op}', 'seq', id * 10 + {place}, "
        return f"if({condition}, {row} 'commit_ts', order_date + interval {days} day), null)"

    log = ", ".join(
        [
            change("status", "insert", 0, 0, "true"),
            change("'cancelled'", "update", 1, 30, "id % 5 = 0"),
            change("status", "delete", 2, 60, "id % 11 = 0"),
        ]
    )
    return orders.selectExpr(
        "id", "customer_id", "total", f"inline(filter(array({log}), c -> c is not null))"
    )


class Shop:
    """The shop over one folder of input tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def stream_path(self, table: str) -> str:
        """The same as a pattern, which a stream also takes for a single file."""
        return f"{self.folder}/{table}.[p]arquet"

    def table(self, table: str) -> DataFrame:
        return self.spark.read.schema(INPUTS[table]).parquet(self.path(table))

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey as id",
            "p_name as name",
            "cast(p_retailprice as decimal(10,2)) as price",
            "p_type as category",
        )

    @cached_property
    def inventory(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey as product_id",
            "cast((p_partkey * 37) % 201 as int) as quantity",
            "case p_partkey % 3 when 0 then 'US-East' when 1 then 'US-West' else 'EU-Central' end as warehouse",
            "cast(5 + 5 * (p_partkey % 4) as int) as reorder_level",
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey as id",
            "c_name as name",
            "concat('user', c_custkey, '@example.com') as email",
            "c_custkey % 3 = 0 as email_verified",
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey as id",
            "o_custkey as customer_id",
            "o_orderkey % 200 as product_id",
            "cast(1 + o_orderkey % 3 as int) as quantity",
            "cast(cast(o_totalprice as decimal(12,2)) * 0.002 as decimal(10,2)) as total",
            "case o_custkey % 4 when 0 then 'USD' when 1 then 'EUR' when 2 then 'GBP' else 'JPY' end as currency",
            "o_orderdate as order_date",
            "case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'pending' end as status",
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey as order_id",
            "l_linenumber as line_no",
            "l_partkey as product_id",
            "cast(l_quantity as int) as quantity",
            "cast(l_extendedprice as decimal(10,2)) as line_total",
        )

    @cached_property
    def exchange_rates(self) -> DataFrame:
        return self.spark.sql(SQL_VIEWS["exchange_rates"])

    @cached_property
    def campaigns(self) -> DataFrame:
        return self.spark.sql(SQL_VIEWS["campaigns"])

    @cached_property
    def promotions(self) -> DataFrame:
        return self.products.filter("id % 4 = 0").selectExpr(
            "id",
            "id as product_id",
            "case id % 3 when 0 then 'SPRING SALE' when 1 then 'FLASH SALE' else 'CLEARANCE' end as badge_text",
            "cast(10 + 5 * (id % 11) as decimal(5,2)) as discount_pct",
            "'percentage' as promo_type",
            "id % 12 <> 0 as is_active",
        )

    @cached_property
    def raw_events(self) -> DataFrame:
        return raw_events(self.table("events"))

    @cached_property
    def bronze(self) -> DataFrame:
        return clickstream_bronze(self.table("events"))

    @cached_property
    def reviews(self) -> DataFrame:
        signups = self.raw_events.filter("event_type = 'signup' and product_id is not null")
        return signups.selectExpr(
            "event_id as id",
            "cast(product_id as bigint) as product_id",
            "user_id as customer_id",
            "cast(1 + event_id % 5 as int) as rating",
            "ts as review_date",
        )

    @cached_property
    def carts(self) -> DataFrame:
        added = self.raw_events.filter("event_type = 'add_to_cart' and product_id is not null")
        keyed = added.selectExpr("user_id as customer_id", "cast(product_id as bigint) as product_id", "ts")
        return keyed.groupBy("customer_id", "product_id").agg(
            F.count(F.lit(1)).alias("quantity"), F.max("ts").alias("added_at")
        )

    @cached_property
    def order_changes(self) -> DataFrame:
        return order_changes(self.orders)

    @cached_property
    def query_log(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "case o_orderpriority when '1-URGENT' then 'storefront' when '2-HIGH' then 'checkout' "
            "else 'reporting' end as role",
            "case o_orderkey % 3 when 0 then concat('/* page */ SELECT * FROM orders  WHERE id = ', o_orderkey) "
            "when 1 then concat('SELECT id FROM orders WHERE status = \\'it\\'\\'s ', o_orderstatus, "
            "'\\' AND customer_id IN (', o_custkey, ', ', o_custkey + 1, ') -- by hand') "
            "else concat('UPDATE orders2024 SET total = total - 1.25, rate = -2.5e-3 WHERE id = ', o_orderkey) end as query",
            "cast(o_totalprice as decimal(12,2)) as duration_ms",
        )

    @cached_property
    def operation_log(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_type as operation",
            "case event_id % 10 when 0 then 'Error' when 1 then 'In progress' else 'OK' end as status",
            "cast(value as decimal(12,2)) as duration_ms",
        )

    def tables(self) -> Tables:
        return {
            "customers": self.customers,
            "products": self.products,
            "inventory": self.inventory,
            "orders": self.orders,
            "order_items": self.order_items,
        }
