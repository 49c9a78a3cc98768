"""Loyalty, currency, campaign and priority queries."""

from millrace.operators import finance, loyalty
from millrace.plans.registry import query
from millrace.plans.shop import NOW, Shop


@query("select id, name, email, email_verified, loyalty_points from points")
def loyalty_points(shop: Shop):
    return loyalty.backfill_points(shop.customers, shop.orders)


@query("select email, tier, enrolled_at, total_earned from members")
def loyalty_members(shop: Shop):
    return loyalty.enroll_members(loyalty_points(shop), NOW)


@query("""select k.id, k.name, b.tier, k.loyalty_points from members b join points k on k.email = b.email
    order by k.loyalty_points desc, k.id limit 10""")
def loyalty_leaderboard(shop: Shop):
    return loyalty.leaderboard(loyalty_points(shop))


@query("""select o.id, k.name as customer, p.name as product, cast(o.quantity as bigint) as quantity,
    cast(o.total as double) as total, o.currency, cast(r.rate_to_usd as double) as rate_to_usd,
    cast(round(o.total * r.rate_to_usd, 2) as double) as total_usd
    from shop_orders o join customers k on k.id = o.customer_id join products p on p.id = o.product_id
    join exchange_rates r on r.currency_code = o.currency""")
def orders_usd(shop: Shop):
    return finance.orders_usd(shop.orders, shop.customers, shop.products, shop.exchange_rates)


@query("""select r.currency_code, r.currency_name, cast(r.rate_to_usd as double) as rate_to_usd, count(o.id) as orders
    from exchange_rates r left join shop_orders o on o.currency = r.currency_code
    group by r.currency_code, r.currency_name, r.rate_to_usd""")
def exchange_rate_list(shop: Shop):
    return finance.rate_usage(shop.exchange_rates, shop.orders)


@query("""select o.id, o.customer_id, o.product_id, cast(o.quantity as bigint) as quantity,
    cast(o.total as double) as total, o.order_date, o.status, cast(r.id as bigint) as currency_id
    from shop_orders o left join exchange_rates r on r.currency_code = o.currency""")
def currency_migration(shop: Shop):
    return finance.migrate_currency(shop.orders, shop.exchange_rates)


@query("""with indexed as (
      select campaign, utm_source, row_number() over (order by campaign) - 1 as share,
        (select count(*) from campaigns) as n from campaigns)
    select c.campaign, c.utm_source, count(o.id) as attributed_orders,
      cast(sum(o.total) as double) as attributed_revenue
    from shop_orders o join indexed c on o.customer_id % c.n = c.share group by c.campaign, c.utm_source""")
def attribution(shop: Shop):
    return finance.attribution(shop.orders, shop.campaigns)


_PRIORITY = "case when total > 500 then 'high' when total > 200 then 'medium' else 'normal' end"


@query(f"""select id, customer_id, product_id, cast(quantity as bigint) as quantity, cast(total as double) as total,
    currency, order_date, status, {_PRIORITY} as priority from shop_orders""")
def order_priority(shop: Shop):
    return loyalty.with_priority(shop.orders)


@query(f"""select {_PRIORITY} as priority, count(*) as orders,
    round(cast(sum(total) as double) / count(*), 2) as avg_total from shop_orders group by 1""")
def priority_distribution(shop: Shop):
    return loyalty.priority_distribution(shop.orders)


@query("select id % 3 = 0 as email_verified, count(*) as customers from customers group by 1")
def email_verified_counts(shop: Shop):
    return loyalty.verified_counts(loyalty.verify_every_third(shop.customers.drop("email_verified")))
