"""Mirror, as-of, restore, sync and drift queries."""

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import changes as ch
from millrace.operators import evolve, loyalty
from millrace.plans.registry import query
from millrace.plans.shop import RECOVERY_POINT, Shop
from millrace.session import filed, scratch_dir
from millrace.sources.history import History, moments
from millrace.sources.serving import sync_incremental

_ORDER = "id, customer_id, cast(total as double) as total, status"
LATEST_SQL = f"select {_ORDER} from orders_latest"


def _snapshot(shop: Shop) -> DataFrame:
    return shop.orders.select("id", "customer_id", "total", "status")


def latest(shop: Shop) -> DataFrame:
    nothing = _snapshot(shop).limit(0)
    return ch.apply_changes(nothing, shop.order_changes, "id", "seq")


def then(shop: Shop) -> DataFrame:
    return ch.as_of(shop.order_changes, "id", "seq", "commit_ts", RECOVERY_POINT)


@query(LATEST_SQL)
def orders_latest(shop: Shop):
    return latest(shop)


@query(LATEST_SQL)
def orders_mirror(shop: Shop):
    """The first snapshot, then only what changed after it."""
    later = shop.order_changes.filter(F.col("op") != ch.INSERT)
    return ch.mirror(_snapshot(shop), later, "id", "seq")


@query(f"select {_ORDER} from orders_then")
def orders_as_of(shop: Shop):
    return then(shop)


@query(f"select {_ORDER} from orders_then")
def orders_as_of_state(shop: Shop):
    """The same from the state kept before that moment and the months of the log since."""
    history = History(shop.spark, scratch_dir(shop.spark, "history"), "id", grain="month")
    history.append(shop.order_changes)
    for when in moments(RECOVERY_POINT - timedelta(days=3 * 365), RECOVERY_POINT + timedelta(days=90), timedelta(days=500)):
        history.save_state(when)
    return history.as_of(RECOVERY_POINT)


@query(f"""select {_ORDER} from orders_latest union all
    select {_ORDER} from orders_then where id not in (select id from orders_latest)""")
def orders_restored(shop: Shop):
    return ch.restore_rows(latest(shop), then(shop), "id")


_CHANGES_SQL = """select case when o.id is null then 'insert' when n.id is null then 'delete' else 'update' end as op,
    coalesce(o.id, n.id) as id, n.customer_id, cast(n.total as double) as total, n.status,
    o.customer_id as before_customer_id, cast(o.total as double) as before_total, o.status as before_status
    from orders_then o full outer join orders_latest n on n.id = o.id
    where o.id is null or n.id is null or o.customer_id is distinct from n.customer_id
      or o.total is distinct from n.total or o.status is distinct from n.status"""


@query(_CHANGES_SQL)
def sync_changes(shop: Shop):
    return ch.change_set(then(shop), latest(shop), "id")


@query(_CHANGES_SQL)
def sync_changes_by_digest(shop: Shop):
    """The same for two stored states, through digests of rows and of key ranges."""
    return ch.change_set_by_digest(filed(then(shop)), filed(latest(shop)), "id")


@query(LATEST_SQL)
def sync_triggered(shop: Shop):
    return sync_incremental(then(shop), latest(shop), "id")


@query("""with compared as (
      select case when o.id is not null and n.id is not null and o.customer_id is not distinct from n.customer_id
        and o.total is not distinct from n.total and o.status is not distinct from n.status then 0 else 1 end as changed
      from orders_then o full outer join orders_latest n on n.id = o.id)
    select count(*) as total_rows, cast(sum(changed) as bigint) as changed_rows,
      cast(sum(changed) as double) / count(*) as churn,
      case when cast(sum(changed) as double) / count(*) > 0.1 then 'snapshot' else 'triggered' end as mode
    from compared""")
def sync_mode(shop: Shop):
    return ch.choose_sync_mode(then(shop), latest(shop), "id")


@query("""with logged as (
      select case id % 3 when 0 then 'orders' when 1 then 'customers' else 'inventory' end as table_name, op,
        case when id % 3 = 2 then null else total end as before_total, status as before_status
      from orders_cdc)
    select table_name, count(*) as changes,
      count(*) filter (where op <> 'insert' and (before_total is null or before_status is null)) as without_before_image,
      case when count(*) filter (where op <> 'insert' and (before_total is null or before_status is null)) = 0
        then 'mirrored' else 'skipped' end as outcome
    from logged group by table_name""")
def before_image_report(shop: Shop):
    third = F.col("id") % 3
    logged = shop.order_changes.select(
        F.when(third == 0, "orders").when(third == 1, "customers").otherwise("inventory").alias("table_name"),
        "op",
        F.when(third != 2, F.col("total")).alias("before_total"),
        F.col("status").alias("before_status"),
    )
    return ch.check_before_image(logged, "table_name", ["before_total", "before_status"])


_MIXED_LOG = """logged as (
      select case id % 3 when 0 then 'orders' when 1 then 'customers' else 'inventory' end as table_name, id,
        customer_id, total, status, op, seq, case when id % 3 = 2 then null else total end as before_total,
        status as before_status
      from orders_cdc),
    skipped as (select distinct table_name from logged
      where op <> 'insert' and (before_total is null or before_status is null)),
    newest as (select *, row_number() over (partition by table_name, id order by seq desc) as place from logged)"""


def _mirrored(shop: Shop):
    third = F.col("id") % 3
    log = shop.order_changes.select(
        F.when(third == 0, "orders").when(third == 1, "customers").otherwise("inventory").alias("table_name"),
        "id", "customer_id", "total", "status", "op", "seq",
        F.when(third != 2, F.col("total")).alias("before_total"),
        F.col("status").alias("before_status"),
    )
    return ch.mirror_tables(log, "table_name", "id", "seq", ["before_total", "before_status"])


@query(f"""with {_MIXED_LOG} select table_name, id, customer_id, cast(total as double) as total, status
    from newest where place = 1 and op <> 'delete' and table_name not in (select table_name from skipped)""")
def mirror_guarded(shop: Shop):
    """Three tables out of one log; the one without old rows is left out."""
    return _mirrored(shop)[0]


@query(f"""with {_MIXED_LOG} select n.table_name, count(*) as changes,
      count(*) filter (where op <> 'insert' and (before_total is null or before_status is null)) as without_before_image,
      count(*) filter (where place = 1 and op <> 'delete') as live_rows,
      case when n.table_name in (select table_name from skipped) then 'skipped' else 'mirrored' end as outcome
    from newest n group by n.table_name""")
def mirror_outcome(shop: Shop):
    return _mirrored(shop)[1]


@query("""with figures as (
      select 'orders' as table_name, (select count(*) from orders_then) as before_rows,
        (select coalesce(sum(total), 0) from orders_then) as before_total,
        (select count(*) from orders_latest) as after_rows,
        (select coalesce(sum(total), 0) from orders_latest) as after_total
      union all
      select 'customers', (select count(*) from customers), 0, (select count(*) from customers), 0)
    select table_name, before_rows, cast(before_total as double) as before_total, after_rows,
      cast(after_total as double) as after_total,
      before_rows = after_rows and before_total = after_total as matches from figures""")
def state_reconciliation(shop: Shop):
    before = {"orders": then(shop), "customers": shop.customers}
    after = {"orders": latest(shop), "customers": shop.customers}
    return evolve.reconcile(before, after, {"orders": F.col("total")})


@query("""select 'customers' as table_name, count(*) as rows from customers union all
    select 'products', count(*) from products union all select 'inventory', count(*) from inventory union all
    select 'orders', count(*) from shop_orders union all select 'order_items', count(*) from order_items""")
def table_row_counts(shop: Shop):
    return evolve.table_figures(shop.tables(), {}).select("table_name", "rows")


_BRANCH = """branch as (select cast(id as decimal(20,0)) as id, coalesce(name, '') as name, email,
      cast(loyalty_points as bigint) as loyalty_points from points)"""


@query(f"""with {_BRANCH},
    production_types as (select distinct typeof(id) as id, typeof(name) as name, typeof(email) as email,
      typeof(email_verified) as email_verified from customers),
    branch_types as (select distinct typeof(id) as id, typeof(name) as name, typeof(email) as email,
      typeof(loyalty_points) as loyalty_points from branch),
    production as (
      select 'id' as column_name, id as kind, true as nullable, (select count(id) from customers) as filled from production_types
      union all select 'name', name, true, (select count(name) from customers) from production_types
      union all select 'email', email, true, (select count(email) from customers) from production_types
      union all select 'email_verified', email_verified, true, (select count(email_verified) from customers) from production_types),
    branched as (
      select 'id' as column_name, id as kind, true as nullable, (select count(id) from branch) as filled from branch_types
      union all select 'name', name, false, (select count(name) from branch) from branch_types
      union all select 'email', email, true, (select count(email) from branch) from branch_types
      union all select 'loyalty_points', loyalty_points, false, (select count(loyalty_points) from branch) from branch_types),
    both_sides as (
      select column_name, p.kind as production_type, b.kind as branch_type, p.filled as production_filled, b.filled as branch_filled,
        case when b.kind is null then 'only production' when p.kind is null then 'only branch'
          when p.kind <> b.kind then 'type' when p.nullable <> b.nullable then 'nullable' end as drift
      from production p full join branched b using (column_name))
    select column_name, drift, production_filled, branch_filled,
      replace(replace(lower(production_type), 'varchar', 'string'), 'integer', 'int') as production_type,
      replace(replace(lower(branch_type), 'varchar', 'string'), 'integer', 'int') as branch_type
    from both_sides where drift is not null""")
def schema_drift(shop: Shop):
    """Columns that differ between two states of the customers, and how full each side's are."""
    production = shop.customers
    branch = loyalty.backfill_points(shop.customers.drop("email_verified"), shop.orders)
    branch = branch.withColumn("id", F.col("id").cast("decimal(20,0)")).fillna({"name": ""})
    columns = [evolve.schema_rows(shop.spark, {"customers": df}) for df in (production, branch)]
    side = F.regexp_replace(F.regexp_replace("drift", "only left", "only production"), "only right", "only branch")
    drift = evolve.schema_diff(*columns)
    for label, df in (("production", production), ("branch", branch)):
        fill = evolve.column_fill(df).withColumnRenamed("filled_rows", f"{label}_filled")
        drift = drift.join(fill, "column_name", "left")
    return drift.select(
        "column_name",
        side.alias("drift"),
        "production_filled",
        "branch_filled",
        F.col("left_type").alias("production_type"),
        F.col("right_type").alias("branch_type"),
    )


@query("""select id, name, email, cast(loyalty_points as bigint) as loyalty_points, id % 3 = 0 as email_verified
    from points""")
def migrated_customers(shop: Shop):
    """Two migrations replayed, the second time without effect."""

    def points(tables):
        with_column = evolve.add_column(tables["customers"], "loyalty_points", "bigint", 0)
        return {"customers": loyalty.backfill_points(with_column, tables["orders"])}

    def verified(tables):
        with_column = evolve.add_column(tables["customers"], "email_verified", "boolean", False)
        marked = evolve.update_where(with_column, F.col("id") % 3 == 0, {"email_verified": F.lit(True)})
        return {"customers": marked}

    start = {"customers": shop.customers.drop("email_verified"), "orders": shop.orders}
    done = evolve.apply_migrations(start, [points, verified])
    return evolve.apply_migrations(done, [points, verified])["customers"]


@query("""select id, name, email, email_verified, cast(null as bigint) as loyalty_points from customers
    union all select id, name, email, null, loyalty_points from points""")
def evolved_customers(shop: Shop):
    """A mirror that gets a batch with one new column and one dropped."""
    batch = loyalty.backfill_points(shop.customers.drop("email_verified"), shop.orders)
    return evolve.evolve(shop.customers, batch)
