"""Streaming and sync jobs, run to their end over the given tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import event_time
from millrace.plans.changes import LATEST_SQL
from millrace.plans.clickstream import DEMAND_SQL, SILVER_SQL, product_demand
from millrace.plans.registry import query
from millrace.plans.shop import Shop, clickstream_bronze, raw_events
from millrace.plans.storefront import PROMOTION_UPDATE_SQL, priced, promotion_update
from millrace.schemas import BRONZE_TEXT, INPUTS
from millrace.session import scratch_dir
from millrace.sources.serving import ServingCopy, sync_snapshot, sync_triggered
from millrace.sources.versions import Versions
from millrace.streaming.clickstream import (
    accepted_events,
    event_to_json,
    ingest_json_events,
    refresh_gold_incremental,
    run_funnel,
    run_silver,
)
from millrace.streaming.runs import file_stream
from millrace.streaming.silver import SilverBatches
from millrace.streaming.sync import maintain, sync_continuous


def _stored_silver(shop: Shop, folder: str) -> DataFrame:
    events = file_stream(shop.spark, shop.stream_path("events"), INPUTS["events"])
    run_silver(clickstream_bronze(events), shop.products, f"{folder}/silver", f"{folder}/silver_state")
    return shop.spark.read.parquet(f"{folder}/silver")


@query(SILVER_SQL)
def silver_stream(shop: Shop):
    return _stored_silver(shop, scratch_dir(shop.spark, "silver"))


@query(DEMAND_SQL)
def gold_stream(shop: Shop):
    """Silver and the demand counts, both brought up to date by streams."""
    folder = scratch_dir(shop.spark, "gold")
    silver = _stored_silver(shop, folder)
    run_funnel(shop.spark, f"{folder}/silver", silver.schema, f"{folder}/funnel", f"{folder}/funnel_state")
    return refresh_gold_incremental(shop.spark, f"{folder}/funnel", shop.order_items, shop.inventory)


@query("select session_id, event_type, cast(product_id as bigint) as product_id, event_ts from clickstream_bronze")
def json_ingest_stream(shop: Shop):
    """The feed as JSON files, taken in by the ingest job."""
    folder = scratch_dir(shop.spark, "ingest")
    event_to_json(shop.bronze).write.text(f"{folder}/feed")
    ingest_json_events(shop.spark, f"{folder}/feed", BRONZE_TEXT, f"{folder}/bronze", f"{folder}/state")
    taken_in = accepted_events(shop.spark, f"{folder}/bronze", BRONZE_TEXT)
    return taken_in.withColumn("event_ts", event_time(F.col("event_ts")))


@query(LATEST_SQL)
def continuous_sync_stream(shop: Shop):
    """An empty copy filled by a stream of changes."""
    folder = scratch_dir(shop.spark, "copy")
    changes = shop.order_changes
    changes.write.parquet(f"{folder}/feed")
    base = changes.select("id", "customer_id", "total", "status").limit(0)
    log_only = set(changes.columns) - {*base.columns, "seq", "op"}
    copy = ServingCopy(shop.spark, f"{folder}/copy", "id", ignore=sorted(log_only))
    copy.load(base)
    feed = file_stream(shop.spark, f"{folder}/feed", changes.schema, files_per_batch=4)
    sync_continuous(feed, copy, f"{folder}/state")
    maintain(copy)
    return copy.read()


@query(DEMAND_SQL)
def demand_synced(shop: Shop):
    """The demand table reloaded into a serving copy as a whole."""
    copy = ServingCopy(shop.spark, scratch_dir(shop.spark, "demand"), "product_id")
    sync_snapshot(product_demand(shop), copy)
    return copy.read()


@query(PROMOTION_UPDATE_SQL)
def promotions_synced(shop: Shop):
    """Promotions loaded into a serving copy; then the update's changes only."""
    copy = ServingCopy(shop.spark, scratch_dir(shop.spark, "promotions"), "id")
    sync_snapshot(priced(shop), copy)
    sync_triggered(promotion_update(shop), copy)
    return copy.read()


# The feed in two deliveries: even events, then odd ones and every tenth again.
_EVENT = "concat('sess-', cast(user_id as varchar(20))) as session_id, event_type, product_id, ts as event_ts"
_VALID = "event_type in ('view', 'click', 'add_to_cart') and product_id is not null and event_ts is not null"
_DELIVERIES = f"""first as (select {_EVENT} from raw_events where event_id % 2 = 0),
    second as (select {_EVENT} from raw_events where event_id % 2 = 1 or event_id % 10 = 0)"""
_LATENESS = "10 days"
_MARK = f"(select max(event_ts) - interval {_LATENESS.replace('days', 'day')} from first where {_VALID})"


def _delivered(shop: Shop, lateness: str | None) -> SilverBatches:
    """Two deliveries brought in one after the other; between them all products get other names."""
    folder = scratch_dir(shop.spark, "batches")
    products = Versions(shop.spark, f"{folder}/products")
    job = SilverBatches(shop.spark, f"{folder}/silver", products, lateness)
    parts = ("event_id % 2 = 0", "event_id % 2 = 1 or event_id % 10 = 0")
    names = (F.col("name"), F.upper("name"))
    for condition, name in zip(parts, names, strict=True):
        products.publish(shop.products.withColumn("name", name))
        events = raw_events(shop.table("events")).filter(condition)
        events = events.selectExpr("concat('sess-', user_id) as session_id", "event_type", "product_id", "ts as event_ts")
        events.write.mode("append").parquet(f"{folder}/feed")
        job.run(file_stream(shop.spark, f"{folder}/feed", events.schema), f"{folder}/state")
    return job


@query(f"""with {_DELIVERIES} select session_id, event_type, cast(product_id as bigint) as product_id, event_ts
    from second where {_VALID} and event_ts < {_MARK}""")
def silver_late(shop: Shop):
    """What came more than ten days behind the newest event, kept apart."""
    return _delivered(shop, _LATENESS).late()


@query(f"""with {_DELIVERIES}, early as (select distinct * from first where {_VALID}),
    later as (select distinct * from second where {_VALID} and event_ts >= {_MARK}),
    rules as (select 'delivered' as rule, (select count(*) from first) + (select count(*) from second) as rows
      union all select 'late', (select count(*) from second where {_VALID} and event_ts < {_MARK})
      union all select 'kept', (select count(*) from (select * from early union select * from later))
      union all select 'valid_event_type', (select count(*) from (select * from first union all select * from second)
        where event_type is null or event_type not in ('view', 'click', 'add_to_cart'))
      union all select 'valid_product_id', (select count(*) from (select * from first union all select * from second) where product_id is null)
      union all select 'valid_event_ts', (select count(*) from (select * from first union all select * from second) where event_ts is null))
    select rule, cast(rows as bigint) as rows from rules
    union all select 'duplicate', (select count(*) from (select * from first union all select * from second) where {_VALID})
      - (select sum(rows)::bigint from rules where rule in ('late', 'kept'))""")
def silver_counts(shop: Shop):
    """What became of every delivery, from counts written with each batch."""
    return _delivered(shop, _LATENESS).totals()


@query(f"""with {_DELIVERIES}, early as (select distinct * from first where {_VALID}),
    later as (select distinct * from second where {_VALID} except select * from early)
    select e.session_id, e.event_type, cast(e.product_id as bigint) as product_id, e.event_ts, p.name as product_name, p.category
      from early e left join products p on p.id = e.product_id
    union all select l.session_id, l.event_type, l.product_id, l.event_ts, upper(p.name), p.category
      from later l left join products p on p.id = l.product_id""")
def silver_fresh_products(shop: Shop):
    """Events named by the products as they were when each batch came."""
    return _delivered(shop, None).silver()
