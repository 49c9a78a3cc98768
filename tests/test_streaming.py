"""Streams give what the batch gives, however the feed is cut or repeated."""

import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.changes import apply_changes
from millrace.operators.demand import clean_events, demand_from_silver, silver_events
from millrace.sources.serving import ServingCopy
from millrace.streaming import clickstream as cs
from millrace.streaming.runs import file_stream, run_to_end, to_files
from millrace.streaming.sync import maintain, sync_continuous
from tests.conftest import rows


def silver_run(spark, shop, folder, horizon=None, files=1):
    bronze = file_stream(spark, f"{folder}/feed", schemas.BRONZE, files_per_batch=files)
    return cs.run_silver(bronze, shop.products, f"{folder}/silver", f"{folder}/state", horizon)


@pytest.mark.parametrize("horizon", [None, "90 days"])
@pytest.mark.parametrize("parts", [1, 3])
def test_silver_stream_equals_batch(spark, shop, folder, parts, horizon):
    shop.bronze.repartition(parts).write.parquet(f"{folder}/feed")
    metrics = silver_run(spark, shop, folder, horizon)
    expected = rows(silver_events(shop.bronze, shop.products))
    assert rows(spark.read.parquet(f"{folder}/silver")) == expected
    assert metrics["deliveries"] == shop.bronze.count() and metrics["late"] == 0
    kinds = F.col("event_type").isin(*schemas.EVENT_TYPES)
    assert metrics["valid_event_type"] == shop.bronze.filter(~kinds).count()
    # Deliver a part once more and go on from the checkpoint.
    shop.bronze.limit(300).write.mode("append").parquet(f"{folder}/feed")
    assert silver_run(spark, shop, folder, horizon)["deliveries"] == 300
    assert rows(spark.read.parquet(f"{folder}/silver")) == expected


def test_events_beyond_the_horizon_are_counted(spark, shop, folder):
    clean = clean_events(shop.bronze)
    clean.write.parquet(f"{folder}/feed")
    silver_run(spark, shop, folder, "1 hour")
    late = clean.limit(1).withColumn("event_ts", F.lit("2020-01-01").cast("timestamp_ntz"))
    for _ in range(2):
        late.write.mode("append").parquet(f"{folder}/feed")
        metrics = silver_run(spark, shop, folder, "1 hour")
        assert (metrics["deliveries"], metrics["late"]) == (1, 1)
    assert spark.read.parquet(f"{folder}/silver").count() == clean.count()
    assert spark.conf.get("spark.sql.streaming.numRecentProgressUpdates") == "100"


def test_spread_enrichment_in_a_stream(spark, shop, folder):
    shop.bronze.write.parquet(f"{folder}/feed")
    bronze = file_stream(spark, f"{folder}/feed", schemas.BRONZE)
    silver = cs.silver_stream(bronze, shop.products, spread=4)
    run_to_end(to_files(silver, f"{folder}/silver", f"{folder}/state"))
    assert rows(spark.read.parquet(f"{folder}/silver")) == rows(silver_events(shop.bronze, shop.products))


def test_incremental_gold_equals_full(spark, shop, folder):
    feed = shop.bronze.randomSplit([0.5, 0.5], seed=1)
    for part in feed:
        part.write.mode("append").parquet(f"{folder}/feed")
        silver_run(spark, shop, folder, files=2)
        silver = spark.read.parquet(f"{folder}/silver")
        cs.run_funnel(spark, f"{folder}/silver", silver.schema, f"{folder}/funnel", f"{folder}/funnel_state")
    fresh = cs.refresh_gold_incremental(spark, f"{folder}/funnel", shop.order_items, shop.inventory)
    full = demand_from_silver(spark.read.parquet(f"{folder}/silver"), shop.order_items, shop.inventory)
    assert rows(fresh) == rows(full)


def test_gold_table_is_replaced(spark, shop, folder):
    silver_events(shop.bronze, shop.products).write.parquet(f"{folder}/silver")
    for _ in range(2):
        cs.refresh_gold(spark, f"{folder}/silver", shop.order_items, shop.inventory, "gold_demand")
    full = demand_from_silver(spark.read.parquet(f"{folder}/silver"), shop.order_items, shop.inventory)
    assert rows(spark.table("gold_demand")) == rows(full)


def test_json_ingest_keeps_bad_events_apart(spark, folder):
    good = [{"event_type": "view", "product_id": i, "event_ts": "2026-07-29T10:15:42.000001+00:00"} for i in range(5)]
    bad = [
        "{not json",
        "[]",
        json.dumps({**good[0], "product_id": "x"}),
        json.dumps({"evt": "view"}),
        json.dumps({k: v for k, v in good[0].items() if k != "product_id"}),
        json.dumps({**good[0], "extra": 1}),
    ]
    feed = Path(folder) / "feed"
    feed.mkdir()
    (feed / "1.json").write_text("\n".join([json.dumps(e) for e in good[:3]] + bad))
    target, state = f"{folder}/bronze", f"{folder}/state"
    cs.ingest_json_events(spark, str(feed), schemas.LIVE_EVENTS, target, state)
    (feed / "2.json").write_text("\n".join(json.dumps(e) for e in good[3:]))
    cs.ingest_json_events(spark, str(feed), schemas.LIVE_EVENTS, target, state)
    accepted = cs.accepted_events(spark, target, schemas.LIVE_EVENTS)
    assert sorted(r.product_id for r in accepted.collect()) == [0, 1, 2, 3, 4]
    kept = cs.rejected_events(spark, target, schemas.LIVE_EVENTS)
    assert sorted(r.value for r in kept.collect()) == sorted(bad)
    adapted = cs.adapt_live_events(accepted).collect()
    assert {r.event_ts for r in adapted} == {datetime(2026, 7, 29, 10, 15, 42, 1)}
    assert {r.session_id for r in adapted} == {None}
    named = cs.adapt_live_events(accepted, F.concat(F.lit("s"), F.col("product_id").cast("string")))
    assert named.select("session_id").distinct().count() == 5


def test_json_round_trip(spark):
    events = spark.createDataFrame(
        [("s", "view", 1, datetime(2024, 1, 1, 1, 2, 3, 4)), (None, 'a"b', None, None)], schemas.BRONZE
    )
    texts = cs.event_to_json(events)
    back = cs.event_from_json(texts, schemas.BRONZE_TEXT)
    assert rows(back) == rows(
        spark.createDataFrame([("s", "view", 1, "2024-01-01T01:02:03.000004+00:00"), (None, 'a"b', None, None)], schemas.BRONZE_TEXT)
    )


def test_live_feed_through_silver(spark, shop, folder):
    live = shop.bronze.limit(400).select(
        "event_type", "product_id", F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_ts")
    )
    live.write.parquet(f"{folder}/feed")
    stream = cs.adapt_live_events(file_stream(spark, f"{folder}/feed", schemas.LIVE_EVENTS))
    cs.run_silver(stream, shop.products, f"{folder}/silver", f"{folder}/state")
    expected = silver_events(cs.adapt_live_events(live), shop.products)
    assert rows(spark.read.parquet(f"{folder}/silver")) == rows(expected)


@pytest.mark.parametrize("folding", [False, True])
def test_continuous_sync_over_late_files(spark, shop, folder, folding):
    changes = shop.order_changes
    # Deletions first, inserts last: every file is out of order.
    for op in ("delete", "update", "insert"):
        changes.filter(F.col("op") == op).coalesce(1).write.mode("append").parquet(f"{folder}/feed")
    base = changes.select("id", "customer_id", "total", "status").limit(0)
    log_only = set(changes.columns) - {*base.columns, "seq", "op"}
    copy = ServingCopy(spark, f"{folder}/copy", "id", ignore=sorted(log_only))
    copy.load(base)
    feed = file_stream(spark, f"{folder}/feed", changes.schema, files_per_batch=1)
    sync_continuous(feed, copy, f"{folder}/state")
    if folding:
        assert maintain(copy, keep=1)
    expected = rows(apply_changes(base, changes, "id", "seq"))
    assert rows(copy.read()) == expected
    # Nothing new: nothing changes.  The same changes again: nothing either.
    sync_continuous(feed, copy, f"{folder}/state")
    changes.coalesce(1).write.mode("append").parquet(f"{folder}/feed")
    sync_continuous(feed, copy, f"{folder}/state")
    assert rows(copy.read()) == expected
    if folding:
        assert maintain(copy, keep=1) and rows(copy.read()) == expected


def test_continuous_sync_keeps_up_until_stopped(spark, shop, folder):
    changes = shop.order_changes
    base = changes.select("id", "customer_id", "total", "status").limit(0)
    log_only = set(changes.columns) - {*base.columns, "seq", "op"}
    copy = ServingCopy(spark, f"{folder}/copy", "id", ignore=sorted(log_only))
    copy.load(base)
    changes.filter("op = 'insert'").write.parquet(f"{folder}/feed")
    feed = file_stream(spark, f"{folder}/feed", changes.schema)
    query = sync_continuous(feed, copy, f"{folder}/state", every="1 second")
    try:
        query.processAllAvailable()
        changes.filter("op <> 'insert'").write.mode("append").parquet(f"{folder}/feed")
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(copy.read()) == rows(apply_changes(base, changes, "id", "seq"))


def test_failed_stream_raises(spark, folder):
    spark.range(5).write.parquet(f"{folder}/feed")
    stream = file_stream(spark, f"{folder}/feed", spark.range(1).schema)
    broken = stream.select(F.raise_error(F.lit("stop here")).alias("x"))
    with pytest.raises(Exception, match="stop here"):
        run_to_end(to_files(broken, f"{folder}/out", f"{folder}/state"))
