"""Silver by batches: every delivery is kept, late or a duplicate, however batches are cut or repeated."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.demand import EVENT_KEY, clean_events, silver_events
from millrace.operators.quality import clickstream_rules, keep_valid
from millrace.sources.versions import Versions
from millrace.streaming import silver as sv
from millrace.streaming.runs import file_stream
from tests.conftest import rows
from tests.test_plans import plan


def job_over(spark, shop, folder, lateness=None):
    products = Versions(spark, f"{folder}/products")
    if products.newest() is None:
        products.publish(shop.products)
    return sv.SilverBatches(spark, f"{folder}/out", products, lateness)


def feed(spark, folder, files=None):
    return file_stream(spark, f"{folder}/feed", schemas.BRONZE, files_per_batch=files)


def totals(job):
    return {r.rule: r.rows for r in job.totals().collect()}


@pytest.mark.parametrize("parts", [1, 4])
def test_any_cut_gives_each_event_once(spark, shop, folder, parts):
    bronze = shop.bronze.limit(600)
    for part in bronze.randomSplit([1.0] * parts, seed=parts):
        part.coalesce(1).write.mode("append").parquet(f"{folder}/feed")
    job = job_over(spark, shop, folder)
    job.run(feed(spark, folder, 1), f"{folder}/state")
    expected = rows(silver_events(bronze, shop.products))
    assert rows(job.silver()) == expected and job.late().isEmpty()
    # Delivered again after a restart: all of it duplicates.
    bronze.coalesce(1).write.mode("append").parquet(f"{folder}/feed")
    job_over(spark, shop, folder).run(feed(spark, folder, 1), f"{folder}/state")
    assert rows(job.silver()) == expected
    found, valid = totals(job), keep_valid(bronze, clickstream_rules()).count()
    assert found["delivered"] == 2 * bronze.count()
    assert (found["kept"], found["late"], found["duplicate"]) == (len(expected), 0, 2 * valid - len(expected))
    assert found["valid_product_id"] == 2 * bronze.filter("product_id is null").count()


def test_a_repeated_batch_replaces_itself(spark, shop, folder):
    job = job_over(spark, shop, folder, "5 days")
    clean = clean_events(shop.bronze)
    half = clean.agg(F.min("event_ts")).first()[0] + timedelta(days=15)
    early, rest = clean.filter(F.col("event_ts") < half), clean.filter(F.col("event_ts") >= half)
    batches = [rest, early, shop.bronze]
    for number, batch in enumerate(batches):
        job.handle(batch, number)
    once = rows(job.silver()), rows(job.late()), rows(job.counts())
    job.products.publish(shop.products.withColumn("name", F.lit("renamed")))
    for number in (2, 0, 1, 2):
        job.handle(batches[number], number)
    assert (rows(job.silver()), rows(job.late()), rows(job.counts())) == once
    found = totals(job)
    wrong = shop.bronze.count() - keep_valid(shop.bronze, clickstream_rules()).count()
    assert found["kept"] + found["late"] + found["duplicate"] == found["delivered"] - wrong
    mark = clean.agg(F.max("event_ts")).first()[0] - timedelta(days=5)
    behind = early.filter(F.col("event_ts") < mark).count() + keep_valid(shop.bronze, clickstream_rules()).filter(F.col("event_ts") < mark).count()
    assert found["late"] == behind == job.late().count()
    assert job.silver().select(*EVENT_KEY).distinct().count() == job.silver().count() == found["kept"]


def test_a_batch_without_counts_is_not_seen(spark, shop, folder, monkeypatch):
    job = job_over(spark, shop, folder)
    events = shop.bronze.limit(200)
    with monkeypatch.context() as patch:
        patch.setattr(job, "_count", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            job.handle(events, 0)
    assert job.silver().isEmpty() and job.totals().isEmpty()
    job.handle(events, 0)
    assert rows(job.silver()) == rows(silver_events(events, shop.products))


def test_products_are_those_of_the_batch(spark, shop, folder):
    clean = clean_events(shop.bronze)
    early, later = clean.filter("product_id % 2 = 0"), clean.filter("product_id % 2 = 1")
    job = job_over(spark, shop, folder)
    job.handle(early, 0)
    renamed = shop.products.withColumn("name", F.upper("name"))
    job.products.publish(renamed)
    job.handle(later, 1)
    job.handle(early, 0)  # sees the products it saw before
    expected = rows(silver_events(early, shop.products)) + rows(silver_events(later, renamed))
    assert rows(job.silver()) == sorted(expected, key=str)


def test_only_the_days_of_a_batch_are_compared(spark, shop, folder, capsys):
    job = job_over(spark, shop, folder)
    clean = clean_events(shop.bronze)
    job.handle(clean, 0)
    day = clean.agg(F.min(F.to_date("event_ts"))).first()[0]
    one = clean.filter(F.to_date("event_ts") == F.lit(day)).withColumn("day", F.lit(day))
    unseen = job._unseen(one, 1)
    text = plan(unseen, capsys)
    assert f"= {day}" in text.split("PartitionFilters")[1].splitlines()[0]
    assert unseen.isEmpty()


def test_nothing_and_nothing_valid(spark, shop, folder):
    job = job_over(spark, shop, folder, "1 day")
    assert job.silver().isEmpty() and job.late().isEmpty() and job.totals().isEmpty()
    job.handle(shop.bronze.limit(0), 0)
    job.handle(shop.bronze.filter("product_id is null"), 1)
    found = totals(job)
    assert found["kept"] == found["late"] == found["duplicate"] == 0
    assert found["delivered"] == found["valid_product_id"] == shop.bronze.filter("product_id is null").count()
    with pytest.raises(ValueError):
        sv.SilverBatches(spark, f"{folder}/other", Versions(spark, f"{folder}/none")).handle(shop.bronze, 0)
