from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace import functions as f

D = Decimal


def one(spark, column, kinds, *values):
    return spark.createDataFrame([values], kinds).select(column.alias("x")).first().x


def test_sale_price_rounds_half_up_and_passes_null(spark):
    price = f.sale_price(F.col("p"), F.col("d"))
    kinds = "p decimal(10,2), d decimal(5,2)"
    assert one(spark, price, kinds, D("10.01"), D("50")) == D("5.01")
    assert one(spark, price, kinds, D("299.99"), D("15")) == D("254.99")
    assert one(spark, price, kinds, None, D("15")) is None


def test_repriced_starts_from_the_rounded_price(spark):
    new = f.repriced(F.col("p"), F.lit(D("20")), F.lit(D("35")))
    assert one(spark, new, "p decimal(10,2)", D("80.00")) == D("65.00")
    assert one(spark, new, "p decimal(10,2)", D("0.08")) == D("0.07")


def test_effective_price_ignores_missing_and_zero_sale(spark):
    price = f.effective_price(F.col("s"), F.col("p"))
    kinds = "s decimal(10,2), p decimal(10,2)"
    assert one(spark, price, kinds, None, D("9.00")) == D("9.00")
    assert one(spark, price, kinds, D("0.00"), D("9.00")) == D("9.00")
    assert one(spark, price, kinds, D("8.00"), D("9.00")) == D("8.00")


def test_percent_of_nothing_is_null(spark):
    rate = f.percent(F.col("a"), F.col("b"))
    assert one(spark, rate, "a bigint, b bigint", 1, 0) is None
    assert one(spark, rate, "a bigint, b bigint", 1, 8) == D("12.5")
    assert one(spark, rate, "a bigint, b bigint", 1, 3) == D("33.3")


@pytest.mark.parametrize(
    "points, tier", [(0, "Bronze"), (499, "Bronze"), (500, "Silver"), (1500, "Gold"), (2999, "Gold"), (3000, "Platinum")]
)
def test_loyalty_tier(spark, points, tier):
    assert one(spark, f.loyalty_tier(F.col("p")), "p int", points) == tier


@pytest.mark.parametrize(
    "total, label", [("200.00", "normal"), ("200.01", "medium"), ("500.00", "medium"), ("500.01", "high"), (None, "normal")]
)
def test_order_priority(spark, total, label):
    assert one(spark, f.order_priority(F.col("t")), "t decimal(10,2)", total and D(total)) == label


def test_restock_flags_products_without_inventory(spark):
    flag = f.restock_needed(F.col("s"), F.col("r"), F.col("c"))
    kinds = "s bigint, r int, c bigint"
    assert one(spark, flag, kinds, None, None, 1) is True
    assert one(spark, flag, kinds, None, None, 0) is False
    assert one(spark, flag, kinds, 11, 10, 5) is False
    assert one(spark, flag, kinds, 10, 10, 5) is True


def test_display_name(spark):
    name = f.display_name(F.col("n"), F.col("i"))
    assert one(spark, name, "n string, i int", None, 7) == "Product #7"
    assert one(spark, name, "n string, i int", "", 7) == "Product #7"
    assert one(spark, name, "n string, i int", "Lamp", 7) == "Lamp"


def test_before_image_label(spark):
    assert one(spark, f.before_image_label(F.col("c")), "c string", "f") == "full"
    assert one(spark, f.before_image_label(F.col("c")), "c string", "z") is None


@pytest.mark.parametrize(
    "text, name",
    [(" Ann.Lee@Example.com ", "ann_lee_example_com"), ("__a--b__", "a_b"), ("!!!", "user"), ("", "user"), ("ÄB", "b")],
)
def test_safe_name(spark, text, name):
    assert one(spark, f.safe_name(F.col("t")), "t string", text) == name


def test_safe_name_is_cut(spark):
    assert one(spark, f.safe_name(F.col("t"), length=5), "t string", "abcdefgh") == "abcde"


@pytest.mark.parametrize("needle, found", [("50%", True), ("5%0", False), ("a_b", False), ("OFF", True), ("\\", False)])
def test_contains_text_takes_wildcards_literally(spark, needle, found):
    assert one(spark, f.contains_text(F.col("t"), needle), "t string", "50% off axb") is found


def test_contains_backslash(spark):
    assert one(spark, f.contains_text(F.col("t"), "a\\b"), "t string", "xa\\by") is True


def test_strip_nul(spark):
    assert one(spark, f.strip_nul(F.col("t")), "t string", "a\x00b\x00") == "ab"


def test_surrogate_key_of_null(spark):
    kinds = "a string, b string"
    plain = f.surrogate_key([F.col("a"), F.col("b")])
    safe = f.surrogate_key([F.col("a"), F.col("b")], null_safe=True)
    assert one(spark, plain, kinds, "x", None) is None
    assert one(spark, plain, kinds, "ab", "c") == one(spark, plain, kinds, "a", "bc")
    keys = [one(spark, safe, kinds, *v) for v in [("ab", "c"), ("a", "bc"), (None, "abc"), ("abc", None), ("", "abc")]]
    assert len(set(keys)) == 5 and None not in keys


@pytest.mark.parametrize(
    "query, pattern",
    [
        ("SELECT * FROM t WHERE a = 5 AND b = 'x y'", "SELECT * FROM t WHERE a = ? AND b = ?"),
        ("select  1.50\n from t2", "select ? from t2"),
        ("x IN (1, 2,3)", "x IN (?)"),
        ("x IN ('a', 'b')", "x IN (?)"),
    ],
)
def test_query_pattern(spark, query, pattern):
    assert one(spark, f.query_pattern(F.col("q")), "q string", query) == pattern


@pytest.mark.parametrize(
    "text, time",
    [
        ("2026-07-29T10:15:42.123456+00:00", datetime(2026, 7, 29, 10, 15, 42, 123456)),
        ("2026-07-29T12:15:42+02:00", datetime(2026, 7, 29, 10, 15, 42)),
        ("2026-07-29T10:15:42Z", datetime(2026, 7, 29, 10, 15, 42)),
        # Around the hour that New York has twice, and the one it skips.
        ("2026-11-01T05:30:00Z", datetime(2026, 11, 1, 5, 30)),
        ("2026-11-01T06:30:00Z", datetime(2026, 11, 1, 6, 30)),
        ("2026-03-08T02:30:00+00:00", datetime(2026, 3, 8, 2, 30)),
        ("1969-12-31T23:59:59.5Z", datetime(1969, 12, 31, 23, 59, 59, 500000)),
        ("yesterday", None),
        (None, None),
    ],
)
def test_event_time(spark, text, time):
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert one(spark, f.event_time(F.col("t")), "t string", text) == time
            there_and_back = f.event_time(f.iso_text(F.col("t")))
            assert one(spark, there_and_back, "t timestamp_ntz", time) == time
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_sale_end_and_epoch(spark):
    start = datetime(2024, 2, 20, 8)
    assert one(spark, f.sale_end(F.col("t")), "t timestamp_ntz", start) == datetime(2024, 3, 5, 8)
    assert one(spark, f.epoch_seconds(F.col("t")), "t timestamp_ntz", start) == 1708416000


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_event_time_does_not_follow_the_session(spark, zone):
    held = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = [
            one(spark, f.event_time(F.col("t")), "t string", text)
            for text in ("2024-03-10T12:00:00", "2024-03-10 12:00:00Z", "2024-03-10T14:00:00+02:00", "2024-03-10T12:00")
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", held)
    assert {str(t) for t in times} == {"2024-03-10 12:00:00"}
