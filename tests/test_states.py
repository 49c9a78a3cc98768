"""Stored states: change sets by digest, bucketed copies, histories, mirrors, replacement."""

import random
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators import changes as ch
from millrace.operators import quality as q
from millrace.functions import query_pattern
from millrace.session import filed
from millrace.sources import tables
from millrace.sources.history import History, moments
from millrace.sources.serving import ServingCopy, clean_null_bytes, to_serving_schema
from millrace.sources.versions import Versions
from tests.conftest import rows
from tests.test_changes import CHANGES, START, random_log, replay
from tests.test_plans import plan


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# Change sets by digest


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("per_range", [1, 16])
def test_digests_give_the_change_set(spark, seed, per_range):
    chance = random.Random(seed)

    def table():
        keys = chance.sample(range(60), 40)
        data = [
            (k, k % 3, chance.choice(["a", "b", None]), chance.choice([1.5, None]), chance.choice([None, [1], [None, 1]]), chance.choice([None, ("x", None), (None, "x")]))
            for k in keys
        ]
        return spark.createDataFrame(data, "id int, part int, v string, w double, l array<int>, s struct<a:string,b:string>")

    old, new = filed(table()), filed(table())
    key = ["id", "part"]
    assert rows(ch.change_set_by_digest(old, new, key, per_range)) == rows(ch.change_set(old, new, key))
    assert ch.change_set_by_digest(old, old, key, per_range).isEmpty()


def test_a_null_that_moves_is_a_change(spark):
    old = spark.createDataFrame([(1, None, 5), (2, 5, None)], "id int, a int, b int")
    new = spark.createDataFrame([(1, 5, None), (2, 5, None)], "id int, a int, b int")
    assert [(r.op, r.id) for r in ch.change_set_by_digest(old, new, "id").collect()] == [("update", 1)]
    assert ch.choose_sync_mode(old, new, "id").first().changed_rows == 1


def test_change_set_of_nothing(spark):
    some = spark.createDataFrame([(1, "a")], "id int, v string")
    none = some.limit(0)
    assert [(r.op, r.v) for r in ch.change_set_by_digest(none, some, "id").collect()] == [("insert", "a")]
    assert [(r.op, r.before_v) for r in ch.change_set_by_digest(some, none, "id").collect()] == [("delete", "a")]
    assert ch.change_set_by_digest(none, none, "id").isEmpty()


def test_only_uneven_ranges_are_compared(spark):
    old = spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("v"))
    new = old.withColumn("v", F.when(F.col("id") % 1000 == 7, "x").otherwise(F.col("v")))
    was, now = (filed(ch.row_digests(df, "id", ["v"])) for df in (old, new))
    # 40 of 40,000 rows changed: at 16 rows a range, few ranges hold one.
    uneven = ch.uneven_ranges(was, now, 4096)
    assert 0 < uneven.count() <= 40
    assert ch.uneven_ranges(was, was, 4096).isEmpty()
    found = ch.change_set_by_digest(old, new, "id")
    assert found.count() == 40
    assert was.columns == ["id", "_deal", "_d0", "_d1"]


# Copies in buckets


def copy_of(spark, folder, **options):
    copy = ServingCopy(spark, f"{folder}/copy", "id", ignore=["at"], buckets=4, **options)
    copy.load(spark.createDataFrame([(i, f"v{i}") for i in range(50)], "id int, v string"))
    return copy


def test_the_state_is_not_shuffled(spark, folder, no_broadcast, capsys):
    copy = copy_of(spark, folder)
    copy.append_changes(spark.createDataFrame(random_log(3, 60), CHANGES), 0)
    text = plan(copy.versions(), capsys)
    # One exchange, of the changes, to the buckets of the state.
    assert text.count("Exchange\n") == 1 and "REPARTITION_BY_NUM" in text
    assert "Bucketed: true" in text
    copy.compact(0)
    assert "SelectedBucketsCount: 4 out of 4" in plan(copy.versions().join(copy.versions(), "id"), capsys)


def test_maintenance_bounds_what_is_stored(spark, folder):
    copy = copy_of(spark, folder)
    log = random_log(6, 240)
    for number in range(8):
        copy.append_changes(spark.createDataFrame(log[number * 30 : number * 30 + 30], CHANGES), number)
        folded = copy.fold()
        assert folded == (number > 0)
        copy.expire(2)
        kept = [p for p in Path(f"{folder}/copy").iterdir() if p.name.startswith("version=")]
        batches = [p for p in Path(f"{folder}/copy/changes").iterdir() if p.name.startswith("batch=")]
        assert len(kept) <= 2 and len(batches) <= 3
        assert rows(copy.read()) == replay({i: f"v{i}" for i in range(50)}, log[: number * 30 + 30])
    # Numbers go on where folded batches left off.
    copy.bring_to(spark.createDataFrame([(1, "only")], "id int, v string"))
    assert rows(copy.read()) == [(1, "only")]
    with pytest.raises(ValueError):
        copy.expire(0)


def test_the_newest_batch_may_be_repeated_after_a_fold(spark, folder):
    copy = copy_of(spark, folder)
    log = random_log(8, 90)
    parts = [spark.createDataFrame(log[i : i + 30], CHANGES) for i in (0, 30, 60)]
    for number, part in enumerate(parts):
        copy.append_changes(part, number)
    copy.fold()
    copy.append_changes(parts[2], 2)
    assert rows(copy.read()) == replay({i: f"v{i}" for i in range(50)}, log)


def test_marks_of_deleted_keys_go(spark, folder):
    copy = copy_of(spark, folder)
    gone = [(i, None, "delete", 10 + i, START) for i in range(40)]
    copy.append_changes(spark.createDataFrame(gone, CHANGES), 0)
    copy.compact(0)
    assert copy.versions().count() == 50
    copy.compact(0, forget_before=30)
    assert copy.versions().count() == 30 and copy.read().count() == 10
    # A change from before counts as delivered.
    copy.append_changes(spark.createDataFrame([(3, "old", "insert", 12, START), (4, "new", "insert", 99, START)], CHANGES), 1)
    assert copy.read().filter("id < 10").count() == 1


def test_a_copy_is_found_by_another_session(spark, folder):
    copy = copy_of(spark, folder)
    spark.sql(f"DROP TABLE {copy._table(0)}")
    again = ServingCopy(spark, f"{folder}/copy", "id", ignore=["at"])
    assert again.read().count() == 50
    again.append_changes(spark.createDataFrame([(1, "x", "update", 1, START)], CHANGES), 0)
    again.compact(0)
    assert again._current().buckets == 4 and again.read().filter("v = 'x'").count() == 1


# Histories


@pytest.mark.parametrize("grain", ["day", "hour"])
def test_moments_of_a_history(spark, folder, grain):
    log = [(*c[:4], START + timedelta(hours=c[3])) for c in random_log(4, 200)]
    history = History(spark, folder, "id", time="at", grain=grain)
    whole = spark.createDataFrame(log, CHANGES)
    for part in (log[:90], log[90:]):
        history.append(spark.createDataFrame(part, CHANGES))
    history.save_state(START + timedelta(hours=50))
    history.save_state(START + timedelta(hours=120))
    for hours in (0, 49, 50, 51, 119, 130, 500):
        when = START + timedelta(hours=hours)
        assert rows(history.as_of(when)) == rows(ch.as_of(whole, "id", "seq", "at", when))
    with pytest.raises(ValueError):
        history.as_of(START - timedelta(hours=1))


def test_late_changes_outdate_states(spark, folder):
    history = History(spark, folder, "id", time="at")
    history.append(spark.createDataFrame([(1, "a", "insert", 1, START)], CHANGES))
    history.save_state(START + timedelta(days=5))
    late = START + timedelta(days=2)
    history.append(spark.createDataFrame([(1, "b", "update", 2, late)], CHANGES))
    assert rows(history.as_of(START + timedelta(days=6))) == [(1, "b")]
    assert rows(history.as_of(START + timedelta(days=1))) == [(1, "a")]
    history.save_state(START + timedelta(days=5))
    assert rows(history.as_of(START + timedelta(days=6))) == [(1, "b")]
    history.append(spark.createDataFrame([], CHANGES))
    assert rows(history.as_of(START + timedelta(days=6))) == [(1, "b")]


def test_only_the_days_since_the_state_are_read(spark, folder, capsys):
    log = [(i, "v", "insert", i, START + timedelta(days=i)) for i in range(30)]
    history = History(spark, folder, "id", time="at")
    history.append(spark.createDataFrame(log, CHANGES))
    history.save_state(START + timedelta(days=20))
    found = history.as_of(START + timedelta(days=24))
    assert found.count() == 25
    read = [f for f in history._log(START + timedelta(days=20), START + timedelta(days=24)).inputFiles()]
    text = plan(found, capsys)
    assert "PartitionFilters: [isnotnull(span" in text and ">= 2024-01-21" in text and "<= 2024-01-25" in text
    assert read  # the log itself; partitions are pruned when it is scanned


def test_evenly_spaced_moments():
    day = timedelta(days=1)
    assert moments(START, START + 2.5 * day, day) == [START, START + day, START + 2 * day]


# One log, many tables


def test_tables_of_one_log(spark):
    chance = random.Random(1)
    log, expected = [], {}
    for table, whole in (("a", True), ("b", False), ("c", True), ("hot", True)):
        own = random_log(ord(table[0]), 300 if table == "hot" else 60)
        for key, value, op, seq, _ in own:
            before = None if op == "insert" or (not whole and seq == 40) else "was"
            log.append((table, key, value, op if seq != 40 else "update", seq, before if seq != 40 or not whole else "was"))
        if whole:
            fixed = [(k, v, "update" if s == 40 else o, s) for k, v, o, s, _ in own]
            expected[table] = replay({}, fixed)
    chance.shuffle(log)
    df = spark.createDataFrame(log, "t string, id int, v string, op string, seq bigint, before_v string").repartition(5)
    live, report = ch.mirror_tables(df, "t", "id", "seq", ["before_v"])
    assert rows(live) == sorted(((t, *r) for t, own in expected.items() for r in own), key=str)
    outcome = {r.t: (r.outcome, r.without_before_image) for r in report.collect()}
    assert outcome == {"a": ("mirrored", 0), "b": ("skipped", 1), "c": ("mirrored", 0), "hot": ("mirrored", 0)}
    assert {r.t: r.changes for r in report.collect()} == {"a": 60, "b": 60, "c": 60, "hot": 300}


# Versions and replacement


def test_versions(spark, folder):
    held = Versions(spark, folder)
    assert held.newest() is None
    assert [held.publish(spark.range(n)) for n in (3, 5)] == [0, 1]
    assert held.newest() == 1 and held.read(0).count() == 3 and held.read(1).count() == 5
    with pytest.raises(ValueError):
        held.read(2)


def location(spark, name):
    return tables._described(spark, name)["Location"]


def test_replacement_is_one_switch(spark, monkeypatch):
    spark.sql("DROP TABLE IF EXISTS t_switch")
    tables.store_keyed(spark.range(100).withColumn("v", F.lit("old")), "t_switch", "id", 4)
    tables.comment_on(spark, "t_switch", "kept")
    before = location(spark, "t_switch")

    def stop(*_):
        raise RuntimeError("stopped")

    # A stop before the switch leaves the old rows, one after it the new ones.
    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", lambda self, text, run=type(spark).sql: stop() if "SET LOCATION" in text else run(self, text))
        with pytest.raises(RuntimeError):
            tables.overwrite(spark.range(7).withColumn("v", F.lit("new")), "t_switch")
    assert spark.table("t_switch").filter("v = 'old'").count() == 100 and location(spark, "t_switch") == before
    with monkeypatch.context() as patch:
        patch.setattr(tables, "remove_folder", stop)
        with pytest.raises(RuntimeError):
            tables.overwrite(spark.table("t_switch").filter("id < 7").withColumn("v", F.lit("new")), "t_switch")
    assert rows(spark.table("t_switch")) == [(i, "new") for i in range(7)]
    facts = tables._described(spark, "t_switch")
    assert facts["Comment"] == "kept" and facts["Num Buckets"] == "4" and location(spark, "t_switch") != before


def test_replaced_buckets_still_join_without_a_shuffle(spark, no_broadcast, capsys):
    spark.sql("DROP TABLE IF EXISTS t_keyed")
    tables.store_keyed(spark.range(100).withColumn("v", F.lit(1)), "t_keyed", "id", 4)
    tables.overwrite(spark.range(50).select("id", F.lit(2).alias("v"), F.lit("n").alias("more")), "t_keyed")
    joined = spark.table("t_keyed").join(spark.table("t_keyed").withColumnRenamed("v", "w"), "id")
    assert joined.count() == 50 and "Exchange" not in plan(joined, capsys)
    assert spark.table("t_keyed").filter("more = 'n' and v = 2").count() == 50


# Rules, query texts, 0x00


def test_key_rules_share_one_scan(spark, folder, capsys):
    spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, None, None), (3, 9, "c"), (None, 2, "toolong")], "id int, ref int, v string").write.parquet(f"{folder}/t")
    spark.createDataFrame([(1,), (2,), (None,)], "k bigint").write.parquet(f"{folder}/p")
    table, parent = spark.read.parquet(f"{folder}/t"), spark.read.parquet(f"{folder}/p")
    rules = [
        q.Unique(("id",)),
        q.Unique(("id", "v")),
        q.ForeignKey("ref", parent, "k"),
        q.NotNull("ref"),
        q.MaxLength("v", 3),
        q.Check("small", F.col("id") < 3),
        q.Check("never broken", F.lit(True)),
    ]
    report = q.validate(table, rules)
    assert {r.rule: r.violations for r in report.collect()} == {
        "unique id": 2, "unique id, v": 0, "foreign key ref": 1, "not null ref": 1, "length v": 1, "check small": 1, "check never broken": 0,
    }
    text = plan(report, capsys).split("Initial Plan")[0]
    assert text.count("Scan parquet") == 2  # the table and the parent, once each
    assert {r.violations for r in q.validate(table.limit(0), rules).collect()} == {0}


@pytest.mark.parametrize(
    "query, pattern",
    [
        ("select 'it''s' , 'its'", "select ? , ?"),
        ("select * -- a 'quote 5\nfrom t1 where x=-5 and y = +.5e-3", "select * from t1 where x=? and y = ?"),
        ("a - 1 + -2 * (-3)", "a - ? + ? * (?)"),
        ("in (1, 2,  'x''', -4)", "in (?)"),
        ('select "a 1" /* it\'s 5 */ from x2', 'select "a 1" from x2'),
        ("'--no comment' 1e5 12ab v2.5", "? ? 12ab v2?"),
        ("unended 'text 5", "unended 'text ?"),
        ("", ""),
        ("x = '" + "a''" * 5000 + "'", "x = ?"),
    ],
)
def test_literals_are_found_from_left_to_right(spark, query, pattern):
    df = spark.createDataFrame([(query,)], "query string")
    assert df.select(query_pattern(F.col("query"))).first()[0] == pattern


def test_null_bytes_inside_values(spark):
    nul = "x\x00y"
    df = spark.createDataFrame(
        [(nul, [nul, None], {nul: [(nul, 1)]}, (nul, (nul,)), [1]), (None, None, None, None, None)],
        "t string, l array<string>, m map<string,array<struct<a:string,n:int>>>, s struct<b:string,c:struct<d:string>>, i array<int>",
    )
    clean = to_serving_schema(clean_null_bytes(df))
    assert rows(clean) == sorted([("xy", '["xy",null]', '{"xy":[{"a":"xy","n":1}]}', '{"b":"xy","c":{"d":"xy"}}', "[1]"), (None,) * 5], key=str)
    twice = spark.range(1).select(F.create_map(F.lit("k"), F.lit(1), F.lit("k\x00"), F.lit(2)).alias("m"))
    assert clean_null_bytes(twice).first().m == {"k": 2}


