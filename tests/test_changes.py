"""Change logs, sets and copies: properties on random tables."""

import random
from datetime import datetime, timedelta

import pytest

from millrace.operators import changes as ch
from millrace.operators.changes import merge_versions
from millrace.sources.serving import ServingCopy, load_snapshot, save_snapshot, sync_incremental, sync_snapshot, sync_triggered
from tests.conftest import rows

START = datetime(2024, 1, 1)
CHANGES = "id int, v string, op string, seq bigint, at timestamp_ntz"


def random_log(seed, n=400, hot=0.35):
    """Changes of 30 keys, a third of them of one key; ``seq`` is unique."""
    chance = random.Random(seed)
    log = []
    for seq in range(n):
        key = 0 if chance.random() < hot else chance.randrange(30)
        op = chance.choice(["insert", "update", "update", "delete"])
        log.append((key, chance.choice(["a", "b", None]), op, seq, START + timedelta(minutes=seq)))
    return log


def replay(base, log):
    state = dict(base)
    for key, value, op, *_ in sorted(log, key=lambda c: c[3]):
        if op == "delete":
            state.pop(key, None)
        else:
            state[key] = value
    return sorted(state.items(), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_apply_changes_is_replay_and_repeatable(spark, seed):
    base, log = {1: "x", 2: "y", 99: "z"}, random_log(seed)
    table = spark.createDataFrame(list(base.items()), "id int, v string")
    changes = spark.createDataFrame(random.Random(seed).sample(log, len(log)), CHANGES).repartition(5)
    once = ch.apply_changes(table, changes, "id", "seq")
    assert rows(once) == replay(base, log)
    assert rows(ch.apply_changes(once, changes, "id", "seq")) == rows(once)
    assert rows(ch.mirror(table, changes, "id", "seq")) == rows(once)


def test_delete_wins_an_equal_seq(spark):
    changes = spark.createDataFrame(
        [(1, "a", "insert", 5, START), (1, None, "delete", 5, START), (2, "a", "insert", 1, START), (2, "b", "update", 1, START)],
        CHANGES,
    )
    empty = spark.createDataFrame([], "id int, v string")
    assert rows(ch.apply_changes(empty, changes, "id", "seq")) == [(2, "b")]


def test_columns_missing_from_the_log_become_null(spark):
    base = spark.createDataFrame([(1, "x", 7), (2, "y", 8)], "id int, v string, extra int")
    changes = spark.createDataFrame([(1, "new", "update", 1, START)], CHANGES)
    assert rows(ch.apply_changes(base, changes, "id", "seq")) == [(1, "new", None), (2, "y", 8)]


def test_as_of_includes_the_moment(spark):
    log = random_log(7)
    changes = spark.createDataFrame(log, CHANGES)
    for minutes in (0, 50, 399):
        moment = START + timedelta(minutes=minutes)
        seen = [c for c in log if c[4] <= moment]
        assert rows(ch.as_of(changes, "id", "seq", "at", moment)) == replay({}, seen)


@pytest.mark.parametrize("seed", range(3))
def test_change_set_turns_old_into_new(spark, seed):
    chance = random.Random(seed)

    def table():
        keys = chance.sample(range(40), 25)
        data = [(k, k % 3, chance.choice(["a", "b", None]), chance.choice([1.5, None])) for k in keys]
        return data, spark.createDataFrame(data, "id int, part int, v string, w double")

    (old_rows, old), (new_rows, new) = table(), table()
    changes = ch.change_set(old, new, ["id", "part"])
    assert rows(ch.apply_change_set(old, changes, ["id", "part"])) == rows(new)
    assert rows(sync_incremental(old, new, ["id", "part"])) == rows(new)
    was, now = {r[:2]: r for r in old_rows}, {r[:2]: r for r in new_rows}
    differing = {k for k in was.keys() | now.keys() if was.get(k) != now.get(k)}
    assert {(r.id, r.part) for r in changes.collect()} == differing
    mode = ch.choose_sync_mode(old, new, ["id", "part"]).first()
    assert (mode.total_rows, mode.changed_rows) == (len(was.keys() | now.keys()), len(differing))
    assert ch.change_set(old, old, ["id", "part"]).isEmpty()


@pytest.mark.parametrize("changed, seconds, mode", [(10, False, "triggered"), (11, False, "snapshot"), (0, True, "continuous"), (0, False, "triggered")])
def test_sync_mode(spark, changed, seconds, mode):
    old = spark.range(100).selectExpr("id", "0 as v")
    new = spark.range(100).selectExpr("id", f"if(id < {changed}, 1, 0) as v")
    assert ch.choose_sync_mode(old, new, "id", seconds).first().mode == mode


def test_sync_mode_of_nothing(spark):
    empty = spark.range(0).selectExpr("id", "0 as v")
    found = ch.choose_sync_mode(empty, empty, "id").first()
    assert (found.total_rows, found.churn, found.mode) == (0, 0.0, "triggered")


def test_merge_versions_in_any_order(spark):
    log = random_log(11, 200)
    batches = [log[i::5] for i in range(5)]
    random.Random(1).shuffle(batches)
    state = spark.createDataFrame([], "id int, v string, seq bigint, op string")
    for batch in [*batches, batches[0]]:
        changes = spark.createDataFrame(batch, CHANGES)
        state = spark.createDataFrame(ch.merge_versions(state, changes, "id", "seq").collect(), state.schema)
    live = state.filter("op <> 'delete'").select("id", "v")
    assert rows(live) == replay({}, log)


def test_restore_brings_back_only_what_is_missing(spark):
    live = spark.createDataFrame([(1, "live", "high")], "id int, v string, priority string")
    recovered = spark.createDataFrame([(1, "then", 0), (2, "then", 0)], "id int, v string, dropped int")
    restored = ch.restore_rows(live, recovered, "id")
    assert rows(restored) == [(1, "live", "high"), (2, "then", None)]
    assert rows(ch.restore_rows(restored, recovered, "id")) == rows(restored)


def test_before_image_guard(spark):
    log = spark.createDataFrame(
        [("a", "insert", None), ("a", "update", 1), ("b", "update", 1), ("b", "delete", None), ("c", "insert", None)],
        "t string, op string, before_v int",
    )
    report = {r.t: (r.without_before_image, r.outcome) for r in ch.check_before_image(log, "t", ["before_v"]).collect()}
    assert report == {"a": (0, "mirrored"), "b": (1, "skipped"), "c": (0, "mirrored")}
    assert {r.t for r in ch.with_before_image(log, "t", ["before_v"]).collect()} == {"a", "c"}


def test_copy_reload_changes_and_compaction(spark, folder):
    copy = ServingCopy(spark, f"{folder}/copy", "id", ignore=["at"])
    with pytest.raises(ValueError):
        copy.read()
    base = {1: "x", 2: "y"}
    sync_snapshot(spark.createDataFrame(list(base.items()), "id int, v string"), copy)
    assert rows(copy.read()) == sorted(base.items())
    log = random_log(5, 120)
    batches = [log[i::4] for i in (2, 0, 3, 1)]
    for number, batch in enumerate(batches):
        copy.append_changes(spark.createDataFrame(batch, CHANGES), number)
        if number == 1:
            copy.compact(number)
    assert rows(copy.read()) == replay(base, log)
    # A batch that is delivered again, before or after its compaction.
    for number in (0, 3):
        copy.append_changes(spark.createDataFrame(batches[number], CHANGES), number)
    assert rows(copy.read()) == replay(base, log)
    copy.compact(3)
    assert rows(copy.read()) == replay(base, log)
    # A reload is the whole truth, whatever streamed in before it.
    copy.append_changes(spark.createDataFrame([(5, "e", "insert", 999, START)], CHANGES), 4)
    sync_snapshot(spark.createDataFrame([(7, "only")], "id int, v string"), copy)
    assert rows(copy.read()) == [(7, "only")]
    copy.append_changes(spark.createDataFrame([(8, "e", "insert", 1000, START)], CHANGES), 5)
    assert rows(copy.read()) == [(7, "only"), (8, "e")]


def test_triggered_syncs_follow_the_source(spark, folder):
    copy = ServingCopy(spark, f"{folder}/copy", "id")
    chance = random.Random(8)

    def table():
        keys = chance.sample(range(30), 20)
        return spark.createDataFrame([(k, chance.choice(["a", "b", None])) for k in keys], "id int, v string")

    sync_snapshot(table(), copy)
    for step in range(4):
        source = table()
        sync_triggered(source, copy)
        assert rows(copy.read()) == rows(source)
        if step == 2:
            copy.compact(step)
    sync_triggered(source, copy)
    assert spark.read.parquet(f"{folder}/copy/changes").filter("batch = 4").isEmpty()


def test_unfinished_version_is_not_seen(spark, folder):
    copy = ServingCopy(spark, f"{folder}/copy", "id")
    sync_snapshot(spark.createDataFrame([(1, "a")], "id int, v string"), copy)
    spark.createDataFrame([(9, "half", 0, "insert")], "id int, v string, seq bigint, op string").write.parquet(
        f"{folder}/copy/version=1"
    )
    assert rows(copy.read()) == [(1, "a")]


def test_named_snapshots(spark, folder):
    tables = {"a": spark.range(3), "b": spark.createDataFrame([("x",)], "s string")}
    save_snapshot(tables, "before", folder)
    save_snapshot({"a": spark.range(1)}, "after", folder)
    found = load_snapshot(spark, "before", folder)
    assert {name: rows(df) for name, df in found.items()} == {name: rows(df) for name, df in tables.items()}
    assert load_snapshot(spark, "after", folder)["a"].count() == 1


def _events(spark, *rows, schema="id int, v string, seq bigint, op string"):
    return spark.createDataFrame(list(rows), schema)


def test_a_reload_is_not_undone_by_an_old_change(spark, folder):
    copy = ServingCopy(spark, f"{folder}/copy", "id")
    copy.load(spark.createDataFrame([(1, "v0"), (2, "w")], "id int, v string"))
    change = _events(spark, (1, "v10", 10, "update"), (3, "late", 9, "insert"))
    copy.append_changes(change, 0)
    copy.load(spark.createDataFrame([(1, "v20"), (2, "w")], "id int, v string"))
    copy.append_changes(change, 1)
    assert rows(copy.read()) == [(1, "v20"), (2, "w")]
    copy.append_changes(_events(spark, (1, "v30", 11, "update")), 2)
    assert rows(copy.read()) == [(1, "v30"), (2, "w")]
    sync_snapshot(spark.createDataFrame([(1, "v40")], "id int, v string"), copy, seq=50)
    copy.append_changes(_events(spark, (1, "old", 50, "update"), (2, "old", 12, "insert")), 3)
    copy.compact(3)
    copy.append_changes(_events(spark, (1, "old", 50, "update")), 4)
    assert rows(copy.read()) == [(1, "v40")]


def test_new_columns_reach_the_copy(spark, folder):
    copy = ServingCopy(spark, f"{folder}/copy", "id")
    sync_snapshot(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), copy)
    wide = spark.createDataFrame([(1, "a", 5), (2, "b", None), (3, "c", 6)], "id int, v string, n int")
    sync_triggered(wide, copy)
    assert copy.read().columns == ["id", "v", "n"] and rows(copy.read()) == [(1, "a", 5), (2, "b", None), (3, "c", 6)]
    more = _events(spark, (2, "x", 1, "k", 90, "update"), schema="id int, v string, n int, extra string, seq bigint, op string")
    copy.append_changes(more, 7)
    copy.compact(7)
    assert rows(copy.read()) == [(1, "a", 5, None), (2, "x", 1, "k"), (3, "c", 6, None)]
    with pytest.raises(ValueError, match="lack"):
        sync_triggered(spark.createDataFrame([(1, "a")], "id int, v string"), copy)


def test_folding_changes_takes_two_exchanges(spark):
    state = _events(spark, (1, "a", 1, "insert")).repartition(2)
    changes = _events(spark, (1, "b", 2, "update")).repartition(2)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merge_versions(state, changes, "id", "seq")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert plan.count("Exchange hashpartitioning") <= 2
