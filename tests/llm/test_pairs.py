"""Comparing groups where they lie: every pair that is close, whatever the cuts."""

import numpy as np
import pytest

from millrace.llm import graph
from millrace.llm.common import in_units, pairs_within, ship, trees_within


@pytest.mark.parametrize("most", [3, 50])
def test_pairs_within_groups(spark, most):
    ship(spark)
    rng = np.random.default_rng(most)
    # Groups of 1 to 40, one of a third of all rows; names are shared by many groups.
    rows = {(int(k), int(s)) for k in range(60) for s in rng.integers(0, 200, rng.integers(1, 40))}
    rows |= {(7, s) for s in range(400)}
    value = {s: int(rng.integers(0, 4)) for s in range(400)}
    df = spark.createDataFrame([(k, s, value[s]) for k, s in rows], "k long, s long, v long").repartition(7)

    def close(t, later, early):
        return t["v"][later] == t["v"][early]

    found = pairs_within(df, "k", "s", most, close).collect()
    pairs = [(r.a, r.b) for r in found if r.a is not None]
    back = [(r.k, r.s) for r in found if r.a is None]
    assert len(back) == len(set(back)) and all(a > b and value[a] == value[b] for a, b in pairs)
    rest = {k for k, _ in back}
    whole = {k: sorted(s for g, s in rows if g == k) for k, _ in rows}
    assert all(sorted(s for g, s in back if g == k) == whole[k] for k in rest)
    wanted = {(a, b) for k, own in whole.items() if k not in rest for a in own for b in own if a > b and value[a] == value[b]}
    assert wanted == set(pairs)
    assert 7 in rest and all(len(whole[k]) > most for k in rest if k not in (min(rest), max(rest))) or len(rest) < 20


def test_components_of_chains_and_odd_links(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 900), (900, 950), (5000, 5000), (None, 3), (4, None)]
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(201)} | {1000: 900, 900: 900, 950: 900}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def _parts(pairs):
    least = {x: x for pair in pairs for x in pair}
    while any(least[a] != least[b] for a, b in pairs):
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    return least


@pytest.mark.parametrize("most", [9, 50])
def test_trees_connect_what_all_pairs_connect(spark, most):
    ship(spark)
    rng = np.random.default_rng(most)
    rows = {(int(k), int(s)) for k in range(60) for s in rng.integers(0, 200, rng.integers(1, 40))}
    rows |= {(7, s) for s in range(400)}
    value = {s: int(rng.integers(0, 90)) for s in range(400)}
    whole = {k: sorted(s for g, s in rows if g == k) for k, _ in rows}
    given = [(k, s, value[s], -(-len(whole[k]) // most)) for k, s in rows]
    df = spark.createDataFrame(given, "k long, s long, v long, chunks long").repartition(7)

    def close(t, later, early):
        return np.abs(t["v"][later] - t["v"][early]) <= 2

    def same(t, one, two):
        return abs(int(t["v"][one]) - int(t["v"][two])) <= 1

    # One task gives two trees: fewer rows than nodes in each, though the pairs are many.
    wanted = [(a, b) for own in whole.values() for a in own for b in own if a > b and abs(value[a] - value[b]) <= 1]
    one_task = in_units(df, "k", "s").coalesce(1).sortWithinPartitions("k", "low", "high", "s")
    for units in (in_units(df, "k", "s"), one_task):
        found = [tuple(r) for r in trees_within(units, "k", "s", "s", close, same, 64).collect()]
        assert set(found) <= set(wanted)
        assert _parts(found) == _parts(wanted)
    few = [tuple(r) for r in trees_within(one_task, "k", "s", "s", close, same).collect()]
    assert len(few) < 2 * 400 < len(set(wanted))  # the last unit is a portion of its own


def test_trees_as_stars(spark):
    """A chain of close rows comes out as links to its least node, not as a chain."""
    ship(spark)
    df = spark.createDataFrame([(1, s, s // 2, 1) for s in range(100)], "k long, s long, part long, chunks long")
    units = in_units(df, "k", "s")
    close = lambda t, later, early: t["s"][later] - t["s"][early] <= 2
    found = [tuple(r) for r in trees_within(units, "k", "s", "part", close, stars=True).collect()]
    assert len(found) == 49 and {b // 2 for _, b in found} == {0} and {a // 2 for a, _ in found} == set(range(1, 50))
