"""Ranked search, whitening and the inverted multi-index, against plain versions."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import multi_index, ranked, whitening
from millrace.llm.common import ship
from millrace.llm.queries import ORACLE_SQL, QUERIES
from tests.llm import cases
from tools.check import compare, connect

SMALL = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("name", ["op11_ranked_search", "op13_embedding_near_dedup"])
def test_query_matches_sql(spark, name):
    assert compare(spark, connect(SMALL), name, QUERIES[name], ORACLE_SQL[name], SMALL) is None


# Ranked search


def plain_terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain_ranks(documents, items, k):
    """``(item_id, rank) -> (score, doc_ids of that score)`` and how often each document may occur."""
    held = [(d, Counter(plain_terms(t))) for d, t in documents]
    held = [(d, c) for d, c in held if c]
    total, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * n + 1))) for t, n in df.items()}
    asked = defaultdict(set)
    for name, text in items:
        asked[name] |= set(plain_terms(text))
    out = []
    for name, terms in asked.items():
        scored = []
        for d, c in held:
            m = 50 + (50 * sum(c.values()) * total) // length
            score = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(name, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return out


ODD = ["Ab-ab_AB 12é日本 x1", "", None, " ... ", "the", "THE the tHe " * 50, "İstanbul ǅ \x00nul\x7fdel", "word " * 40_000 + "rare"]


def ranked_rows():
    rows = [(r[0], r[1]) for r in cases.some_documents()]
    rows += [(900 + i, t) for i, t in enumerate(ODD)] + [(905, ODD[5]), (None, ODD[0]), (None, ODD[0])]
    rows += [(2000 + i, "the same text again and again") for i in range(300)]  # one large stratum of ties
    items = [(i, t) for i, t in enumerate([*ODD, rows[3][1], rows[9][1] + " the", "same again nowhere", "thekeit eauxle theand"])]
    return rows, [*items, (3, "again"), (None, "same é日本")]


@pytest.mark.parametrize(("k", "block"), [(50, 1 << 18), (3, 20)])
def test_ranks_equal_scoring_everything(spark, k, block):
    ship(spark)
    rows, items = ranked_rows()
    documents = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, m int, score int, term string").repartition(5)
    asked = spark.createDataFrame([(*i, 7) for i in items], "item_id long, text string, doc_id long")
    found = [tuple(r) for r in ranked.top_documents(documents, asked, k, block).collect()]
    assert sorted(found, key=str) == sorted(plain_ranks(rows, items, k), key=str)


def test_strata_below_the_bar_are_not_visited(monkeypatch):
    # Strata 50 to 89 of ten documents each; the item's term occurs often only in the first ones.
    m = np.repeat(np.arange(50, 90), 10)
    n = len(m)
    tfs = np.where(m < 54, 9, 1)
    asked = ranked.Asked(np.array([1], object), np.array([0]), np.array([77]), np.array([1000]), np.array([0]))
    best = ranked.Best(asked, 5)
    visited = ranked.visit(asked, best, m, np.arange(n), np.zeros(n, bool), np.full(n, 77), tfs, np.ones(n, np.int64))
    assert visited == 1 and best.docs[0].tolist() == [0, 1, 2, 3, 4]
    assert best.scores[0].tolist() == [1000 * (9_000_000_000 // (9000 + 1000))] * 5


def test_chunks_are_bounded_and_whole(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ranked, "_POSTINGS", 10)
    monkeypatch.setattr(ranked, "_DOCUMENTS", 4)
    terms = [list(range(x)) for x in (3, 0, 0, 0, 0, 25, 1, 9, 1, 10, 2, 2, 2, 2, 2)]
    batches = [pa.RecordBatch.from_pydict({"m": list(range(len(t))), "doc_id": list(range(len(t))), "terms": pa.array(t, pa.list_(pa.int64()))}) for t in (terms[:6], [], terms[6:])]
    chunks = list(ranked._chunks(iter(batches)))
    assert [x for c in chunks for x in c.column("terms").to_pylist()] == terms
    assert all(c.num_rows <= 4 and (c.num_rows == 1 or sum(map(len, c.column("terms").to_pylist())) <= 10) for c in chunks)


def test_ranks_of_nothing(spark):
    ship(spark)
    none = spark.createDataFrame([], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "a b"), (2, None)], "item_id long, text string")
    some = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert ranked.top_documents(none, asked).collect() == []
    assert ranked.top_documents(some, asked.where("item_id > 2")).collect() == []
    # With one document, N is 1 and a term that all hold weighs floor(1000 ln(4 / 3)).
    assert [tuple(r) for r in ranked.top_documents(some, asked).collect()] == [(1, 1, 1, 287 * (10**9 // (1000 + 2000)))]


# Whitening


def whitened_rows(spark, rows, components=32, kind="float"):
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], f"vec_id long, embedding array<{kind}>, x string, n int").repartition(4)
    usable = whitening.scaled(df)
    fitted = whitening.fit(usable, components)
    return fitted, whitening.identity_error(usable, fitted), [tuple(r) for r in whitening.whitened(usable, fitted).collect()]


def test_whitening_equals_a_plain_decomposition(spark):
    ship(spark)
    rng = np.random.default_rng(2)
    shape = rng.normal(size=(12, 12)) * np.geomspace(0.02, 3, 12)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=12) @ shape]) for i in range(700)]
    rows += [(7, rows[7][1]), (None, rows[8][1])] + [(3000 + i, rows[5][1]) for i in range(300)]
    odd = [(1, None), (2, []), (3, [None] * 12), (4, [float("nan")] * 12), (5, [float("inf")] * 12), (6, [1.0] * 11), (8, [1e30] * 12)]
    fitted, error, found = whitened_rows(spark, rows + odd, 9)
    x = np.floor(64 * np.array([v for _, v in rows])) + 1_000_000
    n, mean = len(x), x.mean(axis=0)
    values, vectors = np.linalg.eigh((x - mean).T @ (x - mean) / n)
    assert fitted.n == n and error < 1e-9 and fitted.sums == x.sum(axis=0).astype(int).tolist()
    assert np.allclose(fitted.eigenvalues, values[::-1][:9], rtol=1e-10) and math.isclose(fitted.trace, values.sum(), rel_tol=1e-10)
    assert np.allclose(np.abs((fitted.components * vectors.T[::-1][:9]).sum(axis=1)), 1, atol=1e-11)
    own = fitted.whiten(x - mean)
    exact = [sum((n * int(a) - s) ** 2 for a, s in zip(row, fitted.sums, strict=True)) for row in x]
    by_id = lambda r: (str(r[0]), r[1])
    expected = sorted(((r[0], d, w) for r, d, w in zip(rows, exact, own, strict=True)), key=by_id)
    found = sorted(found, key=by_id)
    assert [by_id(r) for r in found] == [by_id(r) for r in expected]
    assert np.allclose([r[2] for r in found], [r[2] for r in expected], atol=1e-9)
    assert np.allclose(np.cov(own.T, bias=True), np.eye(9), atol=1e-9)


def test_small_directions_next_to_large_ones(spark):
    ship(spark)
    rng = np.random.default_rng(3)
    # Deviations from 1 to 1e8: their squares do not fit a double next to each other.
    rows = [(i, [float(round(x)) / 64 for x in rng.normal(size=5) * 10.0 ** np.array([0.5, 2, 4, 6, 8])]) for i in range(500)]
    fitted, error, _ = whitened_rows(spark, rows, kind="double")
    x = np.floor(64 * np.array([v for _, v in rows]))
    singular = np.linalg.svd(x - x.mean(axis=0), compute_uv=False)
    assert np.allclose(np.sqrt(fitted.eigenvalues * fitted.n), singular, rtol=1e-7) and error < 1e-4


@pytest.mark.parametrize(("rows", "components"), [
    ([], 0),
    ([(1, [0.5, 1.0])], 0),
    ([(i, [0.5, 1.0]) for i in range(9)], 0),
    ([(1, [0.5, 1.0]), (2, [0.0, 3.0])], 1),
    ([(i, [i / 8, i / 4, 2.0, (i % 3) / 2]) for i in range(40)], 2),
])
def test_whitening_of_few_directions(spark, rows, components):
    ship(spark)
    fitted, error, found = whitened_rows(spark, rows)
    assert len(fitted.eigenvalues) == components and error < 1e-6
    assert sorted(len(w) for _, _, w in found) == [components] * len(rows)
    if components:
        assert math.isclose(sum(fitted.explained), 1, rel_tol=1e-6)


def test_differences_stay_exact():
    x = np.array([[1 << 40, 3], [-(1 << 40), 5]], np.int64)
    n, sums = 10**9, [10**9 * 7 + 1, -(10**12)]
    found = whitening.differences(x, n, sums)
    assert found.tolist() == [[n * int(a) - s for a, s in zip(row, sums, strict=True)] for row in x]


def test_whitening_query(spark):
    rows = QUERIES["op12_embedding_whitening"](spark, SMALL).collect()
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.floor(64 * np.array([r[1] for r in table], np.float64)) + 1_000_000
    n, mean = len(x), x.mean(axis=0)
    values, vectors = np.linalg.eigh((x - mean).T @ (x - mean) / n)
    values, vectors = values[::-1], vectors.T[::-1]
    place = {r[0]: i for i, r in enumerate(table)}
    found = np.zeros((n, 32))
    for r in rows:
        assert r["n"] == n and r["identity_error"] < 1e-8
        assert math.isclose(r["explained"], values[r["component"] - 1] / values.sum(), rel_tol=1e-9)
        found[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
    assert len(rows) == n * 32
    plain = (x - mean) @ (vectors[:32] / np.sqrt(values[:32])[:, None]).T
    signs = np.sign((plain * found).sum(axis=0))
    assert np.allclose(found, plain * signs, atol=1e-8)


# Near-duplicate vectors


def plain_links(rows, cosine=0.93):
    """``(vec_id, n_links, component_id)`` by comparing every pair."""
    use = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    by, out = defaultdict(list), {}
    for i in use:
        by[rows[i][2], len(rows[i][1])].append(i)
    for own in by.values():
        v = np.array([rows[i][1] for i in own], np.float64)
        v /= np.sqrt((v**2).sum(axis=1))[:, None]
        linked = v @ v.T >= cosine
        np.fill_diagonal(linked, True)
        ids = np.array([math.inf if rows[i][0] is None else rows[i][0] for i in own])
        least = np.arange(len(own))
        while True:  # every row takes the least of what it links with, until nothing changes
            now = np.where(linked, least, len(own)).min(axis=1)
            if (now == least).all():
                break
            least = now
        for k, i in enumerate(own):
            out[i] = (int(linked[k].sum()) - 1, ids[least == least[k]].min())
    each = ((r[0], *out.get(i, (0, math.inf if r[0] is None else r[0]))) for i, r in enumerate(rows))
    return Counter((name, links, None if least == math.inf else int(least)) for name, links, least in each)


def vectors_with_families(seed, dim=24):
    """Random vectors, families at many distances, copies and odd rows."""
    rng = np.random.default_rng(seed)
    single = lambda x: [float(y) for y in np.float32(x)]
    rows = [(i, single(rng.normal(size=dim)), int(rng.integers(0, 3))) for i in range(600)]
    at = 1000
    for size, noise in ((120, 0.02), (60, 0.12), (60, 0.25), (40, 0.32), (30, 0.4), (40, 0.0)):
        centre = rng.normal(size=dim)
        for _ in range(size):
            rows.append((at, single(centre + noise * rng.normal(size=dim)), 1))
            at += 1
    rows += [(at + i, single(rng.uniform(0.1, 9) * np.array(rows[i][1])), rows[i][2]) for i in range(30)]  # as long as they like
    odd = [None, [], [0.0] * dim, [None] + [1.0] * (dim - 1), [float("nan")] * dim, [float("inf")] * dim, [1.0, 2.0], [1.0, 2.1], [1.0], [-3.0], [2.0]]
    rows += [(5000 + i, v, 1) for i, v in enumerate(odd)]
    rows += [(5100, rows[0][1], None), (5101, rows[0][1], 99), (None, rows[600][1], 1), (None, rows[0][1], 77), (3, rows[3][1], rows[3][2])]
    return rows


def found_links(spark, rows, **options):
    ship(spark)
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, ball int, class string").repartition(5)
    return Counter(tuple(r) for r in multi_index.near_duplicates(df, **options).collect())


@pytest.mark.parametrize("seed", [1])
def test_links_equal_all_pairs(spark, seed):
    rows = vectors_with_families(seed)
    assert found_links(spark, rows, target=1.0) == plain_links(rows)


def test_recall_with_production_parameters(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(1500, 48))
    away = rng.normal(size=base.shape)
    away -= (away * base).sum(axis=1)[:, None] * base / (base**2).sum(axis=1)[:, None]
    near = math.cos(math.acos(0.931)) * base / np.linalg.norm(base, axis=1)[:, None]
    near += math.sin(math.acos(0.931)) * away / np.linalg.norm(away, axis=1)[:, None]
    # All links as far apart as may be: the hardest ones to meet.
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate([*base, *near])]
    wanted, found = plain_links(rows), found_links(spark, rows)
    total = lambda c: sum(x[1] * n for x, n in c.items())
    assert total(wanted) == 3000 and 0.97 * 3000 <= total(found) <= 3000


def test_hot_cells_are_settled_by_balls(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=32)
    rows = [(i, [float(x) for x in np.float32(centre + 0.05 * rng.normal(size=32))], 5) for i in range(1200)]
    rows += [(9000 + i, [float(x) for x in np.float32(rng.normal(size=32))], 5) for i in range(100)]
    pairs = []
    compared = multi_index._compared
    monkeypatch.setattr(multi_index, "_CHUNK", 300)
    monkeypatch.setattr(multi_index, "_compared", lambda doubtful, *a: pairs.append(doubtful.count()) or compared(doubtful, *a))
    assert found_links(spark, rows) == plain_links(rows)
    assert pairs == [0]  # nothing was left to compare member by member


def test_visits_come_in_multi_sequence_order():
    rng = np.random.default_rng(0)
    unit = multi_index._unit(rng.normal(size=(500, 16)))
    grid = multi_index.learn_grid(unit, 4096, math.acos(0.93))
    first, second = grid.distances(unit[:40])
    for i, cells in enumerate(grid.nearest(unit[:40], 25)):
        sums = (first[i][:, None] + second[i][None]).ravel()
        assert cells.tolist() == np.argsort(sums, kind="stable")[:25].tolist()


def test_links_of_nothing(spark):
    ship(spark)
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert multi_index.near_duplicates(none).collect() == []
    assert found_links(spark, [(1, None, 1), (2, [1.0, 0.0], None)]) == Counter([(1, 0, 1), (2, 0, 2)])
    with pytest.raises(ValueError):
        multi_index.near_duplicates(none, cosine=1.0)
