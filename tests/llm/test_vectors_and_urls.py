"""Exact search, URL filters, the registered queries and the pipeline."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import ball_tree, url_trees
from millrace.llm.common import heads, ship, stored
from millrace.llm.queries import ORACLE_SQL, QUERIES, URL_RULES
from tests.llm import cases
from tests.llm.test_documents import plain_targets
from tools.check import compare

SMALL = "/root/testdata/sf0.001"


def plain_top(rows, k):
    use = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in {(i, tuple(v)) for i, v in use if i % 50 == 0}:
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in use if i != q and len(b) == len(a))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("shard_rows", [16_384, 40])
def test_top_k_equals_all_pairs(spark, shard_rows):
    ship(spark)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 8)]) for i in range(600)]
    rows += [(1000 + i, rows[3][1]) for i in range(700)]  # one common vector
    rows += [(2000, None), (2050, [1.0, None] * 4), (2100, [float("nan")] * 8), (2150, [float("inf")] * 8), (None, rows[0][1]), (2200, [1.0, 2.0]), (2201, [0.5, 2.0]), (2250, [])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, v string, shard int")
    found = ball_tree.top_k(ball_tree.quantized(df), F.col("vec_id") % 50 == 0, shard_rows=shard_rows, least_shards=3, block=7)
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == plain_top(single, 5)


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ball_tree.top_k(ball_tree.quantized(df), F.col("vec_id") % 50 == 0).collect() == []


@pytest.mark.parametrize("shards", [1, 2, 3, 8, 33, 1000])
def test_rounds_visit_every_shard_once(shards):
    steps = [step for first, last in ball_tree.rounds(shards) for step in range(first, last + 1)]
    assert steps == list(range(shards)) and len(ball_tree.rounds(shards)) == min(3, shards)


def test_a_higher_bar_opens_fewer_leaves():
    """What a round learns saves the next one work."""
    rng = np.random.default_rng(6)
    points = rng.integers(-99, 99, (6000, 3))
    tree = ball_tree.Tree(points, np.arange(6000))
    opened = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            opened.append(key)
            return np.asarray(super().__getitem__(key))

    def leaves(least):
        opened.clear()
        tree.real = np.asarray(tree.real).view(Counted)
        scores, _ = tree.search(points[:1], np.array([-1]), np.array([least]), 5)
        return len(opened), scores

    low, first = leaves(np.iinfo(np.int64).min)
    high, again = leaves(first[0, -1])
    none, _ = leaves(first[0, 0] + 10**6)
    assert (first == again).all() and none == 0 < high <= low < 6000 / 128


def test_a_tree_is_built_once_for_each_shard(spark):
    """A third of the rows has one id; its rows are in all shards."""
    vec_id = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 10).cast("long")
    df = spark.range(4000).select(vec_id.alias("vec_id"), F.transform(F.sequence(F.lit(1), F.lit(6)), lambda i: F.pmod(F.xxhash64("id", i), F.lit(99))).alias("v"))
    trees = ball_tree.planted(df, 5)
    assert trees.count() == 4000 and trees.where("nodes is not null").count() == 5
    assert {r[0] for r in trees.where("id = 1").groupBy("shard").count().where("count > 200").collect()} == set(range(5))


def test_a_stored_tree_answers_alike():
    rng = np.random.default_rng(5)
    points, ids = rng.integers(-99, 99, (1500, 7)), rng.permutation(1500)
    tree = ball_tree.Tree(points, ids)
    again = ball_tree.Tree.read(tree.points, tree.ids, tree.nodes_as_bytes())
    least = np.full(30, np.iinfo(np.int64).min)
    for one in (tree, again):
        scores, found = one.search(points[:30], ids[:30], least, 4)
        every = points[:30] @ points.T
        every[np.arange(30), np.arange(30)] = np.iinfo(np.int64).min
        order = np.lexsort((np.broadcast_to(ids, every.shape), -every.clip(-(10**9))), axis=1)[:, :4]
        assert (scores == np.take_along_axis(every, order, axis=1)).all() and (found == ids[order]).all()


def test_large_components_stay_exact():
    points = np.array([[2**30, 3], [2**30 + 1, -5], [7, 9]], np.int64)
    tree = ball_tree.Tree(points, np.array([5, 4, 9]))
    scores, ids = tree.search(points[:1], np.array([5]), np.array([-(2**63)]), 2)
    assert ids.tolist() == [[4, 9]] and scores.tolist() == [[2**30 * (2**30 + 1) - 15, 7 * 2**30 + 27]]


URLS = [
    "http://a.example.com/en/1", "https://www.example.com/en/2?x=1&y=2", "HTTP://M.Example.COM/EN/3", "http://example.com/en/", "http://example.com",
    "http://b.net/es/4#f", "http://net/fr/5", "http://x.net/de/6", "http://y.org/en/7?q", "ftp://z.org//a", "no scheme", "", None, "://", "a://b://c/d", "http://com/x", "http://notcom/x",
]


def plain_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max((r.name for r in fits), key=len, default=None)


def test_url_rules(spark):
    df = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(URLS)] + [(0, URLS[0], None, None)], "page_id long, url string, host string, block int")
    rows = url_trees.judged(df, URL_RULES).collect()
    assert len(rows) == len(URLS) + 1
    by_name = {r.name: r.verdict for r in URL_RULES}
    for r in rows:
        assert (r["host"], r["path"], r["rule"]) == plain_url(URLS[r["page_id"]])
        assert r["verdict"] == by_name.get(r["rule"], r["verdict"]) and r["verdict"] in ("allow", "block")


def test_trees_learn_held_out_urls(spark):
    """Trees that saw some labelled URLs judge others like their label."""
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("http://a"), F.col("id").cast("string"), F.lit(".bad/x?a=1&b=2&c="), F.xxhash64("id").cast("string")))
        .otherwise(F.concat(F.lit("http://site.good/about/"), F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 6)))
        .alias("url"),
    )
    rules = [url_trees.rule("block", "bad/"), url_trees.rule("allow", "good/")]
    found = url_trees.judged(pages, rules, sample_rows=300).collect()
    right = sum((r["block_score"] > 0.5) == (r["verdict"] == "block") for r in found)
    assert right >= 0.99 * len(found)


def test_urls_without_labels_are_allowed(spark):
    df = spark.createDataFrame([(1, "http://a.org/x"), (2, None)], "page_id long, url string")
    assert {r["verdict"] for r in url_trees.judged(df, URL_RULES).collect()} == {"allow"}
    assert url_trees.judged(df.limit(0), URL_RULES).collect() == []


def test_heads_finds_whole_groups(spark):
    ship(spark)
    rows = [(k, i, i * 10) for k in range(40) for i in range(k % 7)] + [(100, i, i) for i in range(3000)] + [(7, 0, 0)]
    df = spark.createDataFrame(rows, "k long, o long, v long").repartition(5)
    found = heads(df, "k", ["o"], ["v"]).collect()
    groups = defaultdict(set)
    for k, o, _ in rows:
        groups[k].add(o)
    got = Counter((r["k"], r["o"]) for r in found)
    assert {(k, o) for k, os in groups.items() if len(os) > 1 for o in os} <= set(got)
    assert all(r["head_v"] <= r["v"] and (r["k"] == 100 or r["head_v"] == 0) for r in found)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    import duckdb

    connection = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        connection.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    assert compare(spark, connection, name, QUERIES[name], ORACLE_SQL[name], SMALL) is None


_NOT_BY_ROW = {"pipeline", "op5_line_dedup", "op6_packing", "op7_top_k_search", "op11_ranked_search", "op12_embedding_whitening", "op13_embedding_near_dedup"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - _NOT_BY_ROW))
def test_query_returns_a_row_for_each(spark, name):
    source = "pages" if name.startswith("op1_") else "documents"
    assert QUERIES[name](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/{source}.parquet").count()


def test_pipeline_against_plain_stages(spark, tmp_path_factory):
    """Every stage against a plain version of what it keeps."""
    docs = spark.createDataFrame(
        [(r[0], r[1], r[2] or "en", r[3] or "s", 0) for r in cases.some_documents(80) if r[0] is not None],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    docs = stored(docs.dropDuplicates(["doc_id"]))
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [tuple(r) for r in docs.collect()]
        docs = stored(stage(spark, docs, SMALL))
        after = [tuple(r) for r in docs.collect()]
        assert docs.columns == columns
        ids = {r[0] for r in after}
        if name == "language_id":
            assert {500, 501, 502, 506}.isdisjoint(ids)
            assert len(after) >= 0.9 * sum(any(map(str.isalpha, r[1] or "")) for r in before)
        if name == "line_dedup":
            gone = cases.later_lines(before, 85, 1)
            plain = {}
            for r in before:
                text = "\n".join(x for i, x in enumerate(r[1].split("\n")) if (r[0], i) not in gone)
                if cases.words(text):
                    plain[r[0]] = text
            assert {r[0]: r[1] for r in after} == plain
        if name == "ngram_jaccard_join":
            assert ids == {d for d, _, c in cases.groups(before) if d == c}
        if name == "source_mixing":
            copies = Counter(r[0] for r in after)
            assert max(copies.values()) <= 2 and set(after) <= set(before)
            sizes = [len(cases.words(r[1])) for r in before]
            words = sum(len(cases.words(r[1])) for r in after)
            assert abs(words - 1.5 * sum(sizes)) <= max(sizes)  # one text holds most words here
        kept.append(len(after))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert Counter(p["doc_id"] for p in pieces if p["start"] == 0) == Counter(r["doc_id"] for r in docs.collect())


def test_pipeline_decides_row_by_row(spark):
    """The stages on rows whose ids repeat or are null."""
    stages = dict(corpus_pipeline.STAGES)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(r[0], r[1], r[2] or "en", r[3] or "s", i) for i, r in enumerate(cases.some_documents(80))]
    copy = "\n".join(f"copied line number {i} of some text {i * i}" for i in range(8))
    rows += [(None, "a line of its own here\n" + copy, "en", "s", 1000), (None, "unique first line of another\nsecond one that is kept", "en", "s", 1001)]
    rows += [(None, copy, "en", "s", 1002), (7, copy, "en", "s", 1003), (7, "some other text that shares the id seven", "en", "s", 1004)]
    rows += [(None if i % 3 else 9, " ".join(f"w{i}x{k}" for k in range(5 + i)), "en", f"s{i % 4}", 2000 + i) for i in range(60)]
    docs = stored(spark.createDataFrame(rows, schema).coalesce(1))
    assert [r["n_chars"] for r in docs.collect()] == [r[4] for r in rows]

    # An order of rows that agrees with the ids, so that the plain versions apply.
    order = sorted(range(len(rows)), key=lambda i: (-1 if rows[i][0] is None else rows[i][0], i))
    numbered = [(place, *rows[i][1:]) for place, i in enumerate(order)]
    gone = cases.later_lines(numbered, 85, 1)
    plain = Counter()
    for place, text, *_, name in numbered:
        left = "\n".join(x for i, x in enumerate((text or "").split("\n")) if (place, i) not in gone)
        if cases.words(left):
            plain[name, left] += 1
    found = stages["line_dedup"](spark, docs, SMALL)
    assert found.columns == docs.columns
    assert Counter((r["n_chars"], r["text"]) for r in found.collect()) == plain

    firsts = {c for d, _, c in cases.groups(numbered) if d == c}
    found = stages["ngram_jaccard_join"](spark, docs, SMALL)
    assert found.columns == docs.columns
    assert Counter(r["n_chars"] for r in found.collect()) == Counter(n[4] for n in numbered if n[0] in firsts)

    found = stages["source_mixing"](spark, docs, SMALL)
    assert found.columns == docs.columns
    copies = Counter(r["n_chars"] for r in found.collect())
    sizes = {r[4]: len(cases.words(r[1])) for r in rows}
    assert max(copies.values()) <= 2 and all(sizes[n] for n in copies)
    by = defaultdict(lambda: [0, 0, 0])
    for r in rows:
        by[r[3]][0] += sizes[r[4]]
        by[r[3]][1] += sizes[r[4]] * copies[r[4]]
        by[r[3]][2] = max(by[r[3]][2], sizes[r[4]])
    targets = plain_targets({s: x[0] for s, x in by.items()}, corpus_pipeline.SOURCE_WEIGHTS, 1.5)
    assert all(abs(x[1] - targets[s]) <= x[2] for s, x in by.items())


def test_stages_with_clashing_names(spark):
    """Helper names are not taken from the table's own columns."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, __row int, __GONE string, __often int, __doc string, __copy int, `row` int"
    line = "a line that two documents share word for word"
    rows = [(i, f"{line}\nand a line that only number {i} has {i * i} {i * 7}", "en", "s", 1, 100 + i, "g", 7, "d", i, -i) for i in range(12)]
    docs = stored(spark.createDataFrame(rows, schema))
    stages = dict(corpus_pipeline.STAGES)
    own = lambda r: tuple(r)[4:]
    found = stages["line_dedup"](spark, docs, SMALL)
    assert found.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in found.collect()}
    assert texts[0].startswith(line) and len(texts) == 12 and all(not texts[i].startswith(line) for i in range(1, 12))
    assert sorted(map(own, found.collect())) == sorted(own(r) for r in rows)
    for name in ("ngram_jaccard_join", "source_mixing"):
        found = stages[name](spark, docs, SMALL)
        assert found.columns == docs.columns and {own(r) for r in found.collect()} <= {own(r) for r in rows}


def test_a_stage_deletes_what_earlier_ones_left(spark):
    from pathlib import Path

    rows = [(i, f"line {i} of a text\nshared line of words here", "en", "s", 1) for i in range(8)]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    stages = dict(corpus_pipeline.STAGES)
    lines_out = stages["line_dedup"](spark, docs, SMALL)
    left = [Path(f.removeprefix("file:")) for _, f in corpus_pipeline._LEFT]
    assert left and all(f.exists() for f in left)
    kept = stored(lines_out)
    stages["source_mixing"](spark, kept, SMALL).collect()
    assert not any(f.exists() for f in left) and kept.count() == 8 == docs.count()
    # A stage's input is never deleted, also where it is not written in between.
    lazy = stages["line_dedup"](spark, docs, SMALL)
    assert stages["source_mixing"](spark, lazy, SMALL).count() > 0


@pytest.mark.parametrize("name", ["line_dedup", "ngram_jaccard_join", "source_mixing"])
def test_what_a_stage_leaves_to_run_is_short(spark, name):
    """A job's stages and tasks weigh on the driver, so the last one has few shuffles."""
    rows = [(i, f"line {i} of a text\nshared line of words here", "en", "s", 1) for i in range(8)]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    found = dict(corpus_pipeline.STAGES)[name](spark, docs, SMALL)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall(r"Join|HashAggregate|SortAggregate", plan)) <= 6


def test_similar_documents_go_by_a_short_list(spark, monkeypatch):
    """What the texts are joined with holds the rows that go, not those that stay."""
    rows = [(i, " ".join(f"w{i}-{j}" for j in range(20)), "en", "s", 1) for i in range(40)]
    rows += [(100 + i, rows[i][1], "en", "s", 1) for i in range(3)]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    kept = []
    monkeypatch.setattr(corpus_pipeline, "stored", lambda df: kept.append(stored(df)) or kept[-1])
    found = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, docs, SMALL)
    assert kept[-1].count() == 3
    assert {r["doc_id"] for r in found.collect()} == set(range(40))


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0
