"""Exact top-k by inner product: a ball tree per shard, branch and bound.

Rows are dealt to shards of bounded size by the hash of their place, so an id
with many rows is in all of them.  A shard's tree halves its points until a
leaf is small; each node keeps a centre and a radius, so
``q . centre + |q| * radius`` bounds every score below it.  A tree is built
once and stored with its shard.  A task reads a shard's tree and then lets the
queries go by in blocks, however many there are; at each node only those stay
whose bound reaches their current kth score, and of two children the one with
the higher bound comes first.

The kth score is shared between shards over three rounds: every query is
answered in one shard, its home, then in about the square root of all shards,
then in the rest.  Each round starts from the kth score of all rows found in
the rounds before, which prunes its trees.

Vectors that are null, empty, or hold a null or non-finite component, and rows
without ``vec_id``, take no part.  Vectors of another length than the query's
are no candidates.  A query does not find rows with its own id.  Rows that
repeat are candidates each; queries that repeat are asked once.  Ties go to
the smaller id.  Other columns are not looked at.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import pin

_LEAF = 256
_FOUND = "query_id long, vec_id long, score long"
_EXACT = float(1 << 52)


def quantized(vectors: DataFrame, column: str = "embedding", scale: int = 256) -> DataFrame:
    """``vec_id`` and ``v``: each component's floor after scaling; only usable rows."""
    x = F.col(column)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long")).alias("v"),
    )


class Tree:
    """A ball tree over the rows of a matrix of integers."""

    def __init__(self, points: np.ndarray, ids: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.points, self.ids = points[order], ids[order]
        self._measure()
        self.nodes: list[tuple] = []  # centre, radius, rows, left, right
        self._build(np.arange(len(ids)))
        # Points in the order of the leaves, so that a leaf is a slice.
        order = np.concatenate([node[2] for node in self.nodes if node[2] is not None])
        self.points, self.ids, self.real = self.points[order], self.ids[order], self.real[order]
        at = 0
        for i, (centre, radius, rows, left, right) in enumerate(self.nodes):
            if rows is not None:
                self.nodes[i] = (centre, radius, slice(at, at + len(rows)), left, right)
                at += len(rows)

    def _measure(self) -> None:
        self.real = self.points.astype(np.float64)
        top = float(np.abs(self.real).max(initial=0.0))
        # Products of floats are exact as long as no sum passes 2**52.
        self.limit = _EXACT / max(top * self.points.shape[1], 1.0)

    def nodes_as_bytes(self) -> bytes:
        """The nodes; with the points in order they are the tree."""
        file = io.BytesIO()
        links = [(-1, -1, left, right) if rows is None else (rows.start, rows.stop, -1, -1) for _, _, rows, left, right in self.nodes]
        np.savez(file, centres=np.stack([x[0] for x in self.nodes]), radii=np.array([x[1] for x in self.nodes]), links=np.array(links))
        return file.getvalue()

    @classmethod
    def read(cls, points: np.ndarray, ids: np.ndarray, nodes: bytes) -> Tree:
        tree = cls.__new__(cls)
        tree.points, tree.ids = points, ids
        tree._measure()
        held = np.load(io.BytesIO(nodes))
        tree.nodes = [
            (centre, float(radius), None if left >= 0 else slice(start, stop), left, right)
            for centre, radius, (start, stop, left, right) in zip(held["centres"], held["radii"], held["links"].tolist(), strict=True)
        ]
        return tree

    def _build(self, rows: np.ndarray) -> int:
        own = self.real[rows]
        centre = own.mean(axis=0)
        away = ((own - centre) ** 2).sum(axis=1)
        radius = float(np.sqrt(away.max()))
        here = len(self.nodes)
        self.nodes.append(None)
        left = right = -1
        if len(rows) > _LEAF and radius > 0:
            first = own[away.argmax()]
            far = own[((own - first) ** 2).sum(axis=1).argmax()]
            along = own @ (far - first)
            middle = np.argpartition(along, len(rows) // 2)
            half = len(rows) // 2
            left, right = self._build(np.sort(rows[middle[:half]])), self._build(np.sort(rows[middle[half:]]))
        self.nodes[here] = (centre, radius, rows if left < 0 else None, left, right)
        return here

    def search(self, queries: np.ndarray, own_ids: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of up to ``k`` rows per query, best first, none below ``least``.

        Missing places have the lowest long as their score.
        """
        low = np.iinfo(np.int64).min
        real = queries.astype(np.float64)
        exact = float(np.abs(real).max(initial=0.0)) <= self.limit
        norms = np.sqrt((real**2).sum(axis=1))
        scores = np.full((len(queries), k), low)
        ids = np.full((len(queries), k), np.iinfo(np.int64).max)
        bar = least.copy()

        def bound(node: int, which: np.ndarray) -> np.ndarray:
            centre, radius = self.nodes[node][:2]
            reach = norms[which] * radius
            return real[which] @ centre + reach + 1e-9 * (np.abs(reach) + norms[which] * np.sqrt(centre @ centre)) + 0.5

        stack = [(0, np.arange(len(queries)))]
        while stack:
            node, which = stack.pop()
            which = which[bound(node, which) >= bar[which]]
            if not len(which):
                continue
            _, _, rows, left, right = self.nodes[node]
            if rows is None:
                lower, higher = sorted((left, right), key=lambda x: bound(x, which).sum())
                stack += [(lower, which), (higher, which)]
                continue
            if exact:
                found = np.rint(real[which] @ self.real[rows].T).astype(np.int64)
            else:
                found = queries[which] @ self.points[rows].T
            them = self.ids[rows]
            found[them[None, :] == own_ids[which][:, None]] = low
            keep = (found >= np.maximum(bar[which], low + 1)[:, None]).any(axis=1)
            which, found = which[keep], found[keep]
            if not len(which):
                continue
            all_scores = np.concatenate([scores[which], found], axis=1)
            all_ids = np.concatenate([ids[which], np.broadcast_to(them, found.shape)], axis=1)
            best = np.lexsort((all_ids, -np.maximum(all_scores, low + 1)), axis=1)[:, :k]
            scores[which] = np.take_along_axis(all_scores, best, axis=1)
            ids[which] = np.take_along_axis(all_ids, best, axis=1)
            bar[which] = np.maximum(bar[which], scores[which, k - 1])
        return scores, ids


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _planted(shard: pa.Table) -> pa.Table:
    """A shard's rows in the order of its tree, whose nodes stand in the first row."""
    n = shard.num_rows
    tree = Tree(_matrix(shard.column("v").combine_chunks()), shard.column("vec_id").to_numpy())
    ends = np.arange(n + 1, dtype=np.int32) * tree.points.shape[1]
    columns = {
        "dim": pa.array(np.full(n, tree.points.shape[1], np.int32)),
        "shard": pa.array(shard.column("shard").to_numpy()),
        "place": pa.array(np.arange(n, dtype=np.int32)),
        "id": pa.array(tree.ids),
        "v": pa.ListArray.from_arrays(pa.array(ends), pa.array(tree.points.ravel())),
        "nodes": pa.array([tree.nodes_as_bytes()] + [None] * (n - 1), pa.binary()),
    }
    return pa.table(columns)


def _answered(batches: Iterator[pa.RecordBatch], k: int, block: int) -> Iterator[pa.RecordBatch]:
    """Trees, each followed by the queries that ask it, as rows in order."""
    names = [c.split()[0] for c in _FOUND.split(", ")]
    at, points, ids, nodes, tree = None, [], [], None, None
    for batch in batches:
        marks = np.stack([batch.column(c).to_numpy() for c in ("dim", "shard", "asks")])
        cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            if start == stop:
                continue
            run = batch.slice(start, stop - start)
            if (shard := tuple(marks[:2, start].tolist())) != at:
                at, points, ids, nodes, tree = shard, [], [], None, None
            if not marks[2, start]:
                points.append(_matrix(run.column("v")).copy())
                ids.append(run.column("id").to_numpy().copy())
                nodes = nodes or run.column("nodes")[0].as_py()
                continue
            if tree is None:
                if nodes is None:  # no vector of this length is in the shard
                    continue
                tree = Tree.read(np.concatenate(points), np.concatenate(ids), nodes)
                points, ids = [], []
            for i in range(0, run.num_rows, block):
                some = run.slice(i, block)
                own = some.column("id").to_numpy()
                scores, found = tree.search(_matrix(some.column("v")), own, some.column("least").to_numpy(), k)
                real = scores > np.iinfo(np.int64).min
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, k)[real.ravel()]), pa.array(found[real]), pa.array(scores[real])], names)


def planted(vectors: DataFrame, shards: int) -> DataFrame:
    """The trees, stored: ``dim, shard, place, id, v, nodes``."""
    rows = pin(vectors.select("vec_id", "v", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("row")))
    rows = rows.select("vec_id", "v", "dim", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"))
    trees = rows.groupBy("dim", "shard").applyInArrow(_planted, "dim int, shard int, place int, id long, v array<long>, nodes binary")
    return pin(trees)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, shard_rows: int = 16_384, least_shards: int = 8, block: int = 8_192) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors`` (``vec_id, v``) that are queries.

    A task holds one shard and at most one block of queries at a time, both of
    bounded size.  Runs jobs that count the rows, build and store the trees and
    answer the queries in all rounds but the last.
    """
    vectors = pin(vectors)
    shards = max(least_shards, -(-vectors.count() // shard_rows))
    trees = planted(vectors, shards).select("*", F.lit(0).alias("asks"), F.lit(None).cast("long").alias("least"))
    queries = vectors.where(is_query).dropDuplicates(["vec_id", "v"]).select(F.col("vec_id").alias("query_id"), "v")
    home = F.pmod(F.xxhash64("query_id", "v", F.lit(7)), F.lit(shards)).cast("int")
    queries = pin(queries.select("query_id", "v", F.size("v").alias("dim"), home.alias("home")))

    def answers(asked: DataFrame) -> DataFrame:
        asked = asked.select(
            "dim", "shard", F.lit(0).alias("place"), F.col("query_id").alias("id"), "v", F.lit(None).cast("binary").alias("nodes"),
            F.lit(1).alias("asks"), "least",
        )
        both = trees.unionByName(asked).repartition(shards, "dim", "shard").sortWithinPartitions("dim", "shard", "asks", "place")
        return both.mapInArrow(lambda batches: _answered(batches, k, block), _FOUND)

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def first_k(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    lowest = F.lit(-(2**63)).cast("long")
    # A repeated id may be several queries; their scores are then no bound.
    alone = queries.groupBy("query_id").agg(F.count(F.lit(1)).alias("askers"))
    queries = queries.join(alone, "query_id")
    found = None
    for first, last in rounds(shards):
        asked = queries.withColumn("least", lowest)
        if found is not None:
            shared = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
            kth = F.when((F.col("n") >= k) & (F.col("askers") == 1), F.col("kth"))
            asked = queries.join(shared, "query_id", "left").withColumn("least", F.coalesce(kth, lowest))
        steps = F.explode(F.sequence(F.lit(first), F.lit(last)))
        asked = asked.withColumn("step", steps).withColumn("shard", F.pmod(F.col("home") + F.col("step"), F.lit(shards)))
        more = answers(asked)
        if found is not None:
            more = more.unionByName(found.drop("rank"))
        found = first_k(more)
        if last < shards - 1:
            found = pin(found)
    return found


def rounds(shards: int) -> list[tuple[int, int]]:
    """First and last step from a query's home shard that each round visits."""
    ends = sorted({1, min(shards, 1 + math.isqrt(shards)), shards})
    return [(start, end - 1) for start, end in zip([0, *ends[:-1]], ends, strict=True)]
