"""Ranked lexical search over a length-stratified index.

A document's score for an item is a sum over the item's terms of a weight by
the term's rarity times an impact that depends on two numbers only: how often
the term occurs (``tf``) and the document's normaliser ``m``, a step function
of its length.  So the documents of equal ``m`` form a stratum; within one the
impact of a ``tf`` is computed once, and postings lie by term and ``tf``.

The index is a table sorted by ``m`` and cut into ranges anywhere, so that a
stratum of any size, or one with a third of all documents, is spread over many
tasks.  It holds every document's terms that some item may ask for (a bit table
of fixed size narrows them down, false ones find nothing).  A task reads a
range in chunks of bounded size.  A chunk's strata are visited in the order of
the best bound that any item has there, the bound being the sum of the
weights times the largest impact of each term in the stratum; only the items
whose bound reaches their bar are scored.  The bar is the item's kth score in
this task so far, and never below the kth largest contribution of a single
term over *all* documents, which Spark counts from the postings by term, ``m``
and ``tf`` beforehand.  Both leave out only what cannot be among the first k.

Items are asked in blocks of bounded size, each against the whole index; each
task keeps k rows an item, and the last rank is over those.

Terms are runs of ASCII digits and letters and of all characters beyond ASCII,
A to Z in lower case; they are compared by 64-bit hashes.  All counts are whole
numbers of 64 bits.

Documents without terms (null, empty or other texts) are no documents here:
they add nothing to the counts and are never found.  Items without terms, or
with terms that no document holds, have no rows.  Items that share an
``item_id`` (null is one, too) are one item with the terms of all.  Documents
that repeat count and are ranked each; equal scores go by ``doc_id``, null
last.  Texts of any length are read as a whole; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Words, firsts, lists, marked, marks_of, portions, raw, sorted_within, stored

_GAP = np.ones(256, bool)
_GAP[128:] = False
for _first, _last in (b"09", b"AZ", b"az"):
    _GAP[_first : _last + 1] = False
_INDEXED = "doc_id long, n long, terms array<long>, tfs array<int>"
_FOUND = "item_id long, doc_id long, score long"
_POSTINGS, _DOCUMENTS = 1 << 20, 1 << 13  # of a chunk
_HITS = 1 << 22  # scored together


def terms_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of all texts, by text: hash and count; how many each text has, and its length."""
    words = Words(texts, lower=True, gaps=_GAP)
    order = sorted_within(words.texts, words.hashes)
    hashes, text = words.hashes[order], words.texts[order]
    starts = firsts(text, hashes)
    counts = np.diff(np.append(starts, len(hashes)))
    return hashes[starts], counts, np.bincount(text[starts], minlength=len(texts)), np.bincount(text, minlength=len(texts))


def item_terms(items: DataFrame, key: str = "item_id") -> DataFrame:
    """``item_id, term``, each once, stored."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw(batch.column(1))
            for some in portions(texts):
                hashes, _, many, _ = terms_of([t or b"" for t in texts[some]])
                names = batch.column(0)[some.start : some.stop].take(pa.array(np.repeat(np.arange(len(many)), many)))
                yield pa.RecordBatch.from_arrays([names, pa.array(hashes.view(np.int64))], ["item_id", "term"])

    rows = items.select(F.col(key).cast("long").alias("item_id"), "text")
    return stored(rows.mapInArrow(work, "item_id long, term long").distinct())


def _documents(documents: DataFrame, marks: np.ndarray) -> DataFrame:
    """Every document with terms: its length, and those of its terms that may be asked for."""
    wanted = documents.sparkSession.sparkContext.broadcast(marks)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw(batch.column(1))
            for some in portions(texts):
                hashes, counts, many, n = terms_of([t or b"" for t in texts[some]])
                asked = wanted.value[(hashes & np.uint64(len(wanted.value) - 1)).astype(np.int64)]
                text = np.repeat(np.arange(len(n)), many)[asked]
                held = np.bincount(text, minlength=len(n))
                full = np.flatnonzero(n)
                terms = lists(hashes[asked], held).take(pa.array(full))
                tfs = pa.ListArray.from_arrays(lists(hashes[asked], held).offsets, pa.array(counts[asked].astype(np.int32))).take(pa.array(full))
                names = batch.column(0)[some.start : some.stop].take(pa.array(full))
                yield pa.RecordBatch.from_arrays([names, pa.array(n[full]), terms, tfs], ["doc_id", "n", "terms", "tfs"])

    return stored(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, _INDEXED))


def weight(df: Column, total: int) -> Column:
    """The rarity of a term that ``df`` of ``total`` documents hold."""
    return F.floor(1000 * F.log(F.lit(float(2 * total + 2)) / (2 * df + 1).cast("double"))).cast("long")


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


class Asked:
    """A block of items: for each term those that ask for it, and its weight."""

    def __init__(self, item_ids: np.ndarray, item: np.ndarray, term: np.ndarray, weights: np.ndarray, floors: np.ndarray):
        order = np.argsort(term, kind="stable")
        self.item_ids, self.floors = item_ids, floors
        self.item = item[order]
        starts = firsts(term[order])
        self.terms = term[order][starts]
        self.weights = weights[order][starts]
        self.starts = starts
        self.many = np.diff(np.append(starts, len(order)))

    def places(self, terms: np.ndarray) -> np.ndarray:
        """Numbers of the terms, -1 for those that nobody asks for."""
        at = np.minimum(np.searchsorted(self.terms, terms), max(0, len(self.terms) - 1))
        return np.where(self.terms[at] == terms, at, -1) if len(self.terms) else np.full(len(terms), -1)

    def sums(self, term: np.ndarray, other: np.ndarray, value: np.ndarray, others: int, only: np.ndarray | None = None) -> np.ndarray:
        """For every item (or those picked) and each ``other``, the sum of weight times value over the item's terms.

        The sums are whole numbers far below 2 ** 53, so floats hold them exactly.
        """
        items = len(self.item_ids)
        out = np.zeros(items * others)
        many = self.many[term]
        ends = np.cumsum(many)
        start = 0
        while start < len(term):
            before = int(ends[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + _HITS, "right")))
            own = many[start:end]
            at = np.repeat(self.starts[term[start:end]] - (np.cumsum(own) - own), own) + np.arange(int(own.sum()))
            item = self.item[at]
            cell = item * others + np.repeat(other[start:end], own)
            worth = np.repeat((self.weights[term[start:end]] * value[start:end]).astype(np.float64), own)
            if only is not None:
                keep = only[item]
                cell, worth = cell[keep], worth[keep]
            out += np.bincount(cell, worth, len(out))
            start = end
        return out.reshape(items, others)


class Best:
    """The first ``k`` documents of each item so far."""

    def __init__(self, asked: Asked, k: int):
        self.k, self.floors = k, asked.floors
        n = len(asked.item_ids)
        self.scores = np.zeros((n, k), np.int64)
        self.docs = np.zeros((n, k), np.int64)
        self.nulls = np.zeros((n, k), bool)

    def bars(self) -> np.ndarray:
        """What a score must reach."""
        return np.maximum(np.maximum(self.floors, self.scores[:, -1]), 1)

    def add(self, items: np.ndarray, scores: np.ndarray, docs: np.ndarray, nulls: np.ndarray) -> None:
        """Scores (``items`` by ``docs``) of some items and documents."""
        some = (scores >= self.bars()[items][:, None]).any(axis=1)
        items, scores = items[some], scores[some]
        if not len(items):
            return
        wide = [np.concatenate([held[items], new], axis=1) for held, new in (
            (self.scores, scores), (self.docs, np.broadcast_to(docs, scores.shape)), (self.nulls, np.broadcast_to(nulls, scores.shape)))]
        if wide[0].shape[1] > 8 * self.k:  # the kth score first, so that few are sorted
            kth = -np.partition(-wide[0], self.k - 1, axis=1)[:, self.k - 1]
            columns = (wide[0] >= np.maximum(kth, 1)[:, None]).any(axis=0)
            columns[: self.k] = True
            wide = [x[:, columns] for x in wide]
        order = np.lexsort((wide[1], wide[2], -wide[0]), axis=1)[:, : self.k]
        self.scores[items], self.docs[items], self.nulls[items] = (np.take_along_axis(x, order, axis=1) for x in wide)


def visit(asked: Asked, best: Best, m: np.ndarray, docs: np.ndarray, nulls: np.ndarray, terms: np.ndarray, tfs: np.ndarray, held: np.ndarray) -> int:
    """Some indexed documents, sorted by ``m``, scored stratum by stratum; how many strata were."""
    starts = firsts(m)
    stratum = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(m))))
    doc = np.repeat(np.arange(len(m)), held)
    term = asked.places(terms)
    known = np.flatnonzero(term >= 0)
    term, tf, doc = term[known], tfs[known], doc[known]
    # Postings by stratum, term and tf; an impact for each tf of a stratum.
    order = np.lexsort((tf, term, stratum[doc]))
    term, tf, doc = term[order], tf[order], doc[order]
    of = stratum[doc]
    kinds = firsts(of, tf) if len(of) else np.zeros(0, np.int64)
    kind = np.repeat(np.arange(len(kinds)), np.diff(np.append(kinds, len(of))))
    value = impacts(tf[kinds], m[starts][of[kinds]])[kind]
    groups = firsts(of, term) if len(of) else np.zeros(0, np.int64)
    last = np.append(groups[1:], len(of)) - 1  # the largest tf of each term in a stratum
    bounds = asked.sums(term[groups], of[groups], value[last[: len(groups)]], len(starts))
    edges = np.searchsorted(of, np.arange(len(starts) + 1))
    ends = np.append(starts, len(m))
    visited = 0
    for s in np.argsort(-bounds.max(axis=0, initial=0), kind="stable").tolist():
        active = bounds[:, s] >= best.bars()
        if not active.any():
            continue
        visited += 1
        a, b = edges[s], edges[s + 1]
        first, end = starts[s], ends[s + 1]
        # A stratum of many documents is scored in pieces.
        wide = max(1, _HITS // max(1, len(active)))
        for lo in range(first, end, wide):
            hi = min(end, lo + wide)
            inside = slice(a, b) if (lo, hi) == (first, end) else a + np.flatnonzero((doc[a:b] >= lo) & (doc[a:b] < hi))
            scores = asked.sums(term[inside], doc[inside] - lo, value[inside], hi - lo, active)
            items = np.flatnonzero(active)
            best.add(items, np.rint(scores[items]).astype(np.int64), docs[lo:hi], nulls[lo:hi])
    return visited


def _search(index: DataFrame, asked: Asked, k: int) -> DataFrame:
    """Each task's best rows for a block of items."""
    shared = index.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        best = Best(asked, k)
        for table in _chunks(batches):
            m = table.column("m").to_numpy()
            order = np.argsort(m, kind="stable")  # a task may read several ranges
            table, m = table.take(pa.array(order)), m[order]
            names = table.column("doc_id").combine_chunks()
            nulls = np.array(names.is_null())
            docs = names.fill_null(0).to_numpy()
            terms, tfs = table.column("terms").combine_chunks(), table.column("tfs").combine_chunks()
            held = np.diff(terms.offsets.to_numpy())
            visit(asked, best, m, docs, nulls, terms.flatten().to_numpy(), tfs.flatten().to_numpy(), held)
        real = best.scores > 0
        names = pa.array(asked.item_ids.tolist(), pa.int64()).take(pa.array(np.repeat(np.arange(len(real)), k)[real.ravel()]))
        yield pa.RecordBatch.from_arrays([names, pa.array(best.docs[real], mask=best.nulls[real]), pa.array(best.scores[real])], ["item_id", "doc_id", "score"])

    return index.select("m", "doc_id", "terms", "tfs").mapInArrow(run, _FOUND)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows put together up to a number of documents or of postings, unless one document has more."""
    some: list[pa.RecordBatch] = []
    rows = postings = 0
    for batch in batches:
        many = np.diff(batch.column(2).offsets.to_numpy()) if batch.num_rows else np.zeros(0, np.int64)
        ends = np.cumsum(many)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            end = int(np.searchsorted(ends, before + _POSTINGS - postings, "right"))
            end = min(max(end, start + (not some)), start + _DOCUMENTS - rows, batch.num_rows)
            if end > start:
                some.append(batch.slice(start, end - start))
                rows, postings = rows + end - start, postings + int(ends[end - 1]) - before
            if end < batch.num_rows or rows >= _DOCUMENTS:
                yield pa.Table.from_batches(some)
                some, rows, postings = [], 0, 0
            start = end
    if some:
        yield pa.Table.from_batches(some)


def top_documents(documents: DataFrame, items: DataFrame, k: int = 50, block: int = 1 << 18) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's first ``k`` documents.

    ``block`` bounds the terms of items that are sent to all tasks at once.
    Runs the jobs that store the items' terms and the index, and count.
    """
    wanted = item_terms(items)
    (marks,) = marks_of(wanted, marked(F.col("term"), False))
    found = _documents(documents, marks)
    total, length = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    empty = wanted.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if not total:
        return empty
    m = (F.lit(50).cast("long") + F.expr(f"(50L * n * {total}L) div {length}L")).alias("m")
    spread = F.xxhash64("doc_id", "terms", "tfs")
    held = found.where(F.size("terms") > 0).select(m, "doc_id", "terms", "tfs")
    index = stored(held.repartitionByRange("m", spread).sortWithinPartitions("m"))

    postings = index.select("m", F.explode(F.arrays_zip("terms", "tfs")).alias("p")).groupBy(F.col("p.terms").alias("term"), "m", F.col("p.tfs").alias("tf"))
    postings = postings.agg(F.count(F.lit(1)).alias("docs")).join(wanted.select("term").distinct(), "term")
    postings = stored(postings.withColumn("impact", F.expr("(1000000000L * tf) div (1000L * tf + 20L * m)")))
    df = postings.groupBy("term").agg(F.sum("docs").alias("df"))
    # The impact that at least k documents reach with this term alone.
    running = F.sum("docs").over(Window.partitionBy("term").orderBy(F.desc("impact")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    by_impact = postings.groupBy("term", "impact").agg(F.sum("docs").alias("docs")).withColumn("reached", running)
    kth = by_impact.where(F.col("reached") >= k).groupBy("term").agg(F.max("impact").alias("kth"))
    terms = df.join(kth, "term", "left").select("term", weight(F.col("df"), total).alias("weight"), F.coalesce("kth", F.lit(0)).alias("kth"))
    asks = stored(wanted.join(terms, "term").where("weight > 0").withColumn("of", F.xxhash64("item_id")))

    blocks = max(1, -(-asks.count() // block))
    rows = empty.drop("rank")
    for b in range(blocks):
        some = asks.where(F.pmod("of", F.lit(blocks)) == b).select("item_id", "term", "weight", "kth").toArrow()
        if some.num_rows:
            ids = some.column("item_id").combine_chunks().dictionary_encode(null_encoding="encode")
            item = ids.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            weights = some.column("weight").to_numpy()
            floors = np.zeros(len(ids.dictionary), np.int64)
            np.maximum.at(floors, item, weights * some.column("kth").to_numpy())
            names = np.array(ids.dictionary.to_pylist(), object)
            rows = rows.unionByName(_search(index, Asked(names, item, some.column("term").to_numpy(), weights, floors), k))
    ranked = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
