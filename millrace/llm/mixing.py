"""Sources mixed to target weights by pivotal dependent rounding.

A source's target is its weight's share of the words wanted, at most ``most``
times what it has; what is above goes to the others by weight until none is
above.  All documents of a source are wanted equally often, say 1.3 times:
once for certain, and once more with probability 0.3.  Documents meet in
pairs and one gives words' worth of its probability to the other, in a random
direction that keeps both expectations, until one of them is certain to be in
or out; the other goes on.  So the words taken stay what they should be.

Pairs meet in a reduction tree.  Documents of a source and a size class (a
power of two) are dealt by hash to blocks of about ``BLOCK``; each block is
folded to one open document, the open ones of ``BLOCK`` blocks to one, and so
on.  The few left of a source, one for each size class, are settled from large
to small, each on the side that keeps the words nearest to the target.  Random
numbers are hashes of ids, so reruns agree.  Rows that are equal in id, size
and source count as one another: they are counted, and each gets a number that
its hashes depend on, so they spread over blocks as other rows do.

Words are runs of characters other than space and 0x09 to 0x0D.  Documents
without words (or with null texts) add nothing and are taken no times.  A null
source is a source of its own.  Rows that repeat count each.  Other columns
are not looked at.  Everything here is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored, unused
from millrace.operators.ordering import number_rows, running_totals

BLOCK = 256
_PIECE = 4096  # equal rows that one task makes of their count at once
_PER_RANGE = 100_000
_ITEM = "struct<doc_id:bigint,size:bigint,nth:bigint,part:double>"
_DONE = "array<struct<doc_id:bigint,size:bigint,up:int>>"


def sized(documents: DataFrame) -> DataFrame:
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "source", words.cast("long").alias("size"))


def by_rank(sources: DataFrame, weights: list[float]) -> DataFrame:
    """``source, source_size, weight``: weights in turn, by code point, null last."""
    parts = sources.count() // _PER_RANGE + 1
    placed = number_rows(sources, [F.col("source").asc_nulls_last()], "place", 0, parts)
    turn = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("place") % len(weights) + 1).cast("int"))
    return placed.select("source", "source_size", turn.alias("weight"))


def targets(weighted: DataFrame, wanted: float, most: float = 2.0) -> DataFrame:
    """``source, source_size, target`` that share ``wanted`` times all words.

    Sources fill up in the order of what they have for their weight, so the
    level at which the others share the rest is found with running sums.
    Runs the jobs that sum and find the level.
    """
    rows = weighted.select("*", (most * F.col("source_size")).alias("cap"))
    rows = rows.withColumn("ratio", F.col("cap") / F.col("weight"))
    n, words, weights = rows.agg(F.count(F.lit(1)), F.sum("source_size"), F.sum("weight")).first()
    if not n:
        return rows.select("source", "source_size", F.col("cap").alias("target"))
    order = [F.col("ratio").asc(), F.col("source").asc_nulls_last()]
    sums = {"caps": F.col("cap"), "weights": F.col("weight")}
    rows = running_totals(rows, [], order, sums, n // _PER_RANGE + 1)
    left = F.lit(float(wanted * words)) - (F.col("caps") - F.col("cap"))
    open_ = F.lit(float(weights)) - F.col("weights") + F.col("weight")
    first = rows.select("ratio", (left / open_).alias("level")).where("level <= ratio")
    level = first.agg(F.min(F.struct("ratio", "level"))["level"]).first()[0]
    target = F.col("cap") if level is None else F.least(F.lit(level) * F.col("weight"), F.col("cap"))
    return rows.select("source", "source_size", target.alias("target"))


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``nth``: equal rows are numbered from 0.

    They are counted and made anew from the count, in pieces when many are
    equal, so no task holds them all.
    """
    counted = stored(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("times")))
    up_to = lambda first, last: F.explode(F.sequence(first, last))
    few = counted.where(F.col("times") <= _PIECE)
    few = few.select(*rows.columns, up_to(F.lit(0).cast("long"), F.col("times") - 1).alias("nth"))
    many = counted.where(F.col("times") > _PIECE)
    many = many.withColumn("piece", up_to(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / _PIECE)))
    last = F.least(F.col("times"), (F.col("piece") + 1) * _PIECE) - 1
    many = many.repartition("doc_id", "size", "piece").select(*rows.columns, up_to(F.col("piece") * _PIECE, last).alias("nth"))
    return few.unionByName(many)


def _meet(state: Column, item: Column, salt: int) -> Column:
    """The open document of ``state`` meets ``item``."""
    a, b = state["open"], item
    has_a, has_b = a["part"] * a["size"], b["part"] * b["size"]
    room_a, room_b = (1 - a["part"]) * a["size"], (1 - b["part"]) * b["size"]
    to_a, to_b = F.least(room_a, has_b), F.least(has_a, room_b)
    chance = F.pmod(F.xxhash64(a["doc_id"], b["doc_id"], a["size"], b["size"], a["nth"], b["nth"], F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
    give_a = chance * (to_a + to_b) < to_b
    # Who is certain afterwards; the other keeps the rest of both.
    a_settled = F.when(give_a, room_a <= has_b).otherwise(has_a <= room_b)
    up = F.when(a_settled, give_a).otherwise(~give_a).cast("int")
    rest = F.when(
        a_settled,
        F.struct(b["doc_id"].alias("doc_id"), b["size"].alias("size"), b["nth"].alias("nth"), ((has_a + has_b - F.when(give_a, a["size"]).otherwise(0)) / b["size"]).alias("part")),
    ).otherwise(
        F.struct(a["doc_id"].alias("doc_id"), a["size"].alias("size"), a["nth"].alias("nth"), ((has_a + has_b - F.when(give_a, 0).otherwise(b["size"])) / a["size"]).alias("part"))
    )
    settled = F.struct(
        F.when(a_settled, a["doc_id"]).otherwise(b["doc_id"]).alias("doc_id"),
        F.when(a_settled, a["size"]).otherwise(b["size"]).alias("size"),
        up.alias("up"),
    )
    first = a.isNull()
    return F.struct(
        F.when(first, item).otherwise(rest).cast(_ITEM).alias("open"),
        F.when(first, state["done"]).otherwise(F.concat(state["done"], F.array(settled))).cast(_DONE).alias("done"),
    )


def _folded(items: DataFrame, by: list[str], salt: int) -> DataFrame:
    """Each group of ``item`` s folded to one open document; groups are small."""
    start = F.struct(F.lit(None).cast(_ITEM).alias("open"), F.array().cast(_DONE).alias("done"))
    listed = items.groupBy(*by).agg(F.sort_array(F.collect_list("item")).alias("items"))
    return listed.select(*by, F.aggregate("items", start, lambda state, item: _meet(state, item, salt)).alias("f"))


def _last(open_: DataFrame) -> DataFrame:
    """The open documents of each source settled from large to small."""
    listed = F.sort_array(F.collect_list(F.struct((-F.col("item.size")).alias("order"), F.col("item.doc_id").alias("doc_id"), F.col("item.part").alias("part"))))
    start = F.struct(F.lit(0.0).alias("over"), F.array().cast(_DONE).alias("done"))

    def settle(state: Column, x: Column) -> Column:
        size = -x["order"]
        more, less = state["over"] + (1 - x["part"]) * size, state["over"] - x["part"] * size
        up = F.abs(more) < F.abs(less)
        done = F.struct(x["doc_id"].alias("doc_id"), size.alias("size"), up.cast("int").alias("up"))
        return F.struct(
            F.when(up, more).otherwise(less).cast("double").alias("over"),
            F.concat(state["done"], F.array(done)).cast(_DONE).alias("done"),
        )

    return open_.groupBy("source").agg(listed.alias("items")).select("source", F.aggregate("items", start, settle)["done"].alias("done"))


def mixed(documents: DataFrame, weights: list[float], wanted: float = 1.5, most: float = 2.0, block: int = BLOCK) -> DataFrame:
    """``doc_id, size, source, source_size, target, copies`` for every row.

    Runs the jobs that store sizes, count blocks and store each tree level.
    """
    rows = stored(sized(documents))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = stored(targets(by_rank(sources, weights), wanted, most))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    recipe = sources.select(F.col("source").alias("from"), "source_size", "target", F.floor(rate).alias("sure"), (rate - F.floor(rate)).alias("part"))
    every = rows.join(recipe, rows["source"].eqNullSafe(recipe["from"])).drop("from")
    class_ = F.floor(F.log2(F.col("size").cast("double"))).cast("int")
    unsure = _numbered(every.where("size > 0 and part > 0").select("source", "doc_id", "size", "part")).select(
        "source",
        class_.alias("class"),
        F.pmod(F.xxhash64("doc_id", "size", "nth", F.lit(11)), F.lit(1 << 40)).alias("place"),
        F.struct("doc_id", "size", "nth", "part").cast(_ITEM).alias("item"),
    )
    n = unsure.groupBy("source", "class").count().agg(F.max("count")).first()[0] or 0
    # A block is a range of the hash; one of the next level is a range of blocks.
    levels = 1
    while block**levels < n:
        levels += 1
    done = []
    open_ = unsure
    for level in range(levels - 1, -1, -1):
        width = max(1, (1 << 40) // max(1, -(-n // block ** (levels - level))) + 1) if level else 1 << 40
        groups = open_.withColumn("group", F.floor(F.col("place") / width))
        found = stored(_folded(groups, ["source", "class", "group"], level))
        done.append(found.select("source", F.explode("f.done").alias("d")))
        open_ = found.select("source", "class", (F.col("group") * width).alias("place"), F.col("f.open").alias("item"))
    done.append(_last(open_).select("source", F.explode("done").alias("d")))
    settled = done[0]
    for part in done[1:]:
        settled = settled.unionByName(part)
    settled = settled.select("source", "d.doc_id", "d.size", "d.up")
    settled = settled.join(recipe, settled["source"].eqNullSafe(recipe["from"]))
    settled = settled.select("doc_id", "size", "source", "source_size", "target", (F.col("sure") + F.col("up")).cast("int").alias("copies"))
    sure = every.where("not (size > 0 and part > 0)")
    copies = F.when(F.col("size") > 0, F.col("sure")).otherwise(0).cast("int")
    return settled.unionByName(sure.select("doc_id", "size", "source", "source_size", "target", copies.alias("copies")))


def taken(documents: DataFrame, copies: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents, each as often as it is taken, columns as they were.

    The ``doc_id`` of ``copies`` is the documents' ``key``.  Rows that share
    one are taken as often as the most taken of them.
    """
    doc, times, copy = (unused(documents.columns, name) for name in ("__doc", "__often", "__copy"))
    often = stored(copies.where("copies > 0").groupBy(F.col("doc_id").alias(doc)).agg(F.max("copies").alias(times)))
    both = documents.join(often, documents[key].eqNullSafe(often[doc]))
    repeated = both.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
    return repeated.select(*(documents[c] for c in documents.columns))
