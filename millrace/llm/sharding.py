"""Shards of nearly equal bytes that keep equal texts together.

Longest processing time first: units sorted by size go, one after the other,
to the least-loaded shard, found with a heap.  A unit is a group of equal
texts that is large (at least ``1 / (shards * fineness)`` of all bytes; so
there are at most ``shards * fineness`` of them), or one of
``shards * fineness`` hash bundles of all smaller groups.  So the schedule is
over a bounded list, however many documents there are, and no group is cut.

A null text is part of no group and goes by its ``doc_id``.  Empty texts are
equal to each other.  Repeated rows have equal texts and stay together.  Other
columns are not looked at.  Texts are of any length; only their size and
checksums are moved.  An empty table gives an empty result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import pin

FINENESS = 1024


def schedule(units: list[tuple[int, object]], shards: int) -> dict[object, int]:
    """Longest first, each to the least-loaded shard; ties by unit, then shard."""
    heap = [(0, k) for k in range(shards)]
    out = {}
    for size, unit in sorted(units, key=lambda x: (-x[0], str(x[1]))):
        load, k = heapq.heappop(heap)
        out[unit] = k
        heapq.heappush(heap, (load + size, k))
    return out


def sized(documents: DataFrame) -> DataFrame:
    """Per document its size, its text's checksum and its group."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    loose = F.sha2(F.concat(F.lit("loose "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        size.alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).alias("text_crc32"),
        F.unhex(F.coalesce(F.sha2("text", 256), loose)).alias("group"),
    )


def into_shards(documents: DataFrame, shards: int = 16, fineness: int = FINENESS) -> DataFrame:
    """``doc_id, size, text_crc32, group, shard``; runs the jobs that size the units."""
    spark = documents.sparkSession
    rows = pin(sized(documents))
    bundle = F.pmod(F.xxhash64("group"), F.lit(shards * fineness)).cast("int")
    groups = pin(rows.groupBy("group").agg(F.sum("size").alias("bytes")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    large = F.col("bytes") * shards * fineness >= total
    heavy = groups.where(large).select("group", "bytes").collect()
    light = groups.where(~large).groupBy(bundle.alias("bundle")).agg(F.sum("bytes").alias("bytes")).collect()
    to = schedule([(r["bytes"], bytes(r["group"])) for r in heavy] + [(r["bytes"], r["bundle"]) for r in light], shards)
    of_group = spark.createDataFrame([(bytearray(k), v) for k, v in to.items() if isinstance(k, bytes)], "group binary, of_group int")
    of_bundle = spark.createDataFrame([(k, v) for k, v in to.items() if isinstance(k, int)], "bundle int, of_bundle int")
    # Both tables hold at most shards * fineness rows.
    return (
        rows.withColumn("bundle", bundle)
        .join(F.broadcast(of_group), "group", "left")
        .join(F.broadcast(of_bundle), "bundle", "left")
        .select("doc_id", "size", "text_crc32", "group", F.coalesce("of_group", "of_bundle").alias("shard"))
    )


def with_slots(rows: DataFrame, per_piece: int = 20_000) -> DataFrame:
    """Adds ``slot``: rows of a shard numbered from 0 without gaps.

    A shard is numbered in pieces by the hash of a row's place, so that none of
    its tasks holds a whole shard, nor all of many equal rows; a piece starts
    where the pieces before it end.  No rows give no rows.
    """
    rows = pin(rows.withColumn("row", F.monotonically_increasing_id()))
    pieces = rows.count() // per_piece + 1
    cut = rows.withColumn("piece", F.pmod(F.xxhash64("row"), F.lit(pieces)))
    # One row for each shard and piece.
    starts = cut.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "piece").orderBy("doc_id", "size", "text_crc32", "row")
    numbered = cut.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(starts, ["shard", "piece"]).withColumn("slot", F.col("start") + F.col("place")).drop("row", "piece", "place", "start")
