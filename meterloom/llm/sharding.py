"""Sharding: longest-processing-time scheduling of groups that must stay together.

Groups are rows of equal text. Sorted by size, each goes to the least-loaded shard through a heap.
The heap sees a bounded number of items at every input size: a group of at least ``1 / (shards *
heavy)`` of all bytes stands alone (there are at most ``shards * heavy`` of those), and the others
are bundled by their digest into ``shards * bundles`` parcels, each far below a shard. Only the
sizes of these items reach the driver; rows are dealt by digest, never by group, so that a hot group
is never one task.

Defined results: a null text has no bytes and forms a group of its own; empty texts are one group;
repeated rows are rows of their own in one shard; an empty table gives no rows; other columns are
ignored. Ties between sizes are broken by the item's number, so a plan is repeatable.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm.common import every, stored

#: What every row costs besides its text.
ROW_BYTES = 8


def lpt(sizes: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """(item, size) pairs: the shard of each item."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for size, item in sorted(((s, i) for i, s in sizes), key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        placed[item] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the digest that names the group; the text goes no further."""
    return docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        group_of(F.col("text")).alias("group"),
    )


def group_of(text: Column) -> Column:
    return F.coalesce(F.md5(text.cast("binary")), F.lit("null"))


def _placed(rows: DataFrame, sized: DataFrame, shards: int, bundles: int, heavy: int) -> DataFrame:
    """``rows`` (with a column group) with their shard, by a plan of the groups and sizes of ``sized``."""
    spark = rows.sparkSession
    total = sized.agg(F.sum("size")).first()[0] or 0
    groups = sized.groupBy("group").agg(F.sum("size").alias("bytes"))
    alone = groups.where(F.col("bytes") * (shards * heavy) >= F.lit(total)).orderBy(F.desc("bytes"), "group").limit(shards * heavy)
    heavies = [r[0] for r in alone.select("group").collect()]  # at most shards * heavy
    numbers = spark.createDataFrame([(g, -1 - i) for i, g in enumerate(heavies)], "`group` string, heavy_item long")
    item = F.coalesce("heavy_item", F.pmod(F.xxhash64("group"), F.lit(shards * bundles)))
    # At most shards * heavy rows of 40 bytes.
    named = lambda df: df.join(F.broadcast(numbers), "group", "left").withColumn("item", item).drop("heavy_item")
    loads = named(sized).groupBy("item").agg(F.sum("size")).collect()  # at most shards * (bundles + heavy)
    placed = lpt([(i, s) for i, s in loads], shards)
    plan = spark.createDataFrame(list(placed.items()), "item long, shard int")
    return named(rows).join(F.broadcast(plan), "item").drop("item")


def assign_shards(docs: DataFrame, shards: int = 24, *, bundles: int = 256, heavy: int = 64, pieces: int = 1024) -> DataFrame:
    """One row a document: doc_id, size, text_crc32, group, shard, slot (gapless from 0 in its shard).

    ``pieces``: slots are numbered in so many pieces a shard, side by side.
    """
    rows = stored(measured(docs), "shard-rows")
    # Where a row is stored tells repeated rows apart, and stays the same however often it is read.
    rows = rows.withColumn("place", F.xxhash64("_metadata.file_name", "_metadata.row_index"))
    return with_slots(_placed(rows, rows, shards, bundles, heavy), pieces)


def with_slots(rows: DataFrame, pieces: int) -> DataFrame:
    """Numbers the rows of each shard without sorting a shard in one task.

    Rows are numbered within (shard, piece); the rows of the pieces before come on top.
    """
    rows = rows.withColumn("piece", F.pmod(F.xxhash64("doc_id", "text_crc32", "place"), F.lit(pieces)).cast("int"))
    counts = rows.groupBy("shard", "piece").agg(F.count("*").alias("n"))  # at most shards * pieces
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "piece").orderBy("doc_id", "text_crc32", "size", "place")
    numbered = rows.withColumn("at", F.row_number().over(within) - 1)
    return (
        numbered.join(F.broadcast(starts), ["shard", "piece"])
        .withColumn("slot", (F.col("first") + F.col("at")).cast("long"))
        .drop("piece", "first", "at", "place")
    )


def write_shards(docs: DataFrame, plan: DataFrame, path: str) -> None:
    """Documents as Parquet, a folder a shard, every row once.

    A row's shard follows from its text alone, so texts and not ids meet the plan: null and repeated ids are written as
    they come. A column of the documents that is named shard gives way to the folder's. Spark splits the join of a hot text.
    """
    shard_of = plan.groupBy("group").agg(F.first("shard").alias("shard"))
    whole = docs.select(F.struct(*every([c for c in docs.columns if c != "shard"])).alias("doc"), group_of(F.col("text")).alias("group"))
    whole.join(shard_of, "group").select("doc.*", "shard").write.partitionBy("shard").parquet(path)


def op7(docs: DataFrame) -> DataFrame:
    placed = assign_shards(docs, 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
