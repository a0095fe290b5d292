"""Exact ranks over one global order, without a window that sees all rows.

Distinct keys and their counts are cut into ranges by Spark's sampled splitters and stored with the number of their
range. Inside a range a running sum counts; what ranges before it hold is one number a range, of which there are as many
as shuffle partitions. Rows then meet their key's numbers: a join that Spark splits where one key is hot. Ties never
cross a border, for they are one key.

rank, dense_rank, percent_rank and cume_dist are those of SQL. ntile needs an order without ties: give columns that tell
rows apart (rows that still tie share the tile of the first). Null keys come first, as in Spark; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterloom.session import scratch_path


def with_ranks(rows: DataFrame, order: Sequence[str], tiles: int | None = None) -> DataFrame:
    """The rows with rank, dense_rank, percent_rank, cume_dist and, for ``tiles``, ntile."""
    spark = rows.sparkSession
    keys = rows.groupBy(*order).agg(F.count("*").alias("_n"))
    path = scratch_path(spark, "rank-keys")
    ranged = keys.repartitionByRange(*[F.asc_nulls_first(c) for c in order]).withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)
    ranged = spark.read.parquet(path)

    sizes = sorted(tuple(r) for r in ranged.groupBy("_range").agg(F.sum("_n"), F.count("*")).collect())  # a row a range
    before = [0, *accumulate(n for _, n, _ in sizes)]
    distinct = [0, *accumulate(k for _, _, k in sizes)]
    offsets = [(r, before[i], distinct[i]) for i, (r, _, _) in enumerate(sizes)]
    total = before[-1]
    starts = spark.createDataFrame(offsets, "_range int, _before long, _distinct long")

    inside = Window.partitionBy("_range").orderBy(*[F.asc_nulls_first(c) for c in order])
    upto = F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    numbered = ranged.join(F.broadcast(starts), "_range").select(
        *[F.col(c).alias(f"_key_{c}") for c in order],
        (F.col("_before") + upto - F.col("_n") + 1).alias("rank"),
        (F.col("_distinct") + F.row_number().over(inside)).alias("dense_rank"),
        (F.col("_before") + upto).alias("_through"),
    )
    same = F.lit(True)
    for c in order:
        same &= rows[c].eqNullSafe(numbered[f"_key_{c}"])
    out = rows.join(numbered, same).select(
        *[rows[c] for c in rows.columns], "rank", "dense_rank",
        (F.lit(0.0) if total < 2 else (F.col("rank") - 1) / F.lit(float(total - 1))).alias("percent_rank"),
        (F.col("_through") / F.lit(float(max(total, 1)))).alias("cume_dist"),
    )
    if tiles is None:
        return out
    # The first ``more`` tiles have one row more than the others.
    few, more = divmod(total, tiles)
    large = (F.col("rank") - 1) < F.lit((few + 1) * more)
    first = F.floor((F.col("rank") - 1) / F.lit(few + 1)) + 1
    rest = F.floor((F.col("rank") - 1 - (few + 1) * more) / F.lit(max(few, 1))) + 1 + more
    return out.withColumn("ntile", F.when(large, first).otherwise(rest).cast("int"))
