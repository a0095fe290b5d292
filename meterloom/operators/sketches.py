"""Mergeable states: quantiles of any window from daily states, distinct counts of any grouping set from finest cells.

States are small binary columns that merge in any order, so a stored table of them answers for every window or
grouping without the rows they came from, and new days are new rows.

* Quantile states (KLL) of ``k``: while a merged state has seen at most ``k`` values it is exact; beyond, the rank of an answer is off by
  at most ``rank_error(k)`` of all values in 99 of 100 cases, however many they are and however they were merged.
* Distinct states (theta) of ``lg``: exact up to 2 ** lg distinct items, beyond with a relative standard error of 2 ** (-lg / 2).
  Grouping sets expand the finest cells, not the rows, and unite states.

Null values have no part; a window or cell without values has n = 0 or no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rank_error(k: int) -> float:
    """The normalised rank error of one quantile at 99 % confidence, as published for this sketch."""
    return 2.296 / k**0.9021


def quantile_states(rows: DataFrame, by: Sequence[str], columns: Sequence[str], k: int = 400) -> DataFrame:
    """One row a group with ``<c>_state`` of each column; combines before the shuffle."""
    return rows.groupBy(*by).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(f"{c}_state") for c in columns])


def merged_states(states: DataFrame, by: Sequence[str | Column], columns: Sequence[str], k: int = 400) -> DataFrame:
    return states.groupBy(*by).agg(*[F.kll_merge_agg_double(f"{c}_state", F.lit(k)).alias(f"{c}_state") for c in columns])


def quantiles_of(states: DataFrame, column: str, levels: Sequence[float]) -> DataFrame:
    """The other columns with level, n and value: the least value that as large a share of all does not pass."""
    state = F.col(f"{column}_state")
    kept = [c for c in states.columns if not c.endswith("_state")]
    n = F.kll_sketch_get_n_double(state)
    found = states.withColumn("n", n).where("n > 0")
    values = F.kll_sketch_get_quantile_double(state, F.array(*[F.lit(float(q)) for q in levels]))
    pairs = F.arrays_zip(F.array(*[F.lit(float(q)) for q in levels]).alias("level"), values.alias("value"))
    return found.select(*kept, "n", F.explode(pairs).alias("p")).select(*kept, "n", "p.level", "p.value")


def distinct_states(rows: DataFrame, dimensions: Sequence[str], item: str, lg: int = 14) -> DataFrame:
    """A row for each cell of all dimensions, with the state of its items."""
    return rows.groupBy(*dimensions).agg(F.theta_sketch_agg(item, F.lit(lg)).alias("state"))


def distinct_cube(states: DataFrame, dimensions: Sequence[str], lg: int = 14) -> DataFrame:
    """dimensions (null where summed over), grouping_id and the distinct items of every grouping set."""
    united = states.cube(*dimensions).agg(F.grouping_id().alias("grouping_id"), F.theta_union_agg("state", F.lit(lg)).alias("state"))
    return united.select(*dimensions, "grouping_id", F.theta_sketch_estimate("state").alias("items"))
