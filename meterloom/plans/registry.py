"""Registry of named queries with their oracle SQL, and output normalisation for both."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def add(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Floating columns as DOUBLE rounded to ``digits`` (or as named in ``special``)."""
    return df.select(
        *[
            F.round(F.col(c).cast("double"), special.get(c, digits)).alias(c)
            if t in ("double", "float")
            else F.col(c)
            for c, t in df.dtypes
        ]
    )


def sql_round(columns: Sequence[str], digits: int = 6) -> str:
    """The oracle's side of ``rounded``; adding zero turns -0.0 into 0.0."""
    return ", ".join(f"round(CAST({c} AS DOUBLE), {digits}) + 0.0 AS {c}" for c in columns)
