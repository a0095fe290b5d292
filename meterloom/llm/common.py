"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import meterloom
from meterloom.session import scratch_path

#: Python calls every character of ``[\x20\x09-\x0D]`` white space in bytes, and no other.
SPACE = r"[\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Gives executors this package where their Python cannot import it as the driver's does."""
    package = Path(meterloom.__file__).parent
    root = str(package.parent)
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or os.getcwd() == root:
        return
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        made = shutil.make_archive(os.path.join(tempfile.mkdtemp(), package.name), "zip", root, package.name)
        context.addPyFile(made)  # Spark copies it to every executor
        _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def every(columns: list[str]) -> list[Column]:
    """Columns by name, whatever characters the names have."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def stored(df: DataFrame, name: str, *, batch_bytes: int | None = None, **options: str) -> DataFrame:
    """The rows, written once below the shared folder: later steps and lost executors reread them.

    ``batch_bytes`` bounds the Arrow batches of this one write, for steps whose rows are large.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_BATCH_BYTES)
    if batch_bytes:
        spark.conf.set(_BATCH_BYTES, str(batch_bytes))
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(_BATCH_BYTES, before)
    return spark.read.schema(df.schema).parquet(path)


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
Batches = Iterator[pa.RecordBatch]


def tidy(body: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``body`` for ``mapInArrow``; when a task ends, its worker, which Spark reuses, gives free memory back."""

    @wraps(body)
    def run(batches: Batches) -> Batches:
        try:
            yield from body(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return run


def sent(rows: DataFrame, most: int = 500_000) -> DataFrame:
    """``rows`` marked to go to every task while there are at most ``most`` of them; beyond that Spark joins as it sees fit.

    For tables of narrow rows: half a million of 40 bytes are about 20 MB.
    """
    return F.broadcast(rows) if rows.count() <= most else rows


def text_key(text: Column) -> Column:
    """128 bits of a text, none for a null one: with the doc_id it tells rows apart."""
    return F.coalesce(F.unhex(F.md5(text.cast("binary"))), F.lit(b""))


def remainder(doc_id: Column, divisor: int) -> Column:
    """``crc32(doc_id as text) mod divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor
