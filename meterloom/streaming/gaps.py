"""Short-gap interpolation of a stream, row by row as in batch.

The batch operator numbers a meter's readings in (ts, row_id) order and fills gaps of at most ``max_gap`` rows
from the valid readings on either side. The stream keeps, per meter:

* the readings that the watermark has not passed, which may still be joined by earlier ones: sorted runs of pages;
* the position, the last valid value and the open gap of each column;
* the readings whose gaps are still open: never more than ``max_gap``, for a longer gap is closed as unfilled.

A timer releases readings in order once the watermark has passed them. The runs are merged for that, a page of each run
that has begun at a time, so a task's memory does not grow with a meter's readings. A reading leaves as soon as none of its
columns waits for a valid neighbour. A second timer ends a meter that has been silent for ``idle``: its trailing
gap is closed as batch closes it at the end of the data, its state goes, and a later reading begins a new series.

Late data: a reading at or before the last one released has no place left in the order and is dropped; allow a
longer lateness to keep it. Readings without a meter or a time are left out, as in batch; one without a meter still
carries the watermark on, so it serves as a heartbeat. Values that are NaN are
missing. Equal (ts, row_id) are ordered by their values, as in batch.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StringType, StructField, StructType, TimestampType

from meterloom.config import MAX_GAP, short_flag

#: Stateful operators with several states and timers need this provider.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

Row = list[Any]  # micros, row_id, values, flags, columns that wait

_PAGE = 1024  # readings of a run that are held at a time
_RUN = 1 << 16  # readings that are sorted at a time
_OUT = 4096  # rows of a frame that is handed on


class GapState:
    """One meter's place in its series; a pure function of the readings given in order."""

    def __init__(self, columns: int, max_gap: int) -> None:
        self.max_gap = max_gap
        self.position = 0
        self.at: list[int] = [0] * columns  # position of the last valid value
        self.value: list[float | None] = [None] * columns
        self.held: list[Row] = []

    def _close(self, c: int, gap: list[Row], end: int, value: float | None) -> None:
        """Column c of the gap's rows is settled: filled if the gap is short, else left missing."""
        short = len(gap) <= self.max_gap
        first = end - len(gap)
        for i, row in enumerate(gap):
            row[4].discard(c)
            row[3][c] = int(short)
            before = self.value[c]
            if short and before is not None:
                at = self.at[c]
                row[2][c] = before if value is None else before + (value - before) * (first + i - at) / (end - at)

    def _released(self) -> Iterator[Row]:
        while self.held and not self.held[0][4]:
            yield self.held.pop(0)

    def add(self, micros: int, row_id: int | None, values: list[float | None]) -> Iterator[Row]:
        self.position += 1
        waits = {c for c, v in enumerate(values) if v is None}
        for c, v in enumerate(values):
            gap = [row for row in self.held if c in row[4]] if self.held else []
            if v is not None:
                if gap:
                    self._close(c, gap, self.position, v)
                self.at[c], self.value[c] = self.position, v
            elif self.position - self.at[c] > self.max_gap:
                # One row more than a short gap may have: all of it stays missing.
                for row in gap:
                    row[4].discard(c)
                waits.discard(c)
        self.held.append([micros, row_id, list(values), [0] * len(values), waits])
        yield from self._released()

    def finish(self) -> Iterator[Row]:
        """The series ends here: what waits has no later neighbour."""
        for c in range(len(self.at)):
            gap = [row for row in self.held if c in row[4]]
            if gap:
                self._close(c, gap, self.position + 1, None)
        yield from self._released()


def _schema(columns: Sequence[str], id_type: Any) -> StructType:
    values = [StructField(c, DoubleType()) for c in columns]
    flags = [StructField(short_flag(c), LongType()) for c in columns]
    return StructType([StructField("meter_id", StringType()), StructField("ts", TimestampType()), StructField("row_id", id_type), *values, *flags])


def _reading(columns: int) -> np.dtype:
    """One waiting reading; what is missing is 0 beside a mark."""
    return np.dtype([("micros", "<i8"), ("has_id", "?"), ("row_id", "<i8"), ("has", "?", (columns,)), ("values", "<f8", (columns,))])


def _readings(frame: pd.DataFrame, columns: Sequence[str]) -> np.ndarray:
    out = np.zeros(len(frame), _reading(len(columns)))
    out["micros"] = frame["micros"].to_numpy("int64")
    ids = pd.array(frame["row_id"], "Int64")
    out["has_id"], out["row_id"] = ~ids.isna(), ids.to_numpy("int64", na_value=0)
    for c, name in enumerate(columns):
        value = pd.to_numeric(frame[name]).to_numpy("float64", na_value=np.nan)
        out["has"][:, c], out["values"][:, c] = ~np.isnan(value), np.nan_to_num(value, nan=0.0, posinf=np.inf, neginf=-np.inf)
    return out


def _sort_keys(rows: np.ndarray) -> list[np.ndarray]:
    """(ts, row_id, values); missing ones first, as Spark sorts them."""
    keys = [rows["micros"], rows["has_id"], rows["row_id"]]
    for c in range(rows["values"].shape[1]):
        keys += [rows["has"][:, c], rows["values"][:, c]]
    return keys


def _in_order(rows: np.ndarray) -> np.ndarray:
    return rows[np.lexsort(_sort_keys(rows)[::-1])]


class Run:
    """Sorted readings in numbered pages; holds the page that it has reached, once it is begun."""

    def __init__(self, number: int, page: int, pages: int, offset: int, first: int) -> None:
        self.number, self.page, self.pages, self.offset, self.first = number, page, pages, offset, first
        self.rows: list[tuple] | None = None

    def place(self) -> tuple[int, int, int, int, int]:
        return self.number, self.page, self.pages, self.offset, self.first

    def begin(self, load: Callable[[int, int], np.ndarray]) -> None:
        if self.rows is None:
            self.rows = list(zip(*(k.tolist() for k in _sort_keys(load(self.number, self.page))), strict=True))

    def head(self) -> tuple:
        return self.rows[self.offset]

    def step(self, load: Callable[[int, int], np.ndarray], drop: Callable[[int, int], None]) -> bool:
        """On to the next reading, if there is one; a page that is done goes."""
        self.offset += 1
        if self.offset == len(self.rows):
            drop(self.number, self.page)
            self.page, self.offset, self.rows = self.page + 1, 0, None
            if self.page == self.pages:
                return False
            self.begin(load)
        self.first = self.head()[0]
        return True


def merged(runs: list[Run], passed: int, load: Callable[[int, int], np.ndarray], drop: Callable[[int, int], None]) -> Iterator[tuple]:
    """The runs' readings before ``passed`` in order, as sort keys; a run begins when its first reading may be next."""
    ahead = sorted((r for r in runs if r.first < passed), key=lambda r: r.first, reverse=True)
    heap: list[tuple] = []
    while ahead or heap:
        while ahead and (not heap or ahead[-1].first <= heap[0][0][0]):
            run = ahead.pop()
            run.begin(load)
            heapq.heappush(heap, (run.head(), run.number, run))
        key, number, run = heap[0]
        yield key
        if run.step(load, drop) and run.first < passed:
            heapq.heapreplace(heap, (run.head(), number, run))
        else:
            heapq.heappop(heap)


class _Filler(StatefulProcessor):
    def __init__(self, columns: Sequence[str], max_gap: int, idle_ms: int) -> None:
        self.columns, self.max_gap, self.idle_ms = list(columns), max_gap, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        numbers, counts = ArrayType(DoubleType()), ArrayType(LongType())
        reading = [StructField("micros", LongType()), StructField("row_id", LongType()), StructField("values", numbers)]
        page = StructType([StructField("run", LongType()), StructField("page", LongType())])
        self.pages = handle.getMapState("pages", page, StructType([StructField("rows", BinaryType())]))
        self.runs = handle.getValueState("runs", StructType([StructField(c, counts) for c in ("run", "page", "pages", "offset", "first")]))
        self.held = handle.getListState("held", StructType([*reading, StructField("flags", counts), StructField("waits", counts)]))
        series = [StructField("position", LongType()), StructField("released", LongType()), StructField("at", counts), StructField("value", numbers)]
        self.series = handle.getValueState("series", StructType(series))

    def _load(self) -> tuple[GapState, int | None]:
        state, released = GapState(len(self.columns), self.max_gap), None
        if self.series.exists():
            position, released, at, value = self.series.get()
            state.position, state.at, state.value = position, list(at), [None if _missing(v) else v for v in value]
            state.held = [
                [m, i, [None if _missing(x) else x for x in v], list(f), set(w)]
                for m, i, v, f, w in (self.held.get() if self.held.exists() else ())
            ]
        return state, released

    def _save(self, state: GapState, released: int | None) -> None:
        self.series.update((state.position, released, state.at, state.value))
        if state.held:
            self.held.put([(m, i, v, f, sorted(w)) for m, i, v, f, w in state.held])
        elif self.held.exists():
            self.held.clear()

    def _load_page(self, number: int, page: int) -> np.ndarray:
        return np.frombuffer(self.pages.getValue((number, page))[0], _reading(len(self.columns)))

    def _drop_page(self, number: int, page: int) -> None:
        self.pages.removeKey((number, page))

    def _load_runs(self) -> list[Run]:
        return [Run(*r) for r in zip(*self.runs.get(), strict=True)] if self.runs.exists() else []

    def _save_runs(self, runs: list[Run]) -> None:
        if runs:
            self.runs.update(tuple(list(c) for c in zip(*(r.place() for r in runs), strict=True)))
        elif self.runs.exists():
            self.runs.clear()

    def _add_run(self, runs: list[Run], rows: np.ndarray) -> None:
        """As a run of their own; together with the newest run if that has but one page left."""
        number = runs[-1].number + 1 if runs else 0
        if runs and runs[-1].page == runs[-1].pages - 1:
            last = runs.pop()
            rows = np.concatenate([self._load_page(last.number, last.page)[last.offset :], rows])
            self._drop_page(last.number, last.page)
        rows = _in_order(rows)
        pages = -(-len(rows) // _PAGE)
        for page in range(pages):
            self.pages.updateValue((number, page), (rows[page * _PAGE : (page + 1) * _PAGE].tobytes(),))
        runs.append(Run(number, 0, pages, 0, int(rows["micros"][0])))

    def _frame(self, meter: str, rows: list[Row]) -> pd.DataFrame:
        out = {
            "meter_id": [meter] * len(rows),
            "ts": pd.to_datetime([r[0] for r in rows], unit="us"),
            "row_id": pd.array([r[1] for r in rows], "Int64"),
        }
        values, flags = np.array([r[2] for r in rows], np.float64), np.array([r[3] for r in rows], np.int64)
        for c, name in enumerate(self.columns):
            out[name] = pd.arrays.FloatingArray(values[:, c].copy(), np.isnan(values[:, c]))
        for c, name in enumerate(self.columns):
            out[short_flag(name)] = flags[:, c]
        return pd.DataFrame(out)

    def _set_timer(self, at: int) -> None:
        """The one timer of a meter: for its next reading to release, or for its end."""
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old[0] if isinstance(old, tuple) else old)
        self.handle.registerTimer(at)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        if key[0] is None:
            return iter(())
        released = self.series.get()[1] if self.series.exists() else None
        runs, new, size, first = self._load_runs(), [], 0, None
        for frame in rows:
            part = _readings(frame, self.columns)
            if released is not None:
                part = part[part["micros"] > released]  # the place of the others is gone
            if len(part):
                least = int(part["micros"].min())
                first = least if first is None else min(first, least)
                new.append(part)
                size += len(part)
            if size >= _RUN:
                self._add_run(runs, np.concatenate(new))
                new, size = [], 0
        if new:
            self._add_run(runs, np.concatenate(new))
        if first is not None:
            self._save_runs(runs)
            timers = [t[0] if isinstance(t, tuple) else t for t in self.handle.listTimers()]
            self._set_timer(min([first // 1000 + 1, *timers]))
        return iter(())

    def _released(self, state: GapState, ready: Iterator[tuple]) -> Iterator[Row]:
        for key in ready:
            yield from state.add(key[0], key[2] if key[1] else None, [v if has else None for has, v in zip(key[3::2], key[4::2], strict=True)])
            self.last = key[0]

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        state, self.last = self._load()
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        runs = self._load_runs()
        out = self._released(state, merged(runs, passed, self._load_page, self._drop_page))
        while some := list(islice(out, _OUT)):
            yield self._frame(key[0], some)
        later = [r for r in runs if r.page < r.pages]
        self._save_runs(later)
        last = (self.last or 0) // 1000
        if not later and last + self.idle_ms < passed // 1000:
            if some := list(state.finish()):
                yield self._frame(key[0], some)
            for kept in (self.series, self.held):
                if kept.exists():
                    kept.clear()
        else:
            self._save(state, self.last)
            self._set_timer(min([r.first // 1000 + 1 for r in later] or [last + self.idle_ms + 1]))

    def close(self) -> None:
        pass


def _missing(value: Any) -> bool:
    return value is None or value is pd.NA or (isinstance(value, float) and math.isnan(value))


def interpolate_stream(
    readings: DataFrame, columns: Sequence[str], max_gap: int = MAX_GAP, *, lateness: str = "2 hours", idle: str = "30 days"
) -> DataFrame:
    """meter_id, ts, row_id, the columns filled and their flags, of a stream of readings.

    ``row_id`` must be a number. ``ts`` may be zone-free; event time needs an instant, so it is read in the session zone.
    """
    spark = readings.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != PROVIDER:
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {PROVIDER}")
    timed = readings.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    # Rows without a meter go no further than the operator: a filter would be pushed below the watermark, which they
    # may carry on as heartbeats.
    placed = timed.where("ts IS NOT NULL").select(
        F.col("meter_id").cast("string").alias("meter_id"), "ts", F.unix_micros("ts").alias("micros"),
        F.col("row_id").cast("long").alias("row_id"), *[F.col(c).cast("double").alias(c) for c in columns],
    )
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    filled = placed.groupBy("meter_id").transformWithStateInPandas(
        _Filler(columns, max_gap, idle_ms), _schema(columns, LongType()), outputMode="Append", timeMode="EventTime"
    )
    return filled.select(
        "meter_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "row_id", *columns,
        *[F.col(short_flag(c)).cast("int").alias(short_flag(c)) for c in columns],
    )
