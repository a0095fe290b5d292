"""Calendar expressions of an hour. All are codegen'd column expressions: no lookup, no join."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------
CYCLES = {"hour": 24.0, "dayofweek": 7.0, "month": 12.0, "dayofyear": 365.25}
SEASONS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Autumn": (9, 10, 11),
}
# French public holidays: month * 100 + day, then days after Easter Sunday.
FIXED_HOLIDAYS = (101, 501, 508, 714, 815, 1101, 1111, 1225)
EASTER_HOLIDAYS = (1, 39, 50)
# ----------------------------------------------------------------------------

CALENDAR_COLUMNS = (
    ["is_weekend", "is_holiday", "hour_cat", "dayofweek_cat", "month_cat"]
    + [f"{part}_{fn}" for part in CYCLES for fn in ("sin", "cos")]
)


def truncate_hour(ts: Column) -> Column:
    """The hour of a zone-free time, by its own fields: no session zone takes part."""
    at = ts.cast("timestamp_ntz")
    part = F.make_dt_interval(mins=F.minute(at), secs=F.extract(F.lit("SECOND"), at))
    return (at - part).cast("timestamp_ntz")


def truncate_day(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz")


def add_hours(ts: Column, hours: Column | int) -> Column:
    step = F.lit(hours) if isinstance(hours, int) else hours
    return (ts + F.make_dt_interval(hours=step)).cast("timestamp_ntz")


def epoch_hour(ts: Column) -> Column:
    """Hours since 1970; consecutive integers on a gap-free series."""
    at = ts.cast("timestamp_ntz")
    return (F.datediff(at.cast("date"), F.lit("1970-01-01").cast("date")) * 24 + F.hour(at)).cast("long")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-free time."""
    at = ts.cast("timestamp_ntz")
    second = F.extract(F.lit("SECOND"), at) * 1_000_000
    return epoch_hour(at) * 3_600_000_000 + F.minute(at).cast("long") * 60_000_000 + second.cast("long")


def calendar_part(part: str, ts: Column) -> Column:
    """hour, dayofweek (Monday = 0), month or dayofyear."""
    extract = {
        "hour": F.hour,
        "dayofweek": F.weekday,
        "month": F.month,
        "dayofyear": F.dayofyear,
    }
    return extract[part](ts)


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def day_type(ts: Column) -> Column:
    return F.when(F.weekday(ts) >= 5, "Weekend").otherwise("Weekday")


def cyclical(part: str, fn: str, ts: Column) -> Column:
    angle = F.lit(2 * math.pi) * calendar_part(part, ts) / F.lit(CYCLES[part])
    return {"sin": F.sin, "cos": F.cos}[fn](angle).cast("float")


def season(ts: Column) -> Column:
    month = F.month(ts)
    label = F
    for name, months in SEASONS.items():
        label = label.when(month.isin(*months), name)
    return label


def easter_sunday(year: Column) -> Column:
    """Anonymous Gregorian computus in integer arithmetic."""

    def div(a: Column, b: int) -> Column:
        return F.floor(a / F.lit(b)).cast("int")

    golden = year % 19
    century, in_century = div(year, 100), year % 100
    correction = century - div(century, 4) - div(century - div(century + 8, 25) + 1, 3)
    epact = (golden * 19 + correction + 15) % 30
    weekday = ((century % 4) * 2 + div(in_century, 4) * 2 - epact - in_century % 4 + 32) % 7
    shift = div(golden + epact * 11 + weekday * 22, 451)
    months_days = epact + weekday - shift * 7 + 114
    return F.make_date(year, div(months_days, 31), months_days % 31 + 1)


def is_holiday(ts: Column) -> Column:
    day = F.to_date(ts)
    fixed = (F.month(ts) * 100 + F.dayofmonth(ts)).isin(*FIXED_HOLIDAYS)
    moving = F.datediff(day, easter_sunday(F.year(ts))).isin(*EASTER_HOLIDAYS)
    return (fixed | moving).cast("int")


def holiday_table(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """The holidays of a span of years as a (holiday) date dimension."""
    year = F.col("id").cast("int")
    fixed = [F.make_date(year, F.lit(md // 100), F.lit(md % 100)) for md in FIXED_HOLIDAYS]
    moving = [F.date_add(easter_sunday(year), offset) for offset in EASTER_HOLIDAYS]
    return (
        spark.range(first_year, last_year + 1)
        .select(F.explode(F.array(*fixed, *moving)).alias("holiday"))
        .distinct()
    )


def calendar_block(ts: Column) -> list[Column]:
    """The 13 calendar features of a (target) hour, aliased."""
    flags = [is_weekend(ts).alias("is_weekend"), is_holiday(ts).alias("is_holiday")]
    categories = [
        calendar_part(part, ts).alias(f"{part}_cat") for part in ("hour", "dayofweek", "month")
    ]
    cycles = [
        cyclical(part, fn, ts).alias(f"{part}_{fn}") for part in CYCLES for fn in ("sin", "cos")
    ]
    return flags + categories + cycles
