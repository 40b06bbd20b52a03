"""Calendar arithmetic: periods, stamps, spines."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The year that an open-ended period ends in.
OPEN_END = 9999


def parse_period(text: str) -> tuple[dt.date, dt.date]:
    """"a/b" (years or dates), both ends included. Malformed or reversed periods raise."""
    ends = text.split("/")
    if len(ends) != 2 or not all(re.fullmatch(r"\d{4}(-\d{2}-\d{2})?", x.strip()) for x in ends):
        raise ValueError(f"period must be START/END, not {text!r}")
    a, b = (x.strip() for x in ends)
    start = dt.date.fromisoformat(a if len(a) > 4 else f"{a}-01-01")
    end = dt.date.fromisoformat(b if len(b) > 4 else f"{b}-12-31")
    if end < start:
        raise ValueError(f"period {text!r} ends before it starts")
    return start, end


def in_period(t: Column, start: dt.date, end: dt.date) -> Column:
    """Both ends included, and the whole of the last day for stamps within it."""
    return (t >= F.lit(start)) & (t < F.lit(end + dt.timedelta(days=1)))


def labels(start: dt.date, end: dt.date, step: str = "month") -> Column:
    """An array of every ``step`` label within the period; the first label is at or after its start."""
    if step not in ("day", "month", "year"):
        raise ValueError(f"no such step: {step}")
    first = F.lit(start).cast("date")
    if step != "day":
        floor = F.trunc(first, step)
        first = F.when(floor < first, F.add_months(floor, 1 if step == "month" else 12)).otherwise(floor)
    last = F.lit(end).cast("date")
    return F.when(first <= last, F.sequence(first, last, F.expr(f"interval 1 {step}")))


def spine(spark: SparkSession, start: dt.date, end: dt.date, step: str = "month") -> DataFrame:
    """(t): the labels of a period as rows."""
    return spark.range(1).select(F.explode(labels(start, end, step)).alias("t"))


def months_in_period(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """(year, month) of every month that the period touches."""
    s = spine(spark, start.replace(day=1), end, "month")
    return s.select(F.year("t").alias("year"), F.month("t").alias("month"))


def years_in_period(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    return spark.range(start.year, end.year + 1).select(F.col("id").cast("int").alias("year"))


def split_by_year(df: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per calendar year of each period, both ends clipped to the year."""
    y = df.withColumn("year", F.explode(F.sequence(F.year(start), F.year(end))))
    jan1, dec31 = F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31))
    return y.withColumn("part_start", F.greatest(F.col(start), jan1)).withColumn("part_end", F.least(F.col(end), dec31))


def clamp_period(start: Column, end: Column, first: Column, last: Column) -> tuple[Column, Column]:
    """The part of a period that is available; NULLs if there is none."""
    a, b = F.greatest(start, first), F.least(end, last)
    return F.when(a <= b, a), F.when(a <= b, b)


def month_start(t: Column) -> Column:
    """Start-, mid- or end-of-month stamps to the first of the month."""
    return F.trunc(t, "month")


def day_floor(t: Column) -> Column:
    return F.to_date(t)


def mid_month(t: Column) -> tuple[Column, Column, Column]:
    """The 15th, with the month's bounds: its first day and the next month's."""
    first = F.trunc(t, "month")
    return F.date_add(first, 14), first, F.add_months(first, 1)


def period_end(t: Column, step: str) -> Column:
    """Exclusive end of the day, month or year that starts at ``t``."""
    return {"day": F.date_add(t, 1), "month": F.add_months(t, 1), "year": F.add_months(t, 12)}[step]


def from_month_offset(n: Column, origin: str = "1901-01-01") -> Column:
    """First of the month that is ``n`` months after ``origin``."""
    return F.add_months(F.lit(origin).cast("date"), n)


def from_day_of_year(year: Column, doy: Column) -> Column:
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), (doy - 1).cast("int"))


def from_water_year_day(water_year: Column, day: Column) -> Column:
    """Day index (0 is 1 October of the year before) to date."""
    return F.date_add(F.make_date((water_year - 1).cast("int"), F.lit(10), F.lit(1)), day.cast("int"))


def mid_year(year: Column) -> Column:
    return F.make_date(year, F.lit(7), F.lit(1))


def days_in_month(t: Column) -> Column:
    return F.dayofmonth(F.last_day(t))


def season(t: Column) -> Column:
    """Meteorological season: DJF, MAM, JJA or SON."""
    k = F.floor(F.pmod(F.month(t), F.lit(12)) / 3).cast("int")
    return F.element_at(F.array(*map(F.lit, ("DJF", "MAM", "JJA", "SON"))), k + 1)


def header_map(text: Column) -> Column:
    """"key: value" lines to a map of trimmed strings; the last of equal keys wins, other lines are dropped."""
    lines = F.filter(F.split(text, r"\r?\n"), lambda s: F.instr(s, ":") > 0)
    pairs = F.transform(lines, lambda s: F.struct(F.trim(F.substring_index(s, ":", 1)).alias("k"), F.trim(F.substr(s, F.instr(s, ":") + 1)).alias("v")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + F.lit(2), F.size(pairs)), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)
