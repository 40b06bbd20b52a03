"""Resampling in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catchment.functions.missing import strict_sum, sum_or_zero

KINDS = ("sum", "point")


def kind_of(cell_methods: str | None) -> str:
    """"time: sum" or "time: point"; anything else raises."""
    kind = (cell_methods or "").removeprefix("time:").strip()
    if not (cell_methods or "").startswith("time:") or kind not in KINDS:
        raise ValueError(f"cell_methods must be 'time: sum' or 'time: point', not {cell_methods!r}")
    return kind


def _same(left: str, right: str, by: list[str]) -> Column:
    """Equality of keys, missing ones included."""
    out = F.lit(True)
    for c in by:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def last_samples(df: DataFrame, by: list[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """(by, ts, value) of each series' last sample: what the next year needs of this one."""
    return df.groupBy(*by).agg(F.max(ts).alias(ts), F.max_by(value, ts).alias(value))


def increments(df: DataFrame, by: list[str], ts: str = "ts", value: str = "value", per_year: bool = False, before: DataFrame | None = None) -> DataFrame:
    """Hourly accumulations to increments. A negative difference is a reset: the raw value counts.

    The first sample of a series has no increment and goes, unless ``before`` (by, value: the
    last samples of an earlier run, as ``last_samples`` gives them) has the series; with
    ``per_year`` also the first of each year, as if years were worked on apart. A gap before a
    sample makes its difference NULL, and then the raw value counts as well.

    Samples are sorted within a series' month only. The last sample of a month is carried to
    the next month that has any by a join with one row per series and month.
    """
    month = F.date_trunc("month", ts)
    ends = df.groupBy(*by, month.alias("__m")).agg(F.max_by(value, ts).alias("__last"))
    years = [F.year("__m")] if per_year else []
    carried = ends.withColumn("__c", F.lag(F.struct("__last")).over(Window.partitionBy(*by, *years).orderBy("__m"))).drop("__last")
    if before is not None and not per_year:
        old = before.select(*by, F.struct(F.col(value).alias("__last")).alias("__old"))
        carried = carried.alias("l").join(old.alias("r"), _same("l", "r", by), "left").select("l.*", "r.__old").withColumn("__c", F.coalesce("__c", "__old")).drop("__old")
    w = Window.partitionBy(*by, "__m").orderBy(ts)
    rows = df.withColumn("__m", month).withColumn("__n", F.row_number().over(w)).withColumn("__prev", F.lag(value).over(w))
    met = rows.alias("l").join(carried.alias("r"), _same("l", "r", [*by, "__m"]), "left").select("l.*", F.col("r.__c").alias("__c"))
    kept = met.where((F.col("__n") > 1) | F.col("__c").isNotNull())
    d = F.col(value) - F.when(F.col("__n") > 1, F.col("__prev")).otherwise(F.col("__c.__last"))
    return kept.withColumn("__d", d).withColumn(value, F.when(F.col("__d") >= 0, F.col("__d")).otherwise(F.col(value))).select(df.columns)


def hourly_to_daily(df: DataFrame, by: list[str], ts: str = "ts", value: str = "value", per_year: bool = False, before: DataFrame | None = None) -> DataFrame:
    """Daily sums of increments; a stamp closes its hour, so 00:00 belongs to the day before. Missing counts 0."""
    day = F.to_date(F.col(ts) - F.expr("interval 1 hour"))
    return increments(df, by, ts, value, per_year, before).groupBy(*by, day.alias("t")).agg(sum_or_zero(F.col(value)).alias(value))


def hourly_mean(df: DataFrame, by: list[str], ts: str = "ts", value: str = "value") -> DataFrame:
    return df.groupBy(*by, F.to_date(ts).alias("t")).agg(F.avg(value).alias(value))


def daily_to_monthly(df: DataFrame, by: list[str], kind: str, t: str = "t", value: str = "value") -> DataFrame:
    """Monthly sum or mean, stamped at the month's last day."""
    if kind not in KINDS:
        raise ValueError(f"no such kind: {kind}")
    f = sum_or_zero(F.col(value)) if kind == "sum" else F.avg(value)
    return df.groupBy(*by, F.last_day(t).alias(t)).agg(f.alias(value))


def daily_to_monthly_by_catalog(df: DataFrame, catalog: DataFrame, by: list[str], var: str = "var", t: str = "t", value: str = "value") -> DataFrame:
    """The same with each variable's kind from a catalog (var, cell_methods); an unknown method raises."""
    kinds = catalog.select(F.col(var), F.when(F.col("cell_methods").isin("time: sum", "time: point"), F.col("cell_methods")).otherwise(F.raise_error(F.concat(F.lit("unknown cell_methods: "), F.coalesce("cell_methods", F.lit("none"))))).alias("__k"))
    rows = df.join(kinds, var).groupBy(*by, var, "__k", F.last_day(t).alias(t)).agg(sum_or_zero(F.col(value)).alias("__s"), F.avg(value).alias("__m"))
    return rows.withColumn(value, F.when(F.col("__k") == "time: sum", F.col("__s")).otherwise(F.col("__m"))).drop("__k", "__s", "__m")


def annual(df: DataFrame, by: list[str], how: str = "sum", t: str = "t", value: str = "value", null_if_empty: bool = False) -> DataFrame:
    """Annual sum ("sum": missing counts 0; "strict": missing spoils the year) or mean, stamped at 1 January."""
    c = F.col(value)
    f = {"sum": F.sum(c) if null_if_empty else sum_or_zero(c), "strict": strict_sum(c), "mean": F.avg(c)}[how]
    return df.groupBy(*by, F.trunc(t, "year").alias(t)).agg(f.alias(value))


def _overlap(start: Column, end: Column, month: Column) -> Column:
    return F.datediff(F.least(end, F.add_months(month, 1)), F.greatest(start, month))


def composites_to_monthly(df: DataFrame, by: list[str], days: int = 8, t: str = "t", value: str = "value", strict_dot: bool = False) -> DataFrame:
    """Totals of multi-day composites to calendar months, by days of overlap.

    A composite ends after ``days`` or at the year's end. Only months inside the series'
    first start and last end are given. A missing composite makes the months it meets
    missing; with ``strict_dot`` it makes every month of its series missing.
    """
    c = df.withColumn("__end", F.least(F.date_add(t, days), F.add_months(F.trunc(t, "year"), 12))).withColumn("__len", F.datediff("__end", t))
    c = c.withColumn("__m", F.explode(F.sequence(F.trunc(t, "month"), F.trunc(F.date_sub("__end", 1), "month"), F.expr("interval 1 month"))))
    share = F.col(value) * _overlap(F.col(t), F.col("__end"), F.col("__m")) / F.col("__len")
    span = df.groupBy(*by).agg(F.min(t).alias("__a"), F.max(F.least(F.date_add(t, days), F.add_months(F.trunc(t, "year"), 12))).alias("__b"), F.count_if(F.col(value).isNull()).alias("__gaps"))
    out = c.groupBy(*by, F.col("__m").alias("__t")).agg(strict_sum(share).alias("__v")).join(span, by).where((F.col("__t") >= F.col("__a")) & (F.add_months("__t", 1) <= F.col("__b")))
    v = F.when(F.col("__gaps") == 0, F.col("__v")) if strict_dot else F.col("__v")
    return out.select(*by, F.col("__t").alias(t), v.alias(value))


def composites_in_month(df: DataFrame, by: list[str], year: int, month: int, days: int = 8, t: str = "t", value: str = "value") -> DataFrame:
    """One month's total from the composites that meet it."""
    m = F.make_date(F.lit(year), F.lit(month), F.lit(1))
    end = F.least(F.date_add(t, days), F.add_months(F.trunc(t, "year"), 12))
    rows = df.where((F.col(t) < F.add_months(m, 1)) & (end > m))
    return rows.groupBy(*by).agg(strict_sum(F.col(value) * _overlap(F.col(t), end, m) / F.datediff(end, t)).alias(value)).withColumn(t, m)
