"""Summaries for inspection. Tables come out, no drawings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catchment.operators import selection


def _area_mean(v: Column, area: Column) -> Column:
    mass = F.sum(F.when(v.isNotNull(), area))
    return F.when(mass > 0, F.sum(v * area) / F.when(mass > 0, mass))


def area_weighted_mean(df: DataFrame, meta: DataFrame, value: str = "value", area: str = "area") -> DataFrame:
    """One row: mean over polygons, missing ones left out; ids that one side lacks drop out."""
    return df.join(meta, "hru").agg(_area_mean(F.col(value), F.col(area)).alias("mean"))


def area_weighted_series(df: DataFrame, meta: DataFrame, value: str = "value", area: str = "area", t: str = "t") -> DataFrame:
    return df.join(meta, "hru").groupBy(t).agg(_area_mean(F.col(value), F.col(area)).alias("mean"))


def monthly_mean(df: DataFrame, by: list[str], value: str = "value", t: str = "t") -> DataFrame:
    return df.groupBy(*by, F.trunc(t, "month").alias(t)).agg(F.avg(value).alias(value))


def contributors_per_time(bounds: DataFrame, most: int, t: str = "t") -> DataFrame:
    """Rows per time step with 0, 1, ... ``most`` sources, a column each."""
    return bounds.groupBy(t).agg(*[F.count_if(F.col("n_sources") == k).alias(f"n_{k}") for k in range(most + 1)])


def coverage_by_day(df: DataFrame, value: str, threshold: float, coverage: str, least: float, t: str = "t") -> DataFrame:
    """Per day: finite values, those above the threshold, those covered enough, and both."""
    above, covered = F.col(value) > threshold, F.col(coverage) >= least
    return df.groupBy(t).agg(F.count(value).alias("n_finite"), F.count_if(above).alias("n_above"), F.count_if(covered).alias("n_covered"), F.count_if(above & covered).alias("n_overlap"))


def best_day(summary: DataFrame, metric: str = "n_overlap", month: int | None = None, t: str = "t") -> DataFrame:
    """The day with the greatest metric, the first of several; a month without any day raises."""
    rows = summary if month is None else summary.where(F.month(t) == month)
    if rows.isEmpty():
        raise ValueError(f"no day in month {month}")
    return rows.orderBy(F.desc(metric), t).limit(1)


def missing_count(df: DataFrame, value: str = "value") -> DataFrame:
    n = F.count_if(F.col(value).isNull())
    return df.agg(n.alias("n_missing"), (n / F.count("*")).alias("missing_share"))


def percentiles(df: DataFrame, by: list[str], at: list[float], value: str = "value", accuracy: int | None = None) -> DataFrame:
    """Percentiles, a column each: p2 for 0.02.

    Exact and interpolated ones come from distributed selection, whatever a group's size; its
    passes run when this is called. With ``accuracy`` (say 100,000) they come from sketches of
    bounded size in one lazy pass, off by a share of 1 / accuracy of the rows.
    """
    if accuracy is not None:
        return df.groupBy(*by).agg(*[F.percentile_approx(value, p, accuracy).alias(f"p{round(p * 100)}") for p in at])
    found = selection.wide(df, value, at, by)
    if not by:
        return found
    groups = df.select(*by).distinct()
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by]
    return groups.alias("l").join(found.alias("r"), same, "left").select(*[F.col(f"l.{c}") for c in by], *[F.col(f"r.p{round(p * 100)}") for p in at])


def histogram(df: DataFrame, by: str, bins: int = 60, value: str = "value") -> DataFrame:
    """(by, bin, n, density): equal bins between each group's extremes; the maximum falls in the last."""
    lim = df.groupBy(by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(value).alias("all"))
    rows = df.where(F.col(value).isNotNull()).join(lim.where("hi > lo"), by)
    k = F.least(F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins) + 1, F.lit(bins)).cast("int")
    out = rows.groupBy(by, "lo", "hi", "all", k.alias("bin")).agg(F.count("*").alias("n"))
    return out.select(by, "bin", "n", (F.col("n") / (F.col("all") * (F.col("hi") - F.col("lo")) / bins)).alias("density"))


def _beside(row: DataFrame, df: DataFrame, value: str, at: list[float], accuracy: int | None, order: list[str]) -> DataFrame:
    """One row of figures with percentiles beside it."""
    one = percentiles(df, [], at, value, accuracy).withColumn("__one", F.lit(1))
    return row.withColumn("__one", F.lit(1)).join(one, "__one").select(*order)


def describe(df: DataFrame, value: str, accuracy: int | None = None) -> DataFrame:
    """One row of summary figures; ``accuracy`` as in ``percentiles``."""
    c = F.col(value)
    row = df.agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"), F.sum(c).alias("total"))
    return _beside(row, df, value, [0.25, 0.5, 0.75], accuracy, ["n", "mean", "std", "min", "p25", "p50", "p75", "max", "total"])


def granules_by(df: DataFrame, key: str, path: str = "path") -> DataFrame:
    """Granule paths of one acquisition or water year, sorted. A key has as many as tiles exist."""
    return df.groupBy(key).agg(F.array_sort(F.collect_list(path)).alias("paths"))


def mean_over_time(df: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    return df.groupBy(*by).agg(F.avg(value).alias(value))


def mean_over_space(df: DataFrame, value: str = "value", t: str = "t") -> DataFrame:
    return df.groupBy(t).agg(F.avg(value).alias(value))


def climatology(df: DataFrame, value: str = "value", t: str = "t") -> DataFrame:
    return df.groupBy(F.month(t).alias("month")).agg(F.avg(value).alias(value))


def difference_of_means(df: DataFrame, by: list[str], a: str, b: str) -> DataFrame:
    return df.groupBy(*by).agg((F.avg(a) - F.avg(b)).alias("difference"))


def field_statistics(df: DataFrame, value: str, limit: float, accuracy: int | None = None) -> DataFrame:
    """One row of a field's figures; ``accuracy`` as in ``percentiles``."""
    c = F.col(value)
    row = df.agg(F.min(c).alias("least"), F.max(c).alias("greatest"), F.avg(c).alias("mean"), (F.count_if(c.isNull()) / F.count("*")).alias("missing_share"), F.count_if(c > limit).alias("n_above"))
    return _beside(row, df, value, [0.99], accuracy, ["least", "greatest", "mean", "missing_share", "p99", "n_above"])


def category_shares(df: DataFrame, code: str, labels: DataFrame | None = None) -> DataFrame:
    """(code, label, n, percent), most frequent first; codes without a label are "Unknown"."""
    n = df.groupBy(code).agg(F.count("*").alias("n"))
    out = n.withColumn("percent", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()))
    if labels is not None:
        out = out.join(labels, code, "left").withColumn("label", F.coalesce("label", F.lit("Unknown"))).select(code, "label", "n", "percent")
    return out.orderBy(F.desc("n"), code)


def side_by_side(a: DataFrame, b: DataFrame, value: str = "value", t: str = "t") -> DataFrame:
    """Spatial means of two sources over their common times."""
    return mean_over_space(a, value, t).withColumnRenamed(value, "a").join(mean_over_space(b, value, t).withColumnRenamed(value, "b"), t)


def peak(series: DataFrame, value: str = "value", t: str = "t") -> DataFrame:
    """One row: the time of the greatest value, the first of several."""
    top = F.max_by(F.struct(F.col(t).alias("t"), F.col(value).alias("v")), F.struct(F.col(value), -F.datediff(F.col(t), F.lit("1970-01-01").cast("date")))).alias("r")
    return series.where(F.col(value).isNotNull()).agg(top).select(F.col("r.t").alias(t), F.col("r.v").alias(value))


def period_of(df: DataFrame, t: str = "t") -> DataFrame:
    """One row: first and last time; an empty table raises."""
    out = df.agg(F.min(t).alias("first"), F.max(t).alias("last"))
    if out.first()["first"] is None:
        raise ValueError("no data, so no period")
    return out
