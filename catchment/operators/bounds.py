"""Aligning sources on a calendar and taking their bounds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def align(series: DataFrame, spine: DataFrame, hrus: DataFrame, hru: str = "hru", t: str = "t", value: str = "value", most: int = 100_000) -> DataFrame:
    """One row per polygon and calendar label, NULL where the series has none.

    Two rows with the same label raise. The result is the product of polygons and calendar; the
    calendar goes to every task, so that one of more than ``most`` labels raises.
    """
    if spine.count() > most:
        raise ValueError(f"a calendar has more than {most} labels")
    every = hrus.select(hru).distinct().join(F.broadcast(spine.select(t)))
    one = series.groupBy(hru, t).agg(F.first(value).alias(value), F.count("*").alias("__n"))
    one = one.withColumn(value, F.when(F.col("__n") == 1, F.col(value)).otherwise(F.raise_error(F.lit("a period occurs twice in one series"))))
    return every.join(one.drop("__n"), [hru, t], "left").select(hru, t, value)


def multi_source_bounds(sources: list[DataFrame], keys: tuple[str, ...] = ("hru", "t"), value: str = "value") -> DataFrame:
    """Least, greatest and number of the values that are there; all missing gives (NULL, NULL, 0).

    The sources are stacked and grouped once: partial aggregation leaves one row per key and
    task before the shuffle, where a chain of outer joins would shuffle every source.
    """
    rows = reduce(DataFrame.unionByName, [s.select(*keys, value) for s in sources])
    return rows.groupBy(*keys).agg(F.min(value).alias("lower_bound"), F.max(value).alias("upper_bound"), F.count(value).cast("tinyint").alias("n_sources"))


def bounds_on_calendar(sources: list[DataFrame], hrus: DataFrame, labels: Column, hru: str = "hru", t: str = "t", value: str = "value") -> DataFrame:
    """Bounds of all sources for every polygon and calendar label, as if each source were aligned first.

    The sources are stacked and grouped once; every polygon is exploded by the calendar once,
    without a join, and takes the bounds that are there. Two rows of one source with the same
    polygon and label raise.
    """
    rows = reduce(DataFrame.unionByName, [s.select(hru, t, value, F.lit(k).alias("__s")) for k, s in enumerate(sources)])
    most = F.array_max(F.array(*[F.count_if(F.col("__s") == k) for k in range(len(sources))])).alias("__most")
    one = rows.groupBy(hru, t).agg(F.min(value).alias("lower_bound"), F.max(value).alias("upper_bound"), F.count(value).alias("n_sources"), most)
    every = hrus.select(hru).distinct().select(hru, F.explode(labels).alias(t))
    n = F.when(F.col("__most") > 1, F.raise_error(F.lit("a period occurs twice in one series")).cast("long")).otherwise(F.coalesce("n_sources", F.lit(0)))
    return every.join(one, [hru, t], "left").select(hru, t, "lower_bound", "upper_bound", n.cast("tinyint").alias("n_sources"))


def merge_variables(parts: list[DataFrame], keys: tuple[str, ...] = ("hru", "t")) -> DataFrame:
    """Per-variable results side by side."""
    return reduce(lambda a, b: a.join(b, list(keys), "full"), parts)


def attach(series: DataFrame, meta: DataFrame, hru: str = "hru") -> DataFrame:
    """Polygon attributes to each row of a series."""
    return series.join(meta, hru)
