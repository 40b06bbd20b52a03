"""Exact quantiles of groups of any size by distributed selection.

All ranks of all groups are narrowed down together. A pass draws splitters from a quantile sketch
of every open interval, counts the rows between them and on them, and keeps the intervals that
hold a wanted rank; a rank that falls on a splitter is found. An interval of ``leaf`` rows or fewer
is sorted at last. So a group of n rows takes about log(n / leaf) / log(bins) passes, no task holds
more than ``leaf`` of its rows together, and many equal values end at a splitter at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catchment.sources.tables import scratch


def _cut(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _within(rows: DataFrame, intervals: DataFrame) -> DataFrame:
    """Rows (g, v) with the open interval that holds them; intervals of a group do not overlap."""
    inside = (F.col("lo").isNull() | (F.col("v") > F.col("lo"))) & (F.col("hi").isNull() | (F.col("v") < F.col("hi")))
    return rows.join(intervals, "g").where(inside)


def _narrow(rows: DataFrame, big: DataFrame, bins: int) -> DataFrame:
    """(g, ks, base, n, lo, hi, found) of the bins that hold wanted ranks; ``found`` where the bin is one value."""
    at = [k / bins for k in range(1, bins)]
    splits = _within(rows, big).groupBy("g", "lo", "hi", "base", "ks").agg(F.array_sort(F.array_distinct(F.percentile_approx("v", at, 1000))).alias("s"))
    below = F.size(F.filter("s", lambda x: x < F.col("v")))
    bin_ = _within(rows, splits).withColumn("j", below).withColumn("on", F.coalesce(F.get("s", F.col("j")) == F.col("v"), F.lit(False)))
    counts = bin_.groupBy("g", "lo", "hi", "base", "ks", "s", "j", "on").agg(F.count("*").alias("n"))
    # An interval has 2 * bins rows here at the most.
    start = F.col("base") + F.sum("n").over(Window.partitionBy("g", "lo", "hi").orderBy("j", "on").rowsBetween(Window.unboundedPreceding, -1))
    begun = counts.withColumn("base", F.coalesce(start, F.col("base")))
    mine = F.filter("ks", lambda k: (k >= F.col("base")) & (k < F.col("base") + F.col("n")))
    left, right = F.when(F.col("j") > 0, F.get("s", F.col("j") - 1)).otherwise(F.col("lo")), F.when(F.col("j") < F.size("s"), F.get("s", F.col("j"))).otherwise(F.col("hi"))
    hits = begun.withColumn("ks", mine).where(F.size("ks") > 0)
    return hits.select("g", "ks", "base", "n", left.alias("lo"), right.alias("hi"), F.when(F.col("on"), F.get("s", F.col("j"))).alias("found"))


def values_at(rows: DataFrame, ranks: DataFrame, path: str, bins: int = 32, leaf: int = 10_000) -> DataFrame:
    """(g, k, v): the values at the ranks (g, n, ks) of each group of ``rows`` (g, v), ranks from 0."""
    none = F.lit(None).cast("double")
    open_ = _cut(ranks.select("g", "ks", F.lit(0).cast("long").alias("base"), F.col("n").cast("long").alias("n"), none.alias("lo"), none.alias("hi")), f"{path}/open0")
    done, turn = [], 0
    while True:
        small = _within(rows, open_.where(F.col("n") <= leaf))
        row = F.row_number().over(Window.partitionBy("g", "lo", "hi").orderBy("v")) - 1
        done.append(small.withColumn("k", F.col("base") + row).where(F.array_contains("ks", F.col("k"))).select("g", "k", "v"))
        big = open_.where(F.col("n") > leaf)
        if big.isEmpty():
            break
        turn += 1
        bins_ = _cut(_narrow(rows, big, bins), f"{path}/bins{turn}")
        done.append(bins_.where("found is not null").select("g", F.explode("ks").alias("k"), F.col("found").alias("v")))
        open_ = bins_.where("found is null").drop("found")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def quantiles(df: DataFrame, value: str, at: list[float], by: list[str] | None = None, discrete: bool = False, bins: int = 32, leaf: int = 10_000) -> DataFrame:
    """(by, p, value): exact quantiles, interpolated, or with ``discrete`` the first value that a share p of rows reaches.

    Missing values do not count; a group without values has none. NaN is above all numbers.
    """
    by = by or []
    path = scratch(df.sparkSession)
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    rows = _cut(df.select(group.alias("g"), F.col(value).cast("double").alias("v")).where("v is not null"), f"{path}/rows")
    p = F.explode(F.array(*[F.lit(float(x)) for x in at])).alias("p")
    sized = rows.groupBy("g").agg(F.count("*").alias("n"))
    place: Column = F.greatest(F.ceil(F.col("p") * F.col("n")) - 1, F.lit(0)) if discrete else F.col("p") * (F.col("n") - 1)
    wanted = _cut(sized.select("g", "n", p).withColumn("at", place.cast("double")).withColumns({"k0": F.floor("at"), "k1": F.ceil("at")}), f"{path}/wanted")
    ranks = wanted.select("g", "n", F.explode(F.array("k0", "k1")).alias("k")).groupBy("g", "n").agg(F.array_sort(F.collect_set("k")).alias("ks"))
    found = _cut(values_at(rows, ranks, path, bins, leaf), f"{path}/found")
    low, high = (found.select("g", F.col("k").alias(k), F.col("v").alias(v)) for k, v in (("k0", "v0"), ("k1", "v1")))
    both = wanted.join(low, ["g", "k0"]).join(high, ["g", "k1"])
    part = F.col("at") - F.col("k0")
    v = F.when(part > 0, F.col("v0") + part * (F.col("v1") - F.col("v0"))).otherwise(F.col("v0"))
    return both.select(*[F.col(f"g.{c}").alias(c) for c in by], "p", v.alias(value))


def wide(df: DataFrame, value: str, at: list[float], by: list[str] | None = None, **how) -> DataFrame:
    """The same as a row per group and a column per quantile: p2 for 0.02."""
    long = quantiles(df, value, at, by, **how)
    return long.groupBy(*(by or [])).agg(*[F.max(F.when(F.col("p") == x, F.col(value))).alias(f"p{round(x * 100)}") for x in at])
