"""Grid values to polygons: the weighted join and its statistics.

``grid`` has the cell columns, a time and value columns; ``weights`` has the cell columns,
``hru`` and ``area``. All value columns share one join and one aggregation. The number of
weighted cells of a polygon comes from the weight table, so cells that a sparse grid leaves
out count as missing.

Unmasked statistics are NULL as soon as one weighted cell is missing; masked ones skip
missing cells. ``sum`` weighs by covered area, ``count`` counts cells, ``std`` is the
weighted population deviation, ``median`` the first value at which half of the weight is
reached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATS = ("mean", "min", "max", "sum", "count", "std", "median")


def cell_counts(weights: DataFrame) -> DataFrame:
    return weights.groupBy("hru").agg(F.count("*").alias("n_cells"), F.sum("area").alias("all_area"))


def small(weights: DataFrame, most: int = 1_000_000) -> DataFrame:
    """``weights`` marked to go to every task whole if they have no more than ``most`` rows (some 100 MB), else to be joined by cell.

    Counts the rows, so give it weights that are kept. The grid stays where it was read then:
    only sums per polygon and time are shuffled. Larger weights are marked too, as Spark judges
    by the size of packed files and would send to every task what is much larger there.
    """
    return weights.hint("broadcast" if weights.limit(most + 1).count() <= most else "merge")


def weighted(grid: DataFrame, weights: DataFrame, cell: tuple[str, ...] = ("iy", "ix")) -> DataFrame:
    """The core join: every grid value with each polygon that its cell is part of."""
    return grid.join(weights, list(cell))


def _plain(stat: str, v: Column, w: Column) -> Column:
    there = v.isNotNull()
    mass = F.sum(F.when(there, w))
    mean = F.when(mass > 0, F.sum(w * v) / F.when(mass > 0, mass))
    square = F.when(mass > 0, F.sum(w * v * v) / F.when(mass > 0, mass))
    return {"mean": mean, "min": F.min(v), "max": F.max(v), "sum": F.sum(w * v), "count": F.count(v), "std": F.sqrt(F.greatest(square - mean * mean, F.lit(0.0)))}[stat]


def aggregate(grid: DataFrame, weights: DataFrame, values: list[str], stat: str = "mean", time: str = "t", cell: tuple[str, ...] = ("iy", "ix")) -> DataFrame:
    """(hru, t, one column per value) by ``stat``, or "masked_" + stat."""
    masked, name = stat.startswith("masked_"), stat.removeprefix("masked_")
    if name not in STATS:
        raise ValueError(f"no such statistic: {stat}")
    rows = weighted(grid, weights, cell)
    if name == "median":
        out = _medians(rows, values, time)
    else:
        out = rows.groupBy("hru", time).agg(*[_plain(name, F.col(v), F.col("area")).alias(v) for v in values], *[F.count(v).alias(f"__n_{v}") for v in values])
    if not masked:
        out = out.join(cell_counts(weights), "hru").withColumns({v: F.when(F.col(f"__n_{v}") == F.col("n_cells"), F.col(v)) for v in values})
    return out.select("hru", time, *values)


def _medians(rows: DataFrame, values: list[str], time: str) -> DataFrame:
    """Weighted medians and counts (``__n_``) of all values: one shuffle by polygon and time, one sort for each value."""
    whole = Window.partitionBy("hru", time)
    rows, pick, count = rows.select("hru", time, "area", *values), [], []
    for k, v in enumerate(values):
        there = F.when(F.col(v).isNotNull(), F.col("area"))
        rows = rows.withColumn(f"__run{k}", F.sum(there).over(whole.orderBy(F.col(v).asc_nulls_last())))
        rows = rows.withColumn(f"__all{k}", F.sum(there).over(whole))
        pick.append(F.min(F.when(F.col(f"__run{k}") >= F.col(f"__all{k}") / 2, F.col(v))).alias(v))
        count.append(F.count(v).alias(f"__n_{v}"))
    return rows.groupBy("hru", time).agg(*pick, *count)


def covered_fraction(grid: DataFrame, weights: DataFrame, value: str, time: str = "t", cell: tuple[str, ...] = ("iy", "ix")) -> DataFrame:
    """Share of a polygon's weighted area whose cells have a value."""
    rows = weighted(grid, weights, cell).groupBy("hru", time).agg(F.sum(F.when(F.col(value).isNotNull(), F.col("area")).otherwise(0.0)).alias("__a"))
    return rows.join(cell_counts(weights), "hru").select("hru", time, (F.col("__a") / F.col("all_area")).alias("covered_fraction"))


def valid_area_fraction(grid: DataFrame, weights: DataFrame, mask: str = "valid_mask", time: str = "t", cell: tuple[str, ...] = ("iy", "ix")) -> DataFrame:
    """Weighted mean of a 0/1 mask."""
    return aggregate(grid, weights, [mask], "masked_mean", time, cell).withColumnRenamed(mask, "valid_area_fraction")


def without_cells(fabric: DataFrame, weights: DataFrame) -> DataFrame:
    """Polygons that no grid cell meets."""
    return fabric.join(weights.select("hru").distinct(), "hru", "left_anti")
