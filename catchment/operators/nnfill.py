"""Filling gaps in bounds from the nearest polygons that have them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catchment.sources.tables import scratch


def nearest(gaps: DataFrame, points: DataFrame, k: int, cell: float, hru: str = "hru", x: str = "x", y: str = "y") -> DataFrame:
    """(hru, donor, rank): the ``k`` nearest other points of each gap at any distance, ties by donor id.

    Points are keyed by square cells that would hold one point each if they were spread evenly (of
    side ``cell`` times a power of two) and, level by level, of twice the side until one cell holds all. A gap is searched at the first level where its cell and the
    eight around it hold k + 1 points: the k-th neighbour is then within 2.83 sides, so an
    equi-join with the cells up to three away finds all k. Points of one place are searched
    for once, and only the k + 1 smallest ids of a place can be donors.
    """
    ends = points.agg(F.min(x), F.min(y), F.max(x) - F.min(x), F.max(y) - F.min(y), F.count("*")).first()
    x0, y0, *span, n = (v or 0.0 for v in ends)
    levels = max(0, math.ceil(math.log2(max(*span, cell) / cell))) + 1
    finest = math.floor(math.log2(max(span) / math.sqrt(n) / cell)) if n and max(span) > 0 else 0
    side = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("level"))
    key = lambda c, o: F.floor((F.col(c) - o) / side)
    every = lambda df: df.withColumn("level", F.explode(F.sequence(F.lit(finest), F.lit(levels)))).withColumns({"cx": key("px", x0), "cy": key("py", y0)})
    around = lambda df, r: df.withColumn("cx", F.explode(F.sequence(F.col("cx") - r, F.col("cx") + r))).withColumn("cy", F.explode(F.sequence(F.col("cy") - r, F.col("cy") + r)))
    known = points.select(F.col(hru).alias("donor"), F.col(x).alias("px"), F.col(y).alias("py")).where("px is not null and py is not null")
    first = F.row_number().over(Window.partitionBy("px", "py").orderBy("donor"))
    donors = every(known.withColumn("n", first).where(F.col("n") <= k + 1).drop("n"))
    asked = gaps.select(F.col(hru).alias("donor")).distinct().join(known, "donor").withColumnRenamed("donor", hru)
    places = every(asked.select("px", "py").distinct())
    count = donors.groupBy("level", "cx", "cy").agg(F.count("*").alias("n"))
    level = around(places, 1).join(count, ["level", "cx", "cy"]).groupBy("px", "py", "level").agg(F.sum("n").alias("n"))
    level = level.where((F.col("n") > k) | (F.col("level") == levels)).groupBy("px", "py").agg(F.min("level").alias("level"))
    reach = around(level.withColumns({"cx": key("px", x0), "cy": key("py", y0)}), 3)
    near = reach.join(donors.withColumnsRenamed({"px": "dx", "py": "dy"}), ["level", "cx", "cy"])
    near = near.select("px", "py", "donor", ((F.col("px") - F.col("dx")) ** 2 + (F.col("py") - F.col("dy")) ** 2).alias("d2"))
    best = near.withColumn("n", F.row_number().over(Window.partitionBy("px", "py").orderBy("d2", "donor"))).where(F.col("n") <= k + 1)
    best = best.groupBy("px", "py").agg(F.array_sort(F.collect_list(F.struct("n", "donor"))).alias("best"))
    others = F.slice(F.filter(F.transform("best", lambda s: s["donor"]), lambda d: d != F.col(hru)), 1, k)
    return asked.join(best, ["px", "py"]).select(hru, F.posexplode(others).alias("rank", "donor")).select(hru, "donor", (F.col("rank") + 1).alias("rank"))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _roots(gaps: DataFrame, have: DataFrame, near: DataFrame) -> DataFrame:
    """(hru, t, root): the observed polygon that a chained gap's value comes from, in rounds of written joins.

    A gap can be filled if a candidate is observed, or a gap of a smaller id that can be
    filled; it takes the first such candidate. Pointers to gaps are then halved.
    """
    path = scratch(gaps.sparkSession)
    edges = gaps.join(near, "hru").join(have.select(F.col("hru").alias("donor"), "t", F.lit(True).alias("seen")).unionByName(gaps.select(F.col("hru").alias("donor"), "t", F.lit(False).alias("seen"))), ["donor", "t"])
    edges = _written(edges.where(F.col("seen") | (F.col("donor") < F.col("hru"))), f"{path}/edges")
    can = new = _written(edges.where("seen").select("hru", "t").distinct(), f"{path}/can0")
    step = 0
    while True:
        step += 1
        reached = edges.where("not seen").join(new.withColumnRenamed("hru", "donor"), ["donor", "t"], "left_semi").select("hru", "t").distinct()
        new = _written(reached.join(can, ["hru", "t"], "left_anti"), f"{path}/can{step}")
        if new.isEmpty():
            break
        can = can.unionByName(new)
    good = edges.where("seen").unionByName(edges.where("not seen").join(can.withColumnRenamed("hru", "donor"), ["donor", "t"], "left_semi").select(edges.columns))
    up = _written(good.groupBy("hru", "t").agg(F.min_by(F.struct("donor", "seen"), "rank").alias("d")).select("hru", "t", F.col("d.donor").alias("root"), "d.seen"), f"{path}/up0")
    step = 0
    while not up.where("not seen").isEmpty():
        step += 1
        next_ = up.select(F.col("hru").alias("root"), "t", F.col("root").alias("r2"), F.col("seen").alias("s2"))
        jumped = up.where("not seen").join(next_, ["root", "t"]).select("hru", "t", F.col("r2").alias("root"), F.col("s2").alias("seen"))
        up = _written(up.where("seen").unionByName(jumped), f"{path}/up{step}")
    return up.select("hru", "t", "root")


def fill(bounds: DataFrame, centroids: DataFrame, max_candidates: int = 10, cell: float = 1.0, donors: str = "observed") -> DataFrame:
    """Bounds with both ends missing take those of the nearest polygon that has both at the same time.

    Adds ``nn_filled`` (0 or 1). "observed": only observed bounds are given on. "chained":
    polygons are gone through in id order and a filled one can give on. ``centroids`` (hru, x, y)
    may also be neighbours (hru, donor, rank) that ``nearest`` has found before.
    """
    b = bounds.withColumn("__gap", F.col("lower_bound").isNull() & F.col("upper_bound").isNull())
    near = centroids if "donor" in centroids.columns else nearest(b.where("__gap").select("hru").distinct(), centroids, max_candidates, cell)
    rest = [c for c in bounds.columns if c not in ("hru", "t", "lower_bound", "upper_bound")]
    if donors == "observed":
        have = bounds.where("lower_bound is not null and upper_bound is not null").select(F.col("hru").alias("donor"), "t", F.col("lower_bound").alias("dl"), F.col("upper_bound").alias("du"))
        got = b.where("__gap").select("hru", "t").join(near, "hru").join(have, ["donor", "t"])
        got = got.groupBy("hru", "t").agg(F.min_by(F.struct("dl", "du"), "rank").alias("d"))
        out = b.join(got, ["hru", "t"], "left")
        filled = F.col("__gap") & F.col("d").isNotNull()
        return out.select("hru", "t", F.when(filled, F.col("d.dl")).otherwise(F.col("lower_bound")).alias("lower_bound"), F.when(filled, F.col("d.du")).otherwise(F.col("upper_bound")).alias("upper_bound"), *rest, filled.cast("tinyint").alias("nn_filled"))
    real = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None))
    have = bounds.select("hru", "t", real("lower_bound").alias("dl"), real("upper_bound").alias("du")).where("dl is not null and du is not null")
    roots = _roots(b.where("__gap").select("hru", "t"), have, near)
    got = roots.join(have.withColumnRenamed("hru", "root"), ["root", "t"]).select("hru", "t", "dl", "du", F.lit(1).alias("__filled"))
    out = b.join(got, ["hru", "t"], "left").withColumns({"lower_bound": F.coalesce("dl", real("lower_bound")), "upper_bound": F.coalesce("du", real("upper_bound"))})
    return out.withColumn("nn_filled", F.coalesce("__filled", F.lit(0)).cast("tinyint")).select(*bounds.columns, "nn_filled")
