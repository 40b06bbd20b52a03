"""Spatial batches, and keys under which weight tables are kept."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catchment.operators import selection
from catchment.sources.tables import scratch


def spatial_batches(points: DataFrame, size: int, x: str = "x", y: str = "y", id_col: str = "hru", sketched: int = 20_000) -> DataFrame:
    """``points`` with ``batch_id`` by bisection at the lower median, along x and y in turn.

    A node of ``size`` // 2 points or fewer, or one that a median does not part, stays whole.
    Each level is one aggregation and one join, whatever the number of nodes, and is written,
    so that the next one starts from rows. Medians are exact: of nodes up to ``sketched`` points
    from a quantile sketch, whose error is below half a rank there, of larger ones by selection.
    """
    n = points.count()
    if not n:
        return points.withColumn("batch_id", F.lit(0))
    depth = max(0, math.ceil(math.log2(max(1.0, n / size))))
    path = scratch(points.sparkSession)
    now = points.withColumn("__path", F.lit("")).withColumn("__open", F.lit(True))
    for level in range(depth):
        c = x if level % 2 == 0 else y
        cuts = now.where("__open").groupBy("__path").agg(F.percentile_approx(c, 0.5, 100_000).alias("__cut"), F.count("*").alias("__n"), F.max(c).alias("__hi"))
        if now.where("__open").groupBy("__path").count().where(F.col("count") > sketched).take(1):
            exact = selection.quantiles(now.where("__open"), c, [0.5], ["__path"], discrete=True, leaf=sketched)
            cuts = cuts.drop("__cut").join(exact.select("__path", F.col(c).alias("__cut")), "__path")
        cuts = cuts.where((F.col("__n") > max(1, size // 2)) & (F.col("__hi") > F.col("__cut")))
        now = now.join(cuts.select("__path", "__cut"), "__path", "left")
        split = F.col("__open") & F.col("__cut").isNotNull()
        side = F.when(F.col(c) <= F.col("__cut"), "0").otherwise("1")
        now = now.withColumn("__path", F.when(split, F.concat("__path", side)).otherwise(F.col("__path"))).withColumn("__open", split).drop("__cut")
        now.write.parquet(f"{path}/level{level}")
        now = points.sparkSession.read.schema(now.schema).parquet(f"{path}/level{level}")
    order = now.select("__path").distinct().withColumn("batch_id", (F.dense_rank().over(Window.orderBy("__path")) - 1))
    return now.join(order, "__path").select(*points.columns, "batch_id")


def batch_statistics(batches: DataFrame) -> DataFrame:
    sizes = batches.groupBy("batch_id").agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("n_batches"), F.min("n").alias("smallest"), F.max("n").alias("largest"), F.avg("n").alias("mean_size"), F.percentile("n", F.lit(0.5)).alias("median_size"))


def fingerprint(ids: DataFrame, grid: str, id_col: str = "hru") -> DataFrame:
    """One row: the key of a weight table, from the set of ids and the grid's name.

    The set is reduced to its size and two sums of hashes, so no list of ids is gathered.
    """
    part = lambda at: F.sum(F.conv(F.substring(F.md5(F.col(id_col).cast("string")), at, 15), 16, 10).cast("decimal(38,0)"))
    one = ids.select(id_col).distinct().agg(F.count("*").alias("n"), part(1).alias("a"), part(17).alias("b"))
    return one.select(F.sha2(F.concat_ws("#", "n", "a", "b", F.lit(grid)), 256).alias("key"))
