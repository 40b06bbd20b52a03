"""Weights kept by content: a batch of polygons on a grid is cut once, whatever sources use the grid.

A batch's key is a digest of its polygons' ids and rings and of the grid's name. Wanted keys that
the store does not hold are worked out in one job and appended; all others are read. Moving, adding
or removing a polygon changes the key of its batch only, another grid the keys of all batches.

The store is two Parquet tables below one path: ``weights`` by (run, key), and ``keys``, written
after them. Only runs that ``keys`` names count, so what a job that died has left is never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WEIGHTS = "iy int, ix int, hru long, area double, key string, run string"
KEYS = "key string, grid string, n_polygons long, run string"


def by_place(fabric: DataFrame, side: float, x: Column, y: Column) -> DataFrame:
    """Adds ``batch``: the square of size ``side`` that holds a polygon's point (x, y), so that others' changes leave it as it is."""
    return fabric.withColumn("batch", F.concat_ws("/", F.floor(x / side), F.floor(y / side)))


def batch_keys(fabric: DataFrame, grid: str, hru: str = "hru", rings: str = "rings", batch: str = "batch") -> DataFrame:
    """(batch, n_polygons, key): digests of sets, whatever the order of rows."""
    part = lambda seed: F.sum(F.xxhash64(F.lit(seed), F.col(hru), F.col(rings)).cast("decimal(38,0)")).cast("string")
    sets = fabric.groupBy(batch).agg(F.count("*").alias("n_polygons"), part(1).alias("a"), part(2).alias("b"))
    return sets.select(batch, "n_polygons", F.sha2(F.concat_ws("#", F.col("n_polygons").cast("string"), "a", "b", F.lit(grid)), 256).alias("key"))


class WeightStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def keys(self) -> DataFrame:
        """(key, grid, n_polygons, run), one row a key: two jobs that worked out the same key at once are told apart by run."""
        return self._table("keys", KEYS).groupBy("key").agg(F.min(F.struct("run", "grid", "n_polygons")).alias("r")).select("key", "r.grid", "r.n_polygons", "r.run")

    def plan(self, fabric: DataFrame, grid: str, **names) -> DataFrame:
        """(batch, n_polygons, key, there) of the batches of a fabric."""
        have = self.keys().select("key", F.lit(True).alias("there"))
        return batch_keys(fabric, grid, **names).join(have, "key", "left").withColumn("there", F.coalesce("there", F.lit(False)))

    def weights(self, fabric: DataFrame, grid: str, compute: Callable[[DataFrame], DataFrame], hru: str = "hru", rings: str = "rings", batch: str = "batch") -> tuple[DataFrame, dict[str, int]]:
        """(iy, ix, hru, area) of the whole fabric, and how many batches were wanted and recomputed.

        ``compute`` gives the weights (iy, ix, hru, area) of some of the fabric's rows.
        """
        names = {"hru": hru, "rings": rings, "batch": batch}
        run = uuid.uuid4().hex
        wanted = self.plan(fabric, grid, **names)
        wanted.write.parquet(f"{self.path}/plans/{run}")  # the store changes below, the plan does not
        wanted = self.spark.read.schema(wanted.schema).parquet(f"{self.path}/plans/{run}")
        total = wanted.agg(F.count("*").alias("wanted"), F.count_if(~F.col("there")).alias("recomputed"), F.sum(F.when(~F.col("there"), F.col("n_polygons"))).alias("polygons")).first()
        counts = {"wanted": total["wanted"], "recomputed": total["recomputed"], "polygons": total["polygons"] or 0}
        if counts["recomputed"]:
            todo = fabric.join(wanted.where(~F.col("there")).select(batch, "key"), batch)
            keyed = todo.select(F.col(hru).cast("long").alias("hru"), "key").distinct()
            new = compute(todo.drop("key")).select("iy", "ix", F.col(hru).cast("long").alias("hru"), "area").join(keyed, "hru").withColumn("run", F.lit(run))
            new.repartition("key").sortWithinPartitions("key", "hru").write.partitionBy("run").mode("append").parquet(f"{self.path}/weights")
            wanted.where(~F.col("there")).select("key", F.lit(grid).alias("grid"), "n_polygons", F.lit(run).alias("run")).write.mode("append").parquet(f"{self.path}/keys")
        mine = wanted.select("key").distinct().join(self.keys().select("key", "run"), "key")
        return self._table("weights", WEIGHTS).join(mine, ["key", "run"]).select("iy", "ix", "hru", "area"), counts
