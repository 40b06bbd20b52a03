"""Results from parts that arrive in any order, late, or again.

Each landed part (a file, a granule) leaves its mergeable sums per variable, polygon and time:
weight, weighted sum and square, count, least and greatest value. Statistics are made from all
parts' sums when they are asked for, so a late part adds to them and one that lands again replaces
what it gave before, least and greatest values included. A cell and time in two parts counts twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from catchment.operators.zonal import cell_counts, weighted

SCHEMA = "var string, hru long, t date, w double, wv double, wvv double, n long, lo double, hi double, part string"
STATS = ("mean", "min", "max", "sum", "count", "std")


def partials(grid: DataFrame, weights: DataFrame, values: list[str], part: str = "part", time: str = "t", cell: tuple[str, ...] = ("iy", "ix")) -> DataFrame:
    """Mergeable sums of each part, and one row without a variable for each part, so that a part that lost all its rows replaces too."""
    each = F.explode(F.array(*[F.struct(F.lit(v).alias("var"), F.col(v).cast("double").alias("v")) for v in values])).alias("e")
    rows = weighted(grid, weights, cell).select(part, "hru", F.col(time).alias("t"), "area", each).select(F.col(part).cast("string").alias("part"), "hru", "t", "area", "e.var", "e.v")
    v, w = F.col("v"), F.when(F.col("v").isNotNull(), F.col("area"))
    sums = rows.groupBy("part", "var", "hru", "t").agg(F.sum(w).alias("w"), F.sum(w * v).alias("wv"), F.sum(w * v * v).alias("wvv"), F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    none = {c: F.lit(None) for c in ("var", "hru", "t", "w", "wv", "wvv", "n", "lo", "hi")}
    marks = grid.select(F.col(part).cast("string").alias("part")).distinct().withColumns(none)
    columns = [F.col(c.split()[0]).cast(c.split()[1]) for c in SCHEMA.split(", ")]
    return sums.select(columns).unionByName(marks.select(columns))


def merged(parts: DataFrame, stat: str, weights: DataFrame) -> DataFrame:
    """(var, hru, t, value) by ``stat``, or "masked_" + stat; unmasked ones need every weighted cell."""
    masked, name = stat.startswith("masked_"), stat.removeprefix("masked_")
    if name not in STATS:
        raise ValueError(f"no mergeable statistic: {stat}")
    total = parts.where("var is not null").groupBy("var", "hru", "t").agg(*[F.sum(c).alias(c) for c in ("w", "wv", "wvv", "n")], F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    mass = F.when(F.col("w") > 0, F.col("w"))
    mean = F.col("wv") / mass
    forms: dict[str, Column] = {"mean": mean, "min": F.col("lo"), "max": F.col("hi"), "sum": F.col("wv"), "count": F.col("n"), "std": F.sqrt(F.greatest(F.col("wvv") / mass - mean * mean, F.lit(0.0)))}
    if masked:
        return total.select("var", "hru", "t", forms[name].alias("value"))
    return total.join(cell_counts(weights), "hru").select("var", "hru", "t", F.when(F.col("n") == F.col("n_cells"), forms[name]).alias("value"))


class PartStore:
    """Parts' sums below one path, a folder for each part."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, grid: DataFrame, weights: DataFrame, values: list[str], part: str = "part", time: str = "t", cell: tuple[str, ...] = ("iy", "ix")) -> None:
        """Add or replace the parts of ``grid``. A part is written whole, so a failed run is simply repeated."""
        rows = partials(grid, weights, values, part, time, cell)
        rows.repartition("part", F.pmod(F.col("hru"), F.lit(64))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(self.path)

    def parts(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def result(self, stat: str, weights: DataFrame) -> DataFrame:
        return merged(self.parts(), stat, weights)

    def follow(self, landed: str, schema: str, weights: DataFrame, values: list[str], checkpoint: str, **how) -> StreamingQuery:
        """Add all files that landed since the last run, a part each, then stop. A file that is written again under its name goes through ``add``."""

        def one(batch: DataFrame, _: int) -> None:
            self.add(batch, weights, values, **how)

        stream = self.spark.readStream.schema(schema).parquet(landed).withColumn("part", part_of_file())
        return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def part_of_file() -> Column:
    """A name for the file that a row comes from."""
    return F.md5(F.col("_metadata.file_path"))
