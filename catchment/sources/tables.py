"""Reading and writing series and targets as partitioned Parquet."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment.functions.timeaxis import in_period

SERIES = "source string, var string, hru long, t date, value double, year int"


def read_grids(spark: SparkSession, path: str, schema: str, pattern: str = "*.parquet") -> DataFrame:
    """Grid files by name pattern; none is an error."""
    df = spark.read.schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").parquet(path)
    if df.select("_metadata.file_path").isEmpty():
        raise FileNotFoundError(f"no {pattern} with data below {path}")
    return df


def read_series(spark: SparkSession, path: str, source: str, var: str, period: tuple[dt.date, dt.date]) -> DataFrame:
    """One source's variable over a period. No data, no such variable, and a period outside the coverage are told apart."""
    rows = spark.read.schema(SERIES).parquet(path).where(F.col("source") == source)
    mine = rows.where(F.col("var") == var)
    hit = mine.where(F.col("year").between(period[0].year, period[1].year) & in_period(F.col("t"), *period))
    if hit.isEmpty():
        if rows.isEmpty():
            raise FileNotFoundError(f"no aggregated data of {source}")
        if mine.isEmpty():
            raise KeyError(f"{source} has no variable {var}")
        r = mine.agg(F.min("t"), F.max("t")).first()
        raise ValueError(f"{source}/{var} covers {r[0]}..{r[1]}, not {period[0]}..{period[1]}")
    return hit.drop("year")


def read_region(spark: SparkSession, path: str, region: str) -> DataFrame:
    """One region of a table that is partitioned by region."""
    return spark.read.parquet(path).where(F.col("region") == region)


def concat_granules(parts: list[DataFrame], variables: list[str], keys: tuple[str, ...] = ("t", "iy", "ix")) -> DataFrame:
    """Granules below one another, requested variables only."""
    out = parts[0].select(*keys, *variables)
    for p in parts[1:]:
        out = out.unionByName(p.select(*keys, *variables))
    return out


def merge_groups(groups: list[DataFrame], keys: tuple[str, ...] = ("t", "iy", "ix")) -> DataFrame:
    """Per-variable groups side by side."""
    out = groups[0]
    for g in groups[1:]:
        out = out.join(g, list(keys), "full")
    return out


def stack_pair(a: DataFrame, b: DataFrame, year: str = "year") -> DataFrame:
    """Two variables' annual rasters in one table; their years must be the same."""
    ya, yb = a.select(year).distinct(), b.select(year).distinct()
    odd = ya.withColumn("l", F.lit(1)).join(yb.withColumn("r", F.lit(1)), year, "full").where("l is null or r is null")
    if bad := odd.take(5):
        raise ValueError(f"years differ: {[r[year] for r in bad]}")
    return a.unionByName(b)


def undone(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What is wanted and not there yet."""
    return wanted.join(done.select(*keys).distinct(), keys, "left_anti")


def stale(inputs: DataFrame, outputs: DataFrame, key: str = "year", stamp: str = "modified") -> DataFrame:
    """Keys whose newest input is newer than the output, or that have none."""
    i, o = inputs.groupBy(key).agg(F.max(stamp).alias("i")), outputs.groupBy(key).agg(F.min(stamp).alias("o"))
    return i.join(o, key, "left").where("o is null or i > o").select(key)


def file_stamps(df: DataFrame, key: str = "year") -> DataFrame:
    """(key, modified) of the files behind a table."""
    return df.groupBy(key).agg(F.max("_metadata.file_modification_time").alias("modified"))


def write_series(df: DataFrame, path: str, t: str = "t", hru_span: int = 10_000) -> None:
    """Write by source and year; only the partitions at hand are replaced, so that reruns repeat nothing else.

    A year of a source is dealt out by ranges of ``hru_span`` polygon ids, so that no task
    takes all of its polygons; each file holds neighbouring ids in order.
    """
    out = df.withColumn("year", F.year(t)).withColumn("__span", F.floor(F.col("hru") / hru_span))
    out = out.repartition("source", "year", "__span").sortWithinPartitions("source", "year", "hru", t).drop("__span")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source", "year").parquet(path)


def write_target(df: DataFrame, path: str) -> None:
    """Bounds as floats, flags as bytes, files in ascending polygon order with the period's exclusive end kept."""
    kinds = {"lower_bound": "float", "upper_bound": "float", "n_sources": "tinyint", "nn_filled": "tinyint"}
    out = df.withColumns({c: F.col(c).cast(k) for c, k in kinds.items() if c in df.columns})
    out.repartitionByRange("hru").sortWithinPartitions("hru", "t").write.mode("overwrite").parquet(path)


def read_target(spark: SparkSession, path: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """A target, clipped to a window; an empty window gives no rows."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.where(F.col("t") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("t") <= F.lit(end))
    return df


def read_file_listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, modificationTime); the contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below spark.checkpoint.dir. Only a local session that has none gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/catchment-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to a new scratch table and read from there."""
    path = f"{scratch(df.sparkSession)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
