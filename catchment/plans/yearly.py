"""Work year by year: only what is missing, empty or out of date is built, and the years are put together."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment.sources.tables import read_file_listing, stale


MARKS = "year int, n_rows long, n_files long, n_bytes long, polygons string"


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(year, n_files, n_bytes, modified) as the years' files at ``path`` stand now."""
    try:
        files = read_file_listing(spark, path, "*.parquet")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "year int, n_files long, n_bytes long, modified timestamp")
    year = F.regexp_extract("path", r"year=(\d+)/", 1)
    return files.where(year != "").groupBy(year.cast("int").alias("year")).agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"), F.min("modificationTime").alias("modified"))


def _mark(spark: SparkSession, path: str, year: int, rows: int, files: int, size: int, polygons: str | None = None) -> None:
    """A year's mark, beside the data; it is taken back before the year is written again."""
    spark.createDataFrame([(year, rows, files, size, polygons)], MARKS).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}.marks/mark={year}")


def polygon_set(rows: DataFrame, hru: str = "hru") -> str:
    """A digest of the set of polygons in ``rows``."""
    r = rows.select(hru).distinct().agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(hru)).alias("x")).first()
    return f"{r['n']}/{r['x']}"


def _marks(spark: SparkSession, path: str) -> DataFrame:
    """The marks of years that were written to the end and still have all their files, rows or not, with ``modified``."""
    try:
        marks = spark.read.schema(MARKS).parquet(f"{path.rstrip('/')}.marks")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        marks = spark.createDataFrame([], MARKS)
    return _files(spark, path).join(marks, ["year", "n_files", "n_bytes"])


def years_done(spark: SparkSession, path: str) -> DataFrame:
    """(year, modified) of the years at ``path`` that were written to the end, hold rows, and still have all their files.

    A year counts by the mark that is written after it: a job that died while its files were
    moved has left none, and files that went since do not add up to it.
    """
    return _marks(spark, path).where("n_rows > 0").select("year", "modified")


def run_years(spark: SparkSession, years: Iterable[int], build: Callable[[int], DataFrame], path: str, inputs: DataFrame | None = None, polygons: str | None = None) -> list[int]:
    """Build and write each of ``years`` that is not at ``path`` yet; returns the ones that were built.

    A year that was cut off, is empty or has lost files is redone, and with ``inputs`` (year,
    modified) one that is older than its newest input. Each year replaces its own folder only,
    so a run that broke off goes on where it stopped. ``polygons`` names the set that years are
    worked out for, and is kept with them for ``stitch``.
    """
    done = years_done(spark, path)
    if inputs is not None:
        done = done.join(stale(inputs, done, "year", "modified"), "year", "left_anti")
    there = {r["year"] for r in done.select("year").collect()}
    todo = [y for y in sorted(set(years)) if y not in there]
    for y in todo:
        _mark(spark, path, y, 0, 0, 0)
        at = f"{path}/year={y}"
        build(y).write.mode("overwrite").parquet(at)
        now = _files(spark, path).where(F.col("year") == y).first()
        _mark(spark, path, y, spark.read.parquet(at).count(), *((now["n_files"], now["n_bytes"]) if now else (0, 0)), polygons)
    return todo


def stitch(spark: SparkSession, path: str, years: Iterable[int], hru: str = "hru", by_marks: bool = False) -> DataFrame:
    """All of ``years`` at ``path`` as one table. A year that is missing, or that has other polygons than the first one, raises.

    A year's polygons are those of its rows or, with ``by_marks``, those that it was worked out for
    (``polygons`` of ``run_years``): then a sparse grid may leave any of them out in a year, or all.
    """
    wanted = sorted(set(years))
    rows = spark.read.parquet(path).where(F.col("year").isin(wanted))
    sets = rows.select("year", hru).distinct().groupBy("year").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(hru)).alias("x"))
    found = {r["year"]: f"{r['n']}/{r['x']}" for r in sets.collect()}
    if by_marks:
        found |= {r["year"]: r["polygons"] for r in _marks(spark, path).where(F.col("polygons").isNotNull()).select("year", "polygons").collect()}
    if gone := [y for y in wanted if y not in found]:
        raise ValueError(f"no data for {gone}")
    if odd := [y for y in wanted if found[y] != found[wanted[0]]]:
        raise ValueError(f"{odd} have other polygons than {wanted[0]}")
    return rows.drop("year")
