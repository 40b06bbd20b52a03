"""A source from its grid files to finished years: kept weights, resumable years, regions under keys of their own."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment.functions.projections import albers_steps, geographic_steps, step_by_step
from catchment.operators.cutting import cell_weights, with_corners
from catchment.operators.zonal import small
from catchment.plans.pipelines import aggregate_source, to_long
from catchment.plans.weightstore import WeightStore, by_place
from catchment.plans.yearly import polygon_set, run_years, stitch
from catchment.sources.specs import SourceSpec
from catchment.sources.tables import cut, file_stamps, read_grids


@dataclass(frozen=True)
class Landed:
    """Grid files of one source, or of one region of it: where they are, their columns, the cells (iy, ix, corners) in the
    equal-area system, and a name that changes when the grid does."""

    path: str
    schema: str
    cells: DataFrame
    grid: str


def mapped_cells(cells: DataFrame, mapping: Column) -> DataFrame:
    """(iy, ix, corners) of cells given by w, e, s, n in the system that a grid-mapping struct names."""
    plain = with_corners(cells, lambda x, y: (x, y))
    return plain.select("iy", "ix", step_by_step(F.col("corners"), *geographic_steps(mapping), *albers_steps()).alias("corners"))


def kept_weights(spark: SparkSession, fabric: DataFrame, landed: Landed, store: str, batch_side: float) -> tuple[DataFrame, dict[str, int]]:
    """Weights of a fabric (hru, rings in the equal-area system) on a grid, from the store where it has them."""
    first = F.col("rings")[0][0]
    placed = by_place(fabric.select("hru", "rings").where(F.size("rings") > 0), batch_side, first["x"], first["y"])
    return WeightStore(spark, store).weights(placed, landed.grid, lambda some: cell_weights(some, landed.cells))


def run_source(spark: SparkSession, spec: SourceSpec, landed: Landed, fabric: DataFrame, years: Iterable[int], out: str, store: str, region: str | None = None, batch_side: float = 500_000.0) -> tuple[DataFrame, list[int], dict[str, int]]:
    """(source, var, hru, t, value) of all ``years``, the years that this run built, and the store's counts.

    Years lie below ``out`` under the source's key, a region's under source_region, so that
    regions neither share years nor get in each other's way. A year is redone when grid files
    that hold days of it are newer. No grid file at all raises, and so does a year that none of
    them holds. A polygon that no grid row of a year meets has no rows in it; a region without
    polygons has none at all.
    """
    years = sorted(set(years))
    grid = read_grids(spark, landed.path, landed.schema)
    weights, counts = kept_weights(spark, fabric, landed, store, batch_side)
    weights = small(cut(weights))
    inputs = cut(file_stamps(grid.select(F.year("t").alias("year"), "_metadata")))
    held = {r["year"] for r in inputs.select("year").collect()}
    if gone := [y for y in years if y not in held]:
        raise ValueError(f"no data for {gone}")
    key = spec.source if region is None else f"{spec.source}_{region}"

    def one(year: int) -> DataFrame:
        wide = aggregate_source(grid.where(F.year("t") == year), weights, spec)
        return to_long(wide, spec.source, [c for c in wide.columns if c not in ("hru", "t")])

    built = run_years(spark, years, one, f"{out}/{key}", inputs, polygon_set(weights))
    return stitch(spark, f"{out}/{key}", years, by_marks=True), built, counts


def run_regions(spark: SparkSession, spec: SourceSpec, regions: dict[str, Landed], fabric: DataFrame, years: Iterable[int], out: str, store: str, **how) -> DataFrame:
    """The same for every region of a source, with the region's name in front."""
    parts = []
    for name, landed in sorted(regions.items()):
        rows, _, _ = run_source(spark, spec, landed, fabric, years, out, store, name, **how)
        parts.append(rows.select(F.lit(name).alias("region"), "*"))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole
