"""What each source offers: variables, hooks, statistics, units. Jobs are driven by these rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment.functions import masks, units

Hook = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class SourceSpec:
    """One aggregated source. ``before`` works on pixels, ``after`` on polygon values."""

    source: str
    variables: tuple[str, ...]
    stat: str = "mean"
    crs: str = "EPSG:4326"
    cadence: str = "month"
    before: Hook | None = None
    after: Hook | None = None
    fabrics: tuple[str, ...] | None = None


@dataclass(frozen=True)
class UnitShim:
    """How a source's variable gets to a target's unit; ``units`` is what the catalog must say."""

    source: str
    var: str
    label: str
    units: str
    convert: Callable[[Column, Column], Column]


def _gate(df: DataFrame) -> DataFrame:
    return masks.quality_gate(df, "Day_CMG_Snow_Cover", "Day_CMG_Clear_Index")


def _rename_mask(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"valid_mask": "valid_area_fraction"})


def _runoff_total(df: DataFrame) -> DataFrame:
    return df.withColumn("runoff_total", units.total_of(F.col("Qs_acc"), F.col("Qsb_acc")))


def _et(df: DataFrame) -> DataFrame:
    return df.withColumn("ET_500m", masks.et_fill(F.col("ET_500m")))


def _swe(df: DataFrame) -> DataFrame:
    return df.withColumn("swe", masks.snow_fill(F.col("swe")))


# The sources and their variables.
SOURCES: tuple[SourceSpec, ...] = (
    SourceSpec("era5_land", ("ro", "sro", "ssro")),
    SourceSpec("era5_land_sd", ("sd",), cadence="day"),
    SourceSpec("gldas_noah_v21_monthly", ("Qs_acc", "Qsb_acc", "runoff_total"), before=_runoff_total),
    SourceSpec("mod16a2_v061", ("ET_500m",), "masked_mean", cadence="8day", before=_et),
    SourceSpec("ssebop", ("et",)),
    SourceSpec("reitz2017", ("total_recharge", "eff_recharge"), crs="EPSG:4269", cadence="year"),
    SourceSpec("mwbm_climgrid", ("runoff", "aet", "soilstorage", "swe")),
    SourceSpec("watergap22d", ("qrdif",)),
    SourceSpec("merra2", ("GWETTOP", "GWETROOT", "GWETPROF")),
    SourceSpec("ncep_ncar", ("soilw_0_10cm", "soilw_10_200cm")),
    SourceSpec("nldas_mosaic", ("SoilM_0_10cm", "SoilM_10_40cm", "SoilM_40_200cm")),
    SourceSpec("nldas_noah", ("SoilM_0_10cm", "SoilM_10_40cm", "SoilM_40_100cm", "SoilM_100_200cm")),
    SourceSpec("mod10c1_v061", ("Day_CMG_Snow_Cover", "Day_CMG_Clear_Index", "valid_mask"), "masked_mean", cadence="day", before=_gate, after=_rename_mask),
    SourceSpec("daymet", ("swe",), crs="grid mapping", cadence="day"),
    SourceSpec("snodas", ("swe",), "masked_mean", crs="EPSG:5070", cadence="day", before=_swe),
    SourceSpec("margulis_wus_sr", ("SWE",), cadence="day", fabrics=("or",)),
)

# Conversions to each target's common unit.
SHIMS: dict[str, tuple[UnitShim, ...]] = {
    "runoff": (
        UnitShim("era5_land", "ro", "era5", "m", lambda v, t: units.metres_to_mm(v)),
        UnitShim("gldas_noah_v21_monthly", "runoff_total", "gldas", "kg m-2", units.three_hourly_mean_to_mm),
        UnitShim("mwbm_climgrid", "runoff", "mwbm", "mm", lambda v, t: units.same(v)),
    ),
    "aet": (
        UnitShim("mod16a2_v061", "ET_500m", "mod16", "kg m-2", lambda v, t: units.same(v)),
        UnitShim("ssebop", "et", "ssebop", "mm", lambda v, t: units.same(v)),
        UnitShim("mwbm_climgrid", "aet", "mwbm", "mm", lambda v, t: units.same(v)),
    ),
    "recharge": (
        UnitShim("reitz2017", "total_recharge", "reitz", "m yr-1", lambda v, t: units.metres_to_mm(v)),
        UnitShim("watergap22d", "qrdif", "watergap", "kg m-2 s-1", units.rate_to_mm_per_month),
        UnitShim("era5_land", "ssro", "era5", "m", lambda v, t: units.metres_to_mm(v)),
    ),
    "soil_moisture": (
        UnitShim("merra2", "GWETTOP", "merra2", "1", lambda v, t: units.same(v)),
        UnitShim("ncep_ncar", "soilw_0_10cm", "ncep", "m3 m-3", lambda v, t: units.same(v)),
        UnitShim("nldas_mosaic", "SoilM_0_10cm", "mosaic", "kg m-2", lambda v, t: units.same(v)),
        UnitShim("nldas_noah", "SoilM_0_10cm", "noah", "kg m-2", lambda v, t: units.same(v)),
    ),
    "snow_water_equivalent": (
        UnitShim("daymet", "swe", "daymet", "kg m-2", lambda v, t: units.same(v)),
        UnitShim("snodas", "swe", "snodas", "kg m-2", lambda v, t: units.same(v)),
        UnitShim("era5_land_sd", "sd", "era5", "m", lambda v, t: units.metres_to_mm(v)),
        UnitShim("margulis_wus_sr", "SWE", "margulis", "m", lambda v, t: units.metres_to_mm(v)),
    ),
}


def sources_by_key(specs: tuple[SourceSpec, ...] = SOURCES) -> dict[str, SourceSpec]:
    out: dict[str, SourceSpec] = {}
    for s in specs:
        if s.source in out:
            raise ValueError(f"{s.source} is registered twice")
        out[s.source] = s
    return out


def shims_by(field: str, shims: tuple[UnitShim, ...]) -> dict[str, UnitShim]:
    """Shims by "source" or "label"; duplicates raise."""
    out: dict[str, UnitShim] = {}
    for s in shims:
        if (k := getattr(s, field)) in out:
            raise ValueError(f"{k} occurs twice")
        out[k] = s
    return out


def expected_units(spark: SparkSession, target: str) -> DataFrame:
    """(source, var, units) that a target's conversions rely on."""
    return spark.createDataFrame([(s.source, s.var, s.units) for s in SHIMS[target]], "source string, var string, units string")


def catalog(spark: SparkSession) -> DataFrame:
    """(source, var, stat, cadence, fabrics) of all registered variables."""
    rows = [(s.source, v, s.stat, s.cadence, list(s.fabrics) if s.fabrics else None) for s in SOURCES for v in s.variables]
    return spark.createDataFrame(rows, "source string, var string, stat string, cadence string, fabrics array<string>")


def check_scope(token: str | None, known: tuple[str, ...] = ("or",)) -> str | None:
    """A region token must be a known one."""
    if token is not None and token not in known:
        raise ValueError(f"unknown region {token!r}; known: {', '.join(known)}")
    return token
