"""Pixel masks and row filters. They run before any spatial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits of the products' codings.
FLAG_LIMIT = 100
GATE = 70
ET_FILL, ET_FILL_RAW, ET_RAW_FROM = 3270, 32700, 5000
SNOW_FILL = -9990


def flag_mask(v: Column) -> Column:
    """Codes above 100 are flags."""
    return F.when(v <= FLAG_LIMIT, v)


def quality_gate(df: DataFrame, snow: str, index: str) -> DataFrame:
    """Flags masked in both; snow kept only where the clear index is above 70; adds valid_mask (0 or 1)."""
    ci = flag_mask(F.col(index))
    good = F.coalesce(ci > GATE, F.lit(False))
    return df.withColumns({snow: F.when(good, flag_mask(F.col(snow))), index: ci, "valid_mask": good.cast("double")})


def et_fill(v: Column) -> Column:
    return F.when(v <= ET_FILL, v)


def et_fill_by_tile(df: DataFrame, value: str, tile: list[str]) -> DataFrame:
    """The same before scaling: a tile whose maximum is above 5000 is raw and has the raw limit."""
    top = df.groupBy(*tile).agg(F.when(F.max(value) > ET_RAW_FROM, ET_FILL_RAW).otherwise(ET_FILL).alias("__limit"))
    return df.join(top, tile).withColumn(value, F.when(F.col(value) <= F.col("__limit"), F.col(value))).drop("__limit")


def snow_fill(v: Column) -> Column:
    return F.when(v > SNOW_FILL, v)


def without_flags(v: Column, flags: list[float]) -> Column:
    return F.when(~v.isin(*flags), v)


def within(v: Column, low: float, high: float) -> Column:
    return F.when(v.between(low, high), v)


def clip(df: DataFrame, north: float, west: float, south: float, east: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Rows inside the box; an empty outcome raises and names both extents."""
    out = df.where(F.col(lat).between(south, north) & F.col(lon).between(west, east))
    if out.isEmpty():
        e = df.agg(F.max(lat), F.min(lon), F.min(lat), F.max(lon)).first()
        raise ValueError(f"box {north, west, south, east} (n, w, s, e) and grid {tuple(e)} have nothing in common")
    return out


def common_extent(df: DataFrame, by: str = "source", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Rows inside the extent that all grids share; ``by`` names the grid."""
    each = df.groupBy(by).agg(F.min(lat).alias("s"), F.max(lat).alias("n"), F.min(lon).alias("w"), F.max(lon).alias("e"))
    one = each.agg(F.max("s").alias("__s"), F.min("n").alias("__n"), F.max("w").alias("__w"), F.min("e").alias("__e"))
    return df.join(F.broadcast(one), F.col(lat).between(F.col("__s"), F.col("__n")) & F.col(lon).between(F.col("__w"), F.col("__e"))).drop("__s", "__n", "__w", "__e")


def overlaps_box(rects: Column, north: float, west: float, south: float, east: float) -> Column:
    """Any rectangle meets the box; missing metadata keeps the row."""
    def meets(r: Column) -> Column:
        inside = (r["w"] <= east) & (r["e"] >= west) & (r["s"] <= north) & (r["n"] >= south)
        unknown = r["w"].isNull() | r["e"].isNull() | r["s"].isNull() | r["n"].isNull()
        return unknown | inside

    return rects.isNull() | F.exists(rects, meets)


def not_empty(files: DataFrame, length: str = "length") -> DataFrame:
    """A listing without missing and zero-byte files."""
    return files.where(F.col(length) > 0)


def year_window(df: DataFrame, first: int, last: int, year: str = "year") -> DataFrame:
    """Rows of the years; none is an error."""
    out = df.where(F.col(year).between(first, last))
    if out.isEmpty():
        raise ValueError(f"no data in {first}..{last}")
    return out


def check_coverage(df: DataFrame, first: int, last: int, year: str = "year") -> None:
    """Raise unless the data's years enclose the period."""
    r = df.agg(F.min(year).alias("a"), F.max(year).alias("b")).first()
    if r["a"] is None or r["a"] > first or r["b"] < last:
        raise ValueError(f"period {first}..{last} is outside the coverage {r['a']}..{r['b']}")


def in_scope(df: DataFrame, token: str | None, scope: str = "fabrics") -> DataFrame:
    """Sources without a scope, and those whose scope has the token; no token drops all scoped ones."""
    open_ = F.col(scope).isNull()
    return df.where(open_ if token is None else open_ | F.coalesce(F.array_contains(scope, token), F.lit(False)))


def available(requested: DataFrame, data: DataFrame, key: str = "source") -> DataFrame:
    """Requested sources that have data."""
    return requested.join(data.select(key).distinct(), key, "left_semi")


def first_of_month(df: DataFrame, year: int, month: int, by: list[str], t: str = "t") -> DataFrame:
    """The first record of each series in a calendar month."""
    rows = df.where((F.year(t) == year) & (F.month(t) == month))
    first = rows.groupBy(*by).agg(F.min(t).alias(t))
    return rows.join(first, [*by, t])


def nearest_date(df: DataFrame, day: str, by: list[str], value: str, t: str = "t") -> DataFrame:
    """The record of each series nearest to a date, the earlier one of two."""
    off = F.struct(F.abs(F.datediff(F.col(t), F.lit(day).cast("date"))), F.col(t))
    return df.groupBy(*by).agg(F.min_by(t, off).alias(t), F.min_by(value, off).alias(value))


def agreeing(df: DataFrame, least: int, n: str = "n_sources") -> DataFrame:
    return df.where(F.col(n) >= least)
