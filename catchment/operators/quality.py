"""Contract checks. ``find_*`` return offending rows, ``check_*`` raise if there are any."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def require_variables(df: DataFrame, names: list[str]) -> None:
    """The columns must all be there."""
    if missing := sorted(set(names) - set(df.columns)):
        raise ValueError(f"missing variables: {', '.join(missing)}")


def missing_variables(df: DataFrame, wanted: DataFrame, var: str = "var") -> DataFrame:
    """Wanted variables that a long table does not have."""
    return wanted.select(var).distinct().join(df.select(var).distinct(), var, "left_anti")


def grid_shapes(df: DataFrame, file: str = "file", iy: str = "iy", ix: str = "ix") -> DataFrame:
    """(n_iy, n_ix, n_files): one row if all files have one shape."""
    each = df.groupBy(file).agg((F.max(iy) + 1).alias("n_iy"), (F.max(ix) + 1).alias("n_ix"))
    return each.groupBy("n_iy", "n_ix").agg(F.count("*").alias("n_files"))


def check_one_shape(df: DataFrame, **how) -> None:
    shapes = grid_shapes(df, **how).take(2)
    if len(shapes) > 1:
        raise ValueError(f"grid shapes differ: {shapes}")


def grid_drift(headers: DataFrame, half_pixel: float = 0.5 / 120, exact: float = 1e-6, order: str = "day") -> DataFrame:
    """Each header (day, rows, columns, min_x, max_y) against the first: drift, and "same", "accepted" or "broken"."""
    first = headers.agg(F.min_by(F.struct("rows", "columns", "min_x", "max_y"), order).alias("f"))
    h = headers.join(F.broadcast(first)).withColumn("drift", F.greatest(F.abs(F.col("min_x") - F.col("f.min_x")), F.abs(F.col("max_y") - F.col("f.max_y"))))
    changed = (F.col("rows") != F.col("f.rows")) | (F.col("columns") != F.col("f.columns"))
    state = F.when(changed, "broken").when(F.col("drift") <= exact, "same").when(F.col("drift") <= half_pixel + 1e-12, "accepted").otherwise("broken")
    return h.withColumn("state", state).drop("f")


def drift_summary(headers: DataFrame, **how) -> dict[str, float]:
    """Number and maximum of the accepted drifts; a broken header raises."""
    r = grid_drift(headers, **how).agg(F.count_if(F.col("state") == "broken").alias("b"), F.count_if(F.col("state") == "accepted").alias("n"), F.max(F.when(F.col("state") == "accepted", F.col("drift"))).alias("m")).first()
    if r["b"]:
        raise ValueError(f"{r['b']} headers differ from the first by more than half a pixel or in shape")
    return {"drifted": r["n"], "max_drift": r["m"] or 0.0}


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys on one side only: (key, side)."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    return x.join(y, key, "left_anti").withColumn("side", F.lit("left")).unionByName(y.join(x, key, "left_anti").withColumn("side", F.lit("right")))


def check_same_ids(a: DataFrame, b: DataFrame, key: str = "hru") -> None:
    """Order does not matter; any difference raises."""
    odd = set_difference(a, b, key).take(5)
    if odd:
        raise ValueError(f"ids differ, for example {[tuple(r) for r in odd]}")


def repeated(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def check_unique(df: DataFrame, key: str) -> None:
    if twice := repeated(df, key).take(5):
        raise ValueError(f"{key} repeats: {[r[key] for r in twice]}")


def year_coverage(files: DataFrame, first: int, last: int, year: str = "year") -> DataFrame:
    """(year, state) of every year that is missing, there twice, or empty (``n_rows`` 0)."""
    spine = files.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias(year))
    have = files.groupBy(year).agg(F.count("*").alias("n"), F.sum("n_rows").alias("rows"))
    state = F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "overlap").when(F.col("rows") == 0, "empty")
    return spine.join(have, year, "left").select(year, state.alias("state")).where("state is not null")


def unmatched_years(a: DataFrame, b: DataFrame, year: str = "year") -> DataFrame:
    """Years that only one of two variables has."""
    return set_difference(a, b, year)


def months_outside(df: DataFrame, year: int, month: int, t: str = "t") -> DataFrame:
    """(year, month, n) of stamps that are not in the requested month."""
    return df.groupBy(F.year(t).alias("year"), F.month(t).alias("month")).agg(F.count("*").alias("n")).where((F.col("year") != year) | (F.col("month") != month))


def days_not_once(df: DataFrame, year: int, t: str = "t") -> DataFrame:
    """(t, n) of days of the year that do not occur exactly once."""
    days = df.sparkSession.range(1).select(F.explode(F.sequence(F.make_date(F.lit(year), F.lit(1), F.lit(1)), F.make_date(F.lit(year), F.lit(12), F.lit(31)))).alias("t"))
    have = df.groupBy(F.col(t).alias("t")).agg(F.count("*").alias("n"))
    return days.join(have, "t", "left").select("t", F.coalesce("n", F.lit(0)).alias("n")).where("n <> 1")


def unit_mismatches(expected: DataFrame, catalog: DataFrame) -> DataFrame:
    """(source, var, units, cf_units) where a converter's unit is not the catalog's, or the catalog has none."""
    return expected.join(catalog.select("source", "var", "cf_units"), ["source", "var"], "left").where(~F.col("units").eqNullSafe(F.col("cf_units")))


def check_units(expected: DataFrame, catalog: DataFrame) -> None:
    if odd := unit_mismatches(expected, catalog).take(5):
        raise ValueError(f"units differ: {[tuple(r) for r in odd]}")


def unknown_sources(targets: DataFrame, catalog: DataFrame) -> DataFrame:
    """(target, source) that the catalog does not have; ``targets`` holds arrays of sources."""
    return targets.select("target", F.explode("sources").alias("source")).join(catalog.select("source"), "source", "left_anti").select("target", "source")


def method_differences(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """Per variable: "missing" (a warning) or "differs" (an error)."""
    both = declared.select("var", F.col("cell_methods").alias("d")).join(actual.select("var", F.col("cell_methods").alias("a")), "var", "left")
    return both.select("var", F.when(F.col("a").isNull(), "missing").when(F.col("a") != F.col("d"), "differs").alias("state")).where("state is not null")


def low_coverage(df: DataFrame, limit: float = 0.1, t: str = "t", value: str = "valid_area_fraction") -> DataFrame:
    """Years in which more than ``limit`` of the fractions are 0."""
    share = F.count_if(F.col(value) == 0) / F.count(value)
    return df.groupBy(F.year(t).alias("year")).agg(F.when(F.count(value) > 0, share).alias("zero_share")).where(F.col("zero_share") > limit)


def empty_share(bounds: DataFrame) -> DataFrame:
    """One row: the share of bounds without any source."""
    return bounds.agg(F.count_if(F.col("n_sources") == 0).alias("n_empty"), F.count("*").alias("n_rows"), (F.count_if(F.col("n_sources") == 0) / F.count("*")).alias("empty_share"))


def bound_invariants(bounds: DataFrame) -> DataFrame:
    """One row: whether lower <= upper throughout, whether all lie in 0..1, and the extremes."""
    lo, up = F.col("lower_bound"), F.col("upper_bound")
    return bounds.agg(F.bool_and(F.coalesce(lo <= up, F.lit(True))).alias("ordered"), F.bool_and(F.coalesce((lo >= 0) & (up <= 1), F.lit(True))).alias("in_unit_range"), F.min(lo).alias("least"), F.max(up).alias("greatest"))


def percent_difference(a: DataFrame, b: DataFrame, key: str, value: str = "value") -> DataFrame:
    """(key, a, b, pct): b against a in percent of a."""
    x, y = a.groupBy(key).agg(F.avg(value).alias("a")), b.groupBy(key).agg(F.avg(value).alias("b"))
    return x.join(y, key).withColumn("pct", F.when(F.col("a") != 0, 100 * (F.col("b") - F.col("a")) / F.when(F.col("a") != 0, F.col("a"))))


def magnitude_ratio(df: DataFrame, reference: float, value: str = "value") -> DataFrame:
    return df.agg(F.sum(value).alias("total"), (F.sum(value) / reference).alias("ratio"))


def fill_effect(raw: DataFrame, filled: DataFrame) -> DataFrame:
    """One row: how many bounds were missing and how many of them are filled, and the fill rate."""
    f = filled.select("hru", "t", F.col("lower_bound").alias("fl"), F.col("upper_bound").alias("fu"), "nn_filled")
    both = raw.join(f, ["hru", "t"])
    gap = F.col("lower_bound").isNull() & F.col("upper_bound").isNull()
    n, k = F.count_if(gap), F.count_if(gap & (F.col("nn_filled") == 1))
    changed = F.count_if((F.col("nn_filled") == 0) & ~(F.col("fl").eqNullSafe(F.col("lower_bound")) & F.col("fu").eqNullSafe(F.col("upper_bound"))))
    return both.agg(n.alias("n_gaps"), k.alias("n_filled"), changed.alias("n_changed"), F.when(n > 0, k / F.when(n > 0, n)).alias("fill_rate"))


def superseded(requested: DataFrame, catalog: DataFrame) -> DataFrame:
    """Requested sources that have a replacement, with its name."""
    return requested.join(catalog.where("status = 'superseded'"), "source").select("source", "replaced_by")


def enclosure(grid: DataFrame, box: DataFrame) -> DataFrame:
    """One row: margins by which a grid (w, s, e, n) encloses a fabric's box, negative where it does not."""
    g = grid.agg(F.min("w").alias("w"), F.min("s").alias("s"), F.max("e").alias("e"), F.max("n").alias("n"))
    b = box.agg(F.min("west").alias("bw"), F.min("south").alias("bs"), F.max("east").alias("be"), F.max("north").alias("bn"))
    margins = g.join(F.broadcast(b)).select((F.col("bw") - F.col("w")).alias("west"), (F.col("bs") - F.col("s")).alias("south"), (F.col("e") - F.col("be")).alias("east"), (F.col("n") - F.col("bn")).alias("north"))
    return margins.withColumn("encloses", (F.col("west") >= 0) & (F.col("south") >= 0) & (F.col("east") >= 0) & (F.col("north") >= 0))


def order_breaks(df: DataFrame, position: str, key: str = "hru", block: int = 1 << 20) -> DataFrame:
    """One row: how often ``key`` falls from one row to the next by ``position``.

    Blocks of rows are windows of their own; each block also gets the last row of the one before.
    """
    rows = df.select(F.col(position).cast("long").alias("p"), F.col(key).alias("k")).withColumn("b", F.floor(F.col("p") / block))
    edge = rows.groupBy("b").agg(F.max_by(F.struct("p", "k"), "p").alias("e")).select((F.col("b") + 1).alias("b"), "e.p", "e.k", F.lit(True).alias("extra"))
    both = rows.withColumn("extra", F.lit(False)).unionByName(edge)
    before = F.lag("k").over(Window.partitionBy("b").orderBy("p"))
    return both.withColumn("before", before).where(~F.col("extra")).agg(F.count_if(F.col("k") < F.col("before")).alias("n_breaks"))
