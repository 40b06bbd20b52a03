"""Results from parts in any order, snow year by year, filled targets."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from catchment.operators import zonal
from catchment.plans import yearly
from catchment.plans.targets import runoff, soil_moisture, swe
from catchment.sources.specs import SHIMS
from catchment.streaming.partials import STATS, PartStore, merged, partials

GRID = "part string, iy int, ix int, t date, value double, other double"


def grid(rng, parts):
    day = dt.date(2001, 1, 1)
    return [(p, i, j, day + dt.timedelta(k), None if rng.random() < 0.2 else rng.gauss(0, 5), rng.random()) for p in parts for i in range(4) for j in range(4) for k in range(3) if hash((i * 4 + j, k)) % len(parts) == parts.index(p)]


def results(spark, store_or_rows, weights):
    out = {}
    for stat in (*STATS, *(f"masked_{s}" for s in STATS)):
        df = store_or_rows.result(stat, weights) if isinstance(store_or_rows, PartStore) else merged(store_or_rows, stat, weights)
        out[stat] = {(r["var"], r["hru"], r["t"]): r["value"] for r in df.collect()}
    return out


def test_parts_in_any_order(spark, tmp_path):
    rng = random.Random(4)
    names = ["a", "b", "c", "d"]
    rows = grid(rng, names)
    weights = spark.createDataFrame([(i, j, (i + j) % 3, rng.random() + 0.1) for i in range(4) for j in range(4)] + [(0, 0, 2, 0.5)], "iy int, ix int, hru long, area double")
    whole = spark.createDataFrame(rows, GRID)
    want = {}
    for stat in (*STATS, *(f"masked_{s}" for s in STATS)):
        got = zonal.aggregate(whole, weights, ["value", "other"], stat).collect()
        want[stat] = {(v, r["hru"], r["t"]): r[v] for r in got for v in ("value", "other")}

    for trial in range(2):
        store = PartStore(spark, f"{tmp_path}/{trial}")
        order = rng.sample(names, 4)
        wrong = [(p, i, j, t, 99.0, None) for p, i, j, t, _, _ in rows if p == order[0]] + [(order[0], 3, 3, dt.date(1999, 1, 1), 1.0, 1.0)]
        store.add(spark.createDataFrame(wrong, GRID), weights, ["value", "other"])
        for p in order[1:] + order[:1]:
            store.add(whole.where(F.col("part") == p), weights, ["value", "other"])
        got = results(spark, store, weights)
        for stat in want:
            assert got[stat].keys() == want[stat].keys()
            assert all(v == pytest.approx(want[stat][k], abs=1e-9) if v is not None else want[stat][k] is None for k, v in got[stat].items())
    # A part that comes again without anything inside the polygons takes back what it gave.
    store.add(spark.createDataFrame([("a", 9, 9, dt.date(2001, 1, 1), 1.0, 1.0)], GRID), weights, ["value", "other"])
    rest = results(spark, partials(whole.where("part <> 'a'"), weights, ["value", "other"]), weights)
    assert results(spark, store, weights)["masked_count"] == rest["masked_count"]


def test_files_that_land_one_by_one(spark, tmp_path):
    weights = spark.createDataFrame([(0, 0, 1, 2.0), (0, 1, 1, 1.0)], "iy int, ix int, hru long, area double")
    schema, day = "iy int, ix int, t date, value double", dt.date(2001, 1, 1)
    store = PartStore(spark, f"{tmp_path}/store")
    land = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    for rows, want in (([(0, 0, day, 3.0)], None), ([(0, 1, day, 9.0)], 5.0)):
        land(rows)
        store.follow(f"{tmp_path}/in", schema, weights, ["value"], f"{tmp_path}/check").awaitTermination()
        assert store.result("mean", weights).first()["value"] == want  # both cells of a day may come in different runs
    assert store.result("masked_sum", weights).first()["value"] == 15.0


def test_snow_by_year(spark, tmp_path):
    day = lambda y, m, d: dt.date(y, m, d)
    rows = {"daymet": [(1, day(2001, 1, 1), 25.4), (2, day(2001, 1, 1), 50.8), (1, day(2003, 1, 2), 25.4)], "era5": [(1, day(2001, 1, 1), 0.0508), (2, day(2002, 6, 1), 0.0254)], "margulis": [(1, day(2001, 1, 1), 1.0)]}
    sources = {k: spark.createDataFrame(v, "hru long, t date, value double") for k, v in rows.items()}
    hrus = spark.createDataFrame([(1,), (2,)], "hru long")
    path = f"{tmp_path}/swe"
    out = {(r["hru"], r["t"]): (r["lower_bound"], r["upper_bound"], r["n_sources"]) for r in swe.build_years(spark, sources, hrus, [2001, 2002, 2003], path).collect()}
    assert len(out) == 2 * (365 + 365 + 365)
    assert out[1, day(2001, 1, 1)] == (1.0, 2.0, 2) and out[2, day(2002, 6, 1)] == (1.0, 1.0, 1) and out[2, day(2003, 1, 2)] == (None, None, 0)  # margulis is of another region
    whole = {(r["hru"], r["t"]): (r["lower_bound"], r["upper_bound"], r["n_sources"]) for r in swe.build({k: sources[k] for k in ("daymet", "era5")}, hrus, (day(2001, 1, 1), day(2003, 12, 31))).collect()}
    assert out == whole
    with pytest.raises(ValueError, match="no source at all in 2004"):
        swe.build_years(spark, sources, hrus, [2003, 2004], path)
    assert {r["year"] for r in yearly.years_done(spark, path).collect()} == {2001, 2002, 2003}
    with pytest.raises(ValueError, match="may be used"):
        swe.build_years(spark, {"margulis": sources["margulis"]}, hrus, [2001], path)


def test_filled_targets(spark):
    """Every filled target fills; chained donors give on what they were given."""
    hrus = spark.createDataFrame([(1, 1e6), (2, 1e6), (3, 1e6)], "hru long, area_m2 double")
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 0.0), (3, 10.0, 0.0)], "hru long, x double, y double")
    period = (dt.date(2001, 1, 1), dt.date(2001, 2, 28))
    series = spark.createDataFrame([(1, dt.date(2001, 1, 1), 5.0), (1, dt.date(2001, 2, 1), 7.0), (3, dt.date(2001, 1, 1), 9.0)], "hru long, t date, value double")
    sources = {SHIMS["runoff"][0].label: series}
    for donors in ("observed", "chained"):
        r = {(x["hru"], x["t"].month): (x["lower_bound"], x["nn_filled"]) for x in runoff.build(sources, hrus, period, points, donors).collect()}
        assert r[2, 1] == (r[1, 1][0], 1) and r[2, 2] == (r[1, 2][0], 1) == r[3, 2] and r[1, 1][1] == 0
    years = spark.createDataFrame([(1, dt.date(2001 + k, 1, 1), float(k)) for k in range(3)], "hru long, t date, value double")
    monthly, annual = soil_moisture.build({"x": years}, hrus, (dt.date(2001, 1, 1), dt.date(2003, 12, 31)), None, points, "chained")
    assert sorted((x["hru"], x["t"].year, x["lower_bound"], x["nn_filled"]) for x in annual.collect()) == [(h, 2001 + k, k / 2, int(h > 1)) for h in (1, 2, 3) for k in range(3)]
    assert monthly.where("nn_filled = 1").count() == 6
