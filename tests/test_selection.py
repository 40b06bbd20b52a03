"""Exact quantiles by selection against numpy, and what a task holds together."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from catchment.operators import diagnostics, partitioning, selection
from catchment.sources.tables import scratch


def sample(rng):
    rows = [("big", rng.gauss(0, 1)) for _ in range(3000)] + [("big", 0.25)] * 900 + [("ties", float(rng.randrange(4))) for _ in range(500)]
    rows += [("one", 7.5), (None, 1.0), (None, 2.0), ("none", None), ("wide", 1e300), ("wide", -1e300), ("wide", 1e-300), ("wide", math.inf), ("two", 1.0), ("two", 2.0), ("big", None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("bins", "leaf"), [(32, 10_000), (4, 3), (2, 1)])
def test_quantiles(spark, bins, leaf):
    rows = sample(random.Random(leaf))
    d = spark.createDataFrame(rows, "kind string, value double").repartition(5)
    at = [0.0, 0.02, 0.5, 0.9, 1.0]
    got = {(r["kind"], r["p"]): r["value"] for r in selection.quantiles(d, "value", at, ["kind"], bins=bins, leaf=leaf).collect()}
    low = {(r["kind"], r["p"]): r["value"] for r in selection.quantiles(d, "value", at, ["kind"], discrete=True, bins=bins, leaf=leaf).collect()}
    kinds = {k for k, v in rows if v is not None}
    assert got.keys() == low.keys() == {(k, p) for k in kinds for p in at}
    for k in kinds:
        v = sorted(v for kind, v in rows if kind == k and v is not None)
        for p in at:
            assert low[k, p] == v[max(0, math.ceil(p * len(v)) - 1)]
            if k != "wide":
                assert got[k, p] == pytest.approx(np.quantile(v, p), abs=1e-12)
    assert selection.quantiles(d.limit(0), "value", at, ["kind"]).count() == 0


def test_no_task_sorts_more_than_a_leaf(spark, monkeypatch):
    """The rows that are ranked at last, group by group, and the passes that lead there."""
    held, passes = [], []
    within, narrow = selection._within, selection._narrow

    def watch(rows, intervals):
        out = within(rows, intervals)
        if "s" not in intervals.columns:
            held.append(out)
        return out

    monkeypatch.setattr(selection, "_within", watch)
    monkeypatch.setattr(selection, "_narrow", lambda *a: passes.append(1) or narrow(*a))
    d = spark.range(200_000).select((F.col("id") * 48271 % 200_003).cast("double").alias("v"), F.struct(F.lit(0).alias("all")).alias("g"))
    ranks = d.groupBy("g").agg(F.count("*").alias("n")).withColumn("ks", F.array(F.lit(0).cast("long"), F.lit(1234).cast("long"), F.lit(199_999).cast("long")))
    got = dict(selection.values_at(d, ranks, scratch(spark), bins=16, leaf=500).select("k", "v").collect())
    v = sorted((i * 48271 % 200_003) for i in range(200_000))
    assert got == {k: float(v[k]) for k in (0, 1234, 199_999)} and 2 <= len(passes) <= 3
    ranked = [x.groupBy("lo", "hi").count().agg(F.max("count")).first()[0] for x in (h.where(F.col("n") <= 500) for h in held)]
    assert max(x or 0 for x in ranked) <= 500


def test_figures_use_selection(spark):
    rows = sample(random.Random(5))
    d = spark.createDataFrame(rows, "kind string, value double").where("kind is null or kind <> 'wide'")
    v = [x for k, x in rows if x is not None and k != "wide"]
    r = diagnostics.describe(d, "value").first()
    assert r["n"] == len(v) and (r["p25"], r["p50"], r["p75"]) == pytest.approx(tuple(np.quantile(v, (0.25, 0.5, 0.75))))
    assert diagnostics.field_statistics(d, "value", 1.0).first()["p99"] == pytest.approx(np.quantile(v, 0.99))
    by = {r["kind"]: r["p50"] for r in diagnostics.percentiles(d, ["kind"], [0.5]).collect()}
    assert by.keys() == {"big", "ties", "one", None, "none", "two"} and by["none"] is None and by[None] == 1.5
    assert diagnostics.describe(d.limit(0), "value").first()["p50"] is None


def test_batches_are_the_same_with_selection(spark):
    rng = random.Random(1)
    d = spark.createDataFrame([(i, rng.random(), float(rng.randrange(30))) for i in range(3000)], "hru long, x double, y double")
    sets = [sorted(tuple(r) for r in partitioning.spatial_batches(d, 200, sketched=n).select("hru", "batch_id").collect()) for n in (20_000, 300)]
    assert sets[0] == sets[1] and len({b for _, b in sets[0]}) == 16
