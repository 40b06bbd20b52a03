"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The ASCII white space that the contracts name: blank and 0x09 to 0x0D.
BLANKS = " \t\n\x0b\x0c\r"


class Table:
    """A worker's table of what it has worked out, in two generations of ``size`` entries.

    What a batch uses moves to the young one; when that is full, the old one goes.
    """

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def missing(self, keys: set, turn: bool = True) -> list:
        """Those of ``keys`` that must be worked out; the others stand in ``young`` now, and what stood there stays without ``turn``."""
        if turn and len(self.young) > self.size:
            self.old, self.young = self.young, {}
        young, old, new = self.young, self.old, []
        for k in keys.difference(young):
            if (v := old.get(k)) is None:
                new.append(k)
            else:
                young[k] = v
        return new


def strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()


def slices(texts: pa.Array, size: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``size`` bytes each, one text at least."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + size, "right")))
        yield lo, hi
        lo = hi


def gather(ids: np.ndarray, start: np.ndarray, size: np.ndarray, at: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``at`` of ``ids`` one after another, and how many ids lie between ``edges`` of these runs."""
    n = size[at]
    ends = np.concatenate([[0], np.cumsum(n)])
    return ids[np.repeat(start[at] - ends[:-1], n) + np.arange(ends[-1])], np.diff(ends[edges])


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share.

    The place comes from ``spark.checkpoint.dir``; only where a session has none (tests on
    one machine) a temporary folder is made and set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/catchment-{uuid.uuid4().hex}"


def cut(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet at ``path`` and read it again: a lineage cut that outlives executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, path: str, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``edges`` by alternating large and small stars.

    Returns (node, component) for every node of an edge, component being the smallest node
    id reachable. Null ends and self loops count for nothing. Minima are pre-aggregated,
    and the joins are plain shuffle joins, so a hub is split by the adaptive skew join.
    """
    now = cut(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct(),
        f"{path}/edges",
    )
    step = 0
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct()
        )
        step += 1
        now = cut(small, f"{path}/step{step}")
        # Done when all edges are stars: each node has one root, and no root has another.
        up = now.groupBy("u").agg(F.count("*").alias("k"))
        roots = now.select(F.col("v").alias("u"))
        if up.where("k > 1").select("u").unionByName(up.join(roots, "u", "left_semi").select("u")).isEmpty():
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
