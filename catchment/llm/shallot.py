"""k-means in integers by Shallot search: exact assignments with few distances computed.

Vectors are scaled, floored and packed into blocks of ``block`` rows, each with its bounds: the
nearest and second-nearest centroid that a vector remembers, an upper bound on its distance to
the first and a lower bound on that to all others. A round moves the bounds by how far centroids
went. Vectors whose upper bound is below the lower one, or below half the way to the next
centroid, are done. The others measure both remembered centroids, start from the closer one and
go through its neighbours in order of distance, inside a ball that shrinks with every better
second. Survivors are compared as (squared distance, number) in 64-bit integers, so that rounding
decides nothing; the floating-point bounds err on the safe side by ``SLACK``.

Blocks stay where they were read: a round is a narrow step over the persisted blocks of the
round before, and what crosses the network is one row per task and centroid component. A lost
executor's blocks are worked out again from the input by at most ``rounds`` such steps. The
driver holds the centroids and their pairwise distances, k x k numbers that do not grow with the
data. The assignment is written once and read again.

Nulls and ties: vectors that are null, of another length, or with a component that is null, not
finite or of size 2^17 or more (squared distances would leave a long) are left out. A null id is
kept, but never chosen as a first centroid. Rows that repeat are vectors of their own; equal
hashes are ordered by components. Of centroids equally near the smaller number wins. With fewer
vectors than ``k`` there are as many centroids as vectors; an empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.llm.shared import cut, shared_dir

#: Scaled components stay below this, so that squared distances of 64 components fit a long.
LIMIT = 1 << 27
SLACK = 1e-12
UP, DOWN = 1 + SLACK, 1 - SLACK

BLOCKS = "ids array<long>, x binary, near binary, second binary, upper binary, lower binary, sums array<long>"


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of rows, exact in 64-bit integers."""
    d = x.astype(np.int64) - y
    return np.einsum("ij,ij->i", d, d)


class Centroids:
    """Centroids of a round, their distances, each one's neighbours in order, and how far they went."""

    def __init__(self, now: np.ndarray, before: np.ndarray | None = None):
        self.now, k = now, len(now)
        d = np.stack([np.sqrt(squared(now, c[None, :])) for c in now])
        d[np.arange(k), np.arange(k)] = -1.0
        self.order = np.argsort(d, axis=1, kind="stable")[:, 1:]
        self.gaps = np.take_along_axis(d, self.order, axis=1)
        self.half = self.gaps[:, 0] / 2 * DOWN if k > 1 else np.full(k, np.inf)
        self.moved = np.zeros(k) if before is None else np.sqrt(squared(now, before)) * UP
        most = np.sort(self.moved)[::-1]
        self.others = np.where(np.arange(k) == int(np.argmax(self.moved)), most[min(1, k - 1)], most[0])


def search(x: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray, c: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest and second centroid of each row, its bounds, and how many distances were computed."""
    k = len(c.now)
    near, second, upper, lower = near.copy(), second.copy(), upper + c.moved[near], lower - c.others[near]
    if k == 1:
        return near, second, upper, np.full(len(x), np.inf), 0
    some = np.nonzero(~(upper < np.maximum(lower, c.half[near])))[0]
    best = squared(x[some], c.now[near[some]])
    computed = len(some)
    upper[some] = np.sqrt(best) * UP
    still = ~(upper[some] < np.maximum(lower[some], c.half[near[some]]))
    some, best = some[still], best[still]

    # Start from the closer one of the two that are remembered.
    a, b, next_ = near[some], second[some], squared(x[some], c.now[second[some]])
    computed += len(some)
    swap = (next_ < best) | ((next_ == best) & (b < a))
    a, b, best, next_ = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, next_, best), np.where(swap, best, next_)
    home, known, reach = a.copy(), b.copy(), np.sqrt(best) * UP
    live = np.arange(len(some))
    for j in range(k - 1):
        at = c.order[home[live], j]
        inside = c.gaps[home[live], j] * DOWN <= (reach[live] + np.sqrt(next_[live]) * UP) * UP
        live, at = live[inside], at[inside]  # neighbours are sorted, so who is outside stays outside
        if not len(live):
            break
        new = at != known[live]
        i, at = live[new], at[new]
        d = squared(x[some[i]], c.now[at])
        computed += len(i)
        first = (d < best[i]) | ((d == best[i]) & (at < a[i]))
        other = ~first & ((d < next_[i]) | ((d == next_[i]) & (at < b[i])))
        f, o = i[first], i[other]
        b[f], next_[f], a[f], best[f] = a[f], best[f], at[first], d[first]
        b[o], next_[o] = at[other], d[other]
    near[some], second[some], upper[some], lower[some] = a, b, np.sqrt(best) * UP, np.sqrt(next_) * DOWN
    return near, second, upper, lower, computed


def sums_of(x: np.ndarray, near: np.ndarray, k: int) -> np.ndarray:
    """Members and componentwise sums of each centroid, a row each."""
    out = np.zeros((k, x.shape[1] + 1), np.int64)
    for j in np.unique(near).tolist():
        mine = x[near == j]
        out[j, 0], out[j, 1:] = len(mine), mine.sum(axis=0, dtype=np.int64)
    return out


def _pack(rows: DataFrame, scale: float, dim: int, block: int) -> DataFrame:
    """Blocks of vectors that have not been assigned yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, block):
                part = batch.slice(lo, block)
                x = np.floor(scale * np.asarray(part.column(1).flatten(), float).reshape(-1, dim)).astype(np.int32)
                n = len(x)
                state = (x, np.zeros(n, np.int32), np.ones(n, np.int32), np.full(n, np.inf), np.full(n, -np.inf))
                yield pa.RecordBatch.from_arrays([pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), *(pa.array([v.tobytes()], pa.binary()) for v in state), pa.array([[]], pa.list_(pa.int64()))], names=["ids", "x", "near", "second", "upper", "lower", "sums"])

    return rows.mapInArrow(run, BLOCKS)


def _unpack(batch: pa.RecordBatch, r: int, dim: int) -> list[np.ndarray]:
    kinds = (np.int32, np.int32, np.int32, np.float64, np.float64)
    x, *state = (np.frombuffer(batch.column(j + 1)[r].as_py(), kind) for j, kind in enumerate(kinds))
    return [x.reshape(-1, dim), *state]


def _step(blocks: DataFrame, c: Centroids, dim: int) -> DataFrame:
    """The same blocks, assigned to these centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                x, *state = _unpack(batch, r, dim)
                near, second, upper, lower, _ = search(x, *state, c)
                new = [pa.array([v.tobytes()], pa.binary()) for v in (near.astype(np.int32), second.astype(np.int32), upper, lower)]
                one = batch.slice(r, 1)
                yield pa.RecordBatch.from_arrays([one.column(0), one.column(1), *new, pa.array([sums_of(x, near, len(c.now)).ravel()], pa.list_(pa.int64()))], names=batch.schema.names)

    return blocks.mapInArrow(run, BLOCKS)


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of the members' means; a centroid without members stays."""
    sums = blocks.select(F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    k, dim = centroids.shape
    total = [0] * (k * (dim + 1))
    for r in sums.collect():
        total[r["at"]] = int(r["s"])
    out = centroids.copy()
    for j in range(k):
        n, *s = total[j * (dim + 1) : (j + 1) * (dim + 1)]
        if n:
            out[j] = [v // n for v in s]
    return out


def _distances(blocks: DataFrame, centroids: np.ndarray, dim: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                x, near, *_ = _unpack(batch, r, dim)
                yield pa.RecordBatch.from_arrays([batch.column(0)[r].values, pa.array(near), pa.array(squared(x, centroids[near]))], names=["vec_id", "cluster", "distance"])

    return blocks.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, scale: float = 1024.0, dim: int = 64, id_col: str = "vec_id", vec_col: str = "embedding", block: int = 4096, path: str | None = None) -> DataFrame:
    """One row per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    path = path or shared_dir(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    sound = lambda e: e.isNotNull() & (F.abs(e) < LIMIT / scale)  # noqa: E731  NaN is above all numbers
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") == dim) & F.forall("v", sound))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.where("vec_id is not null").orderBy(order, "v").limit(k).select("v").collect()
    result = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], result)
    now = np.floor(scale * np.array([r["v"] for r in first])).astype(np.int64)

    level = StorageLevel.MEMORY_AND_DISK
    blocks, before = _pack(rows, scale, dim, block).persist(level), None
    for r in range(rounds + 1):
        after = _step(blocks, Centroids(now, before), dim).persist(level)
        new = _moved(after, now) if r < rounds else now
        if r == rounds:
            found = cut(_distances(after, now, dim), f"{path}/assigned")
        blocks.unpersist()
        blocks, before, now = after, now, new
    blocks.unpersist()

    inertia = dict(found.groupBy("cluster").agg(F.sum("distance")).collect())  # a row per centroid
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now.tolist()]
    each = spark.createDataFrame([(j, s, sum(inertia.values()), digest[j]) for j, s in sorted(inertia.items())], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(each), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
