"""Near-duplicate vectors by PCA-ordered tiled comparison.

Vectors of one label are compared by cosine. Equal vectors are one class with a count, so
that copies cost nothing. A principal component analysis over all vectors (a sum of
products per task, reduced to one matrix of fixed size) orders the dimensions by variance.
Classes fall into cells of the first two components of their unit vectors; linked ones lie
in the same or in neighbouring cells, since their distance is at most
sqrt(2 - 2 threshold). Cells are cut into tiles of about ``tile`` vectors, and pairs of
tiles from neighbouring cells are the unit of work; a vector travels once for each of them,
so tiles are as large as a task's memory easily allows.

A task cuts its tiles into blocks along the first component. Two blocks are left out if
their centres are farther apart than their radii and the distance of linked vectors allow.
Within a pair of blocks, products are accumulated over the leading dimensions first; what is
left is bounded by the product of the suffix norms, and pairs that cannot reach the
threshold any more are dropped, the whole pair of blocks once none is left. Survivors are
decided by the plain cosine of the original vectors in double precision. A pair of tiles
returns link counts per class and a spanning forest of its links, so dense groups do not
turn into all their pairs.

Where vectors of a label have no structure (the same spread in all components), no bound
parts tiles or blocks, and the work is that of all pairs of the label, cut short after some
of the dimensions. ``compare`` tells how many pairs of blocks it went through.

Nulls and ties: vectors that are null, zero, or hold null or non-finite components link with
nothing, and neither do rows with a null label or a null id; such a row is its own
component (null for a null id). Vectors of different length are not compared. Rows with
equal vectors link with each other. Extra columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.llm.shared import components, cut, shared_dir

FOUND = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])
GRAM = pa.schema([("dim", pa.int32()), ("g", pa.binary())])
#: Groups that the tasks' matrices are added up in before the last sum.
SUMS = 256


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of products of unit vectors, one row per length of vectors."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        by: dict[int, list] = {}
        for v in batch.column(0).to_pylist():
            by.setdefault(len(v), []).append(v)
        for d, vs in by.items():
            x = np.array(vs, np.float64)
            x /= np.linalg.norm(x, axis=1)[:, None]
            sums[d] = sums.get(d, 0) + x.T @ x
    for d, g in sums.items():
        yield pa.RecordBatch.from_pydict({"dim": [d], "g": [g.tobytes()]}, schema=GRAM)


def _axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes for each length of vectors, strongest first. One matrix a task is added up, in ``SUMS`` groups first."""

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(g, np.float64) for g in group.column("g").to_pylist())
        return pa.table({"dim": pa.array([group.column("dim")[0].as_py()], pa.int32()), "g": pa.array([total.tobytes()])})

    sums = vectors.select("v").mapInArrow(_gram, "dim int, g binary").withColumn("k", F.spark_partition_id() % SUMS)
    for keys in (["dim", "k"], ["dim"]):
        sums = sums.groupBy(*keys).applyInArrow(add, "dim int, g binary")
    out = {}
    for r in sums.collect():
        d = r["dim"]
        _, axes = np.linalg.eigh(np.frombuffer(r["g"], np.float64).reshape(d, d))
        out[d] = np.ascontiguousarray(axes[:, ::-1])
    return out


def _block_links(va, vb, na, nb, ua, ub, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs of two blocks, by their places; ``ua`` and ``ub`` are the unit vectors along the axes."""
    d = ua.shape[1]
    dot = np.zeros((len(ua), len(ub)))
    alive = np.ones(dot.shape, bool)
    if same:
        alive = np.triu(alive, 1)
    ra, rb = (np.sqrt(np.maximum(0, 1 - np.cumsum(u * u, axis=1))) for u in (ua, ub))
    lo, step = 0, max(4, d // 4)
    pairs = None
    while lo < d:
        hi = min(d, lo + step)
        dot += ua[:, lo:hi] @ ub[:, lo:hi].T
        alive &= dot + ra[:, hi - 1, None] * rb[None, :, hi - 1] >= threshold - 1e-9
        left = int(np.count_nonzero(alive))
        if not left:
            break
        if left < alive.size // 64:
            pairs = np.nonzero(alive)
            break
        lo, step = hi, step * 2
    i, j = pairs if pairs is not None else np.nonzero(alive)
    linked = np.zeros(len(i), bool)
    for at in range(0, len(i), 65_536):
        x, y = i[at : at + 65_536], j[at : at + 65_536]
        linked[at : at + 65_536] = (va[x] * vb[y]).sum(axis=1) / (na[x] * nb[y]) >= threshold
    return i[linked], j[linked]


def compare(ids_a, va, ids_b, vb, wa, wb, axes: np.ndarray, threshold: float, same: bool, block: int = 512) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[int, int]]:
    """Link counts of both tiles (by the other's weights), edges that join what the links join, and the pairs of blocks (compared, all)."""
    sides = []
    for v in (va, vb):
        n = np.linalg.norm(v, axis=1)
        u = v / n[:, None] @ axes
        order = np.argsort(u[:, 0], kind="stable")
        blocks = [order[lo : lo + block] for lo in range(0, len(order), block)]
        middle = [u[x].mean(axis=0) for x in blocks]
        sides.append((n, u, blocks, middle, [float(np.sqrt(((u[x] - m) ** 2).sum(axis=1).max())) for x, m in zip(blocks, middle, strict=True)]))
    (na, ua, blocks_a, mid_a, far_a), (nb, ub, blocks_b, mid_b, far_b) = sides
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9
    ca, cb = np.zeros(len(va), np.int64), np.zeros(len(vb), np.int64)
    la, lb = ids_a.copy(), ids_b.copy()
    edges: list[np.ndarray] = []
    done = total = 0
    for s, x in enumerate(blocks_a):
        for t, y in enumerate(blocks_b):
            if same and t < s:
                continue
            total += 1
            if np.sqrt(((mid_a[s] - mid_b[t]) ** 2).sum()) > far_a[s] + far_b[t] + reach:
                continue
            done += 1
            i, j = _block_links(va[x], vb[y], na[x], nb[y], ua[x], ub[y], threshold, same and s == t)
            i, j = x[i], y[j]
            np.add.at(ca, i, wb[j])
            np.add.at(cb, j, wa[i])
            before = np.concatenate([la, lb])
            while len(i):  # Least reachable id, until all linked ones agree.
                ma, mb = la.copy(), lb.copy()
                np.minimum.at(ma, i, lb[j])
                np.minimum.at(mb, j, ma[i])
                if same:
                    ma = mb = np.minimum(ma, mb)
                if (ma == la).all() and (mb == lb).all():
                    break
                la, lb = ma, mb
            now = np.concatenate([la, lb])
            if (fell := now != before).any():
                edges.append(np.unique(np.stack([before[fell], now[fell]]), axis=1))
    return ca, cb, np.concatenate([np.zeros((2, 0), np.int64), *edges], axis=1), (done, total)


def link_vectors(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", tile: int = 4096, path: str | None = None) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    path = path or shared_dir(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite, F.lit(False))
    rows = rows.withColumn("usable", usable)
    good = rows.where("usable")
    classes = cut(good.groupBy("label", "v").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")), f"{path}/classes")
    axes = _axes(classes)
    side = float(np.sqrt(max(0.0, 2 - 2 * threshold))) * (1 + 1e-9) + 1e-9
    shared_axes = spark.sparkContext.broadcast(axes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = [], []
            for v in batch.column("v").to_pylist():
                u = np.array(v, np.float64)
                u = u / np.linalg.norm(u) @ shared_axes.value[len(u)][:, :2]
                x.append(int(np.floor(u[0] / side)))
                y.append(int(np.floor(u[1] / side)) if len(u) > 1 else 0)
            raw = [np.array(v, np.float64).tobytes() for v in batch.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("node"), batch.column("copies"), pa.array([len(r) // 8 for r in raw], pa.int32()), pa.array(x, pa.int32()), pa.array(y, pa.int32()), pa.array(raw, pa.binary())], names=["label", "node", "copies", "dim", "x", "y", "raw"])

    kind = dict(classes.dtypes)["label"]
    placed = cut(classes.mapInArrow(place, f"label {kind}, node long, copies long, dim int, x int, y int, raw binary"), f"{path}/placed")
    cells = placed.groupBy("label", "dim", "x", "y").agg(F.ceil(F.count("*") / tile).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    where = ["label", "dim", "x", "y"]
    # A cell may hold a third of all vectors: its tiles are dealt out, not the cell.
    cells = cut(cells, f"{path}/cells")
    small = cells.count() <= 100_000
    tiled = placed.join(F.broadcast(cells) if small else cells, where).withColumn("part", part).repartition(*where, "part")

    def pack(group: pa.Table) -> pa.Table:
        return pa.table({
            "label": group.column("label").slice(0, 1), "dim": group.column("dim").slice(0, 1), "x": group.column("x").slice(0, 1), "y": group.column("y").slice(0, 1), "part": group.column("part").slice(0, 1),
            "nodes": pa.array([np.array(group.column("node").to_pylist(), np.int64).tobytes()]), "weights": pa.array([np.array(group.column("copies").to_pylist(), np.int64).tobytes()]), "raw": pa.array([b"".join(group.column("raw").to_pylist())]),
        })

    tiles = cut(tiled.groupBy(*where, "part").applyInArrow(pack, f"label {kind}, dim int, x int, y int, part int, nodes binary, weights binary, raw binary"), f"{path}/tiles")
    names = tiles.select(*where, "part")
    near = F.explode(F.array(*[F.struct((F.col("x") + dx).alias("x2"), (F.col("y") + dy).alias("y2")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])).alias("n")
    ask = names.select(*where, "part", near).select(*where, "part", "n.x2", "n.y2")
    other = names.select("label", "dim", F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("part").alias("part2"))
    ask = ask.join(other, ["label", "dim", "x2", "y2"]).where(F.struct("x", "y", "part") <= F.struct("x2", "y2", "part2"))
    two = [F.col(c).alias(f"{c}2") for c in ("x", "y", "part", "nodes", "weights", "raw")]
    pairs = ask.join(tiles, [*where, "part"]).join(tiles.select("label", "dim", *two), ["label", "dim", "x2", "y2", "part2"])
    pairs = pairs.select("dim", "nodes", "weights", "raw", "nodes2", "weights2", "raw2", ((F.col("x") == F.col("x2")) & (F.col("y") == F.col("y2")) & (F.col("part") == F.col("part2"))).alias("same"))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r].as_py() for n in batch.schema.names}
                d = row["dim"]
                ia, ib = np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["nodes2"], np.int64)
                wa, wb = np.frombuffer(row["weights"], np.int64), np.frombuffer(row["weights2"], np.int64)
                va, vb = np.frombuffer(row["raw"], np.float64).reshape(-1, d), np.frombuffer(row["raw2"], np.float64).reshape(-1, d)
                ca, cb, edges, _ = compare(ia, va, ib, vb, wa, wb, shared_axes.value[d], threshold, row["same"])
                if row["same"]:
                    ca, cb, ib = ca + cb, cb[:0], ib[:0]
                node, count = np.concatenate([ia, ib]), np.concatenate([ca, cb])
                keep = count > 0
                node, count = np.concatenate([node[keep], edges[0]]), np.concatenate([count[keep], np.zeros(edges.shape[1], np.int64)])
                other = np.concatenate([np.full(int(keep.sum()), -1), edges[1]])
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(count), pa.array(other, mask=np.arange(len(other)) < keep.sum())], schema=FOUND)

    found = cut(pairs.mapInArrow(links, "node long, links long, other long"), f"{path}/found")
    comp = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")), path).select("node", "component")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    told = classes.join(counts, "node", "left").join(comp, "node", "left").select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    some = good.join(told, ["label", "v"]).select("vec_id", "n_links", "component_id")
    rest = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return some.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
