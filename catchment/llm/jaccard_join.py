"""N-gram Jaccard self-join in the metric space of shingle sets, exact at a given similarity.

Jaccard distance is a metric, but most sets are at distance 1 from one another, so regions
around documents alone would not part them at first. The join therefore works on several levels.

0. Isolated sets. A shingle that no other set holds cannot be part of an overlap, so a set
   with fewer than t n shared shingles links with nothing. Blocks of documents send each
   distinct hash once to the hash's owner, which answers with those that came from more than
   one block or document; what is left are the sets that can link at all. Equal sets would
   answer for one another, so one document of each takes part.
1. Singleton pivots. The sets that are at less than distance 1 from the pivot {s} are those
   that hold shingle s. A set lies in the region of every shingle of its prefix, in one
   global order; two sets within the radius always share such a region (prefix length
   n - ceil(t n) + 1). The order puts crowded shingles last. Crowding is counted over all
   documents in a sketch of fixed size; it only chooses the order, so it cannot lose a link.
2. Document pivots. In each of these regions the least set is the pivot, and all sets that
   share a pivot make up its region. Distances to the pivot are computed exactly; what is
   within the radius is linked to it and so is one component with it. Of the region's main
   component only the rows in the window around the others stay open.
3. Recursion. A region with many open rows is parted again. First into Voronoi cells: each
   row goes to the nearest of several of the region's rows, its home, and to every cell whose
   pivot is at most two radii farther off; by the triangle inequality two linked sets meet in
   the home of either. A pair must hold a row that is at home, so boundary rows are not
   compared with one another. Where the metric cannot part the rows, since they are about as
   far from one another as from any pivot, the pivots are singletons again: prefixes are
   taken anew in the order of how many of the region's own rows hold a shingle, without the
   shingles that one row alone holds. Every parting is exact; one that does not halve the
   pairs to be compared is not made, so the recursion ends by itself.
4. Leaves. Rings by distance to the pivot: linked sets lie in one ring or in neighbouring
   ones. Rings are cut into tiles of bounded size, two of which are compared at a time. A pair
   of tiles returns a spanning forest of its links, so a dense group does not turn into all
   its pairs.

Equal sets are one node. All candidates are checked on whole sets. Shingles are compared by
64-bit hashes. Groups are reduced before shuffles; wide joins are plain shuffle joins that
the adaptive skew join splits; no region is gathered in one task.

Nulls and ties: a null text or one without words has an empty set and links with nothing;
its component is its own id. Rows with equal texts are linked. A null id takes part, and the
component of a group is the least id that is not null. Extra columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchment.llm.shared import components, cut, shared_dir

#: Counters of the crowding sketch, and how many of them make one row.
COUNTERS, CHUNK = 1 << 20, 1 << 14
#: Tiles of a region hold so many rows and hashes at most, on average.
TILE_ROWS, TILE_HASHES = 256, 200_000
#: Regions with more open rows than this are parted again, into so many Voronoi cells.
CELL_ROWS, CELLS = 1024, 8
#: Copies that go to every task as keys at most (some 100 MB); of more of them, texts are shuffled once.
COPIES = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_R = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2**64."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = max(n, 1 << 16) - 1
            self.up = np.concatenate([[_U(1)], np.full(m, _R, _U)]).cumprod(dtype=_U)
            self.down = np.concatenate([[_U(1)], np.full(m, pow(_R, -1, 1 << 64), _U)]).cumprod(dtype=_U)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; with fewer words, of the whole sequence."""
    raw = np.frombuffer((text or "").encode().lower(), np.uint8)  # bytes.lower() changes A-Z only
    if not len(raw):
        return np.zeros(0, _U)
    edge = np.diff(_SPACE[raw].astype(np.int8), prepend=1, append=1)
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(begin):
        return np.zeros(0, _U)
    up, down = _POWERS.upto(len(raw))
    run = np.concatenate([[_U(0)], np.cumsum((raw.astype(_U) + _U(1)) * up, dtype=_U)])
    word = _mix((run[end] - run[begin]) * down[begin] + (end - begin).astype(_U))
    m = min(k, len(word))
    h = np.full(len(word) - m + 1, m, _U)
    for j in range(m):
        h = _mix(h * _U(_R) + word[j : len(word) - m + 1 + j])
    return np.unique(h)


def fingerprint(s: np.ndarray) -> int:
    """A signed 64-bit digest of a set of hashes."""
    if not len(s):
        return 0
    parts = np.array([s.sum(dtype=_U), np.bitwise_xor.reduce(s), len(s)], _U)
    h = _U(7)
    for p in parts:
        h = _mix(np.array([int(h) * _R + int(p) & (1 << 64) - 1], _U))[0]
    return int(h.astype(np.int64))


SETS = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("n", pa.int64()), ("fp", pa.int64()), ("chunk", pa.int32()), ("counts", pa.binary())])
KEYS = pa.schema([("h", pa.int64()), ("fp", pa.int64()), ("n", pa.int32())])
MEMBERS = pa.schema([("fp", pa.int64()), ("n", pa.int32()), ("s", pa.binary())])
PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("inter", pa.int32()), ("na", pa.int32()), ("nb", pa.int32())])


def _scan(k: int):
    """Rows of documents, then rows of the task's sketch."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint32)
        seen: set[int] = set()
        for batch in batches:
            sizes, fps = [], []
            for t in batch.column(2).to_pylist():
                s = shingles(t, k)
                fp = fingerprint(s)
                sizes.append(len(s))
                fps.append(fp)
                if fp not in seen:
                    seen.add(fp)
                    np.add.at(counts, (s >> _U(44)).astype(np.int64), 1)
            if len(seen) > 500_000:
                seen.clear()
            none = [None] * batch.num_rows
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "tie": batch.column(1), "n": sizes, "fp": fps, "chunk": none, "counts": none}, schema=SETS)
        if seen:
            for c in range(COUNTERS // CHUNK):
                part = counts[c * CHUNK : (c + 1) * CHUNK]
                yield pa.RecordBatch.from_pydict({"doc_id": [None], "tie": [None], "n": [None], "fp": [None], "chunk": [c], "counts": [part.tobytes()]}, schema=SETS)

    return scan


def _crowded(sketch: DataFrame) -> bytes:
    """One bit per counter: whether it stands out from the mean. The size is fixed."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.frombuffer(raw, np.uint32).astype(np.uint64)
                own[c] = own[c] + x if c in own else x
        for c, x in own.items():
            mean = float(x.mean())
            bits = np.packbits(x > mean + 6 * mean**0.5 + 24, bitorder="little")
            yield pa.RecordBatch.from_pydict({"chunk": [c], "bits": [bits.tobytes()]}, schema=pa.schema([("chunk", pa.int32()), ("bits", pa.binary())]))

    rows = sketch.select("chunk", "counts").repartition("chunk").mapInArrow(add, "chunk int, bits binary").collect()
    out = bytearray(COUNTERS // 8)
    for r in rows:
        out[r["chunk"] * CHUNK // 8 : (r["chunk"] + 1) * CHUNK // 8] = r["bits"]
    return bytes(out)


PROBES = pa.schema([("p", pa.int32()), ("block", pa.int64()), ("idx", pa.binary()), ("h", pa.binary()), ("fps", pa.binary()), ("need", pa.binary())])
ANSWER = pa.schema([("block", pa.int64()), ("idx", pa.binary()), ("fps", pa.binary()), ("need", pa.binary())])
NOBODY = 0xFFFF


def _probes(k: int, num: int, den: int, owners: int):
    """Per block of documents: its distinct hashes by owner, and what its documents still need.

    A hash that several documents of the block hold is known to be shared; the owner gets it
    once, so a shingle of very many documents costs one entry per block.
    """

    def flush(fps: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        h = np.concatenate(sets)
        doc = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(x) for x in sets])
        order = np.argsort(h, kind="stable")
        h, doc = h[order], doc[order]
        new = np.concatenate([[True], h[1:] != h[:-1]])
        start = np.flatnonzero(new)
        count = np.diff(np.append(start, len(h)))
        several = np.repeat(count > 1, count)
        need = np.array([-(-num * len(x) // den) for x in sets]) - np.bincount(doc[several], minlength=len(sets))
        ids = np.array(fps, np.int64)
        block = fingerprint(ids.view(_U))
        one = np.where(count > 1, np.uint16(NOBODY), doc[start])
        u = h[start]
        owner = ((u >> _U(32)) % _U(owners)).astype(np.int32)
        by = np.argsort(owner, kind="stable")
        owner, one, low = owner[by], one[by], (u[by] & _U(0xFFFFFFFF)).astype(np.uint32)
        cuts = np.flatnonzero(np.diff(owner, prepend=-1))
        ends = np.append(cuts[1:], len(owner))
        m = len(cuts)
        none = [None] * m
        yield pa.RecordBatch.from_pydict({"p": owner[cuts], "block": [block] * m, "idx": [one[x:y].tobytes() for x, y in zip(cuts, ends, strict=True)], "h": [low[x:y].tobytes() for x, y in zip(cuts, ends, strict=True)], "fps": none, "need": none}, schema=PROBES)
        yield pa.RecordBatch.from_pydict({"p": [owners + block % owners], "block": [block], "idx": [None], "h": [None], "fps": [ids.tobytes()], "need": [need.astype(np.int32).tobytes()]}, schema=PROBES)

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fps: list[int] = []
        sets: list[np.ndarray] = []
        seen: set[int] = set()
        size = 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                s = shingles(t, k)
                if not len(s) or (fp := fingerprint(s)) in seen:
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(fp)
                fps.append(fp)
                sets.append(s)
                size += len(s)
                if size >= 1 << 20 or len(fps) >= 60_000:
                    yield from flush(fps, sets)
                    fps, sets, size = [], [], 0
        if fps:
            yield from flush(fps, sets)

    return probes


def _answer(group: pa.Table) -> pa.Table:
    """For one owner: of each block's hashes, the documents whose hash another block has as well."""
    if group.column("h").null_count:
        return group.select(ANSWER.names).cast(ANSWER)
    hs = [np.frombuffer(x, np.uint32) for x in group.column("h").to_pylist()]
    h = np.concatenate(hs)
    order = np.argsort(h, kind="stable")
    h = h[order]
    same = h[1:] == h[:-1]
    both = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    shared = np.zeros(len(h), bool)
    shared[order] = both
    out, at = [], 0
    for x, idx in zip(hs, group.column("idx").to_pylist(), strict=True):
        i = np.frombuffer(idx, np.uint16)[shared[at : at + len(x)]]
        out.append(i[i != NOBODY].tobytes())
        at += len(x)
    none = [None] * len(out)
    return pa.Table.from_pydict({"block": group.column("block"), "idx": out, "fps": none, "need": none}, schema=ANSWER)


def _able(group: pa.Table) -> pa.Table:
    """Of one block: the sets with enough shared shingles to link with any other."""
    own = {x["fps"]: x["need"] for x in group.select(["fps", "need"]).to_pylist() if x["fps"] is not None}
    fps, need = next(iter(own.items()))
    fps, need = np.frombuffer(fps, np.int64), np.frombuffer(need, np.int32)
    got = np.zeros(len(fps), np.int64)
    for raw in group.column("idx").to_pylist():
        if raw:
            got += np.bincount(np.frombuffer(raw, np.uint16), minlength=len(fps))
    return pa.table({"fp": pa.array(fps[got >= need])})


def _prefixes(num: int, den: int, crowded):
    """Region keys of the prefix of each set."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(crowded.value, np.uint8), bitorder="little")
        for batch in batches:
            hs, fps, ns = [], [], []
            for fp, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                s = np.frombuffer(raw.as_buffer(), _U)
                take = len(s) - -(-num * len(s) // den) + 1
                late = bits[(s >> _U(44)).astype(np.int64)].astype(bool)
                hs.append(np.concatenate([np.sort(_mix(s[~late])), np.sort(_mix(s[late]))])[:take].view(np.int64))
                fps.append(np.full(take, fp, np.int64))
                ns.append(np.full(take, len(s), np.int32))
            if hs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (hs, fps, ns)], schema=KEYS)

    return prefixes


def _members(k: int):
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, k) for t in batch.column(0).to_pylist()]
            for lo in range(0, len(sets), 500):
                some = sets[lo : lo + 500]
                yield pa.RecordBatch.from_pydict({"fp": [fingerprint(s) for s in some], "n": [len(s) for s in some], "s": [s.tobytes() for s in some]}, schema=MEMBERS)

    return members


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, sa, sb = (batch.column(i) for i in range(4))
        inter, na, nb = [], [], []
        last, x = None, np.zeros(0, _U)
        ids = a.to_pylist()
        for i, key in enumerate(ids):
            if key != last:
                last, x = key, np.frombuffer(sa[i].as_buffer(), _U)
            y = np.frombuffer(sb[i].as_buffer(), _U)
            inter.append(len(np.intersect1d(x, y, assume_unique=True)))
            na.append(len(x))
            nb.append(len(y))
        yield pa.RecordBatch.from_pydict({"a": ids, "b": b.to_pylist(), "inter": inter, "na": na, "nb": nb}, schema=PAIRS)


def _tile(num: int, den: int):
    """Compares two tiles of a region; returns a spanning forest of their links."""

    def tile(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        fp, d, c = (group.column(n).to_numpy() for n in ("fp", "d", "c"))
        sets = [np.frombuffer(x.as_buffer(), _U) for x in group.column("s")]
        size = np.array([len(x) for x in sets])
        # Only hashes that several sets have can be part of an overlap.
        h = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets)), size)
        order = np.argsort(h, kind="stable")
        h, row = h[order], row[order]
        code = np.cumsum(np.concatenate([[False], h[1:] != h[:-1]]))
        count = np.bincount(code)
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        inter = np.zeros((len(x), len(y)))
        common = count[code] > 1
        code, row = code[common], row[common]
        code = np.cumsum(np.concatenate([[False], code[1:] != code[:-1]])) if len(code) else code
        wide = 4096
        for lo in range(0, int(code[-1]) + 1 if len(code) else 0, wide):
            a, b = np.searchsorted(code, [lo, lo + wide])
            hold = np.zeros((len(sets), wide), np.float32)
            hold[row[a:b], code[a:b] - lo] = 1
            inter += hold[x] @ hold[y].T
        union = size[x][:, None] + size[y][None, :] - inter
        linked = (inter * den >= union * num) & (c[x][:, None] != c[y][None, :])
        low = fp.copy()
        i, j = np.nonzero(linked)
        i, j = x[i], y[j]
        while True:
            new = low.copy()
            np.minimum.at(new, i, low[j])
            np.minimum.at(new, j, new[i])
            if (new == low).all():
                break
            low = new
        hit = low != fp
        return pa.table({"a": pa.array(fp[hit]), "b": pa.array(low[hit])})

    return tile


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shingle of each set."""
    for batch in batches:
        sets = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("s")]
        for lo in range(0, len(sets), 500):
            some = sets[lo : lo + 500]
            at = pa.array(np.repeat(np.arange(lo, lo + len(some)), [len(x) for x in some]))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in ("p", "fp", "n", "core")] + [pa.array(np.concatenate(some))], names=["p", "fp", "n", "core", "h"])


def _distance() -> Column:
    """Jaccard distance of a row of overlaps."""
    return 1 - F.col("inter") / (F.col("na") + F.col("nb") - F.col("inter"))


def _linked(num: int, den: int) -> Column:
    return F.col("inter") * den >= (F.col("na") + F.col("nb") - F.col("inter")) * num


#: Columns of the rows of regions.
_ROW = ["p", "fp", "n", "d", "c", "core"]


def _windowed(rows: DataFrame, radius: float) -> DataFrame:
    """Without the rows that are too near or too far from the pivot to reach a core row of their region."""
    edge = rows.where("core").groupBy("p").agg(F.min("d").alias("near"), F.max("d").alias("far"))
    return rows.join(edge, "p").where(F.col("core") | F.col("d").between(F.col("near") - radius - 1e-9, F.col("far") + radius + 1e-9)).drop("near", "far")


def _paying(children: DataFrame, size: DataFrame) -> DataFrame:
    """The regions p of ``size`` whose ``children`` (parent, p, core) have at most half their pairs to compare."""
    each = children.groupBy("parent", "p").agg((F.count("*") * F.sum(F.col("core").cast("long"))).alias("w"))
    work = each.groupBy(F.col("parent").alias("p")).agg(F.sum("w").alias("w"))
    return size.join(work, "p", "left").where(2 * F.coalesce("w", F.lit(0)) <= F.col("k") * F.col("a")).select("p")


def _parted(rows: DataFrame, members: DataFrame, distances, num: int, den: int, path: str) -> tuple[DataFrame, list[DataFrame]]:
    """The leaves of the recursion over the regions of ``rows``, and the links found on the way.

    ``rows`` and leaves hold p (the region), fp, n, d (distance to the region's pivot), c (what
    is linked already) and core: a pair is to be compared if one of its rows at least is core.
    """
    radius = 1 - num / den
    near = _linked(num, den)
    leaves, links, step = [], [], 0
    while True:
        step += 1
        size = rows.groupBy("p").agg(F.count("*").alias("k"), F.sum(F.col("core").cast("long")).alias("a")).where("a > 0")
        sized = rows.join(size, "p")
        leaves.append(sized.where(F.col("k") <= CELL_ROWS).select(*_ROW))
        large = cut(sized.where(F.col("k") > CELL_ROWS), f"{path}/large{step}")
        if large.isEmpty():
            break
        size = large.select("p", "k", "a").distinct()

        # Voronoi cells: the pivots are compared with all rows of the region and are done with then.
        draw = F.pmod(F.xxhash64("fp", F.lit(step)), F.lit(CELLS))
        pivots = cut(large.groupBy("p", draw.alias("draw")).agg(F.min("fp").alias("q")).select("p", "q"), f"{path}/pivots{step}")
        away = distances(large.join(pivots, "p").where("fp <> q").select(F.col("q").alias("a"), F.col("fp").alias("b")).distinct(), f"away{step}")
        links.append(away.where(near).select("a", "b"))
        others = large.join(pivots.withColumnRenamed("q", "fp"), ["p", "fp"], "left_anti").drop("d")
        e = away.select(F.col("a").alias("q"), F.col("b").alias("fp"), _distance().alias("d"))
        placed = others.join(pivots, "p").join(e, ["q", "fp"])
        home = placed.groupBy("p", "fp").agg(F.min(F.struct("d", "q")).alias("home"))
        cells = placed.join(home, ["p", "fp"]).where(F.col("d") <= F.col("home.d") + 2 * radius + 1e-9)
        cells = cells.select(F.col("p").alias("parent"), F.xxhash64("p", "q").alias("p"), "fp", "n", "d", "c", (F.col("core") & (F.col("q") == F.col("home.q"))).alias("core"))
        cells = cut(_windowed(cells, radius), f"{path}/cells{step}")
        paying = cut(_paying(cells, size), f"{path}/paying{step}")
        rows = cells.join(paying.withColumnRenamed("p", "parent"), "parent", "left_semi").select(*_ROW)

        rest = large.join(paying, "p", "left_anti")
        if not rest.isEmpty():
            # Singletons: only shingles that a core row and another row hold can be part of an overlap.
            held = rest.join(members.select("fp", "s"), "fp").select("p", "fp", "n", "core", "s")
            held = cut(held.mapInArrow(_spread, "p long, fp long, n int, core boolean, h long"), f"{path}/held{step}")
            common = held.groupBy("p", "h").agg(F.count("*").alias("w"), F.max("core").alias("some")).where("w > 1 and some").drop("some")
            own = held.join(common, ["p", "h"]).groupBy("p", "fp", "n", "core").agg(F.sort_array(F.collect_list(F.struct("w", "h"))).alias("hs"))
            take = F.size("hs") - F.expr(f"int(({num} * n + {den - 1}) div {den})") + 1
            keys = own.where(take > 0).select("p", "fp", "core", F.explode(F.slice("hs", F.lit(1), take)).alias("x")).select("p", "fp", "core", "x.h")
            regions = keys.groupBy("p", "h").agg(F.min("fp").alias("q"), F.max("fp").alias("top"), F.max("core").alias("some")).where("q < top and some")
            met = keys.join(regions.select("p", "h", "q"), ["p", "h"]).where("fp <> q").select("p", "q", "fp", "core").distinct()
            met = cut(met.select(F.col("p").alias("parent"), F.xxhash64("p", "q", F.lit(step)).alias("p"), "q", "fp", "core"), f"{path}/met{step}")
            also = cut(_paying(met, size.join(paying, "p", "left_anti")), f"{path}/also{step}").withColumnRenamed("p", "parent")
            met = met.join(also, "parent", "left_semi")
            star = distances(met.select(F.col("q").alias("a"), F.col("fp").alias("b")).distinct(), f"stars{step}")
            links.append(star.where(near).select("a", "b"))
            e = star.select(F.col("a").alias("q"), F.col("b").alias("fp"), _distance().alias("d"))
            around = met.join(e, ["q", "fp"]).join(rest.select(F.col("p").alias("parent"), "fp", "n", "c"), ["parent", "fp"])
            rows = rows.unionByName(_windowed(around.select(*_ROW), radius))
            leaves.append(rest.join(also.withColumnRenamed("parent", "p"), "p", "left_anti").select(*_ROW))
        rows = cut(rows, f"{path}/rows{step}")
    whole = leaves[0]
    for more in leaves[1:]:
        whole = whole.unionByName(more)
    return cut(whole, f"{path}/leaves"), links


def _without_copies(rows: DataFrame, sets: DataFrame, path: str) -> DataFrame:
    """``rows`` (doc_id, tie, text) with one document of those with equal sets; rows that agree in id and text stay together."""
    key = F.xxhash64("doc_id", "tie").alias("key")
    keys = sets.where("n > 0").select("fp", key)
    first = keys.groupBy("fp").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first < last").drop("last")
    copies = cut(keys.join(first, "fp").where("key <> first").select("key").distinct(), f"{path}/copies")
    if not (n := copies.limit(COPIES + 1).count()):
        return rows
    return rows.withColumn("key", key).join(copies.hint("broadcast" if n <= COPIES else "merge"), "key", "left_anti").drop("key")


def link_classes(docs: DataFrame, k: int = 5, num: int = 3, den: int = 4, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id; linked means intersection/union >= num/den."""
    placed = _classes(docs, k, num, den, id_col, text_col, path or shared_dir(docs.sparkSession))
    least = placed.where("n > 0").groupBy("c").agg(F.min("doc_id").alias("component_id"))
    some = placed.where("n > 0").join(least, "c").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return some.unionByName(placed.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def drop_linked(docs: DataFrame, k: int = 5, num: int = 3, den: int = 4, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with one row of each component, that with the least id (null ids last), all its columns as they were.

    Rows without words stay. Rows that agree in id and text are one document, of which one row stays.
    """
    placed = _classes(docs, k, num, den, id_col, text_col, path or shared_dir(docs.sparkSession))
    one = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tie")).alias("one")
    kept = placed.where("n > 0").groupBy("c").agg(one).select("one.doc_id", "one.tie").unionByName(placed.where("n = 0").select("doc_id", "tie"))
    keys = ["__key", "__tie"]
    kept = kept.select(F.xxhash64("doc_id").alias("__key"), F.col("tie").alias("__tie")).distinct()
    keyed = docs.withColumn("__key", F.xxhash64(F.col(id_col).cast("long"))).withColumn("__tie", F.xxhash64(text_col))
    # Rows of one document that differ elsewhere: always the same one stays.
    whole = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind])
    return keyed.join(kept, keys, "left_semi").groupBy(*keys).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), whole).alias("__row")).select("__row.*")


def _classes(docs: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str, path: str) -> DataFrame:
    """Per row: doc_id, tie (a hash of the text), n (shingles), c (the least fingerprint of its component)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text"))
    scanned = cut(rows.mapInArrow(_scan(k), "doc_id long, tie long, n long, fp long, chunk int, counts binary"), f"{path}/scan")
    sets = scanned.where("chunk is null").select("doc_id", "tie", "n", "fp")
    crowded = spark.sparkContext.broadcast(_crowded(scanned.where("chunk is not null")))

    chars = rows.agg(F.sum(F.char_length("text"))).first()[0] or 0
    owners = max(16, chars // 8_000_000)
    probes = _without_copies(rows, sets, path).select("text").mapInArrow(_probes(k, num, den, owners), "p int, block long, idx binary, h binary, fps binary, need binary")
    answers = probes.groupBy("p").applyInArrow(_answer, "block long, idx binary, fps binary, need binary")
    able = cut(answers.groupBy("block").applyInArrow(_able, "fp long").distinct(), f"{path}/able")

    first = sets.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("doc_id")).join(able, "fp", "left_semi").select(F.col("doc_id").alias("i"))
    texts = rows.join(first, rows["doc_id"].eqNullSafe(first["i"]), "left_semi").select("text")
    members = cut(texts.mapInArrow(_members(k), "fp long, n int, s binary").dropDuplicates(["fp"]), f"{path}/members")

    keys = members.select("fp", "s").mapInArrow(_prefixes(num, den, crowded), "h long, fp long, n int")
    shared = keys.groupBy("h").agg(F.min("fp").alias("p"), F.max("fp").alias("top")).where("p < top").select("h", "p")
    region = cut(keys.join(shared, "h").where("fp <> p").select(F.col("p").alias("a"), F.col("fp").alias("b")).distinct(), f"{path}/regions")

    def distances(pairs: DataFrame, name: str) -> DataFrame:
        """Exact overlaps of the distinct pairs (a, b)."""
        b = members.select(F.col("fp").alias("b"), F.col("s").alias("sb"))
        a = members.select(F.col("fp").alias("a"), F.col("s").alias("sa"))
        both = pairs.join(b, "b").join(a, "a").select("a", "b", "sa", "sb")
        return cut(both.mapInArrow(_overlaps, "a long, b long, inter int, na int, nb int"), f"{path}/{name}")

    linked = _linked(num, den)
    radius = 1 - num / den

    # Every set against the pivots of its regions. From here on a region is all that shares
    # a pivot, each row with its exact distance to it.
    star = distances(region, "star")
    links = star.where(linked).select("a", "b")
    rows_of = star.select(F.col("a").alias("p"), F.col("b").alias("fp"), F.col("nb").alias("n"), _distance().alias("d"))
    comp = components(links, f"{path}/comp1").select(F.col("node").alias("fp"), F.col("component").alias("c"))
    rows_of = rows_of.join(comp, "fp", "left").withColumn("c", F.coalesce("c", "fp"))
    parts = rows_of.groupBy("p", "c").agg(F.count("*").alias("k"))
    main = parts.groupBy("p").agg(F.max_by("c", F.struct("k", "c")).alias("c0"), F.count("*").alias("parts"))
    # A pair within the main component of a region says nothing new: one of its rows must be of another.
    several = rows_of.join(main.where("parts > 1"), "p").withColumn("core", F.col("c") != F.col("c0"))
    open_ = cut(_windowed(several.select(*_ROW), radius), f"{path}/open")
    if not open_.isEmpty():
        leaves, found = _parted(open_, members, distances, num, den, path)
        for more in found:
            links = links.unionByName(more)
        leaves = leaves.withColumn("r", F.floor(F.col("d") / radius).cast("int"))
        tiles = F.greatest(F.ceil(F.sum("n") / TILE_HASHES), F.ceil(F.count("*") / TILE_ROWS)).cast("int")
        sides = []
        for name, side in (("x", leaves.where("core")), ("y", leaves)):
            count = side.groupBy("p", "r").agg(tiles.alias("t"))
            dealt = side.join(count, ["p", "r"]).select("p", F.col("r").alias(f"r{name}"), F.pmod(F.xxhash64("fp"), F.col("t")).cast("int").alias(f"t{name}"), "fp", "d", "c")
            sides.append((count.select("p", F.col("r").alias(f"r{name}"), F.explode(F.sequence(F.lit(0), F.col("t") - 1)).alias(f"t{name}")), dealt))
        (xs, left), (ys, right) = sides
        asked = xs.join(ys, "p").where(F.abs(F.col("rx") - F.col("ry")) <= 1)
        key = ["p", "rx", "tx", "ry", "ty"]
        spread = left.join(asked, ["p", "rx", "tx"]).select(*key, F.lit(0).alias("side"), "fp", "d", "c").unionByName(right.join(asked, ["p", "ry", "ty"]).select(*key, F.lit(1).alias("side"), "fp", "d", "c"))
        full = spread.join(members.select("fp", "s"), "fp").select(*key, "side", "fp", "d", "c", "s")
        more = cut(full.groupBy(*key).applyInArrow(_tile(num, den), "a long, b long"), f"{path}/more")
        comp = components(links.unionByName(more), f"{path}/comp2").select(F.col("node").alias("fp"), F.col("component").alias("c"))

    return sets.join(comp, "fp", "left").select("doc_id", "tie", "n", F.coalesce("c", "fp").alias("c"))
