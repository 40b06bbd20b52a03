"""Line dedup by a range sort of line hashes, giving bitmaps of the lines that stay.

A line's key is the line without white space at its ends, A-Z lower-cased. Keys of ``least`` code
points and more that stand in ``copies`` documents and more lose all their lines, except in the
document with the largest id. Lines travel as 128-bit hashes with document and position, never as
text. They are range-partitioned by (hash, document), so that the documents of one frequent line
spread over many tasks, sorted by hash, document from the largest on, and position, and streamed:
the first document of a hash keeps its lines, and those from the third on go at once; the second's
wait for a third. Only the first and the last hash of a task may go on in other tasks: their rows
or witnesses are settled together afterwards, at most one hash per pair of neighbouring tasks.

What is dropped becomes one row per document: a compressed bitmap, 1 for a line that stays; lines
behind the last dropped one have no bit and stay. Bitmaps meet their texts by id and text hash.

Nulls and ties: a null or empty text is one empty line. A null id is an id of its own, smaller than
all others. Rows that share an id count as one document, each with a bitmap of its own; rows that
repeat with id and text share one. Extra columns are kept by ``drop_lines``; an empty table gives
an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchment.llm.shared import cut, shared_dir, slices

LEAST_ID = -(1 << 63)
LINES = "h1 long, h2 long, doc long, row long, pos int"
#: What a streamed row says: the line goes; it depends on other tasks; its document holds the hash.
GOES, OPEN, WITNESS = 0, 1, 2


def _keys(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    """A row's document number and the number of its text."""
    return F.coalesce(docs[id_col].cast("long"), F.lit(LEAST_ID)), F.xxhash64(docs[text_col])


def line_hashes(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(2)):
                part = batch.slice(lo, hi - lo)
                digests, owner, at = [], [], []
                for i, text in enumerate(part.column(2).cast(pa.binary()).to_pylist()):
                    for pos, line in enumerate((text or b"").split(b"\n")):
                        key = line.strip().lower()  # of bytes: blanks and 0x09 to 0x0D, and A-Z only
                        if len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least):
                            digests.append(xxhash.xxh3_128_digest(key))
                            owner.append(i)
                            at.append(pos)
                h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                who = np.array(owner, np.int64)
                doc, row = (np.asarray(part.column(j))[who] for j in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(h[:, 0])), pa.array(np.ascontiguousarray(h[:, 1])), pa.array(doc), pa.array(row), pa.array(at, pa.int32())], names=["h1", "h2", "doc", "row", "pos"])

    doc, row = _keys(docs, id_col, text_col)
    return docs.select(doc.alias("doc"), row.alias("row"), docs[text_col].alias("text")).mapInArrow(run, LINES)


class Stream:
    """Sorted rows of one task, batch by batch; of the open hash it keeps who holds it and the rows that wait.

    Rows that wait belong to fewer than ``copies`` documents, however many rows a hash has.
    """

    def __init__(self, copies: int):
        self.copies, self.key, self.last = copies, None, None
        self.opening, self.n, self.heads, self.waiting = False, 0, [], []

    def feed(self, h: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(hashes, rows, what) that can be told now; ``rows`` are (doc, row, pos). Hash 0 is the one that was open."""
        begin = self.key is None
        new = np.concatenate([[begin or tuple(h[0].tolist()) != self.key], (h[1:] != h[:-1]).any(axis=1)])
        fresh = new | np.concatenate([[rows[0, 0] != self.last], rows[1:, 0] != rows[:-1, 0]])
        group, count = np.cumsum(new), np.cumsum(fresh)
        rank = count - np.concatenate([[-self.n], count[new] - 1])[group]  # 1: the document that keeps its lines
        size = np.zeros(group[-1] + 1, np.int64)  # documents of each hash so far; other hashes than the open one begin at none
        size[0] = self.n
        np.maximum.at(size, group, rank)
        opening = np.zeros(len(size), bool)
        opening[0], opening[min(1, len(size) - 1)] = self.opening, begin or (len(size) == 1 and self.opening)

        late = ~opening[group] & (rank > 1)
        sure = late & (size[group] >= self.copies)
        yield h[opening[group]], rows[opening[group]], OPEN
        yield h[sure], rows[sure], GOES
        if size[0] >= self.copies:
            yield from ((a, b, GOES) for a, b in self.waiting)
        if size[0] >= self.copies or len(size) > 1:
            self.waiting = []
        now = group == len(size) - 1
        self.heads = ((self.heads if len(size) == 1 else []) + rows[now & fresh, 0].tolist())[: self.copies]
        self.key, self.last, self.n, self.opening = tuple(h[-1].tolist()), rows[-1, 0], int(size[-1]), bool(opening[-1])
        wait = now & late & ~sure
        if wait.any():
            self.waiting.append((h[wait], rows[wait]))

    def close(self) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        if self.key is not None and not self.opening:
            yield np.tile(np.array(self.key, np.int64), (len(self.heads), 1)), np.array([(d, 0, 0) for d in self.heads], np.int64), WITNESS
            yield from ((a, b, OPEN) for a, b in self.waiting)


def stream(sorted_rows: DataFrame, copies: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Stream(copies)

        def told(parts):
            for h, rows, what in parts:
                if len(h):
                    h, rows = np.ascontiguousarray(h.T), np.ascontiguousarray(rows.T)
                    yield pa.RecordBatch.from_arrays([*map(pa.array, h), *map(pa.array, rows[:2]), pa.array(rows[2], pa.int32()), pa.array(np.full(h.shape[1], what, np.int8))], names=["h1", "h2", "doc", "row", "pos", "what"])

        for batch in batches:
            if batch.num_rows:
                c = [np.asarray(x) for x in batch.columns]
                yield from told(s.feed(np.stack(c[:2], axis=1), np.stack([x.astype(np.int64) for x in c[2:]], axis=1)))
        yield from told(s.close())

    return sorted_rows.mapInArrow(run, f"{LINES}, what tinyint")


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 20, copies: int = 3, tasks: int | None = None, path: str | None = None, broadcast_rows: int = 1_000_000) -> DataFrame:
    """(doc, row, n_dropped, keep) of the documents that lose lines; ``keep`` is a zlib-compressed bitmap, high bits first."""
    spark = docs.sparkSession
    path = path or shared_dir(spark)
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = cut(line_hashes(docs, id_col, text_col, least), f"{path}/lines")
    order = ["h1", "h2", F.col("doc").desc()]
    told = cut(stream(lines.repartitionByRange(tasks, *order).sortWithinPartitions(*order, "row", "pos"), copies), f"{path}/told")

    # Hashes that go on over the ends of tasks: fewer than there are tasks.
    edge = told.where(F.col("what") != GOES)
    held = edge.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one")).groupBy("h1", "h2").agg(F.max("doc").alias("owner"), F.count("*").alias("n")).where(F.col("n") >= copies).drop("n")
    held = cut(held, f"{path}/held")
    if held.count() <= broadcast_rows:
        held = F.broadcast(held)
    settled = edge.where(F.col("what") == OPEN).join(held, ["h1", "h2"]).where("doc <> owner")
    drops = told.where(F.col("what") == GOES).select("doc", "row", "pos").unionByName(settled.select("doc", "row", "pos"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, n = [], []
            for gone in batch.column(2):
                at = np.asarray(gone.values)
                bits = np.ones(8 * (int(at.max()) // 8 + 1), bool)  # whole bytes
                bits[at] = False
                keep.append(zlib.compress(np.packbits(bits).tobytes()))
                n.append(len(at))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(keep, pa.binary())], names=["doc", "row", "n_dropped", "keep"])

    return drops.groupBy("doc", "row").agg(F.collect_set("pos").alias("gone")).mapInArrow(pack, "doc long, row long, n_dropped long, keep binary")


def kept_lines(text: str, keep: bytes | None) -> str:
    """The lines that a bitmap leaves."""
    if keep is None:
        return text
    lines = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[: len(lines)]
    return "\n".join([x for x, b in zip(lines, bits.tolist(), strict=False) if b] + lines[len(bits) :])


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = False, **how) -> DataFrame:
    """``docs`` without the lines that go; with ``counts`` also n_lines (before) and n_dropped."""

    @F.pandas_udf("string")
    def left(text: pd.Series, keep: pd.Series) -> pd.Series:
        return pd.Series([t if t is None else kept_lines(t, k) for t, k in zip(text, keep, strict=True)], dtype=object)

    doc, row = _keys(docs, id_col, text_col)
    maps = keep_bitmaps(docs, id_col, text_col, **how).withColumnsRenamed({"doc": "__doc", "row": "__row", "n_dropped": "__n", "keep": "__keep"})
    met = docs.withColumn("__doc", doc).withColumn("__row", row).join(maps, ["__doc", "__row"], "left")
    columns = [left(text_col, "__keep").alias(text_col) if c == text_col else F.col(c) for c in docs.columns]
    if counts:
        columns += [F.size(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)).cast("long").alias("n_lines"), F.coalesce("__n", F.lit(0)).cast("long").alias("n_dropped")]
    return met.select(*columns)
