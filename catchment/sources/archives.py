"""Decoding daily snow archives and polygon blobs that Spark reads as binary files."""

from __future__ import annotations

import gzip
import io
import struct
import tarfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Part of the member names that hold snow water equivalent.
SNOW_MEMBER = "ssmv11034"


def parse_header(text: str) -> dict[str, str]:
    """"key: value" lines; the last of equal keys wins."""
    return {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in text.splitlines() if ":" in x)}


class Archive:
    """One archive's snow members. Members are found by their tar headers; a member is inflated when it is asked for."""

    def __init__(self, content: bytes = b"", file=None):
        # A plain tar file is sought through; trying compressed forms first would read ahead.
        self.tar = tarfile.open(fileobj=file, mode="r:") if file else tarfile.open(fileobj=io.BytesIO(content))  # noqa: SIM115
        self.members = {m.name: m for m in self.tar.getmembers() if SNOW_MEMBER in m.name}

    def read(self, end: str) -> bytes:
        name = next((n for n in sorted(self.members) if n.endswith(end)), None)
        if name is None:
            raise ValueError(f"the archive has no snow member {end}")
        return gzip.decompress(self.tar.extractfile(self.members[name]).read())

    def header(self) -> dict[str, str]:
        return parse_header(self.read(".txt.gz").decode("latin-1"))

    def grid(self, header: dict[str, str]) -> np.ndarray:
        raw, (rows, columns) = self.read(".dat.gz"), (int(header["Number of rows"]), int(header["Number of columns"]))
        if len(raw) != 2 * rows * columns:
            raise ValueError(f"{len(raw)} bytes for {rows} x {columns} pixels")
        return np.frombuffer(raw, ">i2").reshape(rows, columns)


def decode_archive(content: bytes) -> tuple[dict[str, str], np.ndarray]:
    """Header and big-endian 16-bit grid of one archive; missing members and wrong sizes raise."""
    archive = Archive(content)
    header = archive.header()
    return header, archive.grid(header)


def snow_pixels(files: DataFrame, fill: int = -9999, rows_at_once: int = 200_000) -> DataFrame:
    """(path, iy, ix, value) of ``files`` (path, content); filled pixels are left out.

    One archive is one row of input and is decoded by itself; pixels leave in pieces.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, content in zip(f["path"], f["content"], strict=True):
                _, grid = decode_archive(content)
                iy, ix = np.nonzero(grid != fill)
                for at in range(0, len(iy), rows_at_once):
                    y, x = iy[at : at + rows_at_once], ix[at : at + rows_at_once]
                    yield pd.DataFrame({"path": path, "iy": y.astype("int32"), "ix": x.astype("int32"), "value": grid[y, x].astype(float)})

    return files.select("path", "content").mapInPandas(run, "path string, iy int, ix int, value double")


def snow_headers(files: DataFrame) -> DataFrame:
    """(path, rows, columns, min_x, max_y, dx, dy) of each archive; grids are not inflated."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            heads = [Archive(c).header() for c in f["content"]]
            get = lambda key, kind: [kind(h[key]) for h in heads]
            yield pd.DataFrame({"path": f["path"], "rows": get("Number of rows", int), "columns": get("Number of columns", int), "min_x": get("Minimum x-axis coordinate", float), "max_y": get("Maximum y-axis coordinate", float), "dx": get("X-axis resolution", float), "dy": get("Y-axis resolution", float)})

    return files.select("path", "content").mapInPandas(run, "path string, rows int, columns int, min_x double, max_y double, dx double, dy double")


def _shape(order: str, blob: bytes, at: int) -> tuple[int, int, int]:
    """(kind, numbers per point, where the counts begin) of a geometry, in the ISO and the extended form of Z, M and SRID."""
    (code,) = struct.unpack_from(order + "I", blob, at + 1)
    flags, code = code >> 29, code & 0x1FFFFFFF
    extra, kind = divmod(code, 1000)
    if extra > 3 or flags & 6 and extra:
        raise ValueError(f"not a polygon: WKB type {code}")
    size = 2 + (flags >> 2 & 1) + (flags >> 1 & 1) + (0, 1, 1, 2)[extra]
    return kind, size, at + 5 + 4 * (flags & 1)


def decode_wkb(blob: bytes) -> list[list[list[dict[str, float]]]]:
    """The parts of a WKB polygon or multipolygon, each a list of rings; heights, measures and SRIDs are left out. Other kinds raise."""
    parts, at, left = [], 0, 1
    while left:
        order = "<" if blob[at] else ">"
        kind, size, at = _shape(order, blob, at)
        (count,) = struct.unpack_from(order + "I", blob, at)
        at, left = at + 4, left - 1
        if kind == 6:
            left += count
        elif kind == 3:
            rings = []
            for _ in range(count):
                (n,) = struct.unpack_from(order + "I", blob, at)
                points = np.frombuffer(blob, order + "f8", size * n, at + 4).reshape(-1, size)
                rings.append([{"x": float(p[0]), "y": float(p[1])} for p in points])
                at += 4 + 8 * size * n
            parts.append(rings)
        else:
            raise ValueError(f"not a polygon: WKB type {kind}")
    return parts


def polygons(fabric: DataFrame, id_col: str = "hru", blob: str = "geometry") -> DataFrame:
    """(hru, part, rings) from a GeoParquet table's WKB column, a row per part; null and empty shapes have none."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(h, k, rings) for h, b in zip(f["hru"], f["blob"], strict=True) if b is not None for k, rings in enumerate(decode_wkb(bytes(b)))]
            yield pd.DataFrame(rows, columns=["hru", "part", "rings"])

    return fabric.selectExpr(f"cast({id_col} as bigint) as hru", f"{blob} as blob").mapInPandas(run, "hru long, part int, rings array<array<struct<x: double, y: double>>>")
