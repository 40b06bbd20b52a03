"""Periodic runs of words, found by recursive frequency splitting and lag scans.

A run is a longest stretch of words with smallest period q, of length ``times`` x q and ``least``
at the least. Each of its words occurs ``times`` times in it or more. So a word that occurs more
rarely within the current segment, a document at first, lies in no run and splits it; pieces below
``least`` words go; pieces that changed are counted anew until nothing changes. Rounds that go on
nibbling at a segment's ends stop after 64 times the words of the batch, which costs nothing but
speed: the scan below is right for any segment.

Surviving segments are scanned lag by lag. At lag q only the words' blocks between multiples of q
are compared, by a rolling hash: a run holds three equal blocks in a row. Around such places the
words themselves are compared, so hashes decide nothing. A segment of m words costs about
m log m, however repetitive it is: stretches that a run with a divisor of q explains are passed over.

Documents are independent, so nothing is shuffled; a task holds some 4 MB of texts, or one text.

Nulls and ties: a null or blank text has no words, no runs, and collapses to the empty string.
Rows that repeat are worked on one by one; a null id is kept as it is. Of equally long runs (by
length / period, compared as fractions) the least start wins, then the least period. Extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchment.llm.shared import slices

WORDS = r"[^\x20\x09-\x0D]+"
RUNS = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, runs array<struct<start:long,length:long,period:long>>"
PRIME, BASE = (1 << 31) - 1, 1_000_003


def _stretches(on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edge = np.diff(np.concatenate([[0], on.astype(np.int8), [0]]))
    return np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]


def split(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, times: int, least: int) -> list[tuple[int, int]]:
    """Segments (start, end) that no rare word splits any more."""
    done: list[tuple[int, int]] = []
    kinds, work = int(ids.max(initial=0)) + 1, 64 * len(ids)
    while True:
        size = ends - starts
        starts, ends = starts[size >= least], ends[size >= least]
        if not len(starts):
            return done
        size = ends - starts
        if work < 0:
            return done + list(zip(starts.tolist(), ends.tolist(), strict=True))
        work -= int(size.sum())
        seg = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(seg)) + np.repeat(starts - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        _, back, n = np.unique(seg * kinds + ids[at], return_inverse=True, return_counts=True)
        keep = n[back] >= times
        whole = np.bincount(seg[~keep], minlength=len(size)) == 0
        done += zip(starts[whole].tolist(), ends[whole].tolist(), strict=True)
        on = np.concatenate([[False], keep & ~whole[seg], [False]])
        edge = np.concatenate([[True], seg[1:] != seg[:-1], [True]])
        starts, ends = at[on[1:-1] & (edge[:-1] | ~on[:-2])], at[on[1:-1] & (edge[1:] | ~on[2:])] + 1


@lru_cache(maxsize=2)
def powers(bits: int) -> np.ndarray:
    """BASE to the power of 0, 1, ... modulo PRIME."""
    out = np.ones(1, np.int64)
    for _ in range(bits):
        out = np.concatenate([out, out * (int(out[-1]) * BASE % PRIME) % PRIME])
    return out


def scan(w: np.ndarray, times: int, least: int) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of one segment."""
    m = len(w)
    power = powers(m.bit_length())
    total = np.concatenate([[0], np.cumsum((w + 1) % PRIME * power[:m] % PRIME)])
    found: list[tuple[int, int, int]] = []
    alive: list[tuple[int, int, int]] = []  # those long enough to explain stretches at this lag and above
    seen: set[tuple[int, int]] = set()
    for q in range(1, m // times + 1):
        part = np.diff(total[::q]) % PRIME
        same = part[:-1] * power[q] % PRIME == part[1:]
        hit = np.nonzero(same[:-1] & same[1:])[0]
        if not len(hit):
            continue
        edge = np.nonzero(np.diff(hit) > 1)[0]
        k0, k1 = hit[np.concatenate([[0], edge + 1])], hit[np.concatenate([edge, [len(hit) - 1]])]
        alive = [x for x in alive if x[1] >= 3 * q]
        known = sorted((s, s + n) for s, n, p in alive if q % p == 0)
        if known:
            # Stretches of period q that a divisor explains overlap by less than q words, so one look tells.
            s, e = np.array(known).T
            at = np.searchsorted(s, k0 * q, "right") - 1
            new = (at < 0) | (e[at] < (k1 + 3) * q)
            k0, k1 = k0[new], k1[new]
        for lo, hi in zip((np.maximum(k0 - 1, 0) * q).tolist(), np.minimum((k1 + 3) * q, m - q).tolist(), strict=True):
            for s, e in zip(*_stretches(w[lo:hi] == w[lo + q : hi + q]), strict=True):
                run = (lo + int(s), lo + int(e) + q)
                if run[1] - run[0] >= max(least, times * q) and run not in seen:
                    seen.add(run)
                    found.append((run[0], run[1] - run[0], q))
                    alive.append(found[-1])
    return found


def find(texts: list[bytes], times: int, least: int) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words and runs of each text, runs by start and period."""
    number: dict[bytes, int] = {}
    words = [t.split() for t in texts]  # bytes split at blanks and 0x09 to 0x0D, as the contracts want
    ids = np.fromiter((number.setdefault(x, len(number)) for w in words for x in w), np.int64)
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for lo, hi in split(ids, starts, ends, times, least):
        doc = int(np.searchsorted(ends, lo, "right"))
        first = lo - int(starts[doc])
        runs[doc] += [(first + s, n, q) for s, n, q in scan(ids[lo:hi], times, least)]
    for w, r in zip(words, runs, strict=True):
        yield w, sorted(r, key=lambda x: (x[0], x[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside runs and each run's first period, joined by blanks."""
    if runs:
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, [s + q for s, _, q in runs], 1)
        np.add.at(depth, [s + n for s, n, _ in runs], -1)
        words = [words[i] for i in np.nonzero(np.cumsum(depth[:-1]) == 0)[0].tolist()]
    return b" ".join(words)


def longest(runs: list[tuple[int, int, int]]) -> tuple[int | None, ...]:
    """Start, length, period and thousandths of the run with the greatest length / period."""
    best = None
    for s, n, q in runs:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    return (*best, 1000 * best[1] // best[2]) if best else (None,) * 4


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = 4, least: int = 6, columns: tuple[str, ...] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_runs, the greatest run, digests, and all runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                out: list[list] = [[] for _ in range(9)]
                texts = batch.column(1).slice(lo, hi - lo).cast(pa.binary()).to_pylist()
                for words, runs in find([t or b"" for t in texts], times, least):
                    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
                    digests = [hashlib.sha256(x).hexdigest() for x in (lines, collapse(words, runs))]
                    for c, v in zip(out, (len(words), len(runs), *longest(runs), *digests, [{"start": s, "length": n, "period": q} for s, n, q in runs]), strict=True):
                        c.append(v)
                kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *(pa.array(v, kind) for v, kind in zip(out, kinds, strict=True))], names=[x.split()[0] for x in RUNS.split(", ")])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, RUNS)
    return rows.select(*columns) if columns else rows


def repeat_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the tails of about a tenth of the texts made periodic, as the query's contract fixes.

    With h the crc32 of the id in decimal: where h % 10 is 0, words from number a = g % n on, g =
    h / 10, repeat the p = 1 + (n - a) / (3 + g % 8) words there (whole divisions). A null id changes nothing.
    """
    h = F.crc32(F.col(id_col).cast("long").cast("string"))
    cut = docs.withColumn("__w", F.when(h % 10 == 0, F.regexp_extract_all(F.col(text_col), F.lit(WORDS), 0))).withColumn("__g", F.floor(h / 10))
    n = F.size("__w")
    sized = cut.withColumn("__a", F.when(n > 0, F.col("__g") % n)).withColumn("__p", 1 + F.floor((n - F.col("__a")) / (3 + F.col("__g") % 8)))

    def word(x: Column, i: Column) -> Column:
        return F.when(i < F.col("__a"), x).otherwise(F.get("__w", (F.col("__a") + (i - F.col("__a")) % F.col("__p")).cast("int")))

    text = F.when(n > 0, F.array_join(F.transform("__w", word), " ")).otherwise(F.col(text_col))
    return sized.withColumn(text_col, text).select(docs.columns)
