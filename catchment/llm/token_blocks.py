"""Token ids as a binary table of patched frame-of-reference blocks.

Documents are range-partitioned by id; each task tokenises its documents in order and packs
the ids into segments. Pieces of words are encoded once per worker where the tokenizer's
own description shows that it parts texts into them, whole texts otherwise. A segment holds whole documents (about ``segment_tokens`` ids), a
document table, an index of block starts, and blocks of ``BLOCK`` ids. In a block the
minimum is subtracted and the rest packed at the width that ``percentile`` of its values
need; the high bits of the others are stored in a list of exceptions.

Segments are rows of a Parquet table (shard, seq, payload), so Spark's commit protocol
covers lost executors, on any file system that Spark can write. ``read_blocks`` decodes
them again without the text.

Segment layout, little-endian: ``PFR1``, u32 documents, u64 ids, u32 blocks; i64 document
ids; u8 null flags; u64 id counts; u32 block starts (from the first block); the blocks. A
block: u32 minimum, u8 width, u16 exceptions, packed bits, u16 positions, u32 high bits.

Nulls and ties: a null text is empty; a null id sorts first; rows with equal ids keep the
order of a hash of their text. Extra columns are ignored. An empty table writes no segment.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catchment.llm.shared import Table, gather, slices, strings

BLOCK = 1024
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def pack_blocks(ids: np.ndarray, percentile: float = 0.98) -> tuple[bytes, np.ndarray]:
    """The blocks of ``ids`` (unsigned 32-bit) and the byte at which each starts."""
    n = len(ids)
    if not n:
        return b"", np.zeros(0, "<u4")
    k = -(-n // BLOCK)
    full = np.concatenate([ids, np.full(k * BLOCK - n, ids[-1], ids.dtype)]).astype(np.uint32).reshape(k, BLOCK)
    low = full.min(axis=1)
    rest = full - low[:, None]
    at = min(BLOCK - 1, int(percentile * BLOCK))
    width = np.ceil(np.log2(np.partition(rest, at, axis=1)[:, at].astype(np.float64) + 1)).astype(np.int64)
    out: list[bytes] = [b""] * k
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        some = rest[rows]
        wide = some.astype("<u2" if w <= 16 else "<u4").view(np.uint8).reshape(len(rows), BLOCK, -1)
        bits = np.unpackbits(wide, axis=2, bitorder="little")[:, :, :w].reshape(len(rows), -1)
        packed = np.packbits(bits, axis=1, bitorder="little")
        high = some >> np.uint32(w) if w < 32 else np.zeros_like(some)
        count = (high > 0).sum(axis=1)
        for i, r in enumerate(rows):
            head = struct.pack("<IBH", low[r], w, count[i]) + packed[i].tobytes()
            if count[i]:
                where = np.flatnonzero(high[i])
                head += where.astype("<u2").tobytes() + high[i][where].astype("<u4").tobytes()
            out[r] = head
    size = np.array([len(x) for x in out], np.int64)
    return b"".join(out), (np.cumsum(size) - size).astype("<u4")


def unpack_blocks(data: bytes, starts: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` ids of the blocks in ``data``."""
    out = np.zeros((len(starts), BLOCK), np.uint32)
    buf = np.frombuffer(data, np.uint8)
    heads = buf[starts.astype(np.int64)[:, None] + np.arange(7)] if len(starts) else np.zeros((0, 7), np.uint8)
    low, width, count = heads[:, :4].copy().view("<u4")[:, 0], heads[:, 4].astype(np.int64), heads[:, 5:7].copy().view("<u2")[:, 0].astype(np.int64)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w:
            nbytes = BLOCK * int(w) // 8
            bits = np.unpackbits(buf[starts[rows].astype(np.int64)[:, None] + 7 + np.arange(nbytes)], axis=1, bitorder="little").reshape(len(rows), BLOCK, int(w))
            padded = np.zeros((len(rows), BLOCK, 16 if w <= 16 else 32), np.uint8)
            padded[:, :, : int(w)] = bits
            out[rows] = np.packbits(padded, axis=2, bitorder="little").view("<u2" if w <= 16 else "<u4")[:, :, 0]
        for r in rows[count[rows] > 0]:
            at, c = int(starts[r]) + 7 + BLOCK * int(w) // 8, int(count[r])
            where = np.frombuffer(data, "<u2", c, at)
            out[r, where] |= np.frombuffer(data, "<u4", c, at + 2 * c) << np.uint32(w)
    return (out + low[:, None]).reshape(-1)[:n]


def pack_segment(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, percentile: float = 0.98) -> bytes:
    blocks, starts = pack_blocks(ids, percentile)
    return b"".join([
        b"PFR1", struct.pack("<IQI", len(doc_ids), len(ids), len(starts)),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array([x is None for x in doc_ids], "u1").tobytes(), np.array(counts, "<u8").tobytes(),
        starts.tobytes(), blocks,
    ])


def unpack_segment(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, id counts, and all ids of a segment."""
    if payload[:4] != b"PFR1":
        raise ValueError("not a token segment")
    docs, n, k = struct.unpack_from("<IQI", payload, 4)
    at = 20
    doc_ids = np.frombuffer(payload, "<i8", docs, at)
    null = np.frombuffer(payload, "u1", docs, at + 8 * docs)
    counts = np.frombuffer(payload, "<u8", docs, at + 9 * docs).astype(np.int64)
    starts = np.frombuffer(payload, "<u4", k, at + 17 * docs)
    return [None if z else int(x) for x, z in zip(doc_ids, null, strict=True)], counts, unpack_blocks(payload[at + 17 * docs + 4 * k :], starts, n)


# The splitting rules that may be applied word by word. Nothing that they match holds or looks at white space.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTERS = [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: Visible Latin-1: no combining marks, and letter cases that every Unicode version has.
PLAIN = "^[!-~\u00a1-\u00ac\u00ae-\u00ff]*$"
#: Longer pieces are not kept.
LONGEST = 64


def _byte_letters() -> dict[int, str]:
    """The letter by which the library's byte level writes each byte that UTF-8 uses."""
    from tokenizers.pre_tokenizers import ByteLevel

    level = ByteLevel(add_prefix_space=False, use_regex=False)
    some = [*range(0x800), *range(0x800, 0xD800, 0x800), 0xE000, 0xF000, *range(0x10000, 0x110000, 0x10000)]
    return {b: x for c in map(chr, some) for b, x in zip(c.encode(), level.pre_tokenize_str(c)[0][0], strict=True)}


class Encoder:
    """A tokenizer of the library, and what it has made of words and their pieces so far.

    The tokenizer's own description decides: where it normalises and splits by the rules
    above and leaves no room for chance, pieces of words are encoded by themselves; with any
    other tokenizer whole texts are.
    """

    def __init__(self, path: str, keep: int = 400_000):
        from tokenizers import Tokenizer

        self.tok = tok = Tokenizer.from_file(path)
        told = json.loads(tok.to_str())
        model, added = told["model"], [x["content"] for x in told["added_tokens"]]
        self.by_word = (
            told["normalizer"] == NORMALIZER and told["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": SPLITTERS}
            and not told["truncation"] and not told["padding"] and model["type"] == "BPE" and not model["dropout"]
            and not any(x["lstrip"] or x["rstrip"] or WORD.sub("", x["content"]) for x in told["added_tokens"])
        )
        self.added = "|".join(map(re.escape, added)) or "^$"
        self.letters = _byte_letters()
        self.pieces = Table(keep)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` (strings without nulls), one text after another, and the number of each text's.

        Arrow splits texts into words and the distinct words into pieces; only distinct
        pieces become Python strings. Words with special tokens or characters that are not
        plain go to the library as they are.
        """
        if not self.by_word:
            return self.join(*self.library(texts))
        words, word_ends = _distinct(texts)
        plain = pc.and_not(pc.match_substring_regex(words.dictionary, PLAIN), pc.match_substring_regex(words.dictionary, self.added, ignore_case=True))
        spaced = pc.replace_substring_regex(pc.utf8_lower(words.dictionary.filter(plain)), f"({SPLITTERS[0]['pattern']['Regex']})", r"\1 ")
        pieces, piece_ends = _distinct(spaced)
        ids, n = self.join(self.spell(strings(pieces.dictionary)), pieces.indices.to_numpy(), piece_ends)
        if not (mask := plain.to_numpy(zero_copy_only=False)).all():
            other, m = self.join(*self.library(words.dictionary.filter(pc.invert(plain))))
            ids, size = np.concatenate([ids, other]), np.zeros(len(mask), np.int64)
            size[mask], size[~mask] = n, m
            start = np.zeros(len(mask), np.int64)
            start[mask], start[~mask] = np.cumsum(n) - n, np.cumsum(m) - m + n.sum()
        else:
            size, start = n, np.cumsum(n) - n
        return gather(ids, start, size, words.indices.to_numpy(), word_ends)

    def join(self, known: list[bytes], at: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        return gather(np.frombuffer(b"".join(known), "<u4"), np.cumsum(size) - size, size, at, edges)

    def spell(self, distinct: list[str]) -> list[bytes]:
        """The ids of each piece as little-endian unsigned 32-bit integers."""
        new = self.pieces.missing(set(distinct))
        known, one, letters = self.pieces.young, self.tok.model.tokenize, self.letters
        for p in new:
            spelt = p if p.isascii() else p.encode().decode("latin-1").translate(letters)
            known[p] = array("I", [t.id for t in one(spelt)]).tobytes()
        out = list(map(known.__getitem__, distinct))
        for p in new:
            if len(p) > LONGEST:
                del known[p]
        return out

    def library(self, texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        found = self.tok.encode_batch_fast(strings(texts), add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found], np.arange(len(texts)), np.arange(len(texts) + 1)


def _distinct(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words between ASCII white space of all ``texts``, and at which of them each text ends, after a 0."""
    split = pc.ascii_split_whitespace(texts)
    return split.flatten().dictionary_encode(), split.offsets.to_numpy() - split.offsets[0].as_py()


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def write_blocks(docs: DataFrame, out: str, tokenizer: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text", segment_tokens: int = 1 << 19, percentile: float = 0.98) -> None:
    """Encode ``docs`` in ascending id order and write segments below ``out``."""
    end = np.zeros(0, "<u4") if end_id is None else np.array([end_id], "<u4")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, seq = TaskContext.get().partitionId(), 0
        encoder = _encoder(tokenizer)
        held: list[tuple[int | None, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate([x for _, some in held for x in (some, end)])
            payload = pack_segment([i for i, _ in held], [len(x) + len(end) for _, x in held], ids, percentile)
            return pa.RecordBatch.from_pydict({"shard": [shard], "seq": [seq], "n_docs": [len(held)], "n_tokens": [len(ids)], "payload": [payload]}, schema=SEGMENT)

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).fill_null("")
            for lo, hi in slices(texts):
                ids, counts = encoder.encode(texts[lo:hi])
                for key, some in zip(keys[lo:hi], np.split(ids, np.cumsum(counts)[:-1]), strict=True):
                    held.append((key, some))
                    size += len(some) + len(end)
                    if size >= segment_tokens:
                        yield flush()
                        held, size, seq = [], 0, seq + 1
        if held:
            yield flush()

    tie = F.xxhash64(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), tie.alias("tie"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    rows.mapInArrow(encode, "shard int, seq int, n_docs long, n_tokens long, payload binary").write.mode("overwrite").parquet(out)


SEGMENT = pa.schema([("shard", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("payload", pa.binary())])
DIGEST = pa.schema([("shard", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("local", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_segments(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema("shard int, seq int, n_docs long, n_tokens long, payload binary").parquet(out)


def read_digests(spark: SparkSession, out: str) -> DataFrame:
    """Per document of the segments at ``out``: doc_id, start, n_tokens, ids_crc32.

    A segment's start comes from running sums over shards and, within a shard, over its
    segments; no window spans all segments.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, seq, payload in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                doc_ids, counts, ids = unpack_segment(payload)
                ends = np.cumsum(counts)
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * (e - c) : 4 * e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                k = len(doc_ids)
                yield pa.RecordBatch.from_pydict({"shard": [shard] * k, "seq": [seq] * k, "doc_id": doc_ids, "local": ends - counts, "n_tokens": counts, "ids_crc32": crc}, schema=DIGEST)

    segments = read_segments(spark, out)
    heads = segments.select("shard", "seq", "n_tokens")
    shards = heads.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    shards = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("seq")
    base = heads.join(shards, "shard").select("shard", "seq", (F.col("shard_start") + F.sum("n_tokens").over(inside) - F.col("n_tokens")).alias("base"))
    rows = segments.select("shard", "seq", "payload").mapInArrow(decode, "shard int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return rows.join(base, ["shard", "seq"]).select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
