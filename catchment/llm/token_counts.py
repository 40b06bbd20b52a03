"""Token counts with overlap resynchronisation for huge documents.

Ordinary texts go to the library as they are. A text of more than ``chunk`` characters is
encoded in chunks that overlap; both encodings of an overlap are compared, and the counts
are spliced at the first token boundary that both have and that is proven stable: no piece
of the vocabulary holds the two characters beside it next to each other, so no merge ever
crosses it, whatever stands around. If an overlap has no such boundary it is doubled, up to
the whole rest of the text. Memory is bounded by the chunk, or by
the longest run without a boundary if that is longer.

Nulls and ties: a null or empty text has no tokens and no bytes. A null id stays null.
Rows that repeat are counted each. Extra columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

COUNTED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


@lru_cache(maxsize=2)
def _model(path: str):
    """The library's processor, and the pairs of characters that stand together in some piece."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pairs: set[str] = set()
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)):
            p = sp.id_to_piece(i)
            pairs.update(p[k : k + 2] for k in range(len(p) - 1))
    return sp, pairs


def _starts(sp, text: str, at: int) -> list[int]:
    """Where each token of ``text`` starts, ``text`` itself standing at ``at``."""
    chars = np.cumsum(np.frombuffer(text.encode(), np.uint8) & 0xC0 != 0x80) + (at - 1)  # offsets come in bytes
    return chars[[p.begin for p in sp.encode(text, return_type="proto").pieces]].tolist()


def _splice(text: str, pairs: set[str], left: list[int], right: list[int], lo: int, hi: int) -> int | None:
    """The first boundary within lo..hi that both encodings have and that is proven stable."""
    for p in sorted({x for x in left if lo < x < hi} & {x for x in right if lo < x < hi}):
        if text[p - 1 : p + 1].replace(" ", "▁") not in pairs:
            return p
    return None


def count_long(text: str, path: str, chunk: int, overlap: int) -> int:
    """Tokens of ``text``, encoded chunk by chunk."""
    sp, pairs = _model(path)
    done, total, size = 0, 0, len(text)
    before = 0  # the stable boundary before ``done``
    held: list[int] = []
    end = min(size, chunk)
    held = _starts(sp, text[:end], 0)
    while end < size:
        wide = overlap
        while True:
            # The next chunk starts ``wide`` before the end of this one; its own first and
            # the other's last tokens are left out, since both are cut there.
            begin = max(done, end - wide)
            stop = min(size, max(end + chunk, begin + chunk))
            nxt = _starts(sp, text[begin:stop], begin)
            at = _splice(text, pairs, held, nxt, begin, end)
            if at is not None:
                break
            if begin == done:
                # No boundary at all since the last one: grow this chunk instead.
                end = min(size, end + chunk)
                # From the boundary before, as the model puts a blank before what it encodes.
                held = [x for x in _starts(sp, text[before:end], before) if x >= done]
                if end == size:
                    at = None
                    break
                wide = overlap
            else:
                wide *= 2
        if at is None:
            break
        total += sum(1 for x in held if x < at)
        before = done if at > done else before
        done, held, end = at, [x for x in nxt if x >= at], stop
    return total + len(held)


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text", chunk: int = 16_384, overlap: int = 512) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, _ = _model(model)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            n = [0] * len(texts)
            short = [i for i, t in enumerate(texts) if len(t) <= chunk]
            for lo in range(0, len(short), 64):
                some = short[lo : lo + 64]
                for i, ids in zip(some, sp.encode([texts[i] for i in some], num_threads=1), strict=True):
                    n[i] = len(ids)
            for i, t in enumerate(texts):
                if len(t) > chunk:
                    n[i] = count_long(t, model, chunk, overlap)
            yield pa.RecordBatch.from_pydict({"doc_id": keys, "n_bytes": [len(t.encode()) for t in texts], "n_tokens": n, "over_limit": [x > limit for x in n]}, schema=COUNTED)

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
