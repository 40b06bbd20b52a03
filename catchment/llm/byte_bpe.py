"""Byte-level BPE encoding and decoding by merge replay over a corpus of words.

Texts are split by the pattern into words. A task's texts, up to ``corpus`` bytes at a time,
give the distinct words that are not yet known, and these are the corpus of one replay: an
inverted index maps each mergeable token pair, under the rank of its
merge, to the positions where it stands. Merges are applied in rank order, lowest first; a
merge visits only the indexed positions and re-indexes only the two neighbours it touched.
If a merge creates a pair of a lower rank than its own, that rank goes first. Encoded words
are kept in a table of bounded size, so a frequent word is replayed once per worker.

Words of up to ``SHORT`` bytes are replayed together, by spans of ranks: of a span's positions,
the lowest rank of each word merges, in all words at once, until the span is empty. Words do
not touch each other, so each word sees its own merges in rank order. Longer words, where one
merge a step would be too slow, go rank by rank with all of a rank's positions.

The pattern never matches across the start of a run of white space, so texts are cut there
by Arrow and only distinct pieces go through the pattern; texts with white space other than
blanks, tabs and line ends go through it whole.

Nothing is shuffled: the words of a task are its corpus, and a task's work follows its
input.

Nulls and ties: a null text is empty: no ids, and the digest of no bytes. A null id stays
null. Rows that repeat are encoded each. Extra columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from catchment.llm.shared import Table, gather, slices, strings

CODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("ids", pa.binary()), ("decoded", pa.binary())])
#: White space other than blanks, tabs and line ends, and what stands for cuts.
ODD = "[\\x01\\x0b\\x0c\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
#: Longer words and pieces are not kept.
LONGEST = 64
#: Longer words are replayed rank by rank; shorter ones by so many spans of ranks.
SHORT, SPANS = 32, 64
#: The rank of a pair that does not merge.
NONE = 1 << 31


class Ranks:
    """A rank file: the tokens' bytes by id, and the rank of every pair that merges."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        self.bytes = {v: k for k, v in self.rank.items()}
        self.single = [self.rank[bytes([b])] for b in range(256)]
        self.pair: dict[int, int] = {}
        for token, r in self.rank.items():
            for k in range(1, len(token)):
                a, b = self.rank.get(token[:k]), self.rank.get(token[k:])
                if a is not None and b is not None:
                    self.pair[a << 32 | b] = r

        self.first = np.full((256, 256), -1, np.int32)
        for x, a in enumerate(self.single):
            for y, b in enumerate(self.single):
                self.first[x, y] = self.pair.get(a << 32 | b, -1)

        # The pairs as sorted arrays, with one behind the last; an id that no pair holds; where spans of ranks end.
        self.none = max(self.bytes) + 1
        self.keys = np.array([*sorted(self.pair), np.iinfo(np.int64).max])
        self.merged = np.array([*map(self.pair.get, self.keys[:-1].tolist()), NONE])
        self.spans = np.unique([*np.geomspace(256, self.none, SPANS).astype(np.int64)[:-1], self.none])

    def replay(self, words: list[bytes]) -> list[bytes]:
        """The ids of each of the distinct, not empty ``words``, as little-endian unsigned 32-bit integers."""
        whole = list(map(self.rank.get, words))
        rest = [w for w, r in zip(words, whole, strict=True) if r is None]
        short, long = [w for w in rest if len(w) <= SHORT], [w for w in rest if len(w) > SHORT]
        some, others = iter(self._merge_short(short) if short else ()), iter(self._merge(long) if long else ())
        return [r.to_bytes(4, "little") if r is not None else next(some if len(w) <= SHORT else others) for w, r in zip(words, whole, strict=True)]

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge."""
        key = a << 32 | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], NONE)

    def _merge_short(self, words: list[bytes]) -> list[bytes]:
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        edge, end = np.cumsum(size), len(raw)
        word = np.repeat(np.arange(len(words)), size)
        # Behind all positions, ``end`` stands for none; its token merges with nothing.
        token = np.append(np.array(self.single, np.int64)[raw], self.none)
        after, before = np.arange(1, end + 2), np.arange(-1, end)
        after[edge - 1] = before[edge - size] = after[end] = end
        now = np.full(end + 1, NONE)  # the rank of the pair that begins at a position
        now[: end - 1] = self.first[raw[:-1], raw[1:]]
        now[edge - 1] = NONE
        now[now < 0] = NONE
        lowest = np.full(len(words), np.iinfo(np.int64).max)
        # The inverted index: the positions of pairs that merge, under the span of their ranks.
        places: list[list[np.ndarray]] = [[] for _ in self.spans]

        def index(at: np.ndarray) -> None:
            at = at[now[at] < NONE]
            span = np.searchsorted(self.spans, now[at], "right")
            order = np.argsort(span, kind="stable")
            found, cuts = np.unique(span[order], return_index=True)
            for k, some in zip(found.tolist(), np.split(at[order], cuts[1:]), strict=False):
                places[k].append(some)

        index(np.arange(end))
        k = 0
        while k < len(places):
            if not places[k]:
                k += 1
                continue
            at, places[k] = np.concatenate(places[k]), []
            at = np.sort(at[np.searchsorted(self.spans, now[at], "right") == k])  # others have merged or changed since
            at = at[np.diff(at, prepend=-1) > 0]
            value, owner = now[at] * (end + 1) + at, word[at]
            np.minimum.at(lowest, owner, value)
            goes = lowest[owner] == value
            lowest[owner] = np.iinfo(np.int64).max
            if not goes.all():
                places[k].append(at[~goes])
            i = at[goes]
            r, j, p = now[i], after[i], before[i]
            n = after[j]
            token[i], token[j], now[j] = r, -1, NONE
            after[i], before[n] = n, i
            now[i], now[p] = self._rank(r, token[n]), self._rank(token[p], r)
            now[end] = NONE
            new = np.concatenate([i, p])
            index(new)
            lower = now[new]
            if len(lower) and (least := int(lower.min())) < NONE:
                k = min(k, int(np.searchsorted(self.spans, least, "right")))
        alive = token[:end] >= 0
        ends = (4 * np.cumsum(alive)[edge - 1]).tolist()
        flat = token[:end][alive].astype("<u4").tobytes()
        return [flat[x:y] for x, y in zip([0, *ends[:-1]], ends, strict=True)]

    def _merge(self, words: list[bytes]) -> list[bytes]:
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        edge = np.cumsum(size)
        token: list[int] = np.array(self.single, np.int64)[raw].tolist()
        after, before = np.arange(1, len(raw) + 1), np.arange(-1, len(raw) - 1)
        after[edge - 1] = before[edge - size] = -1
        # The inverted index: every position of a pair that merges, under the rank of its merge.
        rank = np.append(self.first[raw[:-1], raw[1:]], -1)
        rank[edge - 1] = -1
        order = np.argsort(rank, kind="stable")
        order = order[np.searchsorted(rank[order], 0) :]
        ranks, cuts = np.unique(rank[order], return_index=True)
        places: dict[int, list[int]] = {r: at.tolist() for r, at in zip(ranks.tolist(), np.split(order, cuts[1:]), strict=False)}
        after, before, pair = after.tolist(), before.tolist(), self.pair
        queue = list(places)
        heapq.heapify(queue)
        while queue:
            r = heapq.heappop(queue)
            todo = sorted(places.pop(r))
            for done, i in enumerate(todo):
                j = after[i]
                if token[i] < 0 or j < 0 or pair.get(token[i] << 32 | token[j]) != r:
                    continue
                token[i], token[j] = r, -1
                n = after[i] = after[j]
                lower = False
                if n >= 0:
                    before[n] = i
                    if (q := pair.get(r << 32 | token[n])) is not None:
                        if q not in places:
                            places[q] = []
                            heapq.heappush(queue, q)
                        places[q].append(i)
                        lower = q < r
                p = before[i]
                if p >= 0 and (q := pair.get(token[p] << 32 | r)) is not None:
                    if q not in places:
                        places[q] = []
                        heapq.heappush(queue, q)
                    places[q].append(p)
                    lower = lower or q < r
                if lower and done + 1 < len(todo):
                    if r in places:
                        places[r] += todo[done + 1 :]
                    else:
                        places[r] = todo[done + 1 :]
                        heapq.heappush(queue, r)
                    break
        left = np.array(token, np.int64)
        alive = left >= 0
        ends = (4 * np.cumsum(alive)[edge - 1]).tolist()
        flat = left[alive].astype("<u4").tobytes()
        return [flat[x:y] for x, y in zip([0, *ends[:-1]], ends, strict=True)]


class Coder:
    """Encodes and decodes texts; keeps the ids of words and of pieces between blanks."""

    def __init__(self, path: str, pattern: str, keep: int = 300_000):
        import regex

        self.ranks, self.split = Ranks(path), regex.compile(pattern).findall
        self.table = Table(keep)
        size = np.array([len(self.ranks.bytes.get(i, b"")) for i in range(max(self.ranks.bytes) + 1)])
        self.size, self.start = size, np.cumsum(size) - size
        self.flat = np.frombuffer(b"".join(self.ranks.bytes.get(i, b"") for i in range(len(size))), np.uint8)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` (strings without nulls), one text after another, and the number of each text's."""
        odd = pc.match_substring_regex(texts, ODD)
        cut = pc.if_else(odd, texts, pc.replace_substring_regex(texts, r"([ \t\n\r]+)", "\x01\\1"))
        # A text that is not cut keeps its separators: as one list of one piece.
        split = pc.split_pattern(pc.if_else(odd, "", cut), "\x01")
        pieces, edges = split.flatten().dictionary_encode(), split.offsets.to_numpy() - split.offsets[0].as_py()
        whole = strings(texts.filter(odd))
        distinct = strings(pieces.dictionary)
        known = self.spell(distinct + whole)
        at = pieces.indices.to_numpy().copy()
        at[edges[:-1][odd.to_numpy(zero_copy_only=False)]] = len(distinct) + np.arange(len(whole))
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        return gather(np.frombuffer(b"".join(known), "<u4"), np.cumsum(size) - size, size, at, edges)

    def spell(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece; all words that are new are the corpus of one replay.

        One table holds pieces and words, since a word by itself is a piece of one word.
        """
        new = self.table.missing(set(pieces))
        split = list(map(self.split, new))
        single = [p for p, ws in zip(new, split, strict=True) if len(ws) == 1]
        several = [(p, ws) for p, ws in zip(new, split, strict=True) if len(ws) != 1]
        inner = self.table.missing({w for _, ws in several for w in ws}.difference(single), turn=False)
        known, unknown = self.table.young, single + inner
        known.update(zip(unknown, self.ranks.replay([w.encode() for w in unknown]), strict=True))
        for p, ws in several:
            known[p] = b"".join([known[w] for w in ws])
        out = list(map(known.__getitem__, pieces))
        for k in {*new, *inner}:
            if len(k) > LONGEST:
                del known[k]
        return out

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, one text after another, and the number of each text's."""
        return gather(self.flat, self.start, self.size, ids, np.concatenate([[0], np.cumsum(counts)]))


@lru_cache(maxsize=2)
def _coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


def encode_bytes(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", columns: tuple[str, ...] = tuple(CODED.names), corpus: int = 4 << 20) -> DataFrame:
    """Per row the ``columns`` asked for: doc_id, n_tokens, ids_sha256, decoded_sha256, ids, decoded.

    ``corpus`` bytes of text at most, or one text, are replayed at once.
    """
    schema = pa.schema([CODED.field(n) for n in columns])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(ranks, pattern)
        for keys, texts in _corpora(batches, corpus):
            ids, counts = coder.encode(texts)
            cols = {"doc_id": keys, "n_tokens": counts}
            for name, digest, (flat, size) in (("ids", "ids_sha256", (ids, 4 * counts)), ("decoded", "decoded_sha256", coder.decode(ids, counts))):
                ends = np.cumsum(size).tolist()
                raw = memoryview(np.ascontiguousarray(flat)).cast("B")
                some = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                cols[digest] = [hashlib.sha256(x).hexdigest() for x in some]
                if name in columns:
                    cols[name] = [bytes(x) for x in some]
            yield pa.RecordBatch.from_pydict({n: cols[n] for n in columns}, schema=schema)
        pa.default_memory_pool().release_unused()  # the worker lives on

    kinds = {"doc_id": "long", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string", "ids": "binary", "decoded": "binary"}
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(code, ", ".join(f"{n} {kinds[n]}" for n in columns))


def _corpora(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts of a task, put together or cut to about ``size`` bytes."""
    held: list[tuple[pa.Array, pa.Array]] = []
    n = 0

    def put() -> tuple[pa.Array, pa.Array]:
        return tuple(pa.concat_arrays(x) for x in zip(*held, strict=True))

    for batch in batches:
        keys, texts = batch.column(0), batch.column(1).fill_null("")
        for lo, hi in slices(texts, size):
            more = int(pc.sum(pc.binary_length(texts[lo:hi])).as_py())
            if held and n + more > size:
                yield put()
                held, n = [], 0
            held.append((keys[lo:hi], texts[lo:hi]))
            n += more
    if held:
        yield put()
