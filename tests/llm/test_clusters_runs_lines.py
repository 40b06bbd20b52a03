"""Clusters, periodic runs and line dedup: kernels and jobs against brute force, and awkward tables."""

import hashlib
import html
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from catchment.llm import html_text, line_dedup, periodic_runs, queries, shallot
from tests.llm.test_jobs import awkward

BLANKS = " \t\n\x0b\x0c\r"


# Clusters


def lloyd(x, first, rounds):
    c = [tuple(v) for v in first]
    for r in range(rounds + 1):
        d = ((x[:, None, :] - np.array(c, np.int64)[None]) ** 2).sum(axis=2)
        near = d.argmin(axis=1)  # the first of equal ones
        if r == rounds:
            return near, d[np.arange(len(x)), near], c
        c = [tuple(int(s) // int((near == j).sum()) for s in x[near == j].sum(axis=0)) if (near == j).any() else c[j] for j in range(len(c))]


@pytest.mark.parametrize(("k", "spread"), [(1, 5), (2, 1), (8, 3), (30, 40)])
def test_search_is_exact(k, spread):
    """Small integers give many ties; bounds are carried over rounds as in the job."""
    rng = np.random.default_rng(k)
    x = (rng.integers(-3, 4, (60, 5))[rng.integers(0, 60, 900)] + rng.integers(-spread, spread + 1, (900, 5))).astype(np.int32)
    now, before = x[rng.permutation(900)[:k]].astype(np.int64), None
    state = [np.zeros(900, np.int32), np.ones(900, np.int32), np.full(900, np.inf), np.full(900, -np.inf)]
    work = 0
    for _ in range(12):
        *state, n = shallot.search(x, *state, shallot.Centroids(now, before))
        work += n
        d = ((x[:, None, :].astype(np.int64) - now[None]) ** 2).sum(axis=2)
        assert (state[0] == d.argmin(axis=1)).all()
        true = np.sqrt(d[np.arange(900), state[0]])
        rest = d.copy()
        rest[np.arange(900), state[0]] = 1 << 40
        assert (true <= state[2]).all() and (k == 1 or (np.sqrt(rest.min(axis=1)) >= state[3]).all())
        s = shallot.sums_of(x, state[0], k)
        before, now = now, np.where(s[:, :1] > 0, s[:, 1:] // np.maximum(s[:, :1], 1), now)
    assert k < 8 or work < 0.6 * 12 * 900 * k


def test_search_with_equal_centroids():
    x = np.array([[0, 0], [3, 0], [1, 0]], np.int32)
    c = shallot.Centroids(np.array([[2, 0], [2, 0], [0, 0]], np.int64))
    near, second, *_ = shallot.search(x, np.zeros(3, np.int32), np.ones(3, np.int32), np.full(3, np.inf), np.full(3, -np.inf), c)
    assert near.tolist() == [2, 0, 0]


def test_clusters_of_a_table(spark):
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(12, 64))[rng.integers(0, 12, 400)] + rng.normal(size=(400, 64)) * 0.3).astype(np.float32)
    d = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(x)], "vec_id long, embedding array<float>, cluster string").repartition(5)
    ints = np.floor(1024 * x.astype(float)).astype(np.int64)
    order = sorted(range(400), key=lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest())[:8]
    near, dist, c = lloyd(ints, ints[order], 10)
    rows = shallot.cluster(d, block=37).collect()
    assert {r["vec_id"]: (r["cluster"], r["distance"]) for r in rows} == {i: (int(near[i]), int(dist[i])) for i in range(400)}
    for r in rows:
        assert r["inertia"] == dist.sum() and r["cluster_inertia"] == dist[near == r["cluster"]].sum()
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, c[r["cluster"]])).encode()).hexdigest()


def test_awkward_vectors(spark):
    v = [0.5] * 64
    rows = [(1, v), (1, v), (None, v), (2, None), (3, []), (4, [1.0] * 63), (5, [None] + v[1:]), (6, [float("nan")] + v[1:]), (7, [float("inf")] + v[1:]), (8, [-2.0] * 64), (9, [1e30] + v[1:])]
    d = spark.createDataFrame([(i, e, 5, "c") for i, e in rows], "vec_id long, embedding array<float>, distance int, inertia string")
    got = shallot.cluster(d).collect()
    # Three usable ids give three first centroids, two of them equal: the smaller number takes all.
    assert sorted((r["vec_id"] or 0, r["distance"]) for r in got) == [(0, 0), (1, 0), (1, 0), (8, 0)] and len({r["cluster"] for r in got}) == 2
    empty = shallot.cluster(d.limit(0))
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert shallot.cluster(d.where("vec_id is null")).count() == 0


# Periodic runs


def brute_runs(w, times=4, least=6):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def random_text(rng):
    kind, out = rng.random(), []
    vocabulary = [f"w{i}" for i in range(rng.choice([1, 2, 3, 5, 40]))]
    while len(out) < rng.choice([0, 7, 30, 150, 400]):
        if rng.random() < 0.5:
            period = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 12))]
            out += (period * 12)[: rng.randrange(1, 10 * len(period) + 1)]
        elif kind < 0.3:
            out += [rng.choice(["a", vocabulary[0]])] * rng.randrange(1, 30)
        else:
            out += [rng.choice([*vocabulary, f"r{rng.random()}"]) for _ in range(rng.randrange(1, 12))]
    return out


def test_runs_against_brute_force():
    rng, some = random.Random(5), 0
    texts = [random_text(rng) for _ in range(400)]
    found = list(periodic_runs.find([" ".join(t).encode() for t in texts], 4, 6))
    for t, (words, runs) in zip(texts, found, strict=True):
        assert [x.decode() for x in words] == t
        assert sorted(runs, key=lambda r: (r[0], r[1])) == brute_runs(t)
        assert runs == sorted(runs, key=lambda r: (r[0], r[2]))
        some += len(runs)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert periodic_runs.collapse(words, runs).decode() == " ".join(x for i, x in enumerate(t) if i not in gone)
    assert some > 300


def test_split_goes_on_until_stable():
    """Taking out the rare word leaves pieces in which others are rare."""
    ids = np.array([0, 1, 0, 1, 9, 0, 1, 2, 2, 2, 2, 2, 2, 2, 8, 0, 1, 0])
    assert periodic_runs.split(ids, np.array([0]), np.array([len(ids)]), 4, 6) == [(7, 14)]
    lone = np.arange(50)
    assert periodic_runs.split(lone, np.array([0, 20]), np.array([20, 50]), 4, 6) == []


def test_scan_of_long_segments():
    """One word, and a word at every second place, stay far from quadratic."""
    began = time.perf_counter()
    assert periodic_runs.scan(np.zeros(100_000, np.int64), 4, 6) == [(0, 100_000, 1)]
    rng = np.random.default_rng(2)
    w = np.zeros(40_000, np.int64)
    w[::2] = rng.integers(1, 90, 20_000)
    assert all(n >= max(6, 4 * q) for _, n, q in periodic_runs.scan(w, 4, 6))
    period = rng.integers(0, 30, 9000)
    assert (5, 45_000 - 10, 9000) in periodic_runs.scan(np.concatenate([[99] * 5, np.tile(period, 5)[: 45_000 - 10], [98] * 3]), 4, 6)
    assert time.perf_counter() - began < 30


def altered(i, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if i is None:
        return w
    h, n = zlib.crc32(str(i).encode()), len(w)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    return w


def expected(i, text):
    w = altered(i, text)
    runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *four, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def test_runs_of_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op12_periodic_runs(spark, sf).collect()}
    assert got == {i: expected(i, t) for i, t in texts.items()} and sum(v[0] > 0 for v in got.values()) > 10


def test_awkward_runs(spark):
    d = awkward(spark).withColumn("n_runs", F.lit("x"))
    got = periodic_runs.find_runs(d)
    rows = got.collect()
    assert len(rows) == d.count() and periodic_runs.find_runs(d.limit(0)).count() == 0
    by = {r["doc_id"]: r for r in rows}
    assert by[0]["n_words"] == 0 and by[0]["n_runs"] == 0 and by[0]["start"] is None and by[0]["runs"] == []
    assert by[8]["n_runs"] == 1 and (by[8]["length"], by[8]["period"], by[8]["exponent_milli"]) == (40_000, 977, 40_941)
    assert periodic_runs.repeat_tails(d).columns == d.columns
    same = {r["doc_id"]: r["text"] for r in periodic_runs.repeat_tails(d).where("doc_id is not null").collect()}
    assert all(same[i] == r["text"] or same[i] == " ".join(altered(i, r["text"])) for i, r in ((r["doc_id"], r) for r in d.where("doc_id is not null").collect()))


# Line dedup


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute_lines(rows, least, copies):
    """(kept text, n_lines, n_dropped) by position; ids and texts may repeat."""
    holders = {}
    key = lambda x: lower(x.strip(BLANKS))
    rank = lambda i: float("-inf") if i is None else i
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= least:
                holders.setdefault(key(x), set()).add(rank(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if not (len(h := holders.get(key(x), ())) >= copies and rank(i) != max(h))]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return out


@pytest.mark.parametrize(("tasks", "copies"), [(1, 3), (4, 3), (23, 3), (23, 2), (23, 5)])
def test_lines_against_brute_force(spark, tasks, copies):
    rng = random.Random(tasks + copies)
    pool = [f"Line {i} öäü" for i in range(12)] + ["short", "", " \t"]
    rows = []
    for i in range(120):
        lines = [rng.choice(["", " ", "\t"]) + (x.upper().replace("Ö", "ö").replace("Ä", "ä").replace("Ü", "ü") if rng.random() < 0.3 else x) + rng.choice(["", " \r"]) for x in rng.choices(pool, k=rng.randrange(0, 9))]
        if rng.random() < 0.7:
            lines += ["one line that nearly all hold"] * rng.randrange(1, 4)
        rows.append((rng.choice([None, 5, i, i, i, i]), "\n".join(lines) if lines else rng.choice([None, ""])))
    rows += rows[:9]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = line_dedup.drop_lines(d, least=10, copies=copies, counts=True, tasks=tasks, broadcast_rows=tasks - 4).collect()
    order = lambda x: str(tuple(x))
    assert sorted(((r["doc_id"], r["text"] or "", r["n_lines"], r["n_dropped"]) for r in got), key=order) == sorted(brute_lines(rows, 10, copies), key=order)


def test_stream_in_pieces():
    """However sorted rows are cut into tasks and batches, the same lines go."""
    rng = random.Random(8)
    rows = sorted({(rng.randrange(6), 0, rng.randrange(9), 1, rng.randrange(3)) for _ in range(110)}, key=lambda r: (r[0], -r[2], r[4]))
    holders = {}
    for h, _, doc, *_ in rows:
        holders.setdefault(h, set()).add(doc)
    want = {(h, doc, pos) for h, _, doc, _, pos in rows if len(holders[h]) >= 3 and doc != max(holders[h])}
    for _ in range(200):
        # A task ends between documents of a hash, as ranges are cut by hash and document; batches end anywhere.
        ends = sorted({0, len(rows), *(e for e in rng.sample(range(len(rows)), rng.randrange(0, 12)) if e and rows[e][:3] != rows[e - 1][:3])})
        gone, open_, held = set(), [], {}
        for lo, hi in zip(ends, ends[1:], strict=False):
            s, at, told = line_dedup.Stream(3), lo, []
            while at < hi:
                to = min(hi, at + rng.randrange(1, 9))
                part = np.array(rows[at:to], np.int64)
                told += list(s.feed(part[:, :2], part[:, 2:]))
                at = to
            for h, r, what in [*told, *s.close()]:
                for a, b in zip(h.tolist(), r.tolist(), strict=True):
                    if what == line_dedup.GOES:
                        gone.add((a[0], b[0], b[2]))
                    else:
                        held.setdefault(a[0], set()).add(b[0])
                        open_ += [(a[0], b[0], b[2])] if what == line_dedup.OPEN else []
        assert gone | {x for x in open_ if len(held[x[0]]) >= 3 and x[1] != max(held[x[0]])} == want


@pytest.mark.parametrize("batch", [1, 3, 10])
def test_lines_of_two_documents_behind_frequent_ones(spark, batch):
    """What one hash counted up to does not count for the hashes of later batches."""
    rows = [(i, f"this line stands in all of them\nthis line stands in {i // 2} and its pair\nthis line stands in {i % 3} and every third") for i in range(24)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = line_dedup.drop_lines(spark.createDataFrame(rows, "doc_id long, text string"), counts=True, tasks=1).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(tuple(r) for r in got) == brute_lines(rows, 20, 3)


def test_bitmaps(spark):
    same = "this line stands in all of them"
    d = spark.createDataFrame([(i, f"{same}\nown line number {i} of its document\n{same} ") for i in range(5)], "doc_id long, text string")
    maps = {r["doc"]: r for r in line_dedup.keep_bitmaps(d).collect()}
    assert sorted(maps) == [0, 1, 2, 3] and all(r["n_dropped"] == 2 for r in maps.values())
    assert line_dedup.kept_lines("a\nb\nc\nd", maps[0]["keep"]) == "b\nd" and line_dedup.kept_lines("a\nb", None) == "a\nb"
    assert {r["text"].count("\n") for r in line_dedup.drop_lines(d).collect()} == {0, 2}


def test_awkward_lines(spark):
    d = awkward(spark).withColumn("pos", F.lit("x")).withColumn("keep", F.lit(None).cast("string"))
    out = line_dedup.drop_lines(d)
    assert out.columns == d.columns and out.count() == d.count()
    assert line_dedup.drop_lines(d.limit(0)).count() == 0 and line_dedup.keep_bitmaps(d.limit(0)).count() == 0


# Page text


LONG = "A sentence, with points; and more of them. " * 4
RECIPE = f"""<html><body><nav><a href=1>Home</a></nav><article><h1>Recipe</h1><p>{LONG}</p><p>{LONG}</p><h2>Needs</h2>
<table><tr><td>Flour</td><td>200 g</td></tr></table><dl><dt>Time</dt><dd>20 min</dd></dl><p>{LONG}</p><ul><li>one</li><li>two, <a href=2>three</a></li></ul>
<blockquote><p>Best bread ever, she said.</p></blockquote><figure><figcaption>A loaf</figcaption></figure><pre>a  b</pre><p>Set the <label>timer</label> now.</p>
<div class=share>Share this, please.</div><div><a href=3>One more</a> <a href=4>Another</a></div></article><div>Elsewhere</div><footer>Imprint, 1.</footer></body></html>"""


def test_article_keeps_what_it_holds():
    want = ["Recipe", LONG.strip(), LONG.strip(), "Needs", "Flour", "200 g", "Time", "20 min", LONG.strip(), "one", "two, three", "Best bread ever, she said.", "A loaf", "a b", "Set the timer now."]
    for name in ("article", "div", "section"):
        assert html_text.main_text(RECIPE.replace("article", name)).split("\n\n") == want
    assert "timer" not in html_text.main_text(RECIPE.replace("<p>Set the", "<form><p>Set the").replace("now.</p>", "now.</p></form>"))


@pytest.mark.parametrize("page", ["<b>" * 100_000 + "text, here.", "<div>" * 100_000 + "text, here." + "</i>" * 100_000, "<p>a < b, " * 50_000, "<ul><li>" * 50_000 + "text, here.", "<a href='" * 50_000])
def test_deep_and_unclosed_markup(page):
    began = time.perf_counter()
    html_text.main_text(page)
    assert time.perf_counter() - began < 10


def test_pages_of_whole_tables(spark):
    """All given pages have an article of headings, paragraphs and line breaks; a plain reading of that element says the same."""
    sf = "/root/testdata/sf0.01"
    got = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in queries.op9_html_text(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    for r in rows:
        inner = re.search(r"<article[^>]*>(.*?)</article>", r["html"], re.S)[1]
        inner = re.sub(r"<(script|style)\b.*?</\1>|<!--.*?-->", "", inner, flags=re.S)
        blocks = re.split(r"</?(?:h1|p)\b[^>]*>", inner)
        blocks = [" ".join(re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br[^>]*>", " ", b)))).strip().split(" ")) for b in blocks]
        want = "\n\n".join(b for b in blocks if b)
        assert got[r["page_id"], r["url"]] == (want, len(want))
    assert len(got) == len(rows) == 250
