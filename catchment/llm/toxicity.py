"""Toxicity scores by weak supervision.

Voters are lexicon words, word starts, phrases of two words, and shapes of the text
(shouting, exclamation marks), as the labelled rows single them out for or against the
toxic class; each fires on a document or abstains. A generative label model (two latent
classes, fitted by expectation maximisation on the votes alone) estimates how often each
voter fires in either class, and its correlations: every voter may depend on one other, its
parent in a spanning forest of the dependencies that the classes leave open, so a voter that
repeats another adds nothing. The posterior of the class is the label on which a linear
classifier is trained, on the voters for the toxic class alone: what speaks against never
makes up for an insult. Only its weights are used for scoring.

Labels are learned from rows whose crc32 of the id as text, modulo ``folds``, is not 0, and
from ``sample_rows`` of these at most, the first in hash order: that bound is what lets the
fit run on the driver, and the sample be broadcast. Word counts of the sample are reduced
per task before the shuffle. Scores read the whole text of every document, in one pass
without a shuffle.

Nulls and ties: a null or empty text scores what the classifier says without any word. A
null id counts as empty text for the fold, so it is held out. Labels other than 0 and 1, and
labels without a document, teach nothing; with no usable label of either class every score
is 0. Rows that repeat are scored each. Extra columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.llm.shared import cut, shared_dir

WORD = re.compile(r"\w+")
STARTS = (4, 5, 6)
SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def shapes(text: str) -> set[str]:
    """Patterns of the text as a whole, as "#name"."""
    found = {"#exclaims"} if "!!" in text else set()
    upper = sum(map(text.count, "ETAOINSR"))
    return found | {"#shouts"} if upper >= 8 and upper > sum(map(text.count, "etaoinsr")) else found


def evidence(text: str | None) -> set[str]:
    """Lower-case words and pairs of words of the text, as "start-" the starts of its longer words, and its shapes."""
    order = WORD.findall((text or "").lower())
    words = set(order)
    found = words | {f"{a} {b}" for a, b in zip(order, order[1:])} | shapes(text or "")
    for n in STARTS:
        found.update([w[:n] + "-" for w in words if len(w) > n])
    return found


def held_out(id_col, folds: int = 5):
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))), F.lit(folds)) == 0


def _parents(both: list[np.ndarray], fired: list[np.ndarray], size: list[float], against: np.ndarray, least: float) -> np.ndarray:
    """For each voter the one it depends on, or -1: a spanning forest of the largest mutual information within the classes.

    ``both`` counts common firings in each class, ``fired`` single ones, ``size`` rows. That
    voters for different classes avoid each other is what the classes say, so they do not depend on one another.
    """
    m = len(fired[0])
    info = np.zeros((m, m))
    for t, f, n in zip(both, fired, size, strict=True):
        for joint, one, two in ((t, f[:, None], f[None, :]), (f[:, None] - t, f[:, None], n - f[None, :]), (f[None, :] - t, n - f[:, None], f[None, :]), (n - f[:, None] - f[None, :] + t, n - f[:, None], n - f[None, :])):
            joint = np.maximum(joint, 1e-9)
            info += joint * np.log(joint * n / np.maximum(one * two, 1e-9))
    info[against[:, None] != against[None, :]] = 0
    np.fill_diagonal(info, 0)
    parent, best, source = np.full(m, -1), np.full(m, -1.0), np.full(m, -1)
    left = np.ones(m, bool)
    for _ in range(m):
        j = int(np.argmax(np.where(left, best, -np.inf)))
        left[j] = False
        if best[j] > least:
            parent[j] = source[j]
        more = left & (info[j] > best)
        best[more], source[more] = info[j][more], j
    return parent


def label_model(votes: np.ndarray, times: np.ndarray | None = None, against: np.ndarray | None = None, share: float | None = None, rounds: int = 40) -> np.ndarray:
    """Posterior probability of the toxic class for each row of 0/1 ``votes``, which stands for ``times`` documents.

    ``against`` marks voters for the other class; it only starts the estimate. A voter that
    abstains says nothing by itself; that all abstain is one observation. The ``share`` of the
    class is given, or that of rows with voters for it.
    """
    times = np.ones(len(votes)) if times is None else times
    against = np.zeros(votes.shape[1], bool) if against is None else against
    silent = ~votes.any(axis=1)
    post = np.where(votes[:, ~against].any(axis=1), np.where(votes[:, against].any(axis=1), 0.5, 0.9), 0.02)
    prior = times @ post / times.sum() if share is None else share
    prior_odds = np.log((prior + 1e-9) / (1 - prior + 1e-9))
    for _ in range(rounds):
        mass = [times * (1 - post), times * post]
        size = [s.sum() for s in mass]
        fired = [s @ votes for s in mass]
        both = [(votes * s[:, None]).T @ votes for s in mass]
        parent = _parents(both, fired, size, against, least=8.0)
        alone, at = parent < 0, np.maximum(parent, 0)
        # Rates of firing: given that the parent fires, and given that it does not (or that there is none).
        rate = []
        for t, f, n in zip(both, fired, size, strict=True):
            with_, given = t[np.arange(len(at)), at], f[at]
            usual = (f + 0.1) / (n + 1.0)
            rate.append((np.where(alone, usual, (with_ + usual) / (given + 1.0)), np.where(alone, usual, (f - with_ + usual) / (n - given + 1.0))))
        on, off = (np.log(rate[1][k] / rate[0][k]) for k in (0, 1))
        up = votes[:, at] * ~alone
        quiet = np.log((mass[1] @ silent + 0.1) / (size[1] + 1.0)) - np.log((mass[0] @ silent + 0.1) / (size[0] + 1.0))
        odds = prior_odds + (votes * (up * on + (1 - up) * off)).sum(axis=1) + silent * quiet
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        moved, post = np.abs(new - post).max(), new
        if moved < 1e-4:
            break
    return post


def linear_model(x: np.ndarray, y: np.ndarray, times: np.ndarray | None = None, ridge: float = 0.05, rounds: int = 12) -> np.ndarray:
    """Weights of a ridge logistic regression on soft labels of rows that stand for ``times`` documents; the last one is the intercept."""
    times = np.ones(len(x)) if times is None else times
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (times * (p - y)) + penalty * w
        hess = (x * (times * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 12_000, voters: int = 300, folds: int = 5, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> tuple[dict[str, float], float]:
    """Weights by what voters look for, and the intercept."""
    path = path or shared_dir(docs.sparkSession)
    known = labels.select(F.col("doc_id").alias("i"), F.col("toxic").alias("y")).where("i is not null and y in (0, 1)").where(~held_out(F.col("i"), folds))
    sample = known.groupBy("i").agg(F.max("y").alias("y")).orderBy(F.xxhash64("i"), "i").limit(sample_rows)
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("text"))
    rows = cut(rows.join(F.broadcast(sample), "i").select("text", "y"), f"{path}/labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            keys = list(tally[0] | tally[1])
            return pa.RecordBatch.from_pydict({"word": keys, "neg": [tally[0][k] for k in keys], "pos": [tally[1][k] for k in keys]}, schema=pa.schema([("word", pa.string()), ("neg", pa.int64()), ("pos", pa.int64())]))

        for batch in batches:
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tally[y].update(evidence(t))
                if len(tally[0]) + len(tally[1]) > 200_000:
                    yield out()
                    tally[0].clear(), tally[1].clear()
        yield out()

    total = rows.groupBy("y").count().collect()
    size = {r["y"]: r["count"] for r in total}
    if not size.get(0) or not size.get(1):
        return {}, -30.0
    words = rows.mapInArrow(count, "word string, neg long, pos long").groupBy("word").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
    # Likelihood ratio against independence, beyond what the best of all candidates shows by chance.
    share, n = size[1] / (size[0] + size[1]), F.col("pos") + F.col("neg")
    term = lambda c, p: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / n / p)).otherwise(0.0)
    for_, against = F.col("pos") >= 0.92 * n, F.col("neg") >= (1 - 0.08 * share) * n
    counts = cut(words.where(n >= 4), f"{path}/counts")
    words = counts.where(for_ | against).select("word", n.alias("n"), against.alias("against"), (term("pos", share) + term("neg", 1 - share)).alias("gain"))
    least = float(np.log(max(1, words.count()))) + 3
    picked, polarity = [], []
    for side, most in ((False, voters), (True, voters // 4)):
        best = words.where((F.col("gain") > least) & (F.col("against") == side)).orderBy(F.col("gain").desc(), "word").limit(4 * most).collect()
        parts = {w for r in best if " " in r["word"] for w in r["word"].split(" ")}
        alone = {r["word"]: r["n"] for r in counts.where(F.col("word").isin(*parts)).select("word", n.alias("n")).collect()} if parts else {}
        chosen: set[str] = set()
        for r in best:
            # At most a tenth are phrases. A phrase with a voter in it says no more than that voter; one of rare words is a copied passage rather than a phrase.
            if " " in r["word"] and (side or sum(" " in w for w in chosen) >= most // 10 or any(w in chosen or alone.get(w, 0) < 5 * r["n"] for w in r["word"].split(" "))):
                continue
            if len(chosen) < most:
                chosen.add(r["word"])
                picked.append(r["word"])
                polarity.append(side)
    if not picked:
        return {}, float(np.log(size[1] / size[0]))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: k for k, w in enumerate(picked)}
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"votes": [sorted(place[w] for w in evidence(t) & place.keys()) for t in batch.column(0).to_pylist()]}, schema=pa.schema([("votes", pa.list_(pa.int32()))]))

    # The label model sees distinct vote patterns of the bounded sample; their order is fixed.
    seen = rows.select("text").mapInArrow(vote, "votes array<int>").groupBy("votes").count().orderBy("votes").collect()
    x = np.zeros((len(seen), len(picked)))
    for k, r in enumerate(seen):
        x[k, r["votes"]] = 1
    times = np.array([r["count"] for r in seen])
    against = np.array(polarity)
    w = linear_model(x[:, ~against], label_model(x, times, against, share), times)
    return dict(zip([p for p, n in zip(picked, polarity, strict=True) if not n], w[:-1].tolist(), strict=True)), float(w[-1])


def _judge(weights: dict[str, float], base: float):
    """Scores of texts by the linear classifier."""
    marks = {w: v for w, v in weights.items() if w[0] == "#"}
    phrases = [(frozenset(w.split(" ")), re.compile(r"\b" + r"\W+".join(map(re.escape, w.split(" "))) + r"\b"), v) for w, v in weights.items() if " " in w]
    starts = [(n, {w: v for w, v in weights.items() if len(w) == n + 1 and w.endswith("-")}) for n in STARTS]
    lexicon = {w: v for w, v in weights.items() if w[0] != "#" and " " not in w and not w.endswith("-")}

    def judge(texts: pa.Array) -> list[float]:
        scores = []
        for t in texts.to_pylist():
            t = t or ""
            low = t.lower()
            words = set(WORD.findall(low))
            z = base + sum(sorted(lexicon[w] for w in words & lexicon.keys()))
            for n, some in starts:
                if some:
                    z += sum(sorted(some[s] for s in {w[:n] + "-" for w in words if len(w) > n} & some.keys()))
            z += sum(v for some, pattern, v in phrases if some <= words and pattern.search(low))
            if marks:
                z += sum(sorted(marks[s] for s in shapes(t) & marks.keys()))
            scores.append(1 / (1 + float(np.exp(-max(-30.0, min(30.0, z))))))
        return scores

    return judge


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, **how) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    judge = _judge(*fit(docs, labels, id_col=id_col, text_col=text_col, folds=folds, **how))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = judge(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array([int(s >= 0.5) for s in scores], pa.int32())], schema=SCORED)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col), folds).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Rows of ``docs`` that score less than 0.5, all their columns as they were; each row is judged by itself."""
    judge = _judge(*fit(docs, labels, id_col=id_col, text_col=text_col, **how))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([s < 0.5 for s in judge(batch.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
