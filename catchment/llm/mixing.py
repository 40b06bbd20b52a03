"""Mixing sources to target weights by entropy balancing.

Document rates stay between 0 and 2. Among all such rates that meet a source's token
constraint, the ones nearest to 1 in (bounded) relative entropy are
``rate = 2 / (1 + exp(-lambda * x))`` with ``x = size / mean size``: documents are tilted
exponentially in their share of tokens. ``lambda`` solves the convex dual of the source,
found by damped Newton steps that every source takes at once in one grouped aggregation.
The dual only sees (source, size), so the steps run over that histogram instead of the
documents.

Rates become copies in rounds, the longest documents (by their share of the source's target,
``levels``) first; then the dual is solved again for the rest, with what the rounded ones
left over as constraint, so that short documents make up for the rounding of long ones. Within a round sizes go in
descending order and running sums of rates are rounded, so that the errors of neighbours
cancel. Which of several documents of one size get the extra copy is decided by hash order
within buckets of about ``bucket_rows`` rows. Nothing depends on partitioning: reruns agree.

Only DataFrame functions are used. A source or size that holds a third of all rows is
reduced to its histogram before the shuffle, and is dealt out in buckets afterwards.

Nulls and ties: a null text has size 0 and is taken 0 times; a null source is a source of
its own, last in order. Rows that repeat are separate documents. Extra columns are ignored
by ``mix`` and kept by ``take``. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catchment.llm.shared import cut, shared_dir

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    blank = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.filter(F.split(blank, " ", -1), lambda w: w != "")).cast("long")


def targets(sizes: DataFrame, cycle: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Per source of ``sizes`` (source, source_size): its target in tokens.

    Shares go by weight and stop at ``most`` times the source's size; the excess is shared
    again. The outcome is ``least(most * size, level * weight)`` for one level, found from
    running sums over the sources in the order in which they fill up.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in cycle]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(cycle))) + 1).cast("int"))
    s = sizes.withColumn("weight", w).withColumn("cap", F.col("source_size") * most)
    whole = Window.partitionBy()
    fill = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").isNull(), F.col("source").cast("binary"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    s = (
        s.withColumn("total", F.sum("source_size").over(whole) * share)
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
        .withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("first_open", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(whole)["level"])
    )
    return s.select("source", "source_size", "weight", F.when(F.col("first_open").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("first_open") * F.col("weight"))).alias("target"))


def _solve(hist: DataFrame, goals: DataFrame, start: DataFrame | None, path: str, steps: int = 60, within: float = 1e-6) -> DataFrame:
    """(source, lam) for ``goals`` (source, goal); ``hist`` has (source, size, n, x), ``start`` a guess.

    A goal of twice the source's tokens or more has rate 2 throughout, one of 0 has rate 0.
    """
    whole = hist.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("s")).withColumnRenamed("source", "s2")
    sure = F.when(F.col("goal") >= 2 * F.col("s"), F.lit(1e9)).when(F.col("goal") <= 0, F.lit(-1e9))
    base = cut(goals.join(whole, F.col("source").eqNullSafe(F.col("s2"))).select("source", "goal", "s", sure.alias("sure")), f"{path}/goals")
    now = base.where("sure is null").select("source", "goal", F.lit(0.0).alias("lam"), F.lit(-1e5).alias("lo"), F.lit(1e5).alias("hi"))
    if start is not None:
        guess = start.where("abs(lam) < 1e5").select(F.col("source").alias("s2"), F.col("lam").alias("guess"))
        now = now.join(guess, F.col("source").eqNullSafe(F.col("s2")), "left").select("source", "goal", F.coalesce("guess", F.lit(0.0)).alias("lam"), "lo", "hi")
    for k in range(steps):
        at = hist.join(now.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
        rate = 2.0 / (1.0 + F.exp(-F.col("lam") * F.col("x")))
        tokens = F.col("n") * F.col("size")
        at = at.groupBy("source", "goal", "lam", "lo", "hi").agg(F.sum(tokens * rate).alias("t"), F.sum(tokens * F.col("x") * rate * (2.0 - rate) / 2.0).alias("d"), F.sum(tokens).alias("s"))
        lo = F.when(F.col("t") < F.col("goal"), F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(F.col("t") > F.col("goal"), F.col("lam")).otherwise(F.col("hi"))
        at = at.withColumn("lo", lo).withColumn("hi", hi).withColumn("gap", F.abs(F.col("t") - F.col("goal")) / F.col("s"))
        newton = F.col("lam") + F.try_divide(F.col("goal") - F.col("t"), F.col("d"))
        step = F.when(F.col("gap") <= within, F.col("lam")).when((newton > F.col("lo")) & (newton < F.col("hi")), newton).otherwise((F.col("lo") + F.col("hi")) / 2)
        now = cut(at.select("source", "goal", step.alias("lam"), "lo", "hi", "gap"), f"{path}/newton{k}")
        worst = now.agg(F.max("gap").alias("g")).first()["g"]
        now = now.drop("gap")
        if worst is None or worst <= within:
            break
    return base.where("sure is not null").select("source", F.col("sure").alias("lam")).unionByName(now.select("source", "lam"))


def _round(hist: DataFrame) -> DataFrame:
    """Copies of each (source, size) of ``hist``, which has n and rate: running sums of rates, rounded."""
    down = Window.partitionBy("source").orderBy(F.col("size").desc())
    h = hist.withColumn("upto", F.round(F.sum(F.col("n") * F.col("rate")).over(down.rowsBetween(Window.unboundedPreceding, 0)), 6))
    h = h.withColumn("before", F.coalesce(F.lag("upto").over(down), F.lit(0.0)))
    return h.withColumn("copies", (F.floor(F.col("upto") + 0.5) - F.floor(F.col("before") + 0.5)).cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cycle: tuple[int, ...] = (5, 2, 1), share: float = 1.5, levels: tuple[float, ...] = (0.05, 0.01, 0.002), bucket_rows: int = 200, path: str | None = None) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, rate, copies, source, row_hash."""
    path = path or shared_dir(docs.sparkSession)
    rows = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), F.xxhash64(F.col(id_col), F.col(text_col), F.lit("mix")).alias("h")), f"{path}/rows")
    hist = cut(rows.groupBy("source", "size").agg(F.count("*").alias("n")), f"{path}/hist")
    per = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("docs"))
    goals = cut(targets(per.select("source", "source_size"), cycle, share).join(per.select(F.col("source").alias("s2"), "docs"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2"), f"{path}/targets")
    hist = cut(
        hist.where("size > 0").join(goals.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
        .withColumn("x", F.col("size") / (F.col("source_size") / F.col("docs")))
        .withColumn("share", F.col("size") / F.col("target")).select("source", "size", "n", "x", "share"),
        f"{path}/tilted",
    )

    goal = goals.where("source_size > 0").select("source", F.col("target").alias("goal"))
    left, lam, done = goal, None, []
    for k, level in enumerate((*levels, 0.0)):
        part = hist.where(F.col("share") < levels[k - 1]) if k else hist
        lam = _solve(part, left, lam, f"{path}/level{k}")
        tilted = part.where(F.col("share") >= level).join(lam.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
        done.append(cut(_round(tilted.withColumn("rate", 2.0 / (1.0 + F.exp(-F.col("lam") * F.col("x"))))).select("source", "size", "n", "rate", "copies"), f"{path}/dealt{k}"))
        spent = done[-1].groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("spent")).withColumnRenamed("source", "s2")
        left = left.join(spent, F.col("source").eqNullSafe(F.col("s2")), "left").select("source", F.greatest(F.col("goal") - F.coalesce("spent", F.lit(0)), F.lit(0.0)).alias("goal"))
    dealt = reduce(DataFrame.unionByName, done).withColumn("buckets", F.ceil(F.col("n") / bucket_rows))

    # Extra copies beyond the even share go to buckets by running sums, then to documents by hash order.
    d2 = dealt.withColumn("even", F.floor(F.col("copies") / F.col("n"))).withColumn("extra", F.col("copies") - F.col("even") * F.col("n")).withColumnRenamed("source", "s2").withColumnRenamed("size", "z2")
    placed = rows.join(d2, F.col("source").eqNullSafe(F.col("s2")) & (F.col("size") == F.col("z2")), "left").drop("s2", "z2").withColumn("bucket", F.when(F.col("buckets") > 1, F.pmod("h", "buckets")).otherwise(0))
    placed = cut(placed, f"{path}/placed")
    split = placed.where("extra > 0").groupBy("source", "size", "bucket").agg(F.count("*").alias("m"), F.first("extra").alias("e"), F.first("n").alias("n2"))
    run = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    split = split.withColumn("upto", F.sum("m").over(run))
    quota = F.floor(F.col("upto") * F.col("e") / F.col("n2")) - F.floor((F.col("upto") - F.col("m")) * F.col("e") / F.col("n2"))
    split = split.select(F.col("source").alias("s2"), F.col("size").alias("z2"), F.col("bucket").alias("b2"), quota.alias("quota"))
    same = F.col("source").eqNullSafe(F.col("s2")) & (F.col("size") == F.col("z2")) & (F.col("bucket") == F.col("b2"))
    rank = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("h", "doc_id"))
    some = placed.where("extra > 0").join(split, same).drop("s2", "z2", "b2").withColumn("copies", F.col("even") + F.when(rank <= F.col("quota"), 1).otherwise(0)).drop("quota")
    out = some.unionByName(placed.where("extra is null or extra = 0").withColumn("copies", F.coalesce("even", F.lit(0))))
    g = goals.select(F.col("source").alias("s2"), "source_size", "target")
    return out.join(g, F.col("source").eqNullSafe(F.col("s2")), "left").select(
        "doc_id", "size", F.col("source_size").cast("long").alias("source_size"), F.col("target").cast("double").alias("target"),
        (F.col("copies") * F.col("size")).cast("long").alias("taken"), F.coalesce("rate", F.lit(0.0)).alias("rate"), F.col("copies").cast("long").alias("copies"), "source", F.col("h").alias("row_hash"),
    )


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", path: str | None = None, **how) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it, all its columns as they were.

    Rows find their copies by source, id and a hash of id and text. Rows that agree in all
    of them share what the mix takes of them evenly.
    """
    path = path or shared_dir(docs.sparkSession)
    dealt = mix(docs, id_col, text_col, source_col, path=path, **how).groupBy(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("row_hash").alias("__h"))
    dealt = cut(dealt.agg(F.sum("copies").alias("__n"), F.count("*").alias("__m")).where("__n > 0"), f"{path}/copies")
    keyed = docs.withColumn("__h2", F.xxhash64(F.col(id_col), F.col(text_col), F.lit("mix")))
    same = (F.col("__h2") == F.col("__h")) & F.col(id_col).eqNullSafe(F.col("__id")) & F.col(source_col).eqNullSafe(F.col("__source"))
    out = keyed.join(dealt, same)
    if not dealt.where("__m > 1").isEmpty():
        at = F.row_number().over(Window.partitionBy("__h", "__id", "__source").orderBy("__h"))
        alone, several = out.where("__m = 1"), out.where("__m > 1").withColumn("__k", at)
        share = F.floor(F.col("__n") * F.col("__k") / F.col("__m")) - F.floor(F.col("__n") * (F.col("__k") - 1) / F.col("__m"))
        out = alone.unionByName(several.withColumn("__n", share).drop("__k").where("__n > 0"))
    return out.withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))).select(*docs.columns)
