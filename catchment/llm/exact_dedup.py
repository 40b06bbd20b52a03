"""Exact dedup as a log-structured merge index over Spark tables.

Each input task is a memtable: its digests are sorted and flushed as one run. Compaction
merges runs by digest, ``fan_in`` of them at a time and level by level until one is left;
a merged run is sorted again, keeps the smallest identifier under (longest text first, then
smallest id), and counts the group. Digests that were met more than once are hits. A filter
over the hits, bitmaps of ``filter_bits`` bits a hit, decides which texts are read again: of
these the bytes are compared, and where one digest covers several texts the texts themselves
become the key. What the filter lets through by chance is compared with itself and changes
nothing. A filter beyond ``broadcast_bytes`` gives way to a join with the hits.

Only DataFrame functions are used. Groups are reduced before every shuffle, so a group that
holds a third of all rows costs one row per task. The join that carries a group's head back
to its members is a plain shuffle join, which the adaptive skew join splits.

Nulls and ties: a null text counts as empty; all white-space-only texts are equal to the
empty one. A null id sorts before all others. Rows that repeat with the same id and text
are one document: all of them get the same flags, ``drop_copies`` leaves one of them. Extra
columns are ignored by ``find_copies`` and kept by ``drop_copies``. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchment.llm.shared import BLANKS, cut, shared_dir


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def _may_hit(rows: DataFrame, hits: DataFrame, path: str, filter_bits: int, broadcast_bytes: int) -> DataFrame:
    """``rows`` whose digest is one of ``hits``, and a few others."""
    n = hits.count()
    size = 1 << max(15, (max(1, n) * filter_bits - 1).bit_length())
    if size // 8 > broadcast_bytes:
        return rows.join(hits.select("digest"), "digest", "left_semi")
    at = F.pmod("digest", F.lit(size)) + 1
    marks = hits.select(F.bitmap_bucket_number(at).alias("__bucket"), F.bitmap_bit_position(at).alias("__bit"))
    bits = cut(marks.groupBy("__bucket").agg(F.bitmap_construct_agg("__bit").alias("__bits")), f"{path}/filter")
    byte = F.conv(F.hex(F.substring("__bits", (F.bitmap_bit_position(at) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    probed = rows.withColumn("__bucket", F.bitmap_bucket_number(at)).join(F.broadcast(bits), "__bucket")
    return probed.where(F.getbit(byte, (F.bitmap_bit_position(at) % 8).cast("int")) == 1).select(rows.columns)


def find_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bits: int = 64, path: str | None = None, fan_in: int = 256, filter_bits: int = 16, broadcast_bytes: int = 32 << 20
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    ``digest_bits`` shortens the index digest; results do not depend on it, since hits are
    verified byte by byte.
    """
    spark = docs.sparkSession
    path = path or shared_dir(spark)
    digest = F.shiftrightunsigned(F.xxhash64("norm"), 64 - digest_bits) if digest_bits < 64 else F.xxhash64("norm")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("cp"),
        normalised(F.col(text_col)).alias("norm"),
    ).withColumn("digest", digest)

    entry = rows.select("doc_id", "cp", "digest", F.sha2("norm", 256).alias("text_sha256"), F.spark_partition_id().alias("run"))
    level0 = cut(entry.sortWithinPartitions("digest", "cp", "doc_id"), f"{path}/runs")

    # Compaction: the best identifier is the least of (minus length, id).
    first = F.struct((-F.col("cp")).alias("cp"), F.col("doc_id").alias("id"))
    merged = level0.select("run", "digest", F.lit(1).cast("long").alias("group_size"), first.alias("best"))
    runs, level = (level0.agg(F.max("run")).first()[0] or 0) + 1, 0
    while level == 0 or runs > 1:
        runs, level = -(-runs // fan_in), level + 1
        by = (["run"] if runs > 1 else []) + ["digest"]
        merged = merged.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")).groupBy(*by).agg(F.sum("group_size").alias("group_size"), F.min("best").alias("best"))
        merged = cut(merged.sortWithinPartitions(*by), f"{path}/level{level}")
    hits = merged.where("group_size > 1")

    # Byte verification of hits: equal least and greatest text means that all are equal.
    bytes_of = _may_hit(rows, hits, path, filter_bits, broadcast_bytes).groupBy("digest").agg(F.min("norm").alias("least"), F.max("norm").alias("greatest"))
    broken = cut(bytes_of.where("least <> greatest").select("digest"), f"{path}/broken")
    if broken.isEmpty():
        keyed, heads, on = level0, merged, ["digest"]
    else:
        torn = rows.join(broken, "digest", "left_semi").withColumn("text_sha256", F.sha2("norm", 256))
        exact = torn.groupBy("digest", "norm", "text_sha256").agg(F.count("*").alias("group_size"), F.min(first).alias("best"))
        sound = merged.join(broken, "digest", "left_anti")
        heads = sound.withColumn("sub", F.lit("")).unionByName(exact.select("digest", "group_size", "best", F.col("text_sha256").alias("sub")))
        marks = broken.withColumn("torn", F.lit(True))
        keyed = level0.join(marks, "digest", "left").withColumn("sub", F.when(F.col("torn"), F.col("text_sha256")).otherwise("")).drop("torn")
        on = ["digest", "sub"]
    return keyed.join(heads, on).select(
        "doc_id",
        F.col("best.id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("best.id")) & (F.col("cp") == -F.col("best.cp"))).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns as they were.

    Texts are shuffled once: the join and the removal of repeated rows share their keys.
    """
    keys = ["__sha", "__key"]
    found = find_copies(docs, id_col, text_col).where("kept").select(F.col("text_sha256").alias("__sha"), F.xxhash64("doc_id").alias("__key")).distinct()
    keyed = docs.withColumn("__sha", F.sha2(normalised(F.col(text_col)), 256)).withColumn("__key", F.xxhash64(F.col(id_col).cast("long"))).withColumn("__length", F.char_length(F.coalesce(F.col(text_col), F.lit(""))))
    longest = keyed.join(found, keys, "left_semi")
    best = F.max_by(F.struct(*[F.col(c) for c in docs.columns]), "__length").alias("__row")
    return longest.groupBy(*keys).agg(best).select("__row.*")
