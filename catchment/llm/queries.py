"""The registered queries of this subpackage, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment.llm import shallot, toxicity
from catchment.llm.byte_bpe import encode_bytes
from catchment.llm.embedding_links import link_vectors
from catchment.llm.exact_dedup import find_copies
from catchment.llm.html_text import extract
from catchment.llm.jaccard_join import link_classes
from catchment.llm.licenses import scan
from catchment.llm.line_dedup import drop_lines
from catchment.llm.mixing import mix
from catchment.llm.periodic_runs import find_runs, repeat_tails
from catchment.llm.shared import shared_dir
from catchment.llm.token_blocks import read_digests, write_blocks
from catchment.llm.token_counts import count_tokens


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{shared_dir(spark)}/segments"
    write_blocks(table(spark, sf_dir, "documents"), out, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_digests(spark, out)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op3_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_classes(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_bytes(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, columns=("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))


def op7_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_copies(table(spark, sf_dir, "documents"))


def op11_shallot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shallot.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, seed=3, scale=1024.0, dim=64)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    return find_runs(repeat_tails(table(spark, sf_dir, "documents")), times=4, least=6, columns=columns)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = drop_lines(docs, least=20, copies=3, counts=True)
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


EXACT_DEDUP_SQL = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS cp, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), g AS (
    SELECT *, count(*) OVER (PARTITION BY norm) AS group_size,
        first_value(doc_id) OVER (PARTITION BY norm ORDER BY cp DESC, doc_id) AS keep_id
    FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""


LINE_DEDUP_SQL = r"""
WITH l AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), k AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), g AS (
    SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), m AS (
    SELECT k.*, g.key IS NOT NULL AND doc_id <> owner AS gone FROM k LEFT JOIN g ON k.key = g.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def clusters_sql(rounds: int = 10, k: int = 8) -> str:
    """k-means in exact integers, a pair of subqueries per round."""
    steps = [
        "v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)",
        f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS INTEGER) AS cluster, x AS c FROM v ORDER BY sha256('3:' || vec_id) LIMIT {k})",
    ]
    for r in range(rounds + 1):
        far = f"d{r} AS (SELECT vec_id, x, cluster, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, c{r})"
        steps += [far, f"a{r} AS MATERIALIZED (SELECT vec_id, any_value(x) AS x, unnest(min(struct_pack(d := CAST(d AS BIGINT), cluster := cluster))) FROM d{r} GROUP BY vec_id)"]
        if r < rounds:
            each = f"SELECT cluster, unnest(x) AS s, generate_subscripts(x, 1) AS i FROM a{r}"
            mean = "CAST((sum(s) - ((sum(s) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"
            moved = f"SELECT cluster, list(m ORDER BY i) AS c FROM (SELECT cluster, i, {mean} AS m FROM ({each}) GROUP BY cluster, i) GROUP BY cluster"
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.cluster, coalesce(n.c, c{r}.c) AS c FROM c{r} LEFT JOIN ({moved}) n ON n.cluster = c{r}.cluster)")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, a.cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} USING (cluster)"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_blocks": op1_token_blocks,
        "op2_token_counts": op2_token_counts,
        "op3_embedding_links": op3_embedding_links,
        "op4_toxicity": op4_toxicity,
        "op5_ngram_jaccard": op5_ngram_jaccard,
        "op6_byte_bpe": op6_byte_bpe,
        "op7_entropy_mix": op7_entropy_mix,
        "op8_license_scan": op8_license_scan,
        "op9_html_text": op9_html_text,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_shallot_clusters": op11_shallot_clusters,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_line_dedup": op13_line_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_exact_dedup": EXACT_DEDUP_SQL, "op11_shallot_clusters": clusters_sql(), "op13_line_dedup": LINE_DEDUP_SQL}
