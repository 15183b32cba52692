"""Queries of the training-data operators with production parameters, each over
its whole table, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from alloy.llm import (
    decontam, exact_dedup, hard_negatives, near_dup, ngram_join, packing, pii, quality, secrets, sharding, suffix_dedup,
    token_alignment, toxicity)
from alloy.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = [f"shard-{i:02d}" for i in range(24)]
SLOTS = 2503


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that leaks into a document."""
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and shard."""
    return sharding.assign(table(spark, sf_dir, "documents"), SHARDS, SLOTS)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the id that stays of its equal texts."""
    return exact_dedup.mark(table(spark, sf_dir, "documents"))


_OP3_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size
      FROM d WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id ASC NULLS LAST))
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's category probabilities and verdict."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit_chain(docs, table(spark, sf_dir, "labels")))


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near duplicates."""
    return near_dup.classes(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets: base counts and digest, all spans."""
    return secrets.span_columns(secrets.find_secrets(table(spark, sf_dir, "documents")), secrets.BASE_KINDS)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes without strings of 100 bytes that start earlier."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["stop"] - r["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: base counts and digest, all spans."""
    return secrets.span_columns(pii.find_pii(table(spark, sf_dir, "documents")), pii.BASE_KINDS)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weak label and quality score."""
    return quality.score_quality(table(spark, sf_dir, "documents"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component and number of links by shingles of four words."""
    return ngram_join.join_similar(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


#: Shingles by pure SQL, links by common shingles, components by the smallest id that reaches a document.
_OP11_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
t AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
         ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles FROM w),
n AS (SELECT doc_id, len(shingles) AS n_shingles FROM t),
u AS (SELECT doc_id, unnest(shingles) AS shingle FROM t),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM u a JOIN u b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b
      WHERE 100 * c.both >= 85 * (x.n_shingles + y.n_shingles - c.both)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
l AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT n.doc_id, n.n_shingles, min(r.b) AS component_id, coalesce(any_value(l.n_links), 0) AS n_links
FROM n JOIN r ON r.a = n.doc_id LEFT JOIN l ON l.a = n.doc_id GROUP BY n.doc_id, n.n_shingles
"""


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's groups of tokens of two tokenizers and the weight of their links."""
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return token_alignment.align(table(spark, sf_dir, "documents"), said=digest).withColumnRenamed("groups", "groups_sha256")


#: Labels of every seventh vector move on by one.
MOVED_LABEL = "CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS LONG) + 1) % 10 ELSE label END"


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every fiftieth vector and its positives."""
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", MOVED_LABEL)


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_sharding": op2_sharding,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_packing": op4_packing,
    "op5_toxicity": op5_toxicity,
    "op6_near_dup": op6_near_dup,
    "op7_secrets": op7_secrets,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_pii": op9_pii,
    "op10_quality": op10_quality,
    "op11_ngram_join": op11_ngram_join,
    "op12_token_alignment": op12_token_alignment,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op2_sharding": sharding.oracle(SHARDS, SLOTS),
    "op3_exact_dedup": _OP3_SQL,
    "op11_ngram_join": _OP11_SQL,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
