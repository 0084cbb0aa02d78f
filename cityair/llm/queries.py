"""Registered queries of this subpackage: ``(spark, sf_dir) -> DataFrame``.

Each applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cityair.llm import (align, ann, centroids, chat, lang_id, lattice, mixing, near_dup, packing,
                         quality, suffix_dedup, topk, url_filter)
from cityair.llm.common import table


def op1_language_id(spark, sf_dir):
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark, sf_dir):
    return suffix_dedup.removed_bytes(table(spark, sf_dir, "documents"))


def op3_source_mixing(spark, sf_dir):
    return mixing.mix_words(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_preference_pairs(spark, sf_dir):
    """The table has no preference labels: of conversations 2n and 2n + 1 the
    first counts as chosen, the second as rejected."""
    pairs = chat.preference_pairs(
        table(spark, sf_dir, "conversations"), F.expr("conv_id div 2"), F.expr("conv_id % 2 = 0"))
    return pairs.select("pair_id", "status", "prompt_turns", "prompt", "chosen", "rejected",
                        chat.spans_text("chosen_spans").alias("chosen_spans"),
                        chat.spans_text("rejected_spans").alias("rejected_spans"))


def op7_near_duplicates(spark, sf_dir):
    return near_dup.classes(table(spark, sf_dir, "documents"))


def op8_url_filter(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op9_nearest_neighbours(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op10_exact_top_k(spark, sf_dir):
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op11_centroid_clustering(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_lattice_scores(spark, sf_dir):
    return lattice.score(table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark, sf_dir):
    return align.align(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_suffix_dedup, op3_source_mixing, op4_best_fit_packing,
    op5_quality_classifier, op6_preference_pairs, op7_near_duplicates, op8_url_filter,
    op9_nearest_neighbours, op10_exact_top_k, op11_centroid_clustering, op12_lattice_scores,
    op13_tokenizer_alignment)}

TOP_K_ORACLE = """
WITH parts AS (
  SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x,
         unnest(range(1, len(embedding) + 1)) AS j
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
whole AS (SELECT vec_id, j, CAST(floor(256 * x) AS BIGINT) AS w FROM parts),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.j = c.j AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY ALL),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
    AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLE: dict[str, str] = {
    "op6_preference_pairs": chat.ORACLE,
    "op10_exact_top_k": TOP_K_ORACLE,
    "op11_centroid_clustering": centroids.oracle(),
}
