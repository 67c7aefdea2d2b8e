"""Registered queries of the training-data operators, with SQL where it can state them."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimstone.llm import (
    bpe,
    content_sort,
    decontam,
    html,
    jaccard,
    knn,
    licenses,
    lines,
    oracles,
    phrases,
    quality,
    ranking,
    sharding,
    suffix,
)
from rimstone.llm.common import table


def op1_byte_prefix_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.crc32(text).alias("text_crc32")
    )
    rows = rows.select("doc_id", (F.col("n_bytes") + 1).alias("size"), "text_crc32")
    placed = sharding.balanced_shards(rows, 16, ["doc_id", "text_crc32", "size"], F.col("size"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_main_text(table(spark, sf_dir, "pages"))


def op3_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("matches")


def op4_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op5_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = knn.whole_vectors(table(spark, sf_dir, "embeddings"), each=True)
    return knn.top_k(vectors, F.col("vec_id") % 100 == 0, 10)


def op6_universe_partition_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents")).drop("text_hash")


def op7_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


def op8_line_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.remove_similar_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"), digest=True)


def op10_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), digest=True)


def op11_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.exact_duplicates(table(spark, sf_dir, "documents"))


def op12_hybrid_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_trie_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
    "op1_byte_prefix_shards": (op1_byte_prefix_shards, None),
    "op2_page_differencing": (op2_page_differencing, None),
    "op3_license_templates": (op3_license_templates, None),
    "op4_factorisation_machine": (op4_factorisation_machine, None),
    "op5_voronoi_topk": (op5_voronoi_topk, oracles.OP5),
    "op6_universe_partition_join": (op6_universe_partition_join, None),
    "op7_positional_index": (op7_positional_index, oracles.OP7),
    "op8_line_set_join": (op8_line_set_join, oracles.OP8),
    "op9_suffix_sort": (op9_suffix_sort, None),
    "op10_bpe_transducer": (op10_bpe_transducer, None),
    "op11_content_sort": (op11_content_sort, oracles.OP11),
    "op12_hybrid_ranking": (op12_hybrid_ranking, oracles.OP12),
    "op13_trie_collocations": (op13_trie_collocations, oracles.OP13),
}
