"""The thin queries that apply each operator, with its production parameters, to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm import collocations, embed_dedup, lines, minhash, mixing, order, packing, sharding, suffix_dedup, topk, toxicity, urls, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.95)


def op3_shard_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(_table(spark, sf_dir, "documents"), shards=16)
    return out.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), percent=85, words=5)


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(_table(spark, sf_dir, "documents")).drop("kept")


def op6_voronoi_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.deduplicate(_table(spark, sf_dir, "documents"), min_words=6)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = order.materialise(_table(spark, sf_dir, "documents"), seed=17, length=2048, stride=order.STRIDE)
    return order.digest(order.resume(spark, path))


def op9_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), size=2048)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), max_rows=20_000)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"), least=30, most=2_000)


def op12_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(_table(spark, sf_dir, "embeddings"), k=8, scale=1024.0, shift=100_000)
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))  # null where a long can't hold it


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_shard_by_bytes": op3_shard_by_bytes,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_repeated_passages": op5_repeated_passages,
    "op6_voronoi_top_k": op6_voronoi_top_k,
    "op7_line_dedup": op7_line_dedup,
    "op8_training_order": op8_training_order,
    "op9_pack_windows": op9_pack_windows,
    "op10_toxicity": op10_toxicity,
    "op11_collocations": op11_collocations,
    "op12_whiten_embeddings": op12_whiten_embeddings,
    "op13_url_filter": op13_url_filter,
}
