"""One query for each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadlark.llm import (
    alignment, html, jaccard, language, lattice, licenses, mixing, negatives, neighbours, packing, quality, sharding,
    toxicity,
)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(read(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(read(spark, folder, "documents"))


def op4_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(read(spark, folder, "pages"))


def op5_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.deduplicate(read(spark, folder, "documents")).drop("node")


def op6_lattice(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_duplicates(read(spark, folder, "embeddings"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op8_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(read(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = str(public_tokenizers.path("piece_bpe_32k.model"))
    return language.identify(read(spark, folder, "documents"), vocabulary)


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = str(public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(read(spark, folder, "documents"), tokenizer)


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    a, b = (str(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(read(spark, folder, "documents"), a, b)


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine(read(spark, folder, "embeddings"), vec_id % 50 == 0, moved)


def op13_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(read(spark, folder, "documents"))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_quality": op2_quality,
    "op3_licenses": op3_licenses,
    "op4_main_text": op4_main_text,
    "op5_jaccard": op5_jaccard,
    "op6_lattice": op6_lattice,
    "op7_toxicity": op7_toxicity,
    "op8_neighbours": op8_neighbours,
    "op9_language": op9_language,
    "op10_packing": op10_packing,
    "op11_alignment": op11_alignment,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_kd_shards": op13_kd_shards,
}
