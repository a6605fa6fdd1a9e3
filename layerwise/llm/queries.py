"""Registered queries of the operators: each reads its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment, idcoder, minmax, mixture, packing, pii, rotcodes, slots, spaced_seed, token_counts, toxicity, warc, zonemaps)


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def op1_sentence_bags(spark: SparkSession, root: str) -> DataFrame:
    docs = _table(spark, root, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, root, "labels")))


def op2_exact_complements(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack(_table(spark, root, "documents"), tokenizer("word_bpe_49k.json"))


def op3_token_counts(spark: SparkSession, root: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, root, "documents"), tokenizer("piece_bpe_32k.model"))


def op4_warc_archive(spark: SparkSession, root: str) -> DataFrame:
    return warc.archive_digest(_table(spark, root, "pages"))


def op5_min_max_hashing(spark: SparkSession, root: str) -> DataFrame:
    return minmax.near_copies(_table(spark, root, "documents"))


def op6_rotation_codes(spark: SparkSession, root: str) -> DataFrame:
    return rotcodes.near_vectors(_table(spark, root, "embeddings"))


def op7_spaced_seeds(spark: SparkSession, root: str) -> DataFrame:
    found = spaced_seed.contaminated(_table(spark, root, "documents"), _table(spark, root, "benchmark"))
    return found.select("doc_id", F.array_join(F.col("item_ids").cast("array<string>"), ",").alias("item_ids"), "matched")


def op8_boosted_candidates(spark: SparkSession, root: str) -> DataFrame:
    return pii.digest(_table(spark, root, "documents"))


def op9_virtual_slots(spark: SparkSession, root: str) -> DataFrame:
    return slots.sharded(_table(spark, root, "documents"))


def op10_mixed_ids(spark: SparkSession, root: str) -> DataFrame:
    return idcoder.round_trip(_table(spark, root, "documents"), tokenizer("byte_bpe_50k.json"), 50_257)


def op11_deficit_mixture(spark: SparkSession, root: str) -> DataFrame:
    return mixture.digest(mixture.mixed(_table(spark, root, "documents"), tokenizer("word_bpe_49k.json")))


def op12_zone_maps(spark: SparkSession, root: str) -> DataFrame:
    return zonemaps.digest(_table(spark, root, "embeddings"))


def op13_text_alignment(spark: SparkSession, root: str) -> DataFrame:
    return alignment.align(_table(spark, root, "documents"), tokenizer("byte_bpe_50k.json"),
                           tokenizer("piece_bpe_32k.model"))[0]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_sentence_bags, op2_exact_complements, op3_token_counts, op4_warc_archive, op5_min_max_hashing,
        op6_rotation_codes, op7_spaced_seeds, op8_boosted_candidates, op9_virtual_slots, op10_mixed_ids,
        op11_deficit_mixture, op12_zone_maps, op13_text_alignment)
}
