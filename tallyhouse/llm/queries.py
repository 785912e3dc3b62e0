"""The operators as registered queries, each over its whole table with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import align, bagminhash, htmltext, licenses, lines, mixing, packing, pii, quality, sharding, spelling, topk, warc
from tallyhouse.llm.common import read, work_path
from tallyhouse.llm.oracle import oracle_sql

__all__ = ["oracle_sql", "queries"]

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(read(spark, folder, "documents"))


def op2_warc_chains(spark: SparkSession, folder: str) -> DataFrame:
    archives = work_path(spark, f"warc-{uuid.uuid4().hex}")
    return warc.round_trip(read(spark, folder, "pages"), archives)


def op3_temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    _, places, _ = mixing.mixture(read(spark, folder, "documents"))
    return places.drop("row")


def op4_bagminhash(spark: SparkSession, folder: str) -> DataFrame:
    _, classes, _ = bagminhash.near_duplicates(read(spark, folder, "documents"))
    return classes.select("doc_id", "class_id", "class_size", "is_first")


def op5_contextual_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(read(spark, folder, "documents"))


def op6_license_index(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licence_report(read(spark, folder, "documents"))


def op7_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    left = lines.drop_repeated_lines(read(spark, folder, "documents"))
    return left.select("doc_id", "text", "n_lines", "lines_dropped")


def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return htmltext.extract(read(spark, folder, "pages"))


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_pivot_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_bit_sliced_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_groups(read(spark, folder, "documents"), slips=199)


def op12_vector_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(read(spark, folder, "documents"))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    files = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align.report(read(spark, folder, "documents"), *files)


_QUERIES: list[Query] = [
    op1_quality_rules,
    op2_warc_chains,
    op3_temperature_mixing,
    op4_bagminhash,
    op5_contextual_pii,
    op6_license_index,
    op7_fuzzy_lines,
    op8_html_text,
    op9_best_fit_packing,
    op10_pivot_top_k,
    op11_bit_sliced_spelling,
    op12_vector_shards,
    op13_token_alignment,
]


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in _QUERIES}
