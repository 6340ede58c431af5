"""Queries of the near-duplicate join, packing and benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from noticeflow.llm import decontaminate, ngram_join, packing
from noticeflow.llm.common import table


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


Q = {"op2_ngram_jaccard_join": op2_ngram_jaccard_join, "op4_packing": op4_packing,
     "op8_benchmark_decontamination": op8_benchmark_decontamination}
SQL: dict[str, str] = {}
