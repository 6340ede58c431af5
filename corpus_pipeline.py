"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet to the shared folder and read again as the docs of the next one:

1. quality_rules: lines that break a rule go, and documents that lose too much text or fail a base rule.
2. ngram_jaccard_join: of each class of near duplicates the document with the least id stays.
3. benchmark_decontamination: documents that hold a benchmark passage go.
4. secret_scans: secrets are masked in the texts.
5. packing: the documents become pieces of training sequences.

NULL, empty and very short texts fail the quality rules and go in the first stage; of rows that repeat a text one is left after
the second. NULL keys, columns of any name and texts of any length pass through; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from noticeflow.llm import decontaminate, ngram_join, packing, quality_rules, secret_scan
from noticeflow.llm.common import table
from noticeflow.llm.queries_corpus import tokenizer_path
from noticeflow.session import configure, shared_dir


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents kept by the quality rules, without their failing lines."""
    return quality_rules.clean(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    configure(spark)
    return ngram_join.one_per_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    configure(spark)
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a training sequence."""
    configure(spark)
    return packing.digest(packing.pack(docs, tokenizer_path()))


STAGES = [("quality_rules", clean_lines), ("ngram_jaccard_join", drop_near_duplicates),
          ("benchmark_decontamination", drop_contaminated), ("secret_scans", mask_secrets), ("packing", pack)]

# Edit distance, similarity classes and tokens have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the stages are described above."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
