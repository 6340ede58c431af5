"""Queries of the license scan, HTML extraction and quality classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from noticeflow.llm import classifier, html_text, license_scan
from noticeflow.llm.common import table


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.find_licenses(table(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classifier.score_texts(docs, classifier.fit(docs, table(spark, sf_dir, "labels")))


Q = {"op6_license_scans": op6_license_scans, "op7_html_extraction": op7_html_extraction,
     "op10_quality_classifier": op10_quality_classifier}
SQL: dict[str, str] = {}
