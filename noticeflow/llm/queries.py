"""All queries of the text operators."""

from __future__ import annotations

import corpus_pipeline
from noticeflow.llm import queries_corpus, queries_corpus_audit, queries_filters, queries_text

PARTS = [queries_corpus, queries_corpus_audit, queries_filters, queries_text]
Q = {name: query for part in PARTS for name, query in part.Q.items()} | {"pipeline": corpus_pipeline.run}
SQL = {name: text for part in PARTS for name, text in part.SQL.items()}
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
