"""Tagging run: every pending notice against the active rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tagging import (FAILED, NO_RULES, CallScorer, active_rules, assignments, classifier_input, classify, first_verdict,
                                 keyword_scorer, records_with_rules, rule_semantics)
from ..session import checkpointed
from ..sinks.upsert import upsert_table


@dataclass
class Tagged:
    outcomes: DataFrame
    assignments: DataFrame


def tag_records(records: DataFrame, record_id: str, text: str, rules: DataFrame, items: DataFrame,
                model: str, scorer: Callable[[Column, Column], Column] | CallScorer = keyword_scorer,
                keep: tuple[str, ...] = (), prompt: tuple[str, ...] = ()) -> Tagged:
    """Outcome per record and keyed rule assignments.

    With ``prompt`` (columns of title, project, industry, keywords, category and
    body) the scorer gets the eight labelled lines of ``classifier_input``
    instead of ``text``, as a model needs them.

    Verdicts are written once to the checkpoint folder, because a model call
    must not be repeated when two results are read from it.
    """
    active = active_rules(rules)
    if active.isEmpty():
        failed = records.select(record_id, F.lit(FAILED).alias("ai_status"), F.lit(NO_RULES).alias("reason"))
        return Tagged(failed, records.sparkSession.createDataFrame([], "assignment_key string"))
    columns = list(dict.fromkeys([record_id, text, *keep, *prompt]))
    pairs = records_with_rules(records.select(*columns), rule_semantics(active, items))
    if prompt:
        pairs, text = classifier_input(pairs, *prompt), "prompt"
    verdicts = checkpointed(classify(pairs, record_id, text, scorer).select(
        record_id, "rule", "verdict", "assignment_key"))
    outcomes = first_verdict(verdicts, record_id)
    return Tagged(outcomes, assignments(verdicts, outcomes, record_id, model))


def store_tags(spark: SparkSession, tagged: Tagged, outcomes: str, assigned: str, record_id: str) -> None:
    """Write outcomes (by record) and assignments (by assignment key) into their stored tables.

    A second run of the same records replaces their rows. Read with ``sinks.read_table``.
    """
    upsert_table(spark, outcomes, tagged.outcomes, record_id, record_id, overwrite_with_null=True, count_inserted=False)
    upsert_table(spark, assigned, tagged.assignments, "assignment_key", "assignment_key", overwrite_with_null=True,
                 count_inserted=False)
