"""Rule-based tagging of notices with a pluggable classifier."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import assignment_key
from ..functions.text import Stages, bind, is_blank
from ..functions.verdicts import (MAX_INDUSTRY, MAX_REASON, PROMPT_BODY_CHARS, SEMANTICS_SEPARATOR, parse_verdict,
                                  prompt_input, validate_verdict)

# Fixed values of the tagging contract.
PENDING, DONE, FAILED = "待识别", "已识别", "失败"
RULE_CATEGORY, MAX_RULES, MAX_PENDING, MAX_MESSAGE = "biaoxun", 5, 10, 1000
RULE_BYTES, RULE_SHARES = 8_000_000, 64
NO_RULES, NO_SEMANTICS = "没有启用的标讯标签规则", "标讯规则没有有效语义项"


def pending_top_n(records: DataFrame, status: str, order: Sequence[str], limit: int = MAX_PENDING,
                  pending: str = PENDING) -> DataFrame:
    """The oldest records waiting for a verdict; 1 to 10 per call."""
    if not 1 <= limit <= MAX_PENDING:
        raise ValueError(f"limit must be 1..{MAX_PENDING}")
    return records.where(F.col(status) == pending).orderBy(*order).limit(limit)


def active_rules(rules: DataFrame, category: str = RULE_CATEGORY, limit: int = MAX_RULES) -> DataFrame:
    """The first active rules with a tag of the category, in creation order."""
    return (rules.where(F.col("is_active") & F.col("tag_id").isNotNull() & (F.col("tag_category") == category))
            .orderBy("created", "id").limit(limit))


def rule_semantics(rules: DataFrame, items: DataFrame) -> DataFrame:
    """Rules with the non-blank texts of their active items in creation order.

    Rules without any text are left out. Items are first reduced to the given
    rules, so only the texts that a verdict needs are gathered.
    """
    texts = (items.where(F.col("is_active") & ~is_blank("semantics"))
             .join(rules.select(F.col("id").alias("rule_id")), "rule_id", "left_semi")
             .groupBy("rule_id").agg(F.array_sort(F.collect_list(F.struct("created", "semantics"))).alias("_t")))
    listed = F.transform("_t", lambda t: t["semantics"])
    return rules.join(texts, rules["id"] == texts["rule_id"]).select(rules["*"], listed.alias("semantics"))


def records_with_rules(records: DataFrame, ruled: DataFrame) -> DataFrame:
    """Each record once per rule, as column ``rule``.

    Only the ids of the rules (five at most) travel as one array value that every
    record explodes; names and texts are joined. Rules of up to ``RULE_BYTES`` in all, measured first, are
    broadcast, so no record moves. Longer ones are joined by a shuffle in ``RULE_SHARES`` shares of the records:
    by rule alone, a task would read every record. Without usable rules a record keeps one row with a NULL rule.
    """
    listed = ruled.agg(F.array_sort(F.collect_list("id")).alias("r")).scalar()
    rule = F.struct("created", F.col("id").alias("rule_id"), "name", "tag_id", "semantics")
    rules = ruled.select(F.col("id").alias("_rule"), rule.alias("rule"))
    pairs = records.withColumn("_rule", F.explode_outer(listed))
    size = rules.agg(F.sum(F.octet_length(F.to_json("rule")).cast("bigint"))).first()[0] or 0
    if size <= RULE_BYTES:
        return pairs.join(F.broadcast(rules), "_rule", "left").drop("_rule")
    # The share follows from the record, so a task that is run again deals its rows out as before.
    plain = [f.name for f in records.schema if isinstance(f.dataType, T.AtomicType)]
    share = F.pmod(F.xxhash64(*plain), F.lit(RULE_SHARES)).cast("int") if plain else F.lit(0)
    shares = F.sequence(F.lit(0), F.lit(RULE_SHARES - 1))
    return (pairs.withColumn("_share", share)
            .join(rules.withColumn("_share", F.explode(shares)).hint("merge"), ["_rule", "_share"], "left").drop("_rule", "_share"))


def keyword_scorer(text: Column, semantics: Column) -> Column:
    """Deterministic stand-in for a classifier: a completed response saying which term occurs."""
    def answer(hits: Column) -> Column:
        matched = F.size(hits) > 0
        return F.to_json(F.struct(
            matched.alias("matched"),
            F.when(matched, F.lit(0.9)).otherwise(F.lit(0.5)).cast("decimal(5,3)").alias("confidence"),
            F.coalesce(F.try_element_at(hits, F.lit(1)), F.lit("")).alias("primary_industry"),
            F.when(matched, F.concat(F.lit("found "), F.array_join(hits, ", ")))
            .otherwise(F.lit("no term found")).alias("reason")))

    hits = F.filter(semantics, lambda term: F.contains(text, term))
    return F.to_json(F.struct(F.lit("completed").alias("status"), bind(hits, answer).alias("output_text")))


@dataclass
class CallScorer:
    """A model that is called with several records at once.

    ``open_model`` runs once in each task and returns a function from lists of texts and of
    semantics to a list of response bodies. A call gets up to ``per_call`` records (1 to 10).
    """

    open_model: Callable[[], Callable[[list[str], list[list[str]]], list[str]]]
    per_call: int = MAX_PENDING

    def __post_init__(self) -> None:
        if not 1 <= self.per_call <= MAX_PENDING:
            raise ValueError(f"per_call must be 1..{MAX_PENDING}")


def score_in_calls(pairs: DataFrame, text: str, scorer: CallScorer) -> DataFrame:
    """Add ``_body``, the model's response, and ``_failure``, the error of a call that failed.

    A failed call, or one with the wrong number of answers, fails the records of that call and no others. Pairs
    without a rule are not sent.
    """
    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in pairs.schema],
                           T.StructField("_body", T.StringType()), T.StructField("_failure", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in batches:
            rules = batch.column("rule").to_pylist()
            texts = batch.column(text).to_pylist()
            bodies: list[str | None] = [None] * batch.num_rows
            failures: list[str | None] = [None] * batch.num_rows
            ruled = [i for i, rule in enumerate(rules) if rule is not None]
            for start in range(0, len(ruled), scorer.per_call):
                chosen = ruled[start : start + scorer.per_call]
                try:
                    model = model or scorer.open_model()
                    answers = model([texts[i] or "" for i in chosen], [list(rules[i]["semantics"]) for i in chosen])
                    if len(answers) != len(chosen):
                        raise ValueError(f"{len(answers)} answers to {len(chosen)} records")
                    for i, answer in zip(chosen, answers, strict=True):
                        bodies[i] = answer
                except Exception as error:  # whatever the model raises belongs to its records
                    for i in chosen:
                        failures[i] = f"{type(error).__name__}: {error}"[:MAX_MESSAGE]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bodies, pa.string()), pa.array(failures, pa.string())],
                                             names=[*batch.schema.names, "_body", "_failure"])

    return pairs.mapInArrow(run, schema)


def classify(pairs: DataFrame, record_id: str, text: str,
             scorer: Callable[[Column, Column], Column] | CallScorer = keyword_scorer) -> DataFrame:
    """Verdict per (record, rule): a scorer turns (text, semantics) into a response body.

    Any Column expression will do, including a call of a ``pandas_udf``; a ``CallScorer`` gets several records a call.
    """
    failure = F.lit(None).cast("string")
    if isinstance(scorer, CallScorer):
        pairs = score_in_calls(pairs, text, scorer)
        body, failure = F.col("_body"), F.col("_failure")
    else:
        body = scorer(F.col(text), F.col("rule.semantics"))
    ruled = F.col("rule").isNotNull()

    def only_ruled(verdict: Column) -> Column:
        values = [F.when(ruled, verdict[f]).alias(f) for f in ("matched", "confidence", "primary_industry", "reason")]
        error = F.when(ruled, F.coalesce(failure, verdict["error"])).otherwise(NO_SEMANTICS)
        return F.struct(*values, error.alias("error"))

    steps = Stages(pairs)
    verdict = validate_verdict(parse_verdict(body, steps.bind), MAX_INDUSTRY, MAX_REASON, steps.bind)
    checked = steps.done(verdict=steps.bind(verdict, only_ruled)).drop("_body", "_failure")
    return checked.withColumn("assignment_key", assignment_key(record_id, "rule.rule_id"))


def classifier_input(pairs: DataFrame, name: str, project: str, industry: str, keywords: str,
                     category: str, body: str) -> DataFrame:
    """Add ``prompt``: the text a model is given for (record, rule)."""
    return pairs.withColumn("prompt", prompt_input([
        "rule.name", F.array_join("rule.semantics", SEMANTICS_SEPARATOR), name, project, industry,
        keywords, category, body], PROMPT_BODY_CHARS))


def first_verdict(verdicts: DataFrame, record_id: str) -> DataFrame:
    """Record-level outcome: first non-blank industry, reason and confidence of the first rule.

    One bad verdict fails the record. There are at most five verdicts each, so
    the aggregate's state is small.
    """
    place = F.struct("rule.created", "rule.rule_id")
    v = F.col("verdict")
    first_error = F.min_by(v["error"], F.when(v["error"].isNotNull(), place))
    failed = F.count(v["error"]) > 0

    def unless_failed(value):
        return F.when(~failed, value)

    return verdicts.groupBy(record_id).agg(
        F.when(failed, FAILED).otherwise(DONE).alias("ai_status"),
        unless_failed(F.min_by(v["primary_industry"], F.when(v["primary_industry"].isNotNull(), place)))
        .alias("primary_industry"),
        unless_failed(F.min_by(v["confidence"], place)).alias("confidence"),
        F.when(failed, F.left(first_error, F.lit(MAX_MESSAGE)))
        .otherwise(F.min_by(v["reason"], place)).alias("reason"))


def assignments(verdicts: DataFrame, outcomes: DataFrame, record_id: str, model: str) -> DataFrame:
    """Rule assignments of records whose verdicts were all usable, keyed for upsert."""
    good = outcomes.where(F.col("ai_status") == DONE).select(record_id)
    return verdicts.join(good, record_id, "left_semi").select(
        "assignment_key", record_id, F.col("rule.rule_id").alias("rule_id"),
        F.col("rule.tag_id").alias("tag_id"), F.col("verdict.matched").alias("is_matched"),
        F.col("verdict.confidence").alias("confidence"), F.col("verdict.reason").alias("reason"),
        F.lit(model).alias("model"))
