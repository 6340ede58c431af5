"""Alert outbox: dedupe, due messages, state after an attempt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import MAX_ATTEMPTS, RETRY_MINUTES
from .dedup import dedup_first

PENDING, SENT, GIVEN_UP = "pending", "sent", "permanently_failed"


def outbox_dedupe(new: DataFrame, outbox: DataFrame, order: Sequence[str], message: str = "id") -> DataFrame:
    """New messages whose id the outbox does not hold; the first content of an id is kept.

    Copies are dropped before the join, so a storm of one alert is one row by then.
    """
    held = outbox.where(F.col("status").isin(PENDING, SENT, GIVEN_UP)).select(message)
    return dedup_first(new, [message], order).join(held, message, "left_anti")


def due_messages(outbox: DataFrame, now: Column) -> DataFrame:
    return outbox.where((F.col("status") == PENDING) & (F.col("next_attempt_at") <= now))


def outbox_advance(messages: DataFrame, results: DataFrame, now: Column, message: str = "id",
                   max_error: int | None = None) -> DataFrame:
    """Messages after one delivery round.

    ``results``: (id, ok, error) of the attempted ones. Failure adds an attempt
    and waits ``retry_minutes``; at ``max_attempts`` it is given up. Messages
    that were not due or not attempted stay as they are. ``max_error`` cuts the stored error text.
    """
    outcome = results.select(F.col(message), F.col("ok").alias("_ok"), F.col("error").alias("_error"))
    joined = messages.join(outcome, message, "left")
    tried = F.col("_ok").isNotNull() & (F.col("status") == PENDING) & (F.col("next_attempt_at") <= now)
    tried = F.coalesce(tried, F.lit(False))
    failed, sent = tried & ~F.col("_ok"), tried & F.col("_ok")
    attempts = F.when(failed, F.col("attempts") + 1).otherwise(F.col("attempts"))
    given_up = failed & (F.col("attempts") + 1 >= F.coalesce("max_attempts", F.lit(MAX_ATTEMPTS)))
    pause = F.make_interval(mins=F.coalesce("retry_minutes", F.lit(RETRY_MINUTES)))
    return joined.select(
        *[F.col(c) for c in messages.columns
          if c not in ("status", "attempts", "next_attempt_at", "last_error")],
        F.when(sent, SENT).when(given_up, GIVEN_UP).otherwise(F.col("status")).alias("status"),
        attempts.alias("attempts"),
        F.when(given_up, None).when(failed, now + pause).otherwise(F.col("next_attempt_at")).alias("next_attempt_at"),
        F.when(sent, "").when(failed, F.col("_error") if max_error is None else F.left("_error", F.lit(max_error))).otherwise(F.col("last_error"))
        .alias("last_error")).select(*messages.columns)


def outbox_status_counts(messages: DataFrame) -> DataFrame:
    """One row: checked, sent, pending, permanently failed."""
    status = F.col("status")
    return messages.agg(F.count(F.lit(1)).alias("checked"), F.count_if(status == SENT).alias("sent"),
                        F.count_if(status == PENDING).alias("pending"),
                        F.count_if(status == GIVEN_UP).alias("permanently_failed"))
