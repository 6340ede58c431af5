"""Classifier input and output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import AMOUNT, VERDICT, VERDICT_BODY
from .text import WHITESPACE, ColumnOrName, as_col, bind, is_blank, truncate

# Labels of the classifier input, in order.
PROMPT_LABELS = ["规则名称", "规则语义", "公告标题", "项目名称", "平台行业", "匹配关键词", "公告类别", "公告正文"]
SEMANTICS_SEPARATOR = "；"
# Lengths of the notice contract. The functions cut only where they are passed.
PROMPT_BODY_CHARS = 6000
MAX_INDUSTRY, MAX_REASON = 80, 32768


def prompt_input(fields: Sequence[ColumnOrName], body_chars: int | None = None) -> Column:
    """Eight labelled lines; the last field is the body, cut to ``body_chars`` if given."""
    values = [as_col(f) for f in fields]
    if body_chars is not None:
        values[-1] = truncate(values[-1], body_chars)
    lines = [F.concat(F.lit(f"{label}："), F.coalesce(value.cast("string"), F.lit("")))
             for label, value in zip(PROMPT_LABELS, values, strict=True)]
    return F.concat_ws("\n", *lines)


def _strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE))


def _answer_text(data: Column) -> Column:
    """Top-level text, or the joined text parts of all messages."""
    messages = F.filter(F.coalesce(data["output"], F.array()), lambda m: m["type"] == "message")
    parts = F.flatten(F.transform(messages, lambda m: F.coalesce(m["content"], F.array())))
    texts = F.transform(F.filter(parts, lambda p: p["type"] == "output_text"), lambda p: p["text"])
    return _strip(F.when(is_blank(data["output_text"]), F.array_join(texts, "")).otherwise(data["output_text"]))


def _without_fence(raw: Column, bind) -> Column:
    """Content of a code fence; NULL when the fence has no line break."""
    def closed(inner: Column) -> Column:
        return F.when(F.endswith(inner, F.lit("```")), _strip(F.left(inner, F.length(inner) - 3))).otherwise(inner)

    newline = F.locate("\n", raw)
    opened = F.when(newline > 0, bind(_strip(F.substr(raw, newline + 1)), closed))
    return F.when(F.startswith(raw, F.lit("```")), opened).otherwise(raw)


def parse_verdict(body: ColumnOrName, bind=bind) -> Column:
    """Response JSON -> struct(matched, confidence, primary_industry, reason, error)."""
    def read(data: Column) -> Column:
        answer = bind(_answer_text(data), lambda raw: _without_fence(raw, bind))
        return F.struct(F.coalesce(data["status"], F.lit("")).alias("status"), answer.alias("answer"))

    def judge(found: Column) -> Column:
        verdict = F.from_json(found["answer"], VERDICT)
        return F.struct(found["status"].alias("status"), found["answer"].alias("answer"), verdict.alias("verdict"))

    def report(found: Column) -> Column:
        verdict = found["verdict"]
        # A struct of NULLs is what from_json gives for text that is not an object.
        parsed = F.coalesce(*[verdict[name].cast("string") for name in VERDICT.names]).isNotNull()
        error = (
            F.when(found["status"] != "completed", "incomplete response")
            .when(found["answer"].isNull(), "malformed code fence")
            .when(found["answer"] == "", "empty answer")
            .when(~parsed, "answer is not a verdict object"))
        usable = found["status"] == "completed"
        return F.struct(*[F.when(usable, verdict[name]).alias(name) for name in VERDICT.names],
                        error.alias("error"))

    return bind(bind(bind(F.from_json(as_col(body), VERDICT_BODY), read), judge), report)


def _text_or_null(value: Column) -> Column:
    return F.when(~is_blank(value) & (value != "null"), value)


def validate_verdict(verdict: ColumnOrName, max_industry: int | None = None, max_reason: int | None = None,
                     bind=bind) -> Column:
    """Checked verdict: typed confidence, texts cut where a length is given, and the first problem found."""
    def fitted(value: Column, length: int | None) -> Column:
        return value if length is None else truncate(value, length)

    def typed(v: Column) -> Column:
        return F.struct(
            v["matched"].alias("matched"), v["confidence"].try_cast(AMOUNT).alias("confidence"),
            fitted(_text_or_null(v["primary_industry"]), max_industry).alias("primary_industry"),
            fitted(_text_or_null(v["reason"]), max_reason).alias("reason"), v["error"].alias("error"))

    def checked(v: Column) -> Column:
        error = F.coalesce(
            v["error"],
            F.when(v["matched"].isNull(), F.lit("missing matched flag"))
            .when(v["confidence"].isNull(), F.lit("confidence is not a number"))
            .when((v["confidence"] < 0) | (v["confidence"] > 1), F.lit("confidence outside 0..1"))
            .when(v["reason"].isNull(), F.lit("missing reason")))
        in_range = v["confidence"].between(0, 1)
        return F.struct(
            v["matched"].alias("matched"),
            F.when(in_range, F.round(v["confidence"], 3).cast("decimal(5,3)")).alias("confidence"),
            v["primary_industry"].alias("primary_industry"), v["reason"].alias("reason"), error.alias("error"))

    return bind(bind(as_col(verdict), typed), checked)
