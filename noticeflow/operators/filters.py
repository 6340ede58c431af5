"""Row predicates and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ColumnOrName, as_col, is_blank
from ..schema import ALLOWED_CATEGORIES, BLANK_CATEGORY, MAX_CONTENT_CHARS, STAGE_AWARDED


def skip_blank_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows without any value."""
    return df.where(F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull())


def allow_categories(df: DataFrame, category: str, allowed: Sequence[str] = ALLOWED_CATEGORIES) -> DataFrame:
    return df.where(F.col(category).isin(*allowed))


def skipped_by_category(df: DataFrame, category: str,
                        allowed: Sequence[str] = ALLOWED_CATEGORIES) -> DataFrame:
    """Dropped rows per category; a blank category is shown as such."""
    name = F.coalesce(F.nullif(F.col(category), F.lit("")), F.lit(BLANK_CATEGORY))
    return (df.where(~F.coalesce(F.col(category).isin(*allowed), F.lit(False)))
            .groupBy(name.alias("category")).agg(F.count(F.lit(1)).alias("rows")))


def has_fields(*fields: ColumnOrName) -> Column:
    """All fields are present and not blank."""
    present = F.lit(True)
    for field in fields:
        present = present & ~is_blank(field)
    return present


def require_fields(df: DataFrame, fields: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(complete rows, incomplete rows)."""
    complete = has_fields(*fields)
    return df.where(complete), df.where(~complete)


def quarantine_reason(length: ColumnOrName, limit: int = MAX_CONTENT_CHARS) -> Column:
    return F.concat(F.lit("公告正文 "), as_col(length).cast("string"),
                    F.lit(f" 字符，超过 Salesforce 字段上限 {limit}；原文已完整保存在本机待处理队列"))


def quarantine_oversize(df: DataFrame, body: str, path: str, limit: int = MAX_CONTENT_CHARS,
                        length: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, oversized rows with path, length and reason); bodies stay whole.

    Name a ``length`` column where one exists: the split then reads no body.
    """
    size = F.length(body) if length is None else F.col(length)
    fits = df.where(F.coalesce(size <= limit, F.lit(True)))
    over = df.where(size > limit).select(
        "*", F.col(path).alias("Source_File_Path"), size.alias("Content_Length"),
        quarantine_reason(size, limit).alias("Block_Reason"))
    return fits, over


def same_day(started_at: ColumnOrName, day: ColumnOrName) -> Column:
    """First ten characters of a timestamp text equal the day."""
    return F.left(as_col(started_at).cast("string"), F.lit(10)) == as_col(day).cast("string")


def market_filter(df: DataFrame, stage: str, amount: str, day: str, first: str, last: str,
                  closed: Sequence[str] = (STAGE_AWARDED,)) -> DataFrame:
    """Closed records with an amount, published within the inclusive range."""
    return df.where(F.col(stage).isin(*closed) & F.col(amount).isNotNull()
                    & F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def criteria_equal(left: ColumnOrName, right: ColumnOrName) -> Column:
    """Same set of values, whatever the order or repetition."""
    def canonical(value):
        return F.array_sort(F.array_distinct(as_col(value)))

    return canonical(left) == canonical(right)
