"""Dates and amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import AMOUNT
from .text import WHITESPACE, ColumnOrName, as_col

DAY_PATTERN = r"[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}"
AMOUNT_LIMIT = 10 ** 15


def parse_day(value: ColumnOrName) -> Column:
    """First year-month-day in the text as DATE; NULL when absent or impossible."""
    found = F.regexp_extract(as_col(value).cast("string"), DAY_PATTERN, 0)
    day = F.try_to_date(F.translate(found, "/", "-"), "yyyy-M-d")
    return F.when(F.year(day) >= 1, day)


def _amount_text(value: ColumnOrName) -> Column:
    # Empty text does not cast, so it needs no special case.
    return F.btrim(F.translate(as_col(value).cast("string"), ",￥¥", ""), F.lit(WHITESPACE))


def parse_amount(value: ColumnOrName) -> Column:
    """Money text as DECIMAL(38,18); NULL when unreadable or |x| >= 10^15."""
    number = _amount_text(value).try_cast(AMOUNT)
    return F.when(F.abs(number) < AMOUNT_LIMIT, number)


def unparsed_amount(value: ColumnOrName) -> Column:
    """True where there is text but no readable amount."""
    return F.coalesce(_amount_text(value) != "", F.lit(False)) & parse_amount(value).isNull()


def quantize_half_up(value: ColumnOrName, scale: int) -> Column:
    """Round a DECIMAL half up to ``scale`` places."""
    return F.round(as_col(value).cast(AMOUNT), scale).cast(f"decimal(38,{scale})")
