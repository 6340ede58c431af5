"""Column profiles of raw exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import fingerprint
from ..functions.text import ColumnOrName, as_col, clean, is_blank


def _unpivot(row: DataFrame, names: Sequence[str], measures: Sequence[str], label: str) -> DataFrame:
    """One wide metrics row -> one row per name."""
    items = F.array(*[F.struct(F.lit(n).alias(label), *[F.col(f"{m}_{i}").alias(m) for m in measures])
                      for i, n in enumerate(names)])
    return row.select(F.inline(items))


def profile_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: non-empty values and longest text, in one pass."""
    measures = []
    for i, name in enumerate(columns):
        text = clean(name)
        measures += [F.count(text).alias(f"nonempty_{i}"),
                     F.coalesce(F.max(F.length(text)), F.lit(0)).alias(f"max_length_{i}")]
    return _unpivot(df.agg(*measures), columns, ["nonempty", "max_length"], "column_name")


def profile_missing(df: DataFrame, missing: Sequence[str], lengths: Sequence[str] = (),
                    url: str | None = None, url_limit: int = 255) -> DataFrame:
    """One row: rows, blanks and unstripped length per column, URLs above the limit."""
    def longest(name):
        return F.coalesce(F.max(F.length(F.col(name).cast("string"))), F.lit(0)).alias(f"max_length_{name}")

    measures = [F.count(F.lit(1)).alias("rows")]
    measures += [F.count_if(is_blank(name)).alias(f"missing_{name}") for name in missing]
    measures += [longest(name) for name in [*missing, *lengths]]
    if url:
        measures.append(F.count_if(F.length(url) > url_limit).alias("url_over_limit"))
    return df.agg(*measures)


def _copies(df: DataFrame, value: Column) -> DataFrame:
    """(rows, distinct_values, duplicates) of a value; NULL is not counted."""
    per_value = df.select(value.alias("v")).where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    rows = F.coalesce(F.sum("n"), F.lit(0))
    return per_value.agg(rows.alias("rows"), F.count(F.lit(1)).alias("distinct_values"),
                         (rows - F.count(F.lit(1))).alias("duplicates"))


def duplicate_count(df: DataFrame, preferred: ColumnOrName, fallback: ColumnOrName | None = None) -> DataFrame:
    """Repeats of the first non-empty of two columns, e.g. platform URL or announcement URL."""
    value = F.nullif(as_col(preferred), F.lit(""))
    if fallback is not None:
        value = F.coalesce(value, as_col(fallback))
    return _copies(df, clean(value))


def duplicate_fingerprint(df: DataFrame, parts: Sequence[ColumnOrName], body: ColumnOrName,
                          body_chars: int | None = None) -> DataFrame:
    """Repeats of the tuple of parts and the body, or its first ``body_chars`` where a contract asks for that.

    Grouping is on a 64-character digest, so bodies are not shuffled.
    """
    head = F.coalesce(as_col(body), F.lit(""))
    if body_chars is not None:
        head = F.left(head, F.lit(body_chars))
    return _copies(df, fingerprint([*parts, head]))


def value_histogram(df: DataFrame, value: ColumnOrName, name: str = "value") -> DataFrame:
    text = F.coalesce(as_col(value).cast("string"), F.lit(""))
    return df.groupBy(text.alias(name)).agg(F.count(F.lit(1)).alias("rows"))


def distinct_count(df: DataFrame, value: ColumnOrName, approximate: bool = False) -> DataFrame:
    """Number of distinct texts; blank counts as one value."""
    text = F.coalesce(as_col(value).cast("string"), F.lit(""))
    count = F.approx_count_distinct(text) if approximate else F.count_distinct(text)
    return df.agg(count.alias("distinct_values"))


def header_variants(headers: DataFrame, header: str, separator: str = "|") -> DataFrame:
    """Files per header width. Variants of the same width are added up."""
    width = F.size(F.split(header, f"\\Q{separator}\\E", -1))
    return headers.groupBy(width.alias("width")).agg(F.count(F.lit(1)).alias("files"),
                                                     F.count_distinct(header).alias("variants"))
