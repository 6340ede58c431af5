"""Helpers shared by the query bindings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeflow.functions.text import WHITESPACE
from noticeflow.operators.running import running_total

MONEY = "decimal(18,2)"
# The white-space set as a DuckDB expression, for trim(text, set).
SQL_WS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)
US = "chr(31)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def day(column: str):
    return F.col(column).cast("date")


def event_number():
    """The integer in the JSON property of an event."""
    return F.get_json_object("props", "$.k").cast("bigint")


SQL_EVENT_NUMBER = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

def text_files(spark, rows, order, text, path, most):
    """Text files of ``most`` bytes or less, the last line excepted: lines in order, cut by their running total.

    The number of files follows the input, and a task writes one of them. Gives the number of a file from its path.
    """
    lines = rows.select(order, text.alias("line")).withColumn("size", F.octet_length("line").cast("bigint") + 1)
    ends = running_total(lines.select(order, "size"), "size", [order], name="end")
    part = ends.select(order, F.expr(f"(end - size) div {most}").alias("part"))
    (lines.drop("size").join(part, order).repartition("part").sortWithinPartitions("part", order)
     .drop(order).write.partitionBy("part").text(path))
    return F.regexp_extract("path", "/part=([0-9]+)/", 1).cast("bigint").alias("part")


def sql_parts(order, line, most):
    """The number of the file that a line goes to, as SQL over the rows of one table."""
    size = f"(CAST(strlen({line}) AS BIGINT) + 1)"
    return f"CAST((sum({size}) OVER (ORDER BY {order}) - {size}) // {most} AS BIGINT)"
