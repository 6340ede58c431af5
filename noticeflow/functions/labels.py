"""Classification by fixed lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import (AWARDED_CATEGORIES, LOAD_SUCCESS, OPEN_CATEGORIES, REGIONS, STAGE_AWARDED,
                      STAGE_OPEN, STAGE_OTHER, STATUS_FAILED, STATUS_OK, STATUS_PARTIAL,
                      STATUS_WAITING)
from .text import ColumnOrName, as_col, bind


def classify_stage(category: ColumnOrName, awarded: Sequence[str] = AWARDED_CATEGORIES,
                   opened: Sequence[str] = OPEN_CATEGORIES,
                   labels: tuple[str, str, str] = (STAGE_AWARDED, STAGE_OPEN, STAGE_OTHER)) -> Column:
    category = as_col(category)
    return (F.when(category.isin(*awarded), labels[0])
            .when(category.isin(*opened), labels[1]).otherwise(labels[2]))


def region_rank(name: ColumnOrName, regions: Sequence[str] = REGIONS, strict: bool = True) -> Column:
    """Position of the single region the name starts with.

    None or several stop the job; without ``strict`` they give NULL, for
    ``gates.unknown_regions``.
    """
    name = as_col(name)
    listed = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(r).alias("prefix"))
                       for i, r in enumerate(regions)])
    hits = F.filter(listed, lambda r: F.startswith(name, r["prefix"]))
    problem = F.concat(F.lit("not the name of one region: "), F.coalesce(name, F.lit("NULL")))
    other = F.raise_error(problem).cast("int") if strict else F.lit(None).cast("int")
    return bind(hits, lambda found: F.when(F.size(found) == 1, found[0]["rank"]).otherwise(other))


def run_status(status: ColumnOrName, blocked_rows: ColumnOrName) -> Column:
    """Failed, waiting, partial or successful load run."""
    status = as_col(status)
    return (F.when(~F.coalesce(status.isin(*LOAD_SUCCESS), F.lit(False)), STATUS_FAILED)
            .when(status == "blocked_pending", STATUS_WAITING)
            .when(F.coalesce(as_col(blocked_rows), F.lit(0)) > 0, STATUS_PARTIAL)
            .otherwise(STATUS_OK))


def count_value(total: ColumnOrName | None = None, by_name: ColumnOrName | None = None) -> Column:
    """Total of a scalar count or of a map of counts, whichever is present."""
    parts = []
    if by_name is not None:
        values = F.map_values(as_col(by_name))
        parts.append(F.aggregate(values, F.lit(0).cast("bigint"),
                                 lambda acc, x: acc + F.coalesce(x.cast("bigint"), F.lit(0))))
    if total is not None:
        parts.append(as_col(total).cast("bigint"))
    return F.coalesce(*parts, F.lit(0).cast("bigint"))
