"""Deterministic keys and identities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import KEY_SEPARATOR
from .text import ColumnOrName, as_col, clean


def _joined(parts: Sequence[Column], separator: str) -> Column:
    # concat_ws drops NULLs, which would let different records share a key.
    return F.concat_ws(separator, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def fingerprint(parts: Sequence[ColumnOrName], separator: str = KEY_SEPARATOR) -> Column:
    """sha256 hex over the parts as they are, NULL as empty text."""
    return F.sha2(_joined([as_col(p) for p in parts], separator), 256)


def source_key(day: ColumnOrName, parts: Sequence[ColumnOrName]) -> Column:
    """sha256 hex over an ISO day and cleaned parts. URLs are left out on purpose."""
    return fingerprint([as_col(day), *[clean(p) for p in parts]])


def content_hash(value: ColumnOrName) -> Column:
    return F.sha2(F.coalesce(as_col(value), F.lit("")), 256)


def legacy_identity(title: ColumnOrName, name: ColumnOrName, buyer: ColumnOrName,
                    account: ColumnOrName, day: ColumnOrName) -> Column:
    """(title or name, buyer or account, day); NULL without a title or a day.

    The first choice wins when it is non-empty before stripping.
    """
    def either(first, second):
        chosen = F.coalesce(F.nullif(as_col(first), F.lit("")), as_col(second))
        return F.coalesce(clean(chosen), F.lit(""))

    title_text, buyer_text = either(title, name), either(buyer, account)
    return F.when((title_text != "") & as_col(day).isNotNull(),
                  F.struct(title_text.alias("title"), buyer_text.alias("buyer"),
                           as_col(day).alias("day")))


def composite_key(parts: Sequence[ColumnOrName], required: int | None = None) -> Column:
    """sha256 over cleaned parts; NULL unless the first ``required`` are non-blank."""
    cleaned = [clean(p) for p in parts]
    needed = cleaned[: len(cleaned) if required is None else required]
    complete = F.lit(True)
    for part in needed:
        complete = complete & part.isNotNull()
    return F.when(complete, fingerprint(cleaned))


def assignment_key(record_id: ColumnOrName, rule_id: ColumnOrName) -> Column:
    return fingerprint([record_id, rule_id], ":")


def message_id(dedupe_key: ColumnOrName, kind: ColumnOrName, subject: ColumnOrName,
               recipients: ColumnOrName) -> Column:
    """32 hex characters of the dedupe key, or of kind|subject|recipients."""
    identity = F.concat_ws("|", F.coalesce(as_col(kind), F.lit("")),
                           F.coalesce(as_col(subject), F.lit("")),
                           F.array_join(as_col(recipients), "|"))
    return F.left(F.sha2(F.coalesce(F.nullif(as_col(dedupe_key), F.lit("")), identity), 256), F.lit(32))


def valid_key(value: ColumnOrName) -> Column:
    """64 lower-case hex characters."""
    return F.coalesce(as_col(value).rlike(r"\A[0-9a-f]{64}\z"), F.lit(False))
