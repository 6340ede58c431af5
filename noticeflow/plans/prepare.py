"""Raw sheet rows -> keyed, typed, de-duplicated notices with every row accounted for."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (classify_stage, clean, content_hash, fingerprint, fits_or_blank, parse_amount,
                         parse_day, quantize_half_up, truncate, unparsed_amount)
from ..operators.dedup import dedup_first
from ..operators.disposition import batch_report, counts_by_date, with_disposition
from ..operators.filters import (allow_categories, quarantine_oversize, skip_blank_rows,
                                 skipped_by_category)
from ..schema import (ALLOWED_CATEGORIES, COMPACT_FIELDS, COMPACT_SCALES, FALLBACK_TITLE, FIELD_RULES, KEY_COLUMNS,
                      MAX_CONTENT_CHARS, MAX_PROJECT_NUMBER, NOTICE_FIELDS, QUARANTINE_EXTRA,
                      RAW_COLUMNS, ROW_ORIGIN,
                      TITLE_CONTENT_CHARS)

# Length of the body, so that splits and reports need not read it.
BODY_LENGTH = "_length"
WARNING_FLAGS = ["_unparsed_amount", "_project_number_truncated"]


def complete() -> Column:
    """A notice has its two required fields; a missing body has no length."""
    return F.col("release_date__c").isNotNull() & F.col(BODY_LENGTH).isNotNull()


def _rule(raw: int, kind: str, length: int | None) -> Column:
    text = F.col(f"c{raw}")
    match kind:
        case "prefix":
            return truncate(text, length)
        case "fits":
            return fits_or_blank(text, length)
        case "day":
            return parse_day(text)
        case "amount":
            return parse_amount(text)
        case _:
            return text


def to_notices(raw: DataFrame) -> DataFrame:
    """The 44 notice fields plus row origin and warning flags.

    Cells are stripped in a projection of their own, once, and every rule reads
    the stripped cell.
    """
    cells = skip_blank_rows(raw, RAW_COLUMNS).select(*ROW_ORIGIN, *[clean(c).alias(c) for c in RAW_COLUMNS])
    dated = cells.withColumns({"_day": parse_day("c8"), "_title": F.coalesce(
        "c5", "c11", truncate("c7", TITLE_CONTENT_CHARS), F.lit(FALLBACK_TITLE))})
    fields = {name: _rule(*rule) for name, rule in FIELD_RULES.items()}
    fields |= {
        "release_date__c": F.col("_day"),
        "Source_Key__c": fingerprint(["_day", *[f"c{i}" for i in KEY_COLUMNS]]),
        "Name": truncate("_title", 80),
        "Full_Title__c": truncate("_title", 255),
        "Tender_Stage__c": classify_stage("c6"),
        "Source_Content_Hash__c": content_hash("c7"),
        "Source_File__c": truncate("_file", 255),
    }
    return dated.select(
        *[fields[name].alias(name) for name in NOTICE_FIELDS], *ROW_ORIGIN, F.length("c7").alias(BODY_LENGTH),
        (unparsed_amount("c15") | unparsed_amount("c16")).alias("_unparsed_amount"),
        F.coalesce(F.length("c13") > MAX_PROJECT_NUMBER, F.lit(False)).alias("_project_number_truncated"))


def project_to_target(notices: DataFrame, fields: dict[str, str] = COMPACT_FIELDS,
                      scales: dict[str, int] = COMPACT_SCALES) -> DataFrame:
    """Compact target row: renamed fields, amounts rounded half up."""
    return notices.select(*[
        (quantize_half_up(source, scales[target]) if target in scales else F.col(source)).alias(target)
        for source, target in fields.items()])


def _rules() -> tuple:
    """Key, order (path, sheet row), conditions and size limit of a notice row."""
    return ("Source_Key__c", ["_path", "_row"], F.col("Publication_Category__c").isin(*ALLOWED_CATEGORIES),
            complete(), F.col(BODY_LENGTH), MAX_CONTENT_CHARS)


def label_notices(notices: DataFrame) -> DataFrame:
    """Disposition of every row."""
    return with_disposition(notices, *_rules())


def notice_report(notices: DataFrame) -> DataFrame:
    """Counts of a batch, with its warnings."""
    return batch_report(notices, *_rules(), "_path", {flag.lstrip("_"): F.col(flag) for flag in WARNING_FLAGS})


def is_eligible() -> Column:
    """A row of an allowed category with its required fields."""
    return F.col("Publication_Category__c").isin(*ALLOWED_CATEGORIES) & complete()


def eligible(notices: DataFrame) -> DataFrame:
    """The eligible rows, by conditions that reach the scan."""
    return allow_categories(notices, "Publication_Category__c").where(complete())


def split_by_size(firsts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(written, quarantined) rows by body length."""
    fits, over = quarantine_oversize(firsts, "Source_Content__c", "_path", length=BODY_LENGTH)
    return fits.select(*NOTICE_FIELDS), over.select(*NOTICE_FIELDS, *QUARANTINE_EXTRA)


def split_firsts(notices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(written, quarantined): the first row of each key, split by body length."""
    return split_by_size(dedup_first(eligible(notices), ["Source_Key__c"], ["_path", "_row"]))


@dataclass
class Prepared:
    """Results of one batch; nothing runs until a frame is used."""

    written: DataFrame
    quarantined: DataFrame
    report: DataFrame
    by_date: DataFrame
    skipped: DataFrame
    incomplete: DataFrame


def prepare(raw: DataFrame) -> Prepared:
    """Filter, key, de-duplicate and split a batch of raw rows."""
    notices = to_notices(raw)
    written, quarantined = split_firsts(notices)
    return Prepared(
        written=written, quarantined=quarantined,
        report=notice_report(notices),
        by_date=counts_by_date(written, "release_date__c"),
        skipped=skipped_by_category(notices, "Publication_Category__c"),
        incomplete=allow_categories(notices, "Publication_Category__c").where(~complete()))
