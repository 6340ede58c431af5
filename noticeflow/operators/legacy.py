"""Matching keyless target records to source records by several identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import composite_key, fingerprint, legacy_identity
from ..functions.text import clean, is_blank
from ..schema import LEGACY_FILLS

AMBIGUOUS, COLLISION = "ambiguous_identifiers", "multiple_remote_rows_for_one_source_key"


def notice_methods() -> dict[str, Column]:
    """The five identifiers of a notice, each as a digest; NULL when incomplete."""
    def single(name):
        return F.when(clean(name).isNotNull(), fingerprint([clean(name)]))

    parts = ["release_date__c", "bidstate__c", "bidcity__c", "type__c", "Name"]
    return {
        "swordfishwebsite__c": single("swordfishwebsite__c"),
        "website__c": single("website__c"),
        "content__c": single("content__c"),
        "legacy_composite": composite_key([*parts, "projectnumber__c"], required=5),
        "legacy_composite_without_number": composite_key(parts),
    }


def _identifiers(df: DataFrame, keep: Sequence[str], methods: dict[str, Column]) -> DataFrame:
    """One row per record and usable identifier: (keep..., method, value)."""
    pairs = F.array(*[F.struct(F.lit(m).alias("method"), value.alias("value")) for m, value in methods.items()])
    return df.select(*keep, F.inline(pairs)).where("value is not null")


def unique_index(df: DataFrame, key: str, methods: dict[str, Column]) -> DataFrame:
    """(method, value, key) for identifier values that point at exactly one source key.

    min = max decides uniqueness, so the aggregate combines on the map side and
    a value shared by a third of the rows is one partial row per task.
    """
    rows = _identifiers(df.where(~is_blank(key)), [key], methods)
    bounds = rows.groupBy("method", "value").agg(F.min(key).alias(key), F.max(key).alias("_last"))
    return bounds.where(F.col(key) == F.col("_last")).drop("_last")


def candidates(local: DataFrame, remote: DataFrame, key: str, remote_id: str,
               methods: dict[str, Column]) -> DataFrame:
    """(id, keys, methods) of every target row with at least one candidate source key.

    Both sides hold a digest per record and identifier, far more than their few columns take in
    a file, so a broadcast chosen by file size would not fit the driver: the joins here are by shuffle.
    """
    index = unique_index(local, key, methods)
    hits = _identifiers(remote, [remote_id], methods).join(index.hint("merge"), ["method", "value"])
    # At most one hit per method, so the collected sets hold a few items.
    return hits.groupBy(remote_id).agg(F.array_sort(F.collect_set(key)).alias("keys"),
                                       F.array_sort(F.collect_set("method")).alias("methods"))


def _settled(found: DataFrame, key: str, remote_id: str) -> DataFrame:
    """Per source key: how many target rows claim it, and one of them."""
    single = found.where(F.size("keys") == 1).select(remote_id, F.col("keys")[0].alias(key),
                                                     F.array_join("methods", ",").alias("match_methods"))
    claim = F.struct(remote_id, "match_methods")
    return single.groupBy(key).agg(F.count(F.lit(1)).alias("claims"), F.min(claim).alias("claim"))


def match_legacy(local: DataFrame, remote: DataFrame, key: str, remote_id: str,
                 methods: dict[str, Column] | None = None) -> DataFrame:
    """(id, key, match_methods) of target rows that agree on exactly one source key,
    which no other target row claims."""
    found = candidates(local, remote, key, remote_id, methods or notice_methods())
    return (_settled(found, key, remote_id).where("claims = 1")
            .select(F.col(f"claim.{remote_id}").alias(remote_id), key,
                    F.col("claim.match_methods").alias("match_methods")))


def match_report(local: DataFrame, remote: DataFrame, key: str, remote_id: str,
                 methods: dict[str, Column] | None = None) -> DataFrame:
    """One row: total, matched, unmatched, ambiguous, colliding keys and rows."""
    found = candidates(local, remote, key, remote_id, methods or notice_methods())
    # NULL stands for target rows with several candidate keys.
    claimed = found.groupBy(F.when(F.size("keys") == 1, F.col("keys")[0]).alias("k")).agg(
        F.count(F.lit(1)).alias("n"))
    one, many = F.col("k").isNotNull() & (F.col("n") == 1), F.col("k").isNotNull() & (F.col("n") > 1)

    def rows(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    counts = claimed.agg(rows(one).alias("matched"), rows(F.col("k").isNull()).alias("ambiguous"),
                         F.count_if(many).alias("colliding_keys"), rows(many).alias("colliding_rows"))
    total = remote.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.select(
        total.alias("remote_rows"), "matched", "ambiguous", "colliding_keys", "colliding_rows",
        (total - F.col("matched") - F.col("ambiguous") - F.col("colliding_rows")).alias("unmatched"))


def review_rows(local: DataFrame, remote: DataFrame, key: str, remote_id: str, details: Sequence[str],
                methods: dict[str, Column] | None = None) -> DataFrame:
    """Ambiguous and colliding target rows with their details, for a person to decide."""
    found = candidates(local, remote, key, remote_id, methods or notice_methods())
    claimed = _settled(found, key, remote_id).where("claims > 1").select(F.col(key).alias("_key"))
    listed = found.select(remote_id, "keys", F.array_join("keys", ";").alias("candidate_keys"),
                          F.array_join("methods", ",").alias("match_methods"))
    ambiguous = listed.where(F.size("keys") > 1).withColumn("reason", F.lit(AMBIGUOUS))
    colliding = (listed.where(F.size("keys") == 1)
                 .join(claimed.hint("merge"), F.col("keys")[0] == F.col("_key"), "left_semi")
                 .withColumn("reason", F.lit(COLLISION)))
    rows = ambiguous.unionByName(colliding).drop("keys")
    texts = [F.coalesce(clean(d), F.lit("")).alias(d) for d in details]
    return rows.join(remote.select(remote_id, *texts).hint("merge"), remote_id)


def match_method_counts(matched: DataFrame, column: str = "match_methods") -> DataFrame:
    """Matched rows per identifier."""
    return (matched.select(F.explode(F.split(column, ",")).alias("method"))
            .groupBy("method").agg(F.count(F.lit(1)).alias("rows")))


def notice_identity() -> Column:
    return legacy_identity("Full_Title__c", "Name", "Buyer_Name__c", "accountname__c", "release_date__c")


def legacy_overlap(local: DataFrame, remote: DataFrame, local_identity: Column | None = None,
                   remote_identity: Column | None = None) -> DataFrame:
    """One row: local rows whose fallback identity also occurs among keyless target rows."""
    mine = notice_identity() if local_identity is None else local_identity
    theirs = notice_identity() if remote_identity is None else remote_identity
    counted = (local.select(mine.alias("identity")).where("identity is not null")
               .groupBy("identity").agg(F.count(F.lit(1)).alias("n")))
    known = remote.select(theirs.alias("identity")).where("identity is not null").distinct()
    return counted.join(known, "identity", "left_semi").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("overlap_rows"))


def _fills(pairs: dict[str, str]) -> dict[str, Column]:
    return {new: is_blank(new) & ~is_blank(old) for new, old in pairs.items()}


def fill_from_legacy(df: DataFrame, row_id: str, pairs: dict[str, str] | None = None) -> DataFrame:
    """Rows where a blank new field can take its older value; other fields are repeated as they are."""
    pairs = pairs or LEGACY_FILLS
    flags = _fills(pairs)
    changed = F.lit(False)
    for flag in flags.values():
        changed = changed | flag
    return df.where(changed).select(
        row_id, *[F.when(flags[new], F.col(old)).otherwise(F.col(new)).alias(new) for new, old in pairs.items()])


def field_fill_counts(df: DataFrame, pairs: dict[str, str] | None = None) -> DataFrame:
    """Number of fills per new field."""
    pairs = pairs or LEGACY_FILLS
    flags = list(_fills(pairs).items())
    counts = df.agg(*[F.count_if(flag).alias(f"n{i}") for i, (_, flag) in enumerate(flags)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(new).alias("field"), F.col(f"n{i}").alias("fills")) for i, (new, _) in enumerate(flags)])))
