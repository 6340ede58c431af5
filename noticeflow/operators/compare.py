"""Key comparison and record reconciliation between a source and a target."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean
from ..schema import AMOUNT
from .dedup import dedup_last


def key_presence(local: DataFrame, remote: DataFrame, key: str) -> DataFrame:
    """(key, local_rows, remote_rows) for every key on either side.

    Both sides are stacked and counted, so one combining shuffle of keys does
    the work of a full outer join, and hot keys collapse before it.
    """
    sides = (local.select(F.col(key), F.lit(1).alias("l"), F.lit(0).alias("r"))
             .unionByName(remote.select(F.col(key), F.lit(0).alias("l"), F.lit(1).alias("r"))))
    return sides.groupBy(key).agg(F.sum("l").alias("local_rows"), F.sum("r").alias("remote_rows"))


def compare_keys(local: DataFrame, remote: DataFrame, key: str,
                 ignore_keyless: bool = False) -> DataFrame:
    """What an upsert would insert and update, and whether it is safe.

    A blank target key is a keyless row. Keyless rows block unless ignored.
    ``remote_rows_with_key`` is the length of the target list as passed, blanks included.
    """
    both = key_presence(local, remote, key)
    has_key = F.coalesce(F.col(key).cast("string") != "", F.lit(False))
    on_local, on_remote = F.col("local_rows") > 0, (F.col("remote_rows") > 0) & has_key
    total = both.agg(
        F.coalesce(F.sum("local_rows"), F.lit(0)).alias("local_rows"),
        F.count_if(on_local).alias("local_unique_keys"),
        F.count_if(on_local & on_remote).alias("existing_rows_to_update"),
        F.count_if(on_local & ~on_remote).alias("new_rows_to_insert"),
        F.coalesce(F.sum("remote_rows"), F.lit(0)).alias("remote_rows_with_key"),
        F.count_if(on_remote).alias("remote_unique_keys"),
        F.coalesce(F.sum(F.when(~has_key, F.col("remote_rows"))), F.lit(0)).alias("remote_rows_without_key"),
        F.count_if(F.col("local_rows") > 1).alias("duplicate_local_keys"),
        F.count_if((F.col("remote_rows") > 1) & has_key).alias("duplicate_remote_keys"))
    keyless = F.col("remote_rows_without_key")
    return total.select(
        "*", (keyless if ignore_keyless else F.lit(0).cast("bigint")).alias("legacy_rows_ignored"),
        ((F.col("duplicate_local_keys") == 0) & (F.col("duplicate_remote_keys") == 0)
         & (F.lit(ignore_keyless) | (keyless == 0))).alias("safe_to_upsert"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def insert_update_split(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Add ``action`` = insert or update to every source row."""
    known = target.select(key).distinct().withColumn("_known", F.lit(True))
    return (source.join(known, key, "left")
            .withColumn("action", F.when(F.col("_known"), "update").otherwise("insert")).drop("_known"))


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def reconcile_records(expected: DataFrame, actual: DataFrame, key: str, fields: Sequence[str],
                      order: Sequence[str]) -> DataFrame:
    """(measure, rows): differing values per field, unexpected and missing records.

    The last expected row of a key counts. Target rows are first reduced to one row per
    key and field values with its number of rows, so a hot key has collapsed before one
    outer join compares both sides. NULL keys match nothing.
    """
    def texts(prefix: str) -> list[Column]:
        return [_text(f).alias(f"{prefix}{i}") for i, f in enumerate(fields)]

    last = dedup_last(expected.select(key, *{*fields, *order} - {key}), [key], order)
    want = last.select(F.col(key).alias("_key"), *texts("w"), F.lit(True).alias("_wanted"))
    have = (actual.select(F.col(key).alias("_key"), *texts("h"))
            .groupBy("_key", *[f"h{i}" for i in range(len(fields))]).agg(F.count(F.lit(1)).alias("_rows")))
    pairs = have.join(want, "_key", "full_outer")
    both = F.col("_rows").isNotNull() & F.col("_wanted").isNotNull()

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_rows"))), F.lit(0))

    counts = pairs.agg(*[rows(both & (F.col(f"w{i}") != F.col(f"h{i}"))).alias(f"m{i}") for i in range(len(fields))],
                       rows(F.col("_wanted").isNull()).alias("unexpected"),
                       F.count_if(F.col("_rows").isNull()).alias("missing"))
    return counts.select(F.inline(F.array(
        *[F.struct(F.lit(f).alias("measure"), F.col(f"m{i}").alias("rows")) for i, f in enumerate(fields)],
        F.struct(F.lit("unexpected_record").alias("measure"), F.col("unexpected").alias("rows")),
        F.struct(F.lit("missing_record").alias("measure"), F.col("missing").alias("rows")))))


RANGES = 4096


def _range(key: str, ranges: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(ranges)).alias("_range")


def _range_sums(rows: DataFrame, key: str, fields: Sequence[str], ranges: int) -> DataFrame:
    """(_range, sums): per range of key hashes the rows, and sums over two hashes of key and field texts.

    Sums do not depend on the order of rows and count each copy of a row, so equal sums say that the rows agree (up to
    chance in 128 bits). Halves of hashes are added, so no sum leaves 64 bits below 2^31 rows.
    """
    texts = [_text(f) for f in fields]
    sizes = [F.length(t) for t in texts]
    hashed = rows.select(_range(key, ranges), F.col(key).isNull().cast("bigint").alias("keyless"),
                         F.xxhash64(key, *texts, *sizes).alias("h0"), F.xxhash64(F.lit(1), *sizes, *reversed(texts), key).alias("h1"))
    halves = [half for h in ("h0", "h1") for half in (F.col(h).bitwiseAND(2**32 - 1), F.shiftrightunsigned(h, 32))]
    sums = hashed.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.sum("keyless").alias("keyless"),
                                        *[F.sum(half).alias(f"s{i}") for i, half in enumerate(halves)])
    return sums.select("_range", F.struct("n", *[f"s{i}" for i in range(4)]).alias("sums"), "keyless")


def differing_ranges(expected: DataFrame, actual: DataFrame, key: str, fields: Sequence[str],
                     ranges: int = RANGES, unique_keys: bool = False) -> DataFrame:
    """(_range) in which the sides may differ: other rows, a row without a key, or a key with several expected rows.

    At most ``ranges`` + 1 rows. Finding repeated keys takes a shuffle of key hashes; ``unique_keys`` says that there are none.
    """
    left = _range_sums(expected, key, fields, ranges).select("_range", F.col("sums").alias("l"), F.col("keyless").alias("kl"))
    right = _range_sums(actual, key, fields, ranges).select("_range", F.col("sums").alias("r"), F.col("keyless").alias("kr"))
    keyless = F.coalesce("kl", F.lit(0)) + F.coalesce("kr", F.lit(0))
    found = left.join(right, "_range", "full_outer").where(~F.col("l").eqNullSafe(F.col("r")) | (keyless > 0)).select("_range")
    if unique_keys:
        return found
    repeated = (expected.select(F.xxhash64(key).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
                .where("n > 1").select(F.pmod("h", F.lit(ranges)).alias("_range")))
    return found.unionByName(repeated).distinct()


def reconcile_by_ranges(expected: DataFrame, actual: DataFrame, key: str, fields: Sequence[str], order: Sequence[str],
                        ranges: int = RANGES, unique_keys: bool = False) -> DataFrame:
    """``reconcile_records`` for sides that agree in most places; same result.

    Both sides are read twice: first for sums per range of key hashes, then for the rows of the ranges that differ. Rows
    of equal ranges take no part in any shuffle. Keys must be of one type on both sides, since their hashes are compared.
    """
    kinds = {side.schema[key].dataType for side in (expected, actual)}
    if len(kinds) > 1:
        raise TypeError(f"{key} has two types: {sorted(k.simpleString() for k in kinds)}")
    # ``ranges`` + 1 numbers at most, whatever the size of the tables.
    differing = F.broadcast(differing_ranges(expected, actual, key, fields, ranges, unique_keys))

    def left_over(side: DataFrame, columns: Sequence[str]) -> DataFrame:
        return side.select(*columns, _range(key, ranges)).join(differing, "_range", "left_semi").drop("_range")

    needed = dict.fromkeys([key, *fields])
    return reconcile_records(left_over(expected, [*dict.fromkeys([*needed, *order])]), left_over(actual, [*needed]), key, fields, order)


def field_coverage(expected: DataFrame, actual: DataFrame, fields: Sequence[str],
                   uncounted: Sequence[str] = ()) -> DataFrame:
    """Non-empty values per field on both sides; ``uncounted`` fields are flagged, not judged."""
    def filled(df, name):
        counts = df.agg(*[F.count(F.nullif(F.col(f).cast("string"), F.lit(""))).alias(f"n{i}")
                          for i, f in enumerate(fields)], F.count(F.lit(1)).alias("n_all"))
        return counts.select(F.inline(F.array(
            *[F.struct(F.lit(f).alias("field"), F.col(f"n{i}").alias(name)) for i, f in enumerate(fields)],
            F.struct(F.lit("*").alias("field"), F.col("n_all").alias(name)))))

    pairs = filled(expected, "expected_nonempty").join(filled(actual, "actual_nonempty"), "field")
    countable = ~F.col("field").isin(*uncounted) if uncounted else F.lit(True)
    return pairs.withColumn("matched", F.when(
        countable, F.col("expected_nonempty") == F.col("actual_nonempty")))


def coverage_samples(df: DataFrame, order: Sequence[str], predicates: dict[str, Column],
                     first: int = 3) -> DataFrame:
    """The first rows plus the first row meeting each predicate, labelled ``sample``.

    ``order`` must be unique. Scans of the order columns find the positions, one more reads the rows at them.
    """
    place = F.struct(*[F.col(c).alias(c) for c in order])
    heads = df.select(place.alias("p")).orderBy("p").limit(first)
    number = F.row_number().over(_global([F.col("p")]))
    rows = heads.select("p", F.concat(F.lit("row_"), number).alias("sample"))
    if predicates:
        found = df.agg(*[F.min(F.when(predicate, place)).alias(f"p{i}") for i, predicate in enumerate(predicates.values())])
        listed = F.array(*[F.struct(F.col(f"p{i}").alias("p"), F.lit(label).alias("sample"))
                           for i, label in enumerate(predicates)])
        rows = rows.unionByName(found.select(F.inline(listed)).where("p is not null"))
    # first + len(predicates) rows at most.
    wanted = rows.select(*[F.col(f"p.{c}").alias(c) for c in order], "sample")
    return df.join(F.broadcast(wanted), list(order)).select(*df.columns, "sample")


def _global(order: Sequence[Column]):
    # Only used over the few sampled rows.
    from pyspark.sql import Window
    return Window.orderBy(*order)


def reconcile_samples(samples: DataFrame, target: DataFrame, key: str, fields: Sequence[str],
                      decimals: Sequence[str] = ()) -> DataFrame:
    """(sample, found, <field>_equal...): exact equality of sampled records.

    ``found`` other than 1 is reported without checks. Amounts compare as numbers.
    """
    wanted = samples.select("sample", F.col(key).alias("_key"), *[F.col(f).alias(f"_w_{f}") for f in fields])
    # A handful of sampled rows by construction (first rows plus one per predicate).
    hits = target.select(key, *fields).join(F.broadcast(wanted.select("sample", "_key")),
                                            F.col(key) == F.col("_key"))
    seen = hits.groupBy("sample").agg(F.count(F.lit(1)).alias("found"),
                                      *[F.max(f).alias(f"_a_{f}") for f in fields])

    def equal(name: str) -> Column:
        want, have = F.col(f"_w_{name}"), F.col(f"_a_{name}")
        same = F.coalesce(want.cast("string"), F.lit("")) == F.coalesce(have.cast("string"), F.lit(""))
        if name in decimals:
            as_number = F.coalesce(want.cast("string").try_cast(AMOUNT) == have.cast("string").try_cast(AMOUNT),
                                   F.lit(False))
            same = F.when(clean(want).isNotNull(), as_number).otherwise(same)
        return F.when(F.col("found") == 1, same).alias(f"{name}_equal")

    joined = wanted.join(seen, "sample", "left")
    joined = joined.withColumn("found", F.coalesce("found", F.lit(0).cast("bigint")))
    return joined.select("sample", "found", *[equal(f) for f in fields])


def reconcile_verdict(coverage: DataFrame, samples: DataFrame, links: DataFrame) -> DataFrame:
    """One row: rows on both sides and whether all counts, samples and links agree.

    Takes the results of ``field_coverage``, ``reconcile_samples`` and ``reconcile_records``. A field that is not
    judged counts as no difference, a sample that was not found once as one.
    """
    total = F.col("field") == "*"
    same = [F.coalesce(F.col(c), F.lit(False)) for c in samples.columns if c.endswith("_equal")]
    good = reduce(lambda a, b: a & b, same, F.col("found") == 1)
    samples_ok = samples.agg((F.count_if(~good) == 0).alias("ok")).scalar()
    links_ok = links.agg((F.count_if(F.col("rows") != 0) == 0).alias("ok")).scalar()
    return coverage.agg(
        F.max(F.when(total, F.col("expected_nonempty"))).alias("expected_rows"),
        F.max(F.when(total, F.col("actual_nonempty"))).alias("actual_rows"),
        (F.count_if(~F.col("matched")) == 0).alias("all_count_checks_passed")).select(
            "*", samples_ok.alias("all_sample_checks_passed"), links_ok.alias("all_link_checks_passed"))


def missing_keys(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys only on the left: required minus described, queued minus exported."""
    return left.select(*key).distinct().join(right.select(*key), list(key), "left_anti")


def common_keys(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    return left.select(*key).distinct().join(right.select(*key), list(key), "left_semi")
