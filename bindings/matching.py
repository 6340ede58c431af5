"""Key comparison, upsert, reconciliation, legacy matching, manifests, schema checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from noticeflow.functions import fingerprint, legacy_identity
from noticeflow.operators import compare, gates, incremental, legacy
from noticeflow.session import shared_dir
from noticeflow.sinks import commit_manifest, compact_table, read_table, upsert, upsert_table

from .common import MONEY, day, table

Q: dict = {}
SQL: dict = {}


def _order_keys(spark, d):
    local = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"))
    remote = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"))
    return local, remote


Q["compare_keys"] = lambda spark, d: compare.compare_keys(*_order_keys(spark, d), "key")
SQL["compare_keys"] = """
WITH l AS (SELECT o_orderkey AS key, count(*) AS n FROM orders GROUP BY 1), r AS (SELECT l_orderkey AS key, count(*) AS n FROM lineitem GROUP BY 1)
SELECT (SELECT count(*) FROM orders) AS local_rows, (SELECT count(*) FROM l) AS local_unique_keys,
 (SELECT count(*) FROM l SEMI JOIN r USING (key)) AS existing_rows_to_update, (SELECT count(*) FROM l ANTI JOIN r USING (key)) AS new_rows_to_insert,
 (SELECT count(*) FROM lineitem) AS remote_rows_with_key, (SELECT count(*) FROM r) AS remote_unique_keys,
 0::BIGINT AS remote_rows_without_key, (SELECT count(*) FROM l WHERE n > 1) AS duplicate_local_keys,
 (SELECT count(*) FROM r WHERE n > 1) AS duplicate_remote_keys, 0::BIGINT AS legacy_rows_ignored,
 (SELECT count(*) FROM r WHERE n > 1) = 0 AS safe_to_upsert"""


def keyless(spark, d):
    local = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("key"))
    remote = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").select(
        F.when(F.col("quality").isNotNull(), F.col("doc_id").cast("string")).otherwise("").alias("key"))
    return compare.compare_keys(local, remote, "key", ignore_keyless=True)


Q["compare_keys_keyless"] = keyless
SQL["compare_keys_keyless"] = """
WITH c AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT count(*) FROM documents SEMI JOIN labels USING (doc_id)) AS k)
SELECT n AS local_rows, n AS local_unique_keys, k AS existing_rows_to_update, n - k AS new_rows_to_insert, n AS remote_rows_with_key,
 k AS remote_unique_keys, n - k AS remote_rows_without_key, 0::BIGINT AS duplicate_local_keys, 0::BIGINT AS duplicate_remote_keys,
 n - k AS legacy_rows_ignored, true AS safe_to_upsert FROM c"""

Q["insert_update_split"] = lambda spark, d: compare.insert_update_split(
    table(spark, d, "orders").select("o_orderkey"), table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")
SQL["insert_update_split"] = """SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN 'update' ELSE 'insert' END AS action FROM orders"""

Q["duplicate_keys"] = lambda spark, d: compare.duplicate_keys(table(spark, d, "lineitem"), "l_orderkey")
SQL["duplicate_keys"] = """SELECT l_orderkey, count(*) AS "rows" FROM lineitem GROUP BY 1 HAVING count(*) > 1"""


def _upsert_sides(spark, d):
    seen = table(spark, d, "events").groupBy(F.col("user_id").alias("id")).agg(
        F.lit("UNKNOWN").alias("segment"), F.sum(F.col("value").cast(MONEY)).cast(MONEY).alias("balance"),
        F.max(day("ts")).alias("last_seen"))
    loaded = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast(MONEY)).alias("balance"))
    return seen, loaded


Q["upsert"] = lambda spark, d: upsert(*_upsert_sides(spark, d), "id")
Q["upsert_incremental"] = lambda spark, d: upsert(*_upsert_sides(spark, d), "id", incremental=True)
Q["upsert_overwrite"] = lambda spark, d: upsert(*_upsert_sides(spark, d), "id", overwrite_with_null=True)
_SIDES = """
WITH t AS (SELECT user_id AS id, 'UNKNOWN' AS segment, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS balance,
  max(CAST(ts AS DATE)) AS last_seen FROM events GROUP BY 1),
 s AS (SELECT c_custkey AS id, c_mktsegment AS segment, CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS balance FROM customer)
"""
SQL["upsert"] = _SIDES + """SELECT id, coalesce(s.segment, t.segment) AS segment, coalesce(s.balance, t.balance) AS balance, last_seen
 FROM t FULL JOIN s USING (id)"""
SQL["upsert_incremental"] = SQL["upsert"]
SQL["upsert_overwrite"] = _SIDES + """SELECT id, coalesce(s.segment, t.segment) AS segment,
 CASE WHEN s.segment IS NOT NULL THEN s.balance ELSE t.balance END AS balance, last_seen FROM t FULL JOIN s USING (id)"""


def _stored_orders(spark, d):
    """Orders as a stored table with blank partitions, and a load that moves, blanks and adds rows."""
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("part"),
        F.col("o_totalprice").cast(MONEY).alias("amount"), F.col("o_orderpriority").alias("note"))
    moved = F.when(F.col("id") % 2 == 0, F.lit("moved")).otherwise(F.col("part"))
    changed = orders.where("id % 3 = 0").select(
        "id", moved.alias("part"), F.when(F.col("id") % 5 != 0, F.col("amount") + 1).cast(MONEY).alias("amount"))
    added = table(spark, d, "customer").select(
        (-F.col("c_custkey") - 1).alias("id"), F.lit(None).cast("string").alias("part"), F.col("c_acctbal").cast(MONEY).alias("amount"))
    return orders, changed.unionByName(added)


def upsert_stored(spark, d):
    root = shared_dir(spark, "stored")
    orders, batch = _stored_orders(spark, d)
    first = upsert_table(spark, root, orders, "id", "part")
    second = upsert_table(spark, root, batch, "id", "part")
    compact_table(spark, root, "id", "part")
    upsert_table(spark, root, batch.where("id < 0").limit(0), "id", "part")
    return read_table(spark, root, "id").select("*", F.lit(first["inserted"]).alias("first_inserted"),
                                                F.lit(second["inserted"]).alias("second_inserted"))


Q["upsert_partitions"] = upsert_stored
SQL["upsert_partitions"] = """
WITH t AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS part, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
  o_orderpriority AS note FROM orders)
SELECT id, CASE WHEN id % 3 = 0 AND id % 2 = 0 THEN 'moved' ELSE part END AS part,
 CASE WHEN id % 3 = 0 AND id % 5 <> 0 THEN CAST(amount + 1 AS DECIMAL(18,2)) ELSE amount END AS amount, note,
 (SELECT count(*) FROM orders) AS first_inserted, (SELECT count(*) FROM customer) AS second_inserted FROM t
UNION ALL SELECT -c_custkey - 1, NULL, CAST(c_acctbal AS DECIMAL(18,2)), NULL, (SELECT count(*) FROM orders), (SELECT count(*) FROM customer) FROM customer"""


def _parties(spark, d):
    customers = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").cast(MONEY).alias("balance"),
        F.lower("c_mktsegment").alias("segment"))
    suppliers = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").cast(MONEY).alias("balance"),
        F.lit("building").alias("segment"))
    return customers, suppliers


Q["reconcile_records"] = lambda spark, d: compare.reconcile_records(
    *_parties(spark, d), "id", ["nation", "balance", "segment"], ["balance"])
SQL["reconcile_records"] = """
WITH p AS (SELECT * FROM supplier LEFT JOIN customer ON s_suppkey = c_custkey)
SELECT 'nation' AS measure, count(*) FILTER (c_nationkey <> s_nationkey) AS "rows" FROM p
UNION ALL SELECT 'balance', count(*) FILTER (c_acctbal <> s_acctbal) FROM p
UNION ALL SELECT 'segment', count(*) FILTER (c_mktsegment <> 'BUILDING') FROM p
UNION ALL SELECT 'unexpected_record', count(*) FILTER (c_custkey IS NULL) FROM p
UNION ALL SELECT 'missing_record', count(*) FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)"""


def _bodies(spark, d):
    """Documents, and a later state of them: reversed digests where a body names a token, one source gone."""
    bodies = table(spark, d, "documents").select("doc_id", "source", F.sha2("text", 256).alias("body"), F.col("text").contains("token").alias("named"))
    later = bodies.where(F.coalesce("source", F.lit("")) != "src3").withColumn("body", F.when(F.col("named"), F.reverse("body")).otherwise(F.col("body")))
    return bodies, later


Q["reconcile_by_ranges"] = lambda spark, d: compare.reconcile_by_ranges(*_bodies(spark, d), "doc_id", ["body", "source"], ["body"])
SQL["reconcile_by_ranges"] = """
WITH e AS (SELECT doc_id, coalesce(source, '') AS source, sha256(text) AS body, contains(text, 'token') AS named FROM documents),
 a AS (SELECT doc_id, source, CASE WHEN named THEN reverse(body) ELSE body END AS body FROM e WHERE source <> 'src3'),
 p AS (SELECT e.body AS want, a.body AS have, e.doc_id AS w, a.doc_id AS h, e.source AS ws, a.source AS hs FROM e FULL JOIN a ON e.doc_id = a.doc_id)
SELECT 'body' AS measure, count(*) FILTER (want <> have) AS "rows" FROM p
UNION ALL SELECT 'source', count(*) FILTER (ws <> hs) FROM p
UNION ALL SELECT 'unexpected_record', count(*) FILTER (w IS NULL) FROM p
UNION ALL SELECT 'missing_record', count(*) FILTER (h IS NULL) FROM p"""


def coverage(spark, d):
    # Only presence is counted, so bodies enter the joins as digests.
    bodies = table(spark, d, "documents").select(
        "doc_id", "lang", F.when(F.col("text") != "", F.sha2("text", 256)).alias("text"))
    docs = bodies.join(table(spark, d, "labels"), "doc_id", "left")
    labels = table(spark, d, "labels").join(bodies, "doc_id", "left")
    return compare.field_coverage(docs, labels, ["text", "lang", "quality", "toxic"], ["text"])


Q["field_coverage"] = coverage
SQL["field_coverage"] = "WITH e AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)), a AS (SELECT * FROM labels LEFT JOIN documents USING (doc_id))" + " UNION ALL ".join(
    f""" SELECT '{name}' AS field, x AS expected_nonempty, y AS actual_nonempty, {'NULL' if name == 'text' else 'x = y'} AS matched
 FROM (SELECT (SELECT count({expr}) FROM e) AS x, (SELECT count({expr}) FROM a) AS y)"""
    for name, expr in [("text", "nullif(text, '')"), ("lang", "nullif(lang, '')"), ("quality", "quality"), ("toxic", "toxic"), ("*", "*")])


def sample_check(spark, d):
    docs = table(spark, d, "documents")
    samples = compare.coverage_samples(docs, ["doc_id"], {
        "german": F.col("lang") == "de", "long_body": F.col("n_chars") > 10000, "copied": F.col("source") == "src0"})
    target = docs.select(
        "doc_id", F.when(F.col("lang") == "de", F.upper("text")).otherwise(F.col("text")).alias("text"),
        "source", F.col("n_chars").cast(MONEY).cast("string").alias("n_chars"))
    return compare.reconcile_samples(samples, target, "doc_id", ["text", "source", "n_chars"], ["n_chars"])


Q["reconcile_samples"] = sample_check
SQL["reconcile_samples"] = """
WITH s AS (SELECT 'row_' || row_number() OVER (ORDER BY doc_id) AS sample, * FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 3)
 UNION ALL SELECT 'german', * FROM (SELECT * FROM documents WHERE lang = 'de' ORDER BY doc_id LIMIT 1)
 UNION ALL SELECT 'long_body', * FROM (SELECT * FROM documents WHERE n_chars > 10000 ORDER BY doc_id LIMIT 1)
 UNION ALL SELECT 'copied', * FROM (SELECT * FROM documents WHERE source = 'src0' ORDER BY doc_id LIMIT 1))
SELECT sample, 1::BIGINT AS found, CASE WHEN lang = 'de' THEN upper(text) = text ELSE true END AS text_equal,
 true AS source_equal, true AS n_chars_equal FROM s"""

def reconciled(spark, d):
    """Suppliers as the loaded form of the customers: one row that says whether all of it agrees."""
    customers, suppliers = _parties(spark, d)
    samples = compare.coverage_samples(customers, ["id"], {"owing": F.col("balance") < 0})
    return compare.reconcile_verdict(
        compare.field_coverage(customers, suppliers, ["nation", "balance", "segment"], ["segment"]),
        compare.reconcile_samples(samples, suppliers, "id", ["nation", "balance"], ["balance"]),
        compare.reconcile_records(customers, suppliers, "id", ["nation", "balance", "segment"], ["balance"]))


Q["reconcile_report"] = reconciled
SQL["reconcile_report"] = """
WITH s AS (SELECT * FROM (SELECT * FROM customer ORDER BY c_custkey LIMIT 3) UNION ALL
  SELECT * FROM (SELECT * FROM customer WHERE c_acctbal < 0 ORDER BY c_custkey LIMIT 1)),
 p AS (SELECT * FROM customer FULL JOIN supplier ON s_suppkey = c_custkey)
SELECT (SELECT count(*) FROM customer) AS expected_rows, (SELECT count(*) FROM supplier) AS actual_rows,
 (SELECT count(*) FROM customer) = (SELECT count(*) FROM supplier) AS all_count_checks_passed,
 (SELECT bool_and(coalesce(s_nationkey = c_nationkey AND s_acctbal = c_acctbal, false)) FROM s LEFT JOIN supplier ON s_suppkey = c_custkey) AS all_sample_checks_passed,
 (SELECT bool_and(coalesce(s_nationkey = c_nationkey AND s_acctbal = c_acctbal AND c_mktsegment = 'BUILDING', false)) FROM p) AS all_link_checks_passed"""

# --- legacy matching ----------------------------------------------------------

PART_FIELDS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


def _part_methods():
    return {
        "name_price": fingerprint(["p_name", F.floor("p_retailprice")]),
        "brand_type_size": F.when(F.col("p_type") != "", fingerprint(["p_brand", "p_type", "p_size"])),
        "name_brand_type": F.when(F.col("p_type") != "", fingerprint(["p_name", "p_brand", "p_type"])),
    }


def _part_sides(spark, d):
    """Parts, and a keyless older copy in which sizes, types and names have drifted."""
    local = table(spark, d, "part").withColumn("key", F.format_string("K%09d", "p_partkey"))
    remote = table(spark, d, "part").select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_type") == "PROMO", F.col("p_size") + 1).otherwise(F.col("p_size")).alias("p_size"),
        F.when(F.col("p_size") < 8, "").otherwise(F.col("p_type")).alias("p_type"),
        F.when(F.col("p_brand") == "Brand#2", F.upper("p_name")).otherwise(F.col("p_name")).alias("p_name"),
        "p_brand", F.when(F.col("p_type") == "LARGE", F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")).alias("p_retailprice"))
    return local, remote


_LEGACY = """
WITH local AS (SELECT *, printf('K%09d', p_partkey) AS key FROM part),
remote AS (SELECT p_partkey AS id, CASE WHEN p_type = 'PROMO' THEN p_size + 1 ELSE p_size END AS p_size,
  CASE WHEN p_size < 8 THEN '' ELSE p_type END AS p_type, CASE WHEN p_brand = 'Brand#2' THEN upper(p_name) ELSE p_name END AS p_name, p_brand,
  CASE WHEN p_type = 'LARGE' THEN p_retailprice + 1 ELSE p_retailprice END AS p_retailprice FROM part),
lv AS (SELECT key, 'name_price' AS m, p_name || '|' || CAST(floor(p_retailprice) AS BIGINT) AS v FROM local
  UNION ALL SELECT key, 'brand_type_size', p_brand || '|' || p_type || '|' || p_size FROM local WHERE p_type <> ''
  UNION ALL SELECT key, 'name_brand_type', p_name || '|' || p_brand || '|' || p_type FROM local WHERE p_type <> ''),
rv AS (SELECT id, 'name_price' AS m, p_name || '|' || CAST(floor(p_retailprice) AS BIGINT) AS v FROM remote
  UNION ALL SELECT id, 'brand_type_size', p_brand || '|' || p_type || '|' || p_size FROM remote WHERE p_type <> ''
  UNION ALL SELECT id, 'name_brand_type', p_name || '|' || p_brand || '|' || p_type FROM remote WHERE p_type <> ''),
idx AS (SELECT m, v, min(key) AS key FROM lv GROUP BY m, v HAVING count(DISTINCT key) = 1),
cand AS (SELECT id, list_sort(list(DISTINCT key)) AS keys, list_sort(list(DISTINCT m)) AS methods FROM rv JOIN idx USING (m, v) GROUP BY id),
claims AS (SELECT keys[1] AS key, count(*) AS n FROM cand WHERE len(keys) = 1 GROUP BY 1),
matched AS (SELECT id, keys[1] AS key, array_to_string(methods, ',') AS match_methods FROM cand JOIN claims ON keys[1] = claims.key WHERE len(keys) = 1 AND n = 1)
"""

Q["match_legacy"] = lambda spark, d: legacy.match_legacy(*_part_sides(spark, d), "key", "id", _part_methods())
SQL["match_legacy"] = _LEGACY + "SELECT id, key, match_methods FROM matched"

Q["match_report"] = lambda spark, d: legacy.match_report(*_part_sides(spark, d), "key", "id", _part_methods())
SQL["match_report"] = _LEGACY + """
SELECT *, remote_rows - matched - ambiguous - colliding_rows AS unmatched FROM (SELECT (SELECT count(*) FROM remote) AS remote_rows,
 (SELECT count(*) FROM matched) AS matched, (SELECT count(*) FROM cand WHERE len(keys) > 1) AS ambiguous,
 (SELECT count(*) FROM claims WHERE n > 1) AS colliding_keys, (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM claims WHERE n > 1) AS colliding_rows)"""

Q["review_rows"] = lambda spark, d: legacy.review_rows(
    *_part_sides(spark, d), "key", "id", ["p_name", "p_brand"], _part_methods())
SQL["review_rows"] = _LEGACY + """
SELECT id, array_to_string(keys, ';') AS candidate_keys, array_to_string(methods, ',') AS match_methods,
 CASE WHEN len(keys) > 1 THEN 'ambiguous_identifiers' ELSE 'multiple_remote_rows_for_one_source_key' END AS reason, p_name, p_brand
 FROM cand JOIN remote USING (id) LEFT JOIN claims ON len(keys) = 1 AND keys[1] = claims.key WHERE len(keys) > 1 OR n > 1"""

Q["match_method_counts"] = lambda spark, d: legacy.match_method_counts(
    legacy.match_legacy(*_part_sides(spark, d), "key", "id", _part_methods()))
SQL["match_method_counts"] = _LEGACY + """
SELECT method, count(*) AS "rows" FROM (SELECT unnest(string_split(match_methods, ',')) AS method FROM matched) GROUP BY method"""

Q["unique_index"] = lambda spark, d: legacy.unique_index(
    _part_sides(spark, d)[0], "key", _part_methods()).groupBy("method").agg(F.count(F.lit(1)).alias("rows"))
SQL["unique_index"] = _LEGACY + """SELECT m AS method, count(*) AS "rows" FROM idx GROUP BY m"""


def overlap(spark, d):
    lines, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    none = F.lit(None).cast("string")
    return legacy.legacy_overlap(
        lines, orders, legacy_identity("l_linestatus", none, none, F.lit(" "), day("l_shipdate")),
        legacy_identity(F.lit(""), "o_orderstatus", F.lit(""), none, day("o_orderdate")))


Q["legacy_overlap"] = overlap
SQL["legacy_overlap"] = """SELECT count(*) AS overlap_rows FROM lineitem WHERE (l_linestatus, CAST(l_shipdate AS DATE)) IN
 (SELECT (o_orderstatus, CAST(o_orderdate AS DATE)) FROM orders)"""


def _fill_rows(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "supplier"), F.col("c_custkey") == F.col("s_suppkey"), "left").select(
        "c_custkey", "s_name", "c_name", F.col("s_acctbal").cast(MONEY).cast("string").alias("s_bal"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal").cast(MONEY).cast("string")).alias("c_bal"))


FILLS = {"s_name": "c_name", "s_bal": "c_bal"}
Q["fill_from_legacy"] = lambda spark, d: legacy.fill_from_legacy(_fill_rows(spark, d), "c_custkey", FILLS)
_FILL = """WITH r AS (SELECT c_custkey, s_name, c_name, CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS s_bal,
 CASE WHEN c_acctbal > 0 THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS c_bal FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey)
"""
SQL["fill_from_legacy"] = _FILL + """SELECT c_custkey, coalesce(s_name, c_name) AS s_name, coalesce(s_bal, c_bal) AS s_bal FROM r
 WHERE (s_name IS NULL AND c_name IS NOT NULL) OR (s_bal IS NULL AND c_bal IS NOT NULL)"""
Q["field_fill_counts"] = lambda spark, d: legacy.field_fill_counts(_fill_rows(spark, d), FILLS)
SQL["field_fill_counts"] = _FILL + """SELECT 's_name' AS field, count(*) FILTER (s_name IS NULL AND c_name IS NOT NULL) AS fills FROM r
 UNION ALL SELECT 's_bal', count(*) FILTER (s_bal IS NULL AND c_bal IS NOT NULL) FROM r"""

# --- manifests and quarantine -------------------------------------------------


def _page_files(spark, d):
    return table(spark, d, "pages").select(F.col("url").alias("path"), F.sha2("html", 256).alias("sha256"))


def _page_manifest(spark, d):
    """http pages were loaded (French ones in another version); German https pages were reviewed."""
    pages = table(spark, d, "pages")
    plain = F.startswith("url", F.lit("http:"))
    loaded = pages.where(plain).select(
        F.col("url").alias("path"), F.sha2(F.when(F.contains("html", F.lit('lang="fr"')), F.upper("html")).otherwise(F.col("html")), 256)
        .alias("sha256"), F.lit("files").alias("ledger"))
    reviewed = pages.where(~plain & F.contains("html", F.lit('lang="de"'))).select(
        F.col("url").alias("path"), F.sha2("html", 256).alias("sha256"), F.lit("reviewed").alias("ledger"))
    return loaded.unionByName(reviewed)


_MANIFEST = """
WITH f AS (SELECT url AS path, sha256(html) AS sha256 FROM pages),
m AS (SELECT url AS path, sha256(CASE WHEN contains(html, 'lang="fr"') THEN upper(html) ELSE html END) AS sha256, 'files' AS ledger
   FROM pages WHERE url LIKE 'http:%'
  UNION ALL SELECT url, sha256(html), 'reviewed' FROM pages WHERE url NOT LIKE 'http:%' AND contains(html, 'lang="de"'))
"""
Q["pending_files"] = lambda spark, d: incremental.pending_files(_page_files(spark, d), _page_manifest(spark, d))
SQL["pending_files"] = _MANIFEST + "SELECT path, sha256 FROM f ANTI JOIN (SELECT * FROM m WHERE ledger = 'files') g USING (path, sha256)"
Q["pending_files_guarded"] = lambda spark, d: incremental.pending_files(
    _page_files(spark, d), _page_manifest(spark, d), guarded=True)
SQL["pending_files_guarded"] = _MANIFEST + "SELECT path, sha256 FROM f ANTI JOIN m USING (path, sha256)"
Q["exclude_reviewed"] = lambda spark, d: incremental.exclude_reviewed(_page_files(spark, d), _page_manifest(spark, d))
SQL["exclude_reviewed"] = _MANIFEST + "SELECT path, sha256 FROM f ANTI JOIN (SELECT * FROM m WHERE ledger = 'reviewed') g USING (path, sha256)"

def manifest_roundtrip(spark, d):
    """Commit all page files, then the French ones with new content; the newest digest counts."""
    path = shared_dir(spark, "manifest")
    commit_manifest(_page_files(spark, d), path, "job-1")
    french = table(spark, d, "pages").where(F.contains("html", F.lit('lang="fr"'))).select(
        F.col("url").alias("path"), F.sha2(F.concat("html", F.lit(" v2")), 256).alias("sha256"))
    commit_manifest(french, path, "job-2")
    return incremental.latest_manifest(spark.read.parquet(path)).select("path", "sha256", "ledger", "job_id")


Q["commit_manifest"] = manifest_roundtrip
SQL["commit_manifest"] = """SELECT url AS path, sha256(CASE WHEN contains(html, 'lang="fr"') THEN html || ' v2' ELSE html END) AS sha256,
 'files' AS ledger, CASE WHEN contains(html, 'lang="fr"') THEN 'job-2' ELSE 'job-1' END AS job_id FROM pages"""

Q["cutover_seed"] = lambda spark, d: incremental.cutover_seed(_page_files(spark, d), _page_manifest(spark, d))
SQL["cutover_seed"] = _MANIFEST + """, g AS (SELECT path, sha256 FROM m WHERE ledger = 'files')
SELECT 'conflict' AS status, (SELECT count(*) FROM f) AS files, (SELECT count(*) FROM g) AS recorded,
 (SELECT count(*) FROM f ANTI JOIN g USING (path, sha256)) + (SELECT count(*) FROM g ANTI JOIN f USING (path, sha256)) AS different"""


def quarantine_queue(spark, d):
    docs = table(spark, d, "documents").select(
        F.col("source").alias("path"), F.col("n_chars").alias("row"), "doc_id", "lang")
    rescanned = docs.where("row > 15000").select("path")
    merged = incremental.merge_quarantine(
        docs.withColumn("origin", F.lit("queue")), docs.where("lang <> 'en'").withColumn("origin", F.lit("run")),
        rescanned, "path", "row", ["doc_id"])
    return merged.select("path", "row", "doc_id", "origin")


Q["merge_quarantine"] = quarantine_queue
SQL["merge_quarantine"] = """
WITH x AS (SELECT source AS path, n_chars AS row, doc_id, lang FROM documents),
 u AS (SELECT *, 'queue' AS origin, 0 AS r FROM x WHERE path NOT IN (SELECT path FROM x WHERE row > 15000)
  UNION ALL SELECT *, 'run', 1 FROM x WHERE lang <> 'en')
SELECT path, row, doc_id, origin FROM (SELECT *, row_number() OVER (PARTITION BY path, row ORDER BY r DESC, doc_id DESC) AS rn FROM u) WHERE rn = 1"""

# --- schema and load checks ---------------------------------------------------


def _described(spark, d):
    return table(spark, d, "part").groupBy(F.col("p_brand").alias("name")).agg(
        (F.max("p_size") >= 50).alias("createable"), (F.min("p_size") <= 1).alias("updateable"),
        (F.count(F.lit(1)) > 80).alias("externalId"), (F.max("p_retailprice") > 1000).alias("unique"))


def _required(spark, d):
    part = table(spark, d, "part")
    return part.select(F.col("p_brand").alias("name")).unionByName(part.select(F.col("p_type").alias("name")))


_SCHEMA = """
WITH d AS (SELECT p_brand AS name, max(p_size) >= 50 AS c, min(p_size) <= 1 AS u, count(*) > 80 AS x, max(p_retailprice) > 1000 AS q FROM part GROUP BY 1),
 r AS (SELECT p_brand AS name FROM part UNION SELECT p_type FROM part),
 p AS (SELECT r.name, CASE WHEN c IS NULL THEN 'missing' WHEN NOT c THEN 'not_createable' WHEN NOT u THEN 'not_updateable' ELSE 'ok' END AS problem
  FROM r LEFT JOIN d USING (name))
"""
Q["schema_diff"] = lambda spark, d: gates.schema_diff(_required(spark, d), _described(spark, d))
SQL["schema_diff"] = _SCHEMA + "SELECT name, problem FROM p"
Q["schema_gate"] = lambda spark, d: gates.schema_gate(_required(spark, d), _described(spark, d), "Brand#7")
SQL["schema_gate"] = _SCHEMA + """SELECT *, missing = 0 AND not_createable = 0 AND not_updateable = 0 AND key_external_id AND key_unique AS schema_ok FROM (
 SELECT count(*) FILTER (problem = 'missing') AS missing, count(*) FILTER (problem = 'not_createable') AS not_createable,
 count(*) FILTER (problem = 'not_updateable') AS not_updateable, (SELECT bool_or(x) FROM d WHERE name = 'Brand#7') AS key_external_id,
 (SELECT bool_or(q) FROM d WHERE name = 'Brand#7') AS key_unique FROM p)"""


def preflight_check(spark, d):
    rows = table(spark, d, "orders").agg(F.count(F.lit(1)).alias("pending_rows"))
    schema = gates.schema_gate(_required(spark, d), _described(spark, d), "Brand#7")
    return gates.preflight(rows, schema, compare.compare_keys(*_order_keys(spark, d), "key"), overlap(spark, d))


Q["preflight"] = preflight_check
SQL["preflight"] = """SELECT 'blocked' AS status, (SELECT count(*) FROM orders) AS pending_rows, false AS schema_ok, false AS keys_ok,
 (SELECT count(*) FROM lineitem WHERE (l_linestatus, CAST(l_shipdate AS DATE)) IN (SELECT (o_orderstatus, CAST(o_orderdate AS DATE)) FROM orders))
 AS legacy_overlap_rows, false AS safe_to_execute"""


def modified_since(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("key"))
    changed = F.when(F.col("quality") == 1, F.lit("2024-02-01")).otherwise(F.lit("2024-01-01")).cast("timestamp")
    target = docs.join(table(spark, d, "labels"), "doc_id", "left").select("key", changed.alias("modified"))
    keys = docs.select("key")
    expected = docs.agg(F.count_distinct("key").alias("n")).scalar()
    return gates.verify_modified_since(keys, target, "key", "modified", F.lit("2024-01-15").cast("timestamp"), expected)


Q["verify_modified_since"] = modified_since
SQL["verify_modified_since"] = """SELECT (SELECT count(*) FROM documents) AS "rows", (SELECT count(DISTINCT text) FROM documents) AS distinct_keys,
 0::BIGINT AS invalid_keys, (SELECT count(DISTINCT text) FROM documents JOIN labels USING (doc_id) WHERE quality = 1) AS modified_keys, false AS verified"""
