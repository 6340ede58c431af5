"""Queries of the filter audit, the piece tokenizer and the dataset manifest, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeflow.llm import filter_audit, merkle, pieces
from noticeflow.llm.common import table


def op11_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
firsts AS (SELECT text, min(doc_id) AS least FROM texts GROUP BY text),
told AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
         FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
judged AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
        len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
        regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > least, false)] AS fails
    FROM texts JOIN firsts USING (text) LEFT JOIN told USING (doc_id)),
counts AS (SELECT part, good, toxic, fails, count(*) AS n FROM judged GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
    SELECT filter_order, step, ascii(filter_order[step:step]) - 64 AS own,
           list_transform(range(1, step), lambda k: ascii(filter_order[k:k]) - 64) AS before
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
dealt AS (
    SELECT part, filter_order, step, own, good, toxic, n, fails[own] AS failing,
           len(list_filter(before, lambda b: fails[b])) = 0 AS reached,
           fails[own] AND len(list_filter(fails, lambda x: x)) = 1 AS alone
    FROM counts, steps),
summed AS (
    SELECT part, filter_order, step, own,
           sum(CASE WHEN reached AND NOT failing THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN reached AND failing THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN NOT reached AND failing THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN reached AND failing AND good THEN n ELSE 0 END) AS good_lost,
           sum(CASE WHEN reached AND failing AND toxic THEN n ELSE 0 END) AS toxic_lost
    FROM dealt GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM summed"""


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op12_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = piece_model_path()
    return pieces.digest(pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), model), model))


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def tampered_leaf() -> Column:
    """The leaf of a row with one more in n_chars where 7 divides the CRC of its id; elsewhere NULL."""
    changed = [F.col(f) + 1 if f == "n_chars" else F.col(f) for f in FIELDS]
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, merkle.leaf_hash(changed))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS).withColumn("claimed", tampered_leaf())
    return merkle.verify(merkle.manifest(docs, FIELDS, carry=["claimed"]), claimed="claimed")


# The list of a part's nodes is folded level by level; a fold over the bits of each byte gives the CRC.
OP13_SQL = r"""
WITH RECURSIVE shown AS (
    SELECT doc_id, coalesce('=' || lang, '-') AS part, n_chars,
           coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-') ||
           coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS a,
           coalesce(strlen(text) || ':' || text, '-') AS z FROM documents),
leaves AS (
    SELECT doc_id, part,
           sha256(a || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') || z) AS leaf,
           sha256(a || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || CAST(n_chars + 1 AS VARCHAR), '-') || z) AS bad,
           xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(
               string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
               lambda crc, byte: list_reduce([xor(crc, byte)] || list_transform(range(8), lambda i: CAST(0 AS BIGINT)),
                   lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 7 = 0 AS tampered
    FROM shown),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
levels AS (
    SELECT part, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY part
    UNION ALL
    SELECT part, level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
    FROM levels WHERE len(nodes) > 1),
subroots AS (SELECT part, nodes[1] AS subroot FROM levels WHERE len(nodes) = 1),
ranked AS (SELECT *, row_number() OVER (ORDER BY part) - 1 AS pos FROM subroots),
tops AS (
    SELECT 0 AS level, list(subroot ORDER BY pos) AS nodes FROM ranked
    UNION ALL
    SELECT level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
    FROM tops WHERE len(nodes) > 1),
whole AS (SELECT nodes[1] AS root FROM tops WHERE len(nodes) = 1),
crowns AS (
    SELECT part, coalesce(list(CASE WHEN (pos >> level) % 2 = 1 THEN '<' ELSE '>' END ||
                      coalesce(nodes[xor(pos >> level, 1) + 1], '') ORDER BY level) FILTER (len(nodes) > 1), []) AS steps
    FROM ranked, tops GROUP BY part),
witnesses AS (
    SELECT doc_id, pos, part, leaf, CASE WHEN tampered THEN bad ELSE leaf END AS claimed,
           coalesce(list(CASE WHEN (pos >> level) % 2 = 1 THEN '<' ELSE '>' END ||
                      coalesce(nodes[xor(pos >> level, 1) + 1], '') ORDER BY level) FILTER (len(nodes) > 1), []) AS steps
    FROM placed JOIN levels USING (part) GROUP BY ALL),
full_steps AS (
    SELECT w.*, subroot, root, w.steps || c.steps AS path
    FROM witnesses w JOIN crowns c USING (part) JOIN subroots USING (part), whole),
folded AS (
    SELECT doc_id, leaf, subroot, root,
           sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256,
           list_reduce([claimed] || path, lambda h, s: sha256(CASE WHEN s[1] = '<' THEN s[2:] || h ELSE h || s[2:] END)) AS folded_root
    FROM full_steps)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded"""


Q = {"op11_filter_interaction_audit": op11_filter_interaction_audit, "op12_piece_tokens": op12_piece_tokens,
     "op13_merkle_manifest": op13_merkle_manifest}
SQL = {"op11_filter_interaction_audit": OP11_SQL, "op13_merkle_manifest": OP13_SQL}
