"""The operators applied to the given tables, one query each, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.llm import (
    bpe, chat, embedding_dedup, filter_audit, hamming_search, hard_negatives, mixing, packing, quality, secrets, toxicity, url_filter)
from tracemill.llm.jaccard_join import jaccard_components


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source of a document is its host, and the language below it the path."""
    return quality.score(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality"),
        host=F.col("source"), path=F.col("lang"))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secrets.scan(table(spark, sf_dir, "documents"))
    return secrets.digest(found)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.preference_pairs(chat.spliced(table(spark, sf_dir, "conversations")))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign codes of the embeddings; every 20th vector asks for its 10 nearest others."""
    vectors = table(spark, sf_dir, "embeddings")
    codes = vectors.select(F.col("vec_id").alias("id"), hamming_search.sign_code(F.col("embedding")).alias("code"))
    asked = codes.filter(F.pmod("id", F.lit(20)) == 0).withColumnRenamed("id", "query_id")
    found = hamming_search.top_k(codes, asked, 10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.encode_decode(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh label is off by one; every hundredth vector is an anchor."""
    label = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(vectors, F.pmod("vec_id", F.lit(100)) == 0)


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_secret_scans": op2_secret_scans,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_toxicity": op4_toxicity,
    "op5_source_mixing": op5_source_mixing,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_url_filters": op10_url_filters,
    "op11_filter_audit": op11_filter_audit,
    "op12_bpe_codec": op12_bpe_codec,
    "op13_hard_negatives": op13_hard_negatives,
}

_PATTERNS = {r.kind: r.pattern.replace("'", "''") for r in secrets.RULES}

# Matches and the text between them, as in the operator: a plain text function
# of the engine splits the same text at the same pattern.
_SECRET_SPANS = " UNION ALL ".join(f"""
SELECT doc_id, '{r.kind}' AS kind, {k} AS rank, parts, whole, judged, {r.least} AS least
FROM (SELECT doc_id, regexp_split_to_array(t, '{_PATTERNS[r.kind]}') AS parts, regexp_extract_all(t, '{_PATTERNS[r.kind]}') AS whole,
  regexp_extract_all(t, '{_PATTERNS[r.kind]}', {r.group}) AS judged FROM docs) WHERE len(whole) > 0""" for k, r in enumerate(secrets.RULES))

ORACLES: dict[str, str] = {
    "op2_secret_scans": f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
hits AS ({_SECRET_SPANS}),
each AS (SELECT doc_id, kind, rank, least, parts, whole, judged, unnest(range(1, len(whole) + 1)) AS i FROM hits),
spans AS (
  SELECT doc_id, kind, rank,
    CAST(list_sum(list_transform(parts[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s,
    length(whole[i]) AS n
  FROM each WHERE length(judged[i]) >= least),
joined AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, rank) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN joined USING (doc_id)""",
    "op3_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reach = e.a)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach) AS component_id
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op6_chat_formatting": """
WITH c AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
sides AS (
  SELECT conv_id AS pair_id, 'chosen' AS side, turn, role, text FROM c
  UNION ALL SELECT conv_id, 'rejected', turn, role, text FROM c WHERE coalesce(turn, 0) < 1 + conv_id % 3
  UNION ALL SELECT xor(conv_id, 1), 'rejected', turn, role, text FROM c WHERE coalesce(turn, 0) >= 1 + xor(conv_id, 1) % 3),
placed AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, role, text) AS nth FROM sides),
aligned AS (
  SELECT pair_id, nth, max(role) FILTER (side = 'chosen') AS cr, max(text) FILTER (side = 'chosen') AS ct,
    max(role) FILTER (side = 'rejected') AS rr, max(text) FILTER (side = 'rejected') AS rt
  FROM placed GROUP BY ALL),
prefix AS (
  SELECT pair_id, coalesce(min(nth) FILTER (cr IS DISTINCT FROM rr OR ct IS DISTINCT FROM rt) - 1, max(nth)) AS common_turns
  FROM aligned GROUP BY pair_id HAVING count(cr) > 0),
parts AS (
  SELECT pair_id, nth, common_turns, cr, ct, rr, rt,
    '<|im_start|>' || cr || chr(10) || ct || '<|im_end|>' || chr(10) AS c, '<|im_start|>' || rr || chr(10) || rt || '<|im_end|>' || chr(10) AS r
  FROM aligned JOIN prefix USING (pair_id)),
offs AS (
  SELECT *, coalesce(sum(length(c)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS co,
    coalesce(sum(length(r)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ro
  FROM parts WINDOW w AS (PARTITION BY pair_id, nth > common_turns ORDER BY nth))
SELECT pair_id, common_turns,
  coalesce(string_agg(c, '' ORDER BY nth) FILTER (nth <= common_turns), '') AS prompt,
  coalesce(string_agg(c, '' ORDER BY nth) FILTER (nth > common_turns), '') AS chosen,
  coalesce(string_agg(r, '' ORDER BY nth) FILTER (nth > common_turns), '') AS rejected,
  coalesce(string_agg((co + 13 + length(cr)) || ':' || (co + 13 + length(cr) + length(ct)), ',' ORDER BY nth)
    FILTER (nth > common_turns AND cr = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg((ro + 13 + length(rr)) || ':' || (ro + 13 + length(rr) + length(rt)), ',' ORDER BY nth)
    FILTER (nth > common_turns AND rr = 'assistant'), '') AS rejected_mask
FROM offs GROUP BY pair_id, common_turns""",
    "op7_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS bits FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL)) = 0),
d AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    CAST(len(list_filter(list_zip(q.bits, v.bits), lambda p: p[1] <> p[2])) AS BIGINT) AS distance
  FROM (SELECT * FROM v WHERE vec_id % 20 = 0) q, v WHERE q.vec_id <> v.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank, vec_id, distance
FROM d QUALIFY rank <= 10""",
    "op11_filter_audit": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    min(doc_id) OVER (PARTITION BY t) AS least FROM d),
g AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 2 * length(t) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN doc_id > least THEN 'E' ELSE '' END) AS failed
  FROM w LEFT JOIN g USING (doc_id)),
cells AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT x AS o FROM letters UNION ALL SELECT o || x FROM orders, letters WHERE NOT contains(o, x) AND length(o) < 5),
steps AS (SELECT o AS filter_order, s AS step, o[s:s] AS x, o[1:s - 1] AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS s) WHERE length(o) = 5),
met AS (SELECT part, filter_order, step, x, n, good, toxic, failed,
    contains(failed, x) AS fails, translate(failed, before, '') = failed AS reached FROM cells, steps),
counted AS (
  SELECT part, filter_order, step, x,
    CAST(sum(CASE WHEN reached AND NOT fails THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN reached AND fails THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN NOT reached AND fails THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN failed = x THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN reached AND fails THEN good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN reached AND fails THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM met GROUP BY ALL)
SELECT * EXCLUDE (x), CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM counted""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS whole
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.whole, b.whole), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5""",
}
