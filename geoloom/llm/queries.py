"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm import bpe, clustering, compression_quality, embedding_dedup, html_extract, language_id, line_dedup, merkle, mixing, quality_rules, simhash, suffix_dedup, warc
from geoloom.llm.shared import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated 200-byte strings."""
    return suffix_dedup.removed(_table(spark, sf_dir, "documents")).drop("spans")


def op2_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_line_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines cut from every document, and what stays, as a digest."""
    return line_dedup.report(_table(spark, sf_dir, "documents"))


def op4_sorted_projection_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op5_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.main_texts(_table(spark, sf_dir, "pages"))


def op6_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, read back and assembled per capture."""
    return warc.captures(_table(spark, sf_dir, "pages"))


def op7_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of every document, learned outside the held-out quarter."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = compression_quality.fit(docs, _table(spark, sf_dir, "labels"), learn_from=compression_quality.learnable())
    out = compression_quality.scores(docs, model)
    return out.select(
        F.col("row").alias("doc_id"),
        F.coalesce(F.crc32(F.col("row").cast("string").cast("binary")) % 4 == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= compression_quality.CUT).cast("int").alias("predicted"),
    )


def op8_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the verdict of the robust estimates, per document."""
    return quality_rules.judged(_table(spark, sf_dir, "documents"))


def op9_mix_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document. Word counts are written once and read by both passes."""
    docs = _table(spark, sf_dir, "documents")
    sized = written(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), "sizes")
    out = mixing.with_copies(sized)
    return out.select("doc_id", "size", F.col("mix.source_size").alias("source_size"), F.col("mix.target").alias("target"), (F.col("mix.copies") * F.col("size")).alias("taken"), "source")


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of each document, as digests."""
    return bpe.round_trip(_table(spark, sf_dir, "documents"))


def op11_language_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and score of every document, learned outside the held-out quarter."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    out = language_id.predictions(docs, language_id.fit(docs, learn_from=compression_quality.learnable()))
    held_out = F.coalesce(F.crc32(F.col("row").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return out.select(F.col("row").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score")


def op12_hamerly_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of every whole vector."""
    return clustering.clustered(_table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and verification of every document."""
    return merkle.manifest(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_suffix_array_dedup, op2_simhash_near_duplicates, op3_line_chunk_dedup, op4_sorted_projection_dedup, op5_page_differencing, op6_warc_transactions, op7_compression_quality, op8_robust_outliers, op9_mix_to_targets, op10_bpe_round_trip, op11_language_families, op12_hamerly_clusters, op13_merkle_manifest)}


def _rounds_sql() -> str:
    """Plain Lloyd rounds over whole numbers, each a pair of common table expressions."""
    nearest = "(SELECT arg_min(c.cid, (list_sum(list_transform(list_zip(v.x, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.cid)) FROM c{0} c)"
    parts = []
    for n in range(clustering.ROUNDS):
        parts.append(f"a{n} AS MATERIALIZED (SELECT v.x, {nearest.format(n)} AS cid FROM v)")
        parts.append(f"s{n} AS (SELECT cid, list((s - (((s % n) + n) % n)) // n ORDER BY pos) AS c FROM (SELECT cid, pos, sum(x[pos])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{n}, range(1, 65) r(pos) GROUP BY cid, pos) GROUP BY cid)")
        parts.append(f"c{n + 1} AS MATERIALIZED (SELECT c.cid, coalesce(s.c, c.c) AS c FROM c{n} c LEFT JOIN s{n} s ON s.cid = c.cid)")
    return ",\n".join(parts)


ORACLES = {
    "op1_suffix_array_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
blocks AS (SELECT doc_id, base, least(1000, n - 199 - base) AS m, substr(h, 2 * base + 1, 2398) AS bh
           FROM (SELECT doc_id, h, n, unnest(range(0, greatest(n - 199, 0), 1000)) AS base FROM d)),
w AS (SELECT doc_id, base + j AS i, md5(substr(bh, 2 * j + 1, 400)) AS k FROM (SELECT doc_id, base, bh, unnest(range(m)) AS j FROM blocks)),
hit AS (SELECT doc_id, i FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
marked AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS opens FROM hit),
numbered AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY doc_id, run),
gaps AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS s, a AS e FROM runs
         UNION ALL SELECT d.doc_id, coalesce(max(r.b), 0), any_value(d.n) FROM d LEFT JOIN runs r USING (doc_id) GROUP BY d.doc_id),
kept AS (SELECT g.doc_id, string_agg(substr(d.h, 2 * s + 1, 2 * (e - s)), '' ORDER BY s) AS h FROM gaps g JOIN d USING (doc_id) GROUP BY g.doc_id)
SELECT d.doc_id, d.n AS n_bytes, coalesce(x.n_removed, 0)::BIGINT AS n_removed, coalesce(x.n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id) x USING (doc_id)
""",
    "op4_sorted_projection_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, p.b FROM reach r JOIN p ON r.b = p.a),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT v.vec_id, (SELECT count(*) FROM p WHERE p.a = v.vec_id)::BIGINT AS n_links, low.component_id, v.vec_id = low.component_id AS kept
FROM v JOIN low ON low.a = v.vec_id
""",
    "op6_warc_transactions": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
FROM m
""",
    "op9_mix_to_targets": """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM per),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
            / sum(weight) OVER after AS level,
         row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS rank
  FROM ranked
  WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
settled AS (SELECT *, (SELECT arg_min(level, rank) FROM levels WHERE level * weight <= 3 * source_size) AS final FROM levels),
targets AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, coalesce(final * weight, (3 * source_size)::DOUBLE)) AS target FROM settled),
rated AS (
  SELECT s.doc_id, s.size, s.source, t.source_size, t.target, s.size * 2000 > t.source_size AS heavy,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('mix-1:' || s.doc_id::VARCHAR), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u,
         ('0x' || substr(md5('mix-1:source:' || coalesce(s.source, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS su
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
placed AS (SELECT *, su + row_number() OVER (PARTITION BY source, heavy ORDER BY size DESC, u, doc_id) * (rate - floor(rate)) AS moved FROM rated),
drawn AS (SELECT *, CASE WHEN heavy THEN moved - floor(moved) ELSE u END AS d FROM placed)
SELECT doc_id, size, source, source_size, target,
       (least(floor(rate) + CASE WHEN d < rate - floor(rate) THEN 1 ELSE 0 END, 3) * size)::BIGINT AS taken
FROM drawn
""",
    "op12_hamerly_clusters": f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::HUGEINT) AS x FROM embeddings
           WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x)::INTEGER - 1 AS cid, x AS c FROM (SELECT sha256('3:' || coalesce(vec_id::VARCHAR, '')) AS h, x FROM v ORDER BY h, x LIMIT 8)),
{_rounds_sql()},
d AS (SELECT v.vec_id, c.cid, c.c, list_sum(list_transform(list_zip(v.x, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance, row_number() OVER (PARTITION BY v.n ORDER BY distance, c.cid) AS place
      FROM (SELECT *, row_number() OVER () AS n FROM v) v, c{clustering.ROUNDS} c)
SELECT vec_id, cid AS cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY cid))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM d WHERE place = 1
""",
    "op13_merkle_manifest": """
WITH RECURSIVE d AS (
  SELECT *, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
                        lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) % 2 = 1 AS tampered
  FROM documents),
fields AS (
  SELECT doc_id, source, tampered, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head, text, replace(text, chr(10), '') AS flat FROM d),
leaves AS (
  SELECT doc_id, source, leaf, changed, (row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1)::BIGINT AS i, (count(*) OVER (PARTITION BY source))::BIGINT AS n
  FROM (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
               CASE WHEN tampered THEN sha256(head || coalesce(strlen(flat) || ':' || flat, '-')) ELSE leaf END AS changed FROM fields)),
tree(level, source, i, n, h) AS (
  SELECT 0, source, i, n, leaf FROM leaves
  UNION ALL
  SELECT level + 1, source, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY level, source, i // 3, (n + 2) // 3),
runs AS (SELECT level, source, i // 3 AS p, list(h ORDER BY i) AS hs FROM tree WHERE n > 1 GROUP BY level, source, i // 3),
fold(level, leaf_at, source, i, n, h, proof) AS (
  SELECT 0, i, source, i, n, changed, '' FROM leaves
  UNION ALL
  SELECT f.level + 1, leaf_at, f.source, i // 3, (n + 2) // 3, sha256(array_to_string(hs[1:i % 3], '') || h || array_to_string(hs[i % 3 + 2:], '')),
         proof || array_to_string(hs[1:i % 3], '') || array_to_string(hs[i % 3 + 2:], '')
  FROM fold f JOIN runs r ON r.level = f.level AND r.source IS NOT DISTINCT FROM f.source AND r.p = f.i // 3 WHERE n > 1),
subs AS (SELECT source, h, (row_number() OVER (ORDER BY source NULLS FIRST) - 1)::BIGINT AS i, (count(*) OVER ())::BIGINT AS n FROM tree WHERE n = 1),
top(level, i, n, h) AS (
  SELECT 0, i, n, h FROM subs
  UNION ALL
  SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 3, (n + 2) // 3),
top_runs AS (SELECT level, i // 3 AS p, list(h ORDER BY i) AS hs FROM top WHERE n > 1 GROUP BY level, i // 3),
top_fold(level, leaf_at, source, i, n, h, proof) AS (
  SELECT 0, leaf_at, f.source, s.i, s.n, f.h, f.proof FROM fold f JOIN subs s ON s.source IS NOT DISTINCT FROM f.source WHERE f.n = 1
  UNION ALL
  SELECT f.level + 1, leaf_at, source, i // 3, (n + 2) // 3, sha256(array_to_string(hs[1:i % 3], '') || h || array_to_string(hs[i % 3 + 2:], '')),
         proof || array_to_string(hs[1:i % 3], '') || array_to_string(hs[i % 3 + 2:], '')
  FROM top_fold f JOIN top_runs r ON r.level = f.level AND r.p = f.i // 3 WHERE n > 1)
SELECT l.doc_id, l.leaf, s.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = (SELECT h FROM top WHERE n = 1) AS verified
FROM leaves l JOIN subs s ON s.source IS NOT DISTINCT FROM l.source JOIN top_fold f ON f.source IS NOT DISTINCT FROM l.source AND f.leaf_at = l.i AND f.n = 1
""",
}
