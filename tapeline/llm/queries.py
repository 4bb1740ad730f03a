"""Registered queries of this package, and check SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.llm import chat, filter_audit, importance, language, mixing, neighbours, packing, quality, secret_scan, simhash, substring_dedup, vector_dedup, voronoi


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Grades of all documents; kept are those that are good (neither toxic nor poor) with a chance of one half or more."""
    docs = table(spark, sf, "documents")
    ratings = table(spark, sf, "labels").select("doc_id", quality.graded(F.col("quality"), F.col("toxic")).alias("grade"))
    scored = quality.grade(docs, quality.train(docs, ratings, 3), select=2)
    return scored.withColumn("kept", F.col("tail_probability") >= 0.5)


def op2_substrings(spark: SparkSession, sf: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf, "documents"), digest=True)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept").cast("string").alias("kept_sha256"))


def op3_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    return neighbours.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op5_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    names, matrix = language.prototypes(docs.where(~language.held_out(F.col("doc_id"))))
    found = language.identify(docs, names, matrix)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_vector_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf, "embeddings"))


OP6_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95
), reached(vec_id, other) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT r.vec_id, l.b FROM reached r JOIN l ON r.other = l.a
), c AS (
  SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
)
SELECT c.vec_id, (SELECT count(*) FROM l WHERE l.a = c.vec_id) AS n_links, c.component_id, c.vec_id = c.component_id AS kept FROM c
"""


def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


def op8_chat(spark: SparkSession, sf: str) -> DataFrame:
    return chat.format_chats(table(spark, sf, "conversations"))


OP8_SQL = """
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS pos FROM conversations
), p AS (
  SELECT conv_id, pos, list([role, text]) OVER (PARTITION BY conv_id ORDER BY pos) AS path FROM t
), w AS (
  SELECT conv_id, max(pos) + 1 AS n, max_by(path, pos) AS path FROM p GROUP BY conv_id
), one AS (
  SELECT min(conv_id) AS conv_id, path FROM w GROUP BY path
), shorter AS (
  SELECT DISTINCT p.path FROM p JOIN w USING (conv_id) WHERE p.pos + 1 < w.n
), stay AS (
  SELECT conv_id FROM one ANTI JOIN shorter USING (path)
)
SELECT conv_id, CAST(pos // 64 AS BIGINT) AS segment, count(*) AS turns,
  string_agg('<|im_start|>' || replace(coalesce(role, 'unknown'), '<|', '< |') || chr(10) || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM t JOIN stay USING (conv_id) GROUP BY conv_id, pos // 64
"""


def op9_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secret_scan.spans_text(base).cast("binary"), 256).alias("base_sha256"), secret_scan.spans_text(F.col("spans")).alias("spans"), count("entropy"),
    )


def op10_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf, "documents"), tokenizer_file())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_importance(spark: SparkSession, sf: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


#: CRC-32 (reversed polynomial 3988292384) of each different feature, a byte at a time.
OP11_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT n, list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n) AS v FROM (SELECT unnest(range(256)) AS n)
), texts AS (
  SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), worded AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), grams AS (
  SELECT kind, id, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT kind, id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM worded, (SELECT unnest([1, 2, 3]) AS n))
), counted AS (
  SELECT kind, id, g, count(*) AS n FROM grams GROUP BY ALL
), walk(g, h, pos, c) AS (
  SELECT g, hex(encode(g)), 0, CAST(4294967295 AS BIGINT) FROM (SELECT DISTINCT g FROM counted)
  UNION ALL
  SELECT g, h, pos + 1, xor(c // 256, t.v) FROM walk JOIN crc_table t ON t.n = xor(c, CAST('0x' || substr(h, 2 * pos + 1, 2) AS BIGINT)) % 256 WHERE 2 * pos < length(h)
), hashed AS (
  SELECT g, xor(c, 4294967295) % 10000 AS bucket FROM walk WHERE 2 * pos = length(h)
), placed AS (
  SELECT kind, id, bucket, n FROM counted JOIN hashed USING (g)
), totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (kind = 0), 0) AS s, coalesce(sum(n) FILTER (kind = 1), 0) AS t FROM placed GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((CAST(t AS DOUBLE) + 1) * ((SELECT CAST(sum(s) AS DOUBLE) FROM totals) + 10000) / ((CAST(s AS DOUBLE) + 1) * ((SELECT CAST(sum(t) AS DOUBLE) FROM totals) + 10000)))) AS gain FROM totals
), weights AS (
  SELECT id, sum(n) AS n_features, sum(n * gain) AS weight FROM placed JOIN gains USING (bucket) WHERE kind = 0 GROUP BY id
), scored AS (
  SELECT id AS doc_id, len(w) AS words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM worded LEFT JOIN weights USING (id) WHERE kind = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) AS place FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN words >= 20 AND place <= (SELECT 5 * count(*) // 100 FROM scored WHERE words >= 20) THEN place END AS rank FROM ranked
"""


def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


OP12_SQL = r"""
WITH marks AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
    len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t), regexp_matches(t, '[#$%&*|]'),
    d.doc_id > min(d.doc_id) OVER (PARTITION BY t)
  ] AS fails FROM d LEFT JOIN marks USING (doc_id)
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), m AS (
  SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL
), steps AS (
  SELECT part, good, toxic, fails, n, o AS filter_order, step, ascii(substr(o, step, 1)) - 64 AS k,
    len(list_filter(range(1, step), lambda i: fails[ascii(substr(o, i, 1)) - 64])) > 0 AS gone
  FROM m, orders, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)
), out AS (
  SELECT part, filter_order, step, k,
    CAST(coalesce(sum(n) FILTER (NOT gone AND NOT fails[k]), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (NOT gone AND fails[k]), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (gone AND fails[k]), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (fails[k] AND len(list_filter(fails, lambda x: x)) = 1), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(n) FILTER (NOT gone AND fails[k] AND good), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(n) FILTER (NOT gone AND fails[k] AND toxic), 0) AS BIGINT) AS toxic_lost
  FROM steps GROUP BY ALL
)
SELECT * EXCLUDE (k), CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley FROM out
"""


def op13_voronoi(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    return voronoi.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


OP13_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(1024 * x)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY rank <= 10
"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality, op2_substrings, op3_neighbours, op4_simhash, op5_language, op6_vector_dedup, op7_mixing, op8_chat, op9_secrets, op10_packing,
        op11_importance, op12_filter_audit, op13_voronoi,
    )
}
CHECKS = {"op6_vector_dedup": OP6_SQL, "op8_chat": OP8_SQL, "op11_importance": OP11_SQL, "op12_filter_audit": OP12_SQL, "op13_voronoi": OP13_SQL}
