"""Queries of the operators and their SQL, for ``__spark_entry__``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlog.llm import content_dedup, exact_topk, language_id, lexical, mixing, near_dups, outliers, packing, prefix_trie, quotes, warc, wavelet, weak_labels
from wearlog.llm.tokens import vocabulary

VOCABULARY = "word_bpe_49k.json"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings").where(exact_topk.usable(F.col("embedding")))
    vectors = rows.select(F.col("vec_id").cast("long").alias("vec_id"), exact_topk.quantised(F.col("embedding")).alias("v"))
    return exact_topk.top_k(vectors, vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id")))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = warc.page_captures(_read(spark, sf_dir, "pages"))
    return got.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("refers_page").alias("refers_to"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(_read(spark, sf_dir, "documents")).drop("class_id")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_read(spark, sf_dir, "documents"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(_read(spark, sf_dir, "conversations"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.quality(_read(spark, sf_dir, "documents"))


def op8_token_wavelets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.read_shards(wavelet.write_shards(_read(spark, sf_dir, "documents"), vocabulary(VOCABULARY), end_id=2))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_dedup.content_groups(_read(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), vocabulary(VOCABULARY), end_id=1)


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = outliers.outliers(_read(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance2")


def rebuilt_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of conversations that begin with their hundred's first ones, and all conversation ids."""
    ids = rows.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    heads = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(6))
    return prefix_trie.shared_heads(prefix_trie.ordered_turns(rows), ids, heads, F.expr("conv_id - conv_id % 100"), 5), ids


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, ends = prefix_trie.prefix_trie(*rebuilt_conversations(_read(spark, sf_dir, "conversations")))
    digests = nodes.join(prefix_trie.end_digests(ends), "node_id", "left")
    nobody = F.sha2(F.lit("").cast("binary"), 256)
    return digests.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nobody).alias("ends_sha256"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.build_index(_read(spark, sf_dir, "documents")), _read(spark, sf_dir, "benchmark"), 10)


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_topk, op2_warc, op3_minhash_near_dedup, op4_language_id, op5_source_mix,
        op6_chat_formatting, op7_quality_classifier, op8_token_wavelets, op9_exact_dedup, op10_best_fit_packing,
        op11_quality_rules, op12_prefix_trie, op13_ranked_search,
    )
}

ORACLE_SQL = {
    "op1_exact_topk": """
WITH v AS (
  SELECT vec_id, max(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
  GROUP BY vec_id
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op2_warc": """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM f""",
    "op3_minhash_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS grams
  FROM w
), g AS (
  SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS an, any_value(b.n) AS bn, count(*) AS common
  FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared WHERE 100 * common >= 85 * (an + bn - common)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT s.doc_id, CAST(len(s.grams) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM s JOIN least USING (doc_id)""",
    "op9_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)""",
    "op12_prefix_trie": """
WITH c AS (
  -- crc32 of the id's decimal text, a byte and eight shifts at a time
  SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base,
    xor(4294967295, list_reduce(
      list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END)) % 6 AS h
  FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''),
    sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), s AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:h], []), o.turns[h + 1:]) AS q
  FROM c JOIN o USING (conv_id) LEFT JOIN o b ON b.conv_id = c.base
), p AS (
  SELECT conv_id, q[1:d] AS path, d = len(q) AS ends FROM (SELECT conv_id, q, unnest(range(0, len(q) + 1)) AS d FROM s)
), n AS (
  SELECT path, len(path) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ended
  FROM p GROUP BY path
), k AS (
  SELECT n.*, (SELECT count(*) FROM n m WHERE m.depth = n.depth + 1 AND m.path[1:n.depth] = n.path) AS n_children FROM n
), t AS (
  SELECT a.path, count(*) FILTER (b.n_children = 0) AS n_leaves,
    CAST(sum((b.n_convs - 1) * CASE WHEN b.depth = 0 THEN 0 ELSE length(b.path[b.depth].t) END) AS BIGINT) AS saved_tokens
  FROM k a JOIN k b ON b.depth >= a.depth AND b.path[1:a.depth] = a.path GROUP BY a.path
)
SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children, t.n_leaves, t.saved_tokens, sha256(k.ended) AS ends_sha256
FROM k JOIN t ON t.path = k.path LEFT JOIN n u ON k.depth > 0 AND u.depth = k.depth - 1 AND u.path = k.path[1:k.depth - 1]""",
    "op13_ranked_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(min(text), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id
), s AS (
  SELECT count(*) FILTER (len(terms) > 0) AS docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM d
), f AS (
  SELECT place, doc_id, len(terms) AS size, term, count(*) AS tf FROM (SELECT place, doc_id, terms, unnest(terms) AS term FROM d) GROUP BY place, doc_id, len(terms), term
), q AS (
  SELECT item_id, term, count(*) AS reps FROM (SELECT item_id, unnest(terms) AS term FROM i) GROUP BY item_id, term
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM f GROUP BY term), s
), r AS (
  SELECT item_id, place, doc_id, CAST(sum(reps * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * size * docs) // total)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN f USING (term), s WHERE doc_id IS NOT NULL GROUP BY item_id, place, doc_id
), x AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM x WHERE rank <= 10""",
}
