"""The registered queries of this folder, each with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.llm import (
    capfilters, debruijn, editcount, indexing, maxsketch, mixing, probminhash, rendezvous, repair, spacedseeds, turntrie, urltree, zstdclass,
)
from registrylake.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

END_ID = 2
SHARDS = 40
# crc32 of UTF-8 bytes in DuckDB: the table from its rule, then one step a byte
SQL_CRC = """
SELECT list(list_reduce(range(8), lambda c, j: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
FROM (SELECT unnest(range(256)) AS i)
"""
SQL_CRC_OF = """
xor(4294967295, list_reduce(
  list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT),
  lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT))
"""
MIX_WEIGHTS = (5.0, 2.0, 1.0)
MIX_LIMIT = 3.0


SQL_REPEATS = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, row_number() OVER () AS r FROM documents
), p AS (
  SELECT r, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35
), h AS (
  SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS k FROM p
), c AS (
  SELECT r, i FROM h WHERE k IN (SELECT k FROM h GROUP BY k HAVING count(*) > 1)
), g AS (
  SELECT r, list_distinct(flatten(list(range(i, i + 35)))) AS gone FROM c GROUP BY r
), k AS (
  SELECT doc_id, w, coalesce(gone, []) AS gone,
         [x[1] FOR x IN list_zip(w, range(1, len(w) + 1)) IF NOT list_contains(coalesce(gone, []), x[2])] AS kept
  FROM d LEFT JOIN g USING (r)
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - len(kept))::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
FROM k
"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op5_hash_threshold_mix",
    r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '/' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0::DOUBLE, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1] AS weight
  FROM d GROUP BY source
), r AS (
  SELECT *, 3.0::DOUBLE * source_size / weight AS full_at, sum(source_size) OVER ()::DOUBLE AS budget FROM s
), l AS (
  SELECT *, (budget - 3.0::DOUBLE * coalesce(sum(source_size) OVER w, 0)::BIGINT)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0.0)) AS lev
  FROM r WINDOW w AS (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size,
         least(3.0::DOUBLE * source_size,
               coalesce((SELECT arg_min(lev, full_at) FROM l WHERE lev <= full_at) * weight, 3.0::DOUBLE * source_size)) AS target
  FROM l
), u AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS rounds FROM t
), c AS (
  SELECT d.*, u.source_size, u.target, u.rounds, u.target - u.rounds * u.source_size AS rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING)::BIGINT AS upto,
         sum(size) OVER (PARTITION BY d.source, h)::BIGINT AS own
  FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source
)
SELECT doc_id, size, source_size, target,
       (size * (rounds + CASE WHEN rest > 0 AND upto + (upto - own) < 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
""",
)
def op5_hash_threshold_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, 1.0, MIX_LIMIT)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query(
    "op7_rendezvous_shards",
    rf"""
WITH crc AS ({SQL_CRC}), d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), k AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS key, strlen(text)::BIGINT + 16 AS size,
         {SQL_CRC_OF}::BIGINT AS text_crc32, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '/slot'), 1, 3))::INT AS bucket
  FROM d, crc
), g AS (
  SELECT key, c, md5(key || '/' || c::VARCHAR) AS m FROM (SELECT DISTINCT key FROM k), (SELECT unnest(range(11)) AS c)
), v AS (
  SELECT key, c * 4 + p AS shard, ('0x' || substr(m, 8 * p::INT + 1, 8))::BIGINT AS u
  FROM g, (SELECT unnest(range(4)) AS p)
), b AS (
  SELECT key, arg_max(shard, u * 64 - shard) FILTER (shard < 40)::INT AS shard,
         arg_max(shard, u * 64 - shard) FILTER (shard < 41)::INT AS grown_shard
  FROM v GROUP BY key
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM k JOIN b USING (key)
""",
)
def op7_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = rendezvous.shard_documents(table(spark, sf_dir, "documents"), [1.0] * SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_repair_token_ids")
def op1_repair_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    repair.write_shards(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"), END_ID)
    return repair.read_documents(spark, path)


#: mail addresses, IPv4 addresses, runs of 13 to 19 digits and of 32 or more hexadecimal digits, a digit among them
PERSONAL = r"(?<![\w.+-])[\w.+-]+@[\w-]+\.[\w.]*\w|\b(?:\d{1,3}(?:\.\d{1,3}){3}|\d{13,19}|(?=[a-f]*\d)[0-9a-f]{32,})\b"


@query("op4_edit_aware_counts")
def op4_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts before and after personal data and secrets are masked."""
    path = tokenizer_path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = editcount.count_trees(editcount.replacing_edits(docs, PERSONAL, "[masked]", needs=r"[\d@]"), path)
    return editcount.recount(trees, path).select("doc_id", "n_before", "n_edits", "n_tokens", "n_leaves", "n_redone")


@query("op6_spaced_seed_decontamination")
def op6_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = spacedseeds.mark_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return marked.drop("text_hash")


SQL_LINKS = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings
), g AS (
  SELECT r, vec_id, e FROM v WHERE vec_id IS NOT NULL AND len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
    AND list_dot_product(e, e) > 0
), p AS (
  SELECT a.r AS x, b.r AS y FROM g AS a JOIN g AS b ON a.r <> b.r AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT r, r AS m FROM g UNION SELECT reach.r, p.y FROM reach JOIN p ON p.x = reach.m
), c AS (
  SELECT reach.r, min(g.vec_id) AS component_id FROM reach JOIN g ON g.r = reach.m GROUP BY reach.r
), n AS (
  SELECT x AS r, count(*) AS n FROM p GROUP BY x
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(coalesce(component_id, vec_id) = vec_id, FALSE) AS kept
FROM v LEFT JOIN c USING (r) LEFT JOIN n USING (r)
"""


@query("op3_cap_filter_links", SQL_LINKS)
def op3_cap_filter_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capfilters.link_vectors(table(spark, sf_dir, "embeddings"), 0.95)


def _scored(scores: DataFrame, least: float) -> DataFrame:
    held = F.coalesce(indexing.held_out(F.col("doc_id")), F.lit(False))
    return scores.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


@query("op8_random_indexing_quality")
def op8_random_indexing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(indexing.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), 0.5)


@query("op10_compression_toxicity")
def op10_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(zstdclass.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), 0.7)


@query("op2_probminhash_classes")
def op2_probminhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = probminhash.near_classes(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id") == F.col("class_id"))


@query("op9_debruijn_repeats", SQL_REPEATS)
def op9_debruijn_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL_SEARCH = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents WHERE text IS NOT NULL
), w AS (
  SELECT r, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), tf AS (
  SELECT r, doc_id, term, count(*)::BIGINT AS tf FROM w GROUP BY ALL
), n AS (
  SELECT r, count(*)::BIGINT AS n FROM w GROUP BY r
), a AS (
  SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM n
), df AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM tf, a GROUP BY term, n_docs
), i AS (
  SELECT DISTINCT item_id, text FROM benchmark
), q AS (
  SELECT item_id, text, term, count(*)::BIGINT AS times
  FROM (SELECT item_id, text, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i)
  GROUP BY ALL
), s AS (
  SELECT item_id, text, r, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) JOIN n USING (r), a GROUP BY item_id, text, r, doc_id
), o AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS FIRST)::INT AS rank, doc_id, score
  FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10
"""


@query("op13_max_sketch_search", SQL_SEARCH)
def op13_max_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = maxsketch.build_index(table(spark, sf_dir, "documents"))
    return maxsketch.search(index, table(spark, sf_dir, "benchmark"), 10)


SQL_TRIE = rf"""
WITH crc AS ({SQL_CRC}), t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
         count(*) OVER (PARTITION BY conv_id) AS n, strlen(coalesce(text, ''))::BIGINT AS size,
         md5(strlen(coalesce(role, ''))::VARCHAR || ' ' || coalesce(role, '') || ' ' || coalesce(text, '')) AS key
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, {SQL_CRC_OF.replace('text', 'conv_id::VARCHAR')}::BIGINT % 9 AS h FROM (SELECT DISTINCT conv_id FROM t), crc
), r AS (
  SELECT c.conv_id, i, key, size FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND i <= h
  UNION ALL
  SELECT c.conv_id, i + 1000000, key, size FROM c JOIN t ON t.conv_id = c.conv_id AND i > h
), o AS (
  SELECT conv_id, key, size, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS depth FROM r
), p AS (
  SELECT conv_id, depth, size, string_agg(key, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS path FROM o
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
), m AS (
  SELECT conv_id, depth, size, md5(path) AS node, lag(md5(path)) OVER (PARTITION BY conv_id ORDER BY depth) AS up,
         max(depth) OVER (PARTITION BY conv_id) = depth AS is_end
  FROM p
), v AS (
  SELECT node, depth, min(up) AS up, min(conv_id) AS conv_id, count(*)::BIGINT AS n_convs, (count(*) - 1) * min(size) AS own,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end) AS ends
  FROM m GROUP BY node, depth
), k AS (
  SELECT up AS node, count(*)::BIGINT AS n_children FROM v WHERE up IS NOT NULL GROUP BY up
), s AS (
  SELECT a.node, sum(v.own)::BIGINT AS saved_tokens, (count(*) FILTER (k.node IS NULL))::BIGINT AS n_leaves
  FROM (SELECT DISTINCT a.node, b.node AS below FROM m AS a JOIN m AS b ON a.conv_id = b.conv_id AND b.depth >= a.depth) AS a
  JOIN v ON v.node = a.below LEFT JOIN k ON k.node = v.node GROUP BY a.node
)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens,
       sha256(coalesce(v.ends, '')) AS ends_sha256
FROM v JOIN s ON s.node = v.node LEFT JOIN k ON k.node = v.node LEFT JOIN v AS u ON u.node = v.up
"""


@query("op12_turn_trie", SQL_TRIE)
def op12_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = turntrie.encode_turns(table(spark, sf_dir, "conversations"))
    conv_id = F.col("conv_id")
    head_turns = F.crc32(conv_id.cast("string").cast("binary")) % 9
    return turntrie.trie(turntrie.spliced(convs, conv_id - conv_id % 5, head_turns, 8))


ALLOWED_URLS = ("org/", "com/fr/")
BLOCKED_URLS = ("example.org/es/", "example.org/en/1", "com/de/")


@query("op11_path_template_verdicts")
def op11_path_template_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urltree.judge(table(spark, sf_dir, "pages"), ALLOWED_URLS, BLOCKED_URLS)
    return judged.select("page_id", "host", "path", "rule", "verdict")
