"""The operators as queries over the given tables, with the columns their contracts state, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.bigru import toxicity_scores
from strata.llm.bpe import encode_documents
from strata.llm.common import read_table
from strata.llm.imatch import edited_fingerprints
from strata.llm.licenses import scan_licenses
from strata.llm.mixing import mix_sources
from strata.llm.nbsvm import quality_scores
from strata.llm.prefix_join import jaccard_components
from strata.llm.prefix_trie import prefix_trie
from strata.llm.simhash import simhash_groups
from strata.llm.threshold import top_k
from strata.llm.token_counts import count_tokens
from strata.llm.warc import warc_round_trip
from strata.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def add(function):
        QUERIES[name] = function
        return function

    return add


@query("op1_entropy_balanced_mix")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sources(read_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", "taken")


@query("op2_warc_members")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_round_trip(read_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op2_warc_members"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
g AS (SELECT digest, n, max(page_id) AS chosen FROM p WHERE n >= 1000 GROUP BY digest, n)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN g.chosen IS NOT NULL AND p.page_id IS DISTINCT FROM g.chosen THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN g.chosen IS NOT NULL AND p.page_id IS DISTINCT FROM g.chosen THEN g.chosen END AS refers_to
FROM p LEFT JOIN g USING (digest, n)
"""


@query("op3_threshold_top_k")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5, scale=256)


ORACLES["op3_threshold_top_k"] = """
WITH v AS (SELECT row_number() OVER () AS own, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.own, q.vec_id AS query_id, c.vec_id, CASE WHEN len(q.v) = 0 THEN 0 ELSE CAST(list_inner_product(q.v, c.v) AS BIGINT) END AS score
  FROM v q JOIN v c ON q.own <> c.own AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@query("op5_imatch_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read_table(spark, sf_dir, "documents"))


@query("op6_byte_level_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    coded = encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query("op7_nbsvm_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op8_simhash_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(read_table(spark, sf_dir, "documents"))


@query("op9_license_signatures")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query("op10_bigru_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op11_conversation_prefix_trie")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


# crc32 bit by bit over the digits of a conversation's number
CRC32 = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(CAST(c AS VARCHAR)) + 1),
  lambda i: CAST(ascii(CAST(c AS VARCHAR)[i]) AS BIGINT))), lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
  lambda v, zero: xor(v >> 1, 3988292384::BIGINT * (v & 1)))))"""

ORACLES["op11_conversation_prefix_trie"] = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i,
    md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS turn_key,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT c, c - c % 20 AS base, {CRC32} % 4 AS h FROM (SELECT DISTINCT conv_id AS c FROM t) x),
r AS (SELECT c.c, t.* EXCLUDE (conv_id) FROM c JOIN t ON t.conv_id = c.base AND t.i < c.h
  UNION ALL SELECT c.c, t.* EXCLUDE (conv_id) FROM c JOIN t ON t.conv_id = c.c AND t.i >= c.h),
p AS (SELECT c, words, row_number() OVER w AS depth, string_agg(turn_key, '') OVER w AS node FROM r WINDOW w AS (PARTITION BY c ORDER BY i)),
every AS (SELECT c, words, depth, node FROM p UNION ALL SELECT c, 0, 0, '' FROM c),
n AS (SELECT node, depth, min(c) AS conv_id, count(*) AS n_convs, max(words) AS words FROM every GROUP BY node, depth),
ends AS (SELECT node, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM (SELECT c, max(node) AS node FROM every GROUP BY c) x GROUP BY node),
kids AS (SELECT left(node, 32 * (depth - 1)) AS node, count(*) AS n FROM n WHERE depth > 0 GROUP BY 1),
under AS (SELECT left(n.node, 32 * CAST(d AS BIGINT)) AS node, count(*) FILTER (kids.n IS NULL) AS n_leaves, sum((n_convs - 1) * words) AS saved
  FROM n LEFT JOIN kids USING (node), unnest(range(0, depth + 1)) AS u(d) GROUP BY 1)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children, CAST(under.n_leaves AS BIGINT) AS n_leaves,
  CAST(under.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM n LEFT JOIN n up ON n.depth > 0 AND up.node = left(n.node, 32 * (n.depth - 1)) AND up.depth = n.depth - 1
  LEFT JOIN kids ON kids.node = n.node LEFT JOIN under ON under.node = n.node LEFT JOIN ends ON ends.node = n.node
"""


@query("op12_ngram_jaccard_join")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))


ORACLES["op12_ngram_jaccard_join"] = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
l AS (SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id, doc_id AS other FROM s UNION SELECT reach.doc_id, l.y FROM reach JOIN l ON reach.other = l.x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, (SELECT min(other) FROM reach WHERE reach.doc_id = s.doc_id) AS component_id FROM s
"""


@query("op13_spectrum_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
