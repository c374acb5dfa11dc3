"""The numbered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import (
    best_fit,
    block_anchors,
    context_mixing,
    conversation_trie,
    dart_minhash,
    disclosure,
    fertility,
    merge_automaton,
    ngram_toxicity,
    pivot_index,
    site_templates,
    token_efficiency,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        REGISTRY[name] = function
        return function

    return register


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


@query("op1_context_mixing")
def language_model(spark: SparkSession, root: str) -> DataFrame:
    return context_mixing.score(table(spark, root, "documents"))


@query("op2_block_anchors")
def substrings(spark: SparkSession, root: str) -> DataFrame:
    found = block_anchors.remove_repeats(table(spark, root, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op3_best_fit_packing")
def packing(spark: SparkSession, root: str) -> DataFrame:
    return best_fit.pack(table(spark, root, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op4_dart_minhash")
def near_duplicates(spark: SparkSession, root: str) -> DataFrame:
    return dart_minhash.classes(table(spark, root, "documents"))


@query("op5_disclosure")
def personal_data(spark: SparkSession, root: str) -> DataFrame:
    return disclosure.report(disclosure.find(table(spark, root, "documents").select("doc_id", "text")))


@query("op6_ngram_toxicity")
def toxicity(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    return ngram_toxicity.scored(docs, ngram_toxicity.train(docs, table(spark, root, "labels")))


@query("op7_merge_automaton")
def bpe(spark: SparkSession, root: str) -> DataFrame:
    return merge_automaton.digests(table(spark, root, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op8_pivot_index")
def nearest(spark: SparkSession, root: str) -> DataFrame:
    vectors = pivot_index.whole_vectors(table(spark, root, "embeddings"))
    return pivot_index.search(vectors, vectors.where("vec_id % 20 = 0"))


@query("op9_tokeniser_fertility")
def quality(spark: SparkSession, root: str) -> DataFrame:
    measured = fertility.measure(
        table(spark, root, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    more = ("n_tokens", "chars_per_token", "byte_share", "entropy_share")
    return fertility.judged(measured).select("doc_id", *columns, *more)


@query("op10_token_efficiency")
def secrets(spark: SparkSession, root: str) -> DataFrame:
    found = token_efficiency.spans(table(spark, root, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return token_efficiency.report(found)


@query("op11_adaptive_radix")
def conversation_prefixes(spark: SparkSession, root: str) -> DataFrame:
    turns = conversation_trie.sequences(table(spark, root, "conversations"))
    return conversation_trie.trie(conversation_trie.with_heads(turns))


@query("op12_site_templates")
def main_text(spark: SparkSession, root: str) -> DataFrame:
    return site_templates.main_texts(table(spark, root, "pages"))


@query("op13_jacobi_davidson")
def whitened(spark: SparkSession, root: str) -> DataFrame:
    return whitening.whiten(whitening.whole_vectors(table(spark, root, "embeddings")))


ORACLE["op2_block_anchors"] = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, words, UNNEST(range(1, GREATEST(1, len(words) - 33))) AS p FROM texts
), windows AS (
  SELECT doc_id, p, array_to_string(words[p:p + 34], ' ') AS w FROM starts
), repeated AS (
  SELECT doc_id, p FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING COUNT(*) > 1)
), gone AS (
  SELECT DISTINCT doc_id, p + k AS p FROM repeated, (SELECT UNNEST(range(0, 35)) AS k)
), places AS (
  SELECT doc_id, words, UNNEST(range(1, len(words) + 1)) AS p FROM texts
), kept AS (
  SELECT doc_id, string_agg(words[p], ' ' ORDER BY p) AS text, COUNT(*) AS n
  FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - COALESCE(n, 0) AS BIGINT) AS n_removed,
  sha256(COALESCE(text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept USING (doc_id)
"""

ORACLE["op8_pivot_index"] = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(FLOOR(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: CAST(p[1] AS HUGEINT) * p[2])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

ORACLE["op11_adaptive_radix"] = """
WITH turns AS (
  SELECT conv_id, COALESCE(role, '') AS role, COALESCE(text, '') AS text, turn,
    substr(sha256(strlen(COALESCE(role, '')) || ':' || COALESCE(role, '') || COALESCE(text, '')), 1, 32) AS id
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids,
    list(strlen(text) ORDER BY turn NULLS FIRST, id) AS sizes,
    xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, step: xor(x >> 1, 3988292384 * (x & 1))
      )
    )) % 9 AS h
  FROM turns GROUP BY conv_id
), rebuilt AS (
  SELECT o.conv_id,
    CASE WHEN o.conv_id % 5 = 0 THEN o.ids ELSE list_concat(COALESCE(b.ids[1:o.h], []), o.ids[o.h + 1:]) END AS ids,
    CASE WHEN o.conv_id % 5 = 0 THEN o.sizes ELSE list_concat(COALESCE(b.sizes[1:o.h], []), o.sizes[o.h + 1:]) END AS sizes
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5
), places AS (
  SELECT conv_id, ids, sizes, UNNEST(range(0, len(ids) + 1)) AS depth FROM rebuilt
), prefixes AS (
  SELECT conv_id, depth, array_to_string(ids[1:depth], '') AS path, depth = len(ids) AS ends,
    CASE WHEN depth = 0 THEN 0 ELSE sizes[depth] END AS size
  FROM places
), nodes AS (
  SELECT path, depth, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs, MAX(size) AS size,
    sha256(COALESCE(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY path, depth
), families AS (
  SELECT substr(path, 1, 32 * (depth - 1)) AS path, COUNT(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), counted AS (
  SELECT n.*, COALESCE(n_children, 0) AS n_children FROM nodes n LEFT JOIN families USING (path)
), above AS (
  SELECT path, n_children, (n_convs - 1) * size AS saved, UNNEST(range(0, depth + 1)) AS d FROM counted
), subtrees AS (
  SELECT substr(path, 1, 32 * d) AS path, COUNT(*) FILTER (n_children = 0) AS n_leaves, SUM(saved) AS saved
  FROM above GROUP BY 1
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN subtrees s ON s.path = n.path
LEFT JOIN nodes p ON n.depth > 0 AND p.path = substr(n.path, 1, 32 * (n.depth - 1))
"""
