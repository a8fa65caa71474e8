"""The registered queries of the operators of this package, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.llm import (decision_lists, hard_negatives, order_minhash, personal_data, piece_encoding, positional_index, prefix_trie, projections, secret_index, suffix_sort, token_codes,
                           toxicity, url_trees)
from propensity.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


def joined_spans(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    return F.concat_ws(",", F.transform(spans, one))


def count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")


# ---- 2: secrets

def _kind_sql(rank: int, rule: secret_index.Rule, group: int, least: int) -> str:
    """DuckDB: list of {start, rank, end, kind} of one rule; lengths are code points."""
    pattern = rule.pattern.replace("'", "''")
    return f"""list_transform(list_filter(list_transform(range(1, len(regexp_extract_all(t, '{pattern}')) + 1), lambda i: {{
        'start': list_sum(list_transform(regexp_split_to_array(t, '{pattern}')[1:i], lambda x: length(x)))::BIGINT
               + coalesce(list_sum(list_transform(regexp_extract_all(t, '{pattern}')[1:i-1], lambda x: length(x))), 0)::BIGINT,
        'rank': {rank}, 'size': length(regexp_extract_all(t, '{pattern}')[i]),
        'part': length(regexp_extract_all(t, '{pattern}', {group})[i])}}), lambda m: m.part >= {least}),
        lambda m: {{'start': m.start, 'rank': m.rank, 'end': m.start + m.size, 'kind': '{rule.kind}'}})"""


_LEAST = {"assign": (2, 12), "access": (0, 18)}
_SPAN_TEXT = "coalesce(array_to_string(list_transform({0}, lambda m: m.kind || ':' || m.start || ':' || m.end), ','), '')"
_ALL_SPANS = "list_sort(list_concat(" + ", ".join(
    _kind_sql(i, r, *_LEAST.get(r.kind, (0, 0))) for i, r in enumerate(secret_index.RULES)) + "))"
_BASE = "list_filter(spans, lambda m: m.rank < 3)"
SECRETS_SQL = f"""
SELECT doc_id,
       len(list_filter(spans, lambda m: m.kind = 'assign'))::BIGINT AS n_assign,
       len(list_filter(spans, lambda m: m.kind = 'access'))::BIGINT AS n_access,
       len(list_filter(spans, lambda m: m.kind = 'hex'))::BIGINT AS n_hex,
       sha256({_SPAN_TEXT.format(_BASE)}) AS base_sha256,
       {_SPAN_TEXT.format("spans")} AS spans
FROM (SELECT doc_id, {_ALL_SPANS} AS spans FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))"""


@query("op2_secret_scan", SECRETS_SQL)
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_index.find_secrets(table(spark, sf_dir, "documents"), secret_index.RULES)
    base = [r.kind for r in secret_index.BASE_RULES]
    return found.select(
        "doc_id", *[count_of(k).alias(f"n_{k}") for k in base],
        F.sha2(joined_spans(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"))


# ---- 5: benchmark passages

@query("op5_benchmark_passages")
def benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional_index.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda acc, h: acc + h["end"] - h["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


# ---- 4: pieces

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@query("op4_piece_encoding")
def piece_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_encoding.encode_documents(table(spark, sf_dir, "documents"), PIECES, ids=False)


# ---- 10: token files

@query("op10_token_codes")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_codes.write_tokens(table(spark, sf_dir, "documents"), WORDS, end_id=2)
    return token_codes.read_documents(spark.read.parquet(path), ids=False)


# ---- 9: URLs

@query("op9_url_filter")
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_trees.judge(pages).select("page_id", "host", "path", "rule", "verdict", "p_block")


# ---- 7: toxicity

def learning_labels(labels: DataFrame) -> DataFrame:
    """The rows that a fit may use: crc32 of the id as text, modulo 4, is not 2."""
    return labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)


@query("op7_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, learning_labels(table(spark, sf_dir, "labels")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return toxicity.score_documents(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


# ---- 1: near-duplicates

@query("op1_near_duplicates")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.find_groups(table(spark, sf_dir, "documents"), shingles=order_minhash.SIMILARITY)


# ---- 3: embeddings

EMBEDDINGS_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(id, other) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other),
named AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id)::BIGINT AS n_links, component_id,
       vec_id = component_id AS kept
FROM embeddings JOIN named ON named.id = vec_id"""


@query("op3_embedding_links", EMBEDDINGS_SQL)
def embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.find_links(table(spark, sf_dir, "embeddings"))


# ---- 6: repeated passages

@query("op6_repeated_passages")
def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_sort.remove_repeats(table(spark, sf_dir, "documents"), kept_text=False)


# ---- 8: personal data

@query("op8_personal_data")
def personal_data_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = personal_data.find_personal_data(docs, personal_data.fit(docs))
    base = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return found.select("doc_id", *[base(k) for k in personal_data.KINDS],
                        F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"))


# ---- 11: quality rules

@query("op11_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decision_lists.filter_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


# ---- 12: hard negatives

NEGATIVES_SQL = """
WITH v AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
    FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 100 = 0),
positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id)
QUALIFY row_number() OVER w <= 5"""


@query("op12_hard_negatives", NEGATIVES_SQL)
def mined_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


# ---- 13: conversation prefixes

_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i, 1))::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
PREFIX_SQL = f"""
WITH own AS (
    SELECT conv_id, conv_id::VARCHAR AS s, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST,
        sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT conv_id, s, turns, ({_CRC}) % 6 AS h FROM own),
paths AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS p
    FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
members AS (SELECT conv_id, len(p) AS n, d, md5(p[1:d]::JSON::VARCHAR) AS node, CASE WHEN d > 0 THEN md5(p[1:d - 1]::JSON::VARCHAR) END AS parent,
        CASE WHEN d > 0 THEN length(p[d].t) ELSE 0 END AS chars
    FROM paths, unnest(range(0, len(p) + 1)) AS r(d)),
nodes AS (
    SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           (count(*) - 1) * any_value(chars) AS own,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
    FROM members GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
sums AS (
    SELECT m.node, count(*) FILTER (k.n_children IS NULL) AS n_leaves, sum(b.own) AS saved
    FROM nodes b LEFT JOIN kids k ON k.node = b.node JOIN members m ON m.conv_id = b.conv_id AND m.d <= b.depth GROUP BY m.node)
SELECT a.conv_id, a.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, a.n_convs::BIGINT AS n_convs,
       coalesce(k.n_children, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, a.ends_sha256
FROM nodes a JOIN sums s ON s.node = a.node LEFT JOIN kids k ON k.node = a.node LEFT JOIN nodes p ON p.node = a.parent"""


@query("op13_conversation_trie", PREFIX_SQL)
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(table(spark, sf_dir, "conversations"))
