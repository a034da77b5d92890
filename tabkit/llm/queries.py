"""Registered queries: one per operator, over its whole table, and the
pipeline.  Each derives the columns to return from the operator's real
output."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tabkit.functions.frames import materialize
from tabkit.llm import (alignment, bpe, fingerprints, lm, mixing, near_dups, packing, quality, resampling, shards,
                        token_counts, url_lists, warc)
from tabkit.llm.common import documents
from tabkit.session import scratch_path
from tabkit.sources.tables import table


@dataclass(frozen=True)
class LlmQuery:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, LlmQuery] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = LlmQuery(name, fn, sql.strip() if sql else None)
        return fn
    return deco


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)


def all_queries() -> dict[str, LlmQuery]:
    return QUERIES


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), ranks, pattern)
    digests = ids.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                         F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                         "ids")
    return bpe.decode(digests, ranks, pattern).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op10_quality_votes")
def op10_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = materialize(quality.counts_frame(documents(spark, sf_dir).select("doc_id", "text"), keep_text=False))
    judged = quality.judge(counts, quality.fit(counts))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", F.round("p_good", 6).alias("p_good"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey
  FROM documents),
placed AS (
  SELECT *, CASE WHEN size < 16 THEN size
                 ELSE (length(bin(size)) - 1) * 16 + ((size >> (length(bin(size)) - 5)::INT) & 15) END AS cls,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '-42'), 1, 8))::BIGINT % 1024 AS cell
  FROM d),
src AS (SELECT skey, sum(size) AS s FROM placed GROUP BY skey),
weighted AS (
  SELECT *, (CASE (row_number() OVER (ORDER BY skey) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::HUGEINT AS w
  FROM src),
capped AS (
  SELECT *, (sum(2 * s) OVER lv * w + 2 * s * ((SELECT sum(w) FROM weighted) - sum(w) OVER lv)) * 2
            <= (SELECT sum(s) FROM src) * 3 * w AS fullup
  FROM weighted WINDOW lv AS (ORDER BY s * 2 * (10 / w)::BIGINT)),
goal AS (
  SELECT skey, s::BIGINT AS s, CASE WHEN fullup THEN (2 * s)::DOUBLE ELSE
    ((SELECT sum(s) FROM src) * 3 - 2 * coalesce((SELECT sum(2 * s) FROM capped WHERE fullup), 0))::DOUBLE * w::DOUBLE
    / ((SELECT sum(w) FROM capped WHERE NOT fullup) * 2)::DOUBLE END AS target,
    ('0x' || substr(md5(skey || '-42'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM capped),
ranked AS (
  SELECT p.*, row_number() OVER (PARTITION BY skey ORDER BY cls, cell, doc_id, size) AS k FROM placed p)
SELECT doc_id, size, s AS source_size, target,
  (size * (floor(u + r * k::DOUBLE) - floor(u + r * (k - 1)::DOUBLE)))::BIGINT AS taken
FROM (SELECT r.*, g.s, g.target, g.u, CASE WHEN g.s > 0 THEN g.target / g.s::DOUBLE ELSE 0.0 END AS r
      FROM ranked r JOIN goal g USING (skey))
"""


@query("op8_systematic_mix", OP8_SQL)
def op8_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    sized = materialize(docs.select("doc_id", "source", mixing.word_count().alias("size")))
    return mixing.systematic_copies(sized, "size").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op6_lsh_forest")
def op6_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return near_dups.near_duplicates(docs, width=3, threshold=(85, 100)).drop("text_hash")


@query("op2_virtual_slots")
def op2_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4,096 slots in 16 shards balanced by bytes; the map is stored, read
    back and applied, then edited for 17 shards as its second version."""
    slots, n = 4096, 16
    sized = documents(spark, sf_dir).select("doc_id", shards.text_size().alias("size"),
                                            shards.text_crc32().alias("text_crc32"))
    slotted = materialize(shards.with_slots(sized, "size", "text_crc32", slots=slots))
    sizes = shards.slot_sizes(slotted, "size", slots)
    first = shards.new_map(sizes, n)
    path = scratch_path(spark, f"slot-map-{uuid.uuid4().hex}")
    version = shards.store_map(spark, path, first, sizes)
    shards.store_map(spark, path, shards.rebalance(first, sizes, n + 1), sizes)
    edited = shards.load_map(spark, path).select("vslot", F.col("shard").alias("rebalanced_shard"))
    placed = shards.assign(slotted, shards.load_map(spark, path, version), ["doc_id", "size", "text_crc32"])
    return placed.join(F.broadcast(edited), "vslot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot", "map_version", "rebalanced_shard")


@query("op9_sharded_warc")
def op9_sharded_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages in the shared scratch folder, read back."""
    path = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    warc.write(table(spark, sf_dir, "pages"), path, shard_bytes=32 * 1024 * 1024, file_bytes=8 * 1024 * 1024)
    return warc.read(spark, path).select(F.col("page").alias("page_id"), "payload_bytes", "payload_digest",
                                         "record_type", "refers_to")


@query("op1_multiset_hash")
def op1_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


OP7_SQL = r"""
WITH cap AS (
  SELECT page_id, url, DATE '2023-01-01' + (('0x' || substr(md5(page_id::VARCHAR || '-fetch'), 1, 8))::BIGINT % 730)::INT AS day,
         nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '') AS host,
         nullif(regexp_extract(url, '^[^/?#]*://[^/?#]*/([^/?#]+)', 1), '') AS seg
  FROM pages),
keyed AS (
  SELECT page_id, url, day, host || '/' || seg AS path, host,
         coalesce(nullif(regexp_extract(host, '([^.]+\.[^.]+)$', 1), ''), host) AS domain FROM cap),
names AS (
  SELECT DISTINCT 'path' AS level, path AS key FROM keyed WHERE path IS NOT NULL UNION ALL
  SELECT DISTINCT 'host', host FROM keyed WHERE host IS NOT NULL UNION ALL
  SELECT DISTINCT 'domain', domain FROM keyed WHERE domain IS NOT NULL),
hashed AS (
  SELECT level, key, ('0x' || substr(md5(level || ':' || key || ':' || k), 1, 8))::BIGINT AS h
  FROM names, (SELECT unnest([0, 1, 2])::VARCHAR AS k)),
entries AS (
  SELECT level, key, min(CASE h % 3 WHEN 0 THEN 'block' WHEN 1 THEN 'allow' ELSE 'remove' END
                         ) FILTER (h % 3 = 0) AS b,
         bool_or(h % 3 = 1) AS a, DATE '2023-01-01' + ((h // 16) % 730)::INT AS listed_on
  FROM hashed WHERE (h // 4) % 4 < 2 GROUP BY level, key, listed_on),
spans AS (
  SELECT level, key, CASE WHEN b IS NOT NULL THEN 'block' WHEN a THEN 'allow' ELSE 'remove' END AS action, listed_on,
         lead(listed_on) OVER (PARTITION BY level, key ORDER BY listed_on) AS listed_to FROM entries),
live AS (SELECT * FROM spans WHERE action <> 'remove')
SELECT c.page_id, c.day::VARCHAR AS fetched_on, c.host,
       coalesce(p.level, h.level, d.level) AS list_level, coalesce(p.action, h.action, d.action) AS list_action,
       (CASE WHEN p.level IS NOT NULL THEN p.listed_on WHEN h.level IS NOT NULL THEN h.listed_on ELSE d.listed_on END)::VARCHAR AS listed_on,
       (CASE WHEN p.level IS NOT NULL THEN p.listed_to WHEN h.level IS NOT NULL THEN h.listed_to ELSE d.listed_to END)::VARCHAR AS listed_to,
       coalesce(coalesce(p.action, h.action, d.action) = 'block', false) AS blocked
FROM keyed c
LEFT JOIN live p ON p.level = 'path' AND p.key = c.path AND c.day >= p.listed_on AND (p.listed_to IS NULL OR c.day < p.listed_to)
LEFT JOIN live h ON h.level = 'host' AND h.key = c.host AND c.day >= h.listed_on AND (h.listed_to IS NULL OR c.day < h.listed_to)
LEFT JOIN live d ON d.level = 'domain' AND d.key = c.domain AND c.day >= d.listed_on AND (d.listed_to IS NULL OR c.day < d.listed_to)
"""


def _hash32(text) -> F.Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


@query("op7_temporal_url_list", OP7_SQL)
def op7_temporal_url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as captures with a fetch date from their id, against a list
    whose entries are drawn, by hashes, from the pages' own paths, hosts and
    domains."""
    start = F.lit("2023-01-01").cast("date")
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.date_add(start, (_hash32(F.concat(F.col("page_id").cast("string"), F.lit("-fetch"))) % 730)
                                     .cast("int")).alias("fetched_on"))
    keys = url_lists.url_keys(F.col("url"))
    named = pages.select(F.explode(F.array(*(F.struct(F.lit(level).alias("level"), k.alias("key"))
                                             for level, k in keys.items()))).alias("n")).select("n.*").where("key is not null")
    drawn = (named.distinct().withColumn("k", F.explode(F.array(*map(F.lit, "012"))))
             .withColumn("h", _hash32(F.concat_ws(":", "level", "key", "k"))).where("(h div 4) % 4 < 2"))
    entries = materialize(drawn.select(
        "level", "key", F.element_at(F.array(*map(F.lit, ("block", "allow", "remove"))), (F.col("h") % 3 + 1).cast("int")).alias("action"),
        F.date_add(start, F.expr("cast((h div 16) % 730 as int)")).alias("listed_on")))
    judged = url_lists.judge(pages, entries)
    return judged.select("page_id", F.col("fetched_on").cast("string").alias("fetched_on"), keys["host"].alias("host"),
                         "list_level", "list_action", F.col("listed_on").cast("string").alias("listed_on"),
                         F.col("listed_to").cast("string").alias("listed_to"), "blocked")


@query("op5_unigram_counts")
def op5_unigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir).select("doc_id", "text"),
                                     public_tokenizers.path("piece_bpe_32k.model"), keep_text=False)


@query("op4_packed_rows")
def op4_packed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of 2,048 ids, padded with the id that the vocabulary leaves free."""
    ids = packing.library_ids(documents(spark, sf_dir).select("doc_id", "text"),
                              public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return packing.pack(ids, capacity=2048, pad=50256)


@query("op11_importance_resampling")
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed towards the benchmark's texts; one in twenty of
    those with 20 words or more is drawn."""
    drawn = resampling.resample(documents(spark, sf_dir).select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_neural_scores")
def op12_neural_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


@query("op13_tokenizer_alignment")
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))
