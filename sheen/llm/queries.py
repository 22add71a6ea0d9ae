"""Queries of the training-data operators, and DuckDB SQL where it can state them."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheen.llm import oracle
from sheen.llm.chat import digests, format_chats
from sheen.llm.common import documents
from sheen.llm.embedding_dedup import embedding_dedup
from sheen.llm.exact_dedup import exact_dedup
from sheen.llm.language_id import held_out, languages
from sheen.llm.minhash import near_dedup
from sheen.llm.mixing import mix
from sheen.llm.periodic_runs import periodic_runs, run_digests, with_planted_periods
from sheen.llm.pieces import encode
from sheen.llm.quality import quality_scores
from sheen.llm.secrets import secret_digests
from sheen.llm.substring_dedup import substring_dedup
from sheen.llm.suffix_dedup import suffix_dedup
from sheen.llm.whitening import component_rows, whiten
from sheen.session import table

WS = r"[\x20\x09-\x0D]"


def op1_mix_sources(spark, sf_dir):
    """All documents mixed to the source targets."""
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op2_suffix_dedup(spark, sf_dir):
    """All documents without the 100-byte strings that also start earlier."""
    return suffix_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_minhash_dedup(spark, sf_dir):
    """All documents with their component of near copies."""
    return near_dedup(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


def op4_exact_dedup(spark, sf_dir):
    """Groups of documents whose texts agree up to white space."""
    return exact_dedup(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_quality(spark, sf_dir):
    """All documents scored; those of 0.5 or more are kept."""
    return quality_scores(documents(spark, sf_dir), table(spark, sf_dir, "labels")).select(
        "doc_id", "p_weak", "score", "kept")


def op6_sentencepiece(spark, sf_dir):
    """The tokens of all documents, and whether they decode to the text."""
    return encode(documents(spark, sf_dir)).select("doc_id", "n_tokens", "ids", "round_trip")


def op7_embedding_dedup(spark, sf_dir):
    """All vectors with their links and component at cosine 0.9."""
    return embedding_dedup(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


def op8_chat_format(spark, sf_dir):
    """All conversations formatted, and conversation -7, whose texts hold control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return digests(format_chats(turns.union(extra)))


def op9_secret_scan(spark, sf_dir):
    """Secrets of all documents, each distinct text scanned once."""
    return secret_digests(spark, documents(spark, sf_dir))


def op10_substring_dedup(spark, sf_dir):
    """All documents without the 35-word windows that also start elsewhere."""
    return substring_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_whitening(spark, sf_dir):
    """All usable vectors along the 16 leading components of the distinct ones."""
    return component_rows(whiten(table(spark, sf_dir, "embeddings"))).select(
        "vec_id", "component", "n", F.expr("try_cast(deviation as bigint)").alias("deviation"), "whitened", "explained",
        "identity_error")


def op12_periodic_runs(spark, sf_dir):
    """The periodic runs of all documents, a tenth of which are made periodic first."""
    return run_digests(periodic_runs(with_planted_periods(documents(spark, sf_dir))))


def op13_language_id(spark, sf_dir):
    """The language of all documents, learned from four fifths of them."""
    docs, out = documents(spark, sf_dir), held_out(F.col("doc_id"))
    return languages(docs, learn=~out & F.col("doc_id").isNotNull()).select(
        "doc_id", out.alias("held_out"), "lang_pred", "score", "rejected")


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_suffix_dedup, op3_minhash_dedup, op4_exact_dedup, op5_quality, op6_sentencepiece,
    op7_embedding_dedup, op8_chat_format, op9_secret_scan, op10_substring_dedup, op11_whitening,
    op12_periodic_runs, op13_language_id)}

SQL = {
    "op1_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix-1:' || doc_id::VARCHAR), 1, 15))::BIGINT AS k
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS i,
         coalesce(sum(3 * source_size) OVER (ORDER BY source_size / w, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS stopped,
         sum(w) OVER (ORDER BY source_size / w, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w,
         sum(source_size) OVER ()::BIGINT AS total
  FROM s),
share AS (
  SELECT arg_min((total - stopped)::DOUBLE / open_w, i) AS lam FROM o
  WHERE 3 * source_size >= (total - stopped)::DOUBLE / open_w * w),
t AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, lam * w) AS target FROM s, share),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, round(t.target)::BIGINT AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken
FROM e""",
    "op4_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS kept,
       sha256(t) AS text_sha256
FROM d""",
    "op8_chat_format": r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
r AS (
  SELECT *, length('### ') + length(CASE role WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant'
              WHEN 'system' THEN 'System' END) + length(': ') + length(text)
            + len(regexp_extract_all(text, '###|</turn>')) + length('</turn>') + 2 AS chars
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM r GROUP BY conv_id""",
    "op2_suffix_dedup": oracle.SUFFIX_DEDUP,
    "op3_minhash_dedup": oracle.MINHASH_DEDUP,
    "op7_embedding_dedup": oracle.EMBEDDING_DEDUP,
    "op9_secret_scan": oracle.SECRET_SCAN,
    "op10_substring_dedup": oracle.SUBSTRING_DEDUP,
    "op12_periodic_runs": oracle.PERIODIC_RUNS,
}
