"""Registered queries of the training-data operators, and their SQL.

Each query applies its operator, with production parameters, to whole tables
and derives the columns of the contract from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportflow.llm.conversation_repair import repair_conversations
from reportflow.llm.embedding_dedup import near_duplicates
from reportflow.llm.exact_dedup import exact_duplicates
from reportflow.llm.language_id import identify
from reportflow.llm.language_model import score_texts
from reportflow.llm.mixing import mix_sources
from reportflow.llm.ngram_join import near_duplicates as near_shingles
from reportflow.llm.oracles import EMBEDDING_SQL, NGRAM_SQL, REPAIR_SQL, SPELLING_SQL
from reportflow.llm.packing import pack_documents
from reportflow.llm.personal_data import find_personal_data
from reportflow.llm.repeated_passages import repeated_passages
from reportflow.llm.secret_scan import KINDS, UNOPENED, find_secrets
from reportflow.llm.spelling import spelling_variants
from reportflow.llm.toxicity import score_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat_ws(':', '17', coalesce(doc_id::VARCHAR, ''))) AS k
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM totals),
levels AS (
  SELECT *, 2 * source_size AS cap, 2 * source_size / w::DOUBLE AS ratio,
         1.5::DOUBLE * sum(source_size) OVER () AS budget, sum(w) OVER () AS all_w
  FROM weighed),
filled AS (
  SELECT *, sum(cap) OVER o + ratio * (all_w - sum(w) OVER o) <= budget AS is_full
  FROM levels WINDOW o AS (ORDER BY ratio RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE w * (
    (budget - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (), 0))
    / sum(CASE WHEN NOT is_full THEN w END) OVER ()) END AS target
  FROM filled),
placed AS (
  SELECT s.*, t.source_size, t.target,
         sum(size) OVER (PARTITION BY s.source ORDER BY k, doc_id, size
                         ROWS UNBOUNDED PRECEDING)::BIGINT AS cum,
         row_number() OVER () AS rid
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT rid, doc_id, k, size, p, (cum + p * source_size) / target AS finish
  FROM placed, (VALUES (0), (1)) AS v(p) WHERE size > 0 AND target > 0),
queued AS (
  SELECT *, sum(size) OVER (ORDER BY finish, k, doc_id, p, size ROWS UNBOUNDED PRECEDING) AS run
  FROM copies),
taken AS (
  SELECT rid, sum(size)::BIGINT AS taken FROM queued
  WHERE run <= (SELECT 1.5 * sum(size) FROM sized) GROUP BY rid)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM placed LEFT JOIN taken USING (rid)
"""


@_register("op3_mix_sources", MIXING_SQL)
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents: sources to their targets by weighted fair queueing."""
    return mix_sources(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


@_register("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into length buckets of least padding and token-budget batches."""
    return pack_documents(_table(spark, sf_dir, "documents"))


EXACT_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t)::BIGINT AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""


@_register("op8_exact_dedup", EXACT_SQL)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents by content-defined chunk recipes."""
    return exact_duplicates(_table(spark, sf_dir, "documents"))


@_register("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document: family first, then pairwise SVMs inside it."""
    return identify(_table(spark, sf_dir, "documents"))


@_register("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by an n-gram classifier with naive Bayes scaled features."""
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_register("op10_personal_data")
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base spans and the terms that reveal them."""
    found = find_personal_data(_table(spark, sf_dir, "documents"))
    extra = F.transform("terms", lambda x: F.concat_ws(
        ":", F.lit("term"), x.start.cast("string"), x.end.cast("string")))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"),
        F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.concat_ws(",", extra).alias("x"))
        .alias("spans"))


@_register("op7_embedding_dedup", EMBEDDING_SQL)
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.93 or more within a label."""
    return near_duplicates(_table(spark, sf_dir, "embeddings"))


@_register("op5_ngram_join", NGRAM_SQL)
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at a Jaccard similarity of 0.75 on five-word shingles."""
    return near_shingles(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@_register("op4_repeated_passages")
def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of 100 bytes and more in all documents; first occurrences stay."""
    found = repeated_passages(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
                        "kept_sha256")


@_register("op9_lm_scoring")
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents from an Elias-Fano n-gram trie."""
    return score_texts(_table(spark, sf_dir, "documents"))


def _spans(spans) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(
        ":", x.kind, x.start.cast("string"), x.end.cast("string"))))


def _kind(kind: str) -> Column:
    return F.size(F.filter("base", lambda x: x.kind == kind)).cast("bigint")


@_register("op11_secret_scan")
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base spans and those in layers unwrapped from its text."""
    found = find_secrets(_table(spark, sf_dir, "documents"))
    rank = lambda x: F.array_position(F.array(*map(F.lit, (*KINDS, UNOPENED))), x.kind)     # noqa: E731
    order = lambda x: F.struct(x.start.alias("start"), rank(x).alias("rank"),               # noqa: E731
                               x.end.alias("end"), x.kind.alias("kind"))
    every = F.array_sort(F.transform(F.concat("base", "hidden"), order))
    return found.select(
        "doc_id", _kind("assign").alias("n_assign"), _kind("access").alias("n_access"), _kind("hex").alias("n_hex"),
        F.sha2(_spans(F.col("base")), 256).alias("base_sha256"), _spans(every).alias("spans"))


@_register("op12_spelling_variants", SPELLING_SQL)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their more frequent neighbours a single edit away."""
    return spelling_variants(_table(spark, sf_dir, "documents"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with every twentieth turn each dropped, emptied, cut, repeated or given to the user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))       # noqa: E731
    code = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("code") == 3, 2).otherwise(1)))
    text = F.when(F.col("code") == 1, "").when(
        F.col("code") == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    x = rows.select("conv_id", "turn", "role", "text", code.alias("code")).filter("code <> 0")
    return x.select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(space("role")).alias("role"),
                    text.alias("text"), copies.alias("copy")).drop("copy")


@_register("op13_conversation_repair", REPAIR_SQL)
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of all damaged conversations and their cheapest repair."""
    rows = _table(spark, sf_dir, "conversations")
    every = rows.select(F.col("conv_id").alias("_conv")).distinct()
    found = repair_conversations(damaged(rows))
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in
              ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.col("_conv").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_conv").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
