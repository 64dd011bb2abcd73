"""Corpus pipeline: language ID, exact dedup, near dedup, mixing and packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and reread as the next one's
docs.  ``run`` applies all stages to ``documents``.  All stages but the last
return the columns of their input.

Defined cases: see the operators.  Where rows share an id, each row is judged by
its own text; rows equal in id and text are one document for the dedup stages and
one of them stays.  A null id is an id like any other.  Empty tables pass through,
and columns beside those of ``documents`` come back as they were, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportflow.llm.exact_dedup import exact_duplicates
from reportflow.llm.language_id import accept
from reportflow.llm.mixing import mixed_documents
from reportflow.llm.ngram_join import near_duplicates
from reportflow.llm.packing import pack_documents
from reportflow.session import scratch_path


def _stay(docs: DataFrame, kept: DataFrame, key) -> DataFrame:
    """One row of ``docs`` for each (id, key) of ``kept``; ``key`` gives a row's key.

    Rows travel as one struct column, so that no name of theirs can clash.
    """
    kept = kept.toDF("kept_id", "kept_key").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").alias("id"), key.alias("key"))
    found = rows.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key")),
                      "left_semi")
    return found.dropDuplicates(["id", "key"]).select("row.*")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter, or of no language the model is sure of, go."""
    return accept(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the document with the smallest id stays."""
    kept = exact_duplicates(docs).filter("kept").select("doc_id", "text_sha256")
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return _stay(docs, kept, F.sha2(text, 256))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near dedup: of each group linked by n-gram similarity the smallest id stays."""
    groups = near_duplicates(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # Rows of one id: each wordless text is a group, of the others the smallest hash stays.
    alone = F.when(F.col("n_shingles") == 0, F.col("text_hash"))
    kept = groups.groupBy("doc_id", alone.alias("_alone")).agg(F.min("text_hash").alias("least"))
    return _stay(docs, kept.select("doc_id", "least"), F.xxhash64("text"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: a document comes as often as the mix takes it, up to twice."""
    return mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: length bucket, batch and place in the batch of every document."""
    return pack_documents(docs)


STAGES = [
    ("language ID", language_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# The language model and the packing program can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; stage results go to shared storage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, "pipeline", str(i))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
