"""Mixing sources to target weights by weighted fair queueing.

Every source is put in a reproducible random order.  A document's virtual
finish time is the number of words of its source up to and with it, divided by
the source's target; a second pass over a source continues where the first
ended.  All copies are then ordered by virtual finish time over all sources and
cut where the running total would exceed the budget.  Only DataFrame functions
are used.

Targets: the budget is ``share`` times all words.  Sources share it by weight; a
target stops at ``passes`` times the words of its source, and what it leaves is
shared again by weight among the others.  Sources get their weights in code
point order, the null source last.

Defined cases: a null text has no words; documents without words take part with
size 0 and take 0 words; the null source is a source; repeated rows are
documents of their own; an empty table gives an empty result.  Only the three
named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reportflow.llm.ordered import key_range, range_count, running_total, shuffle_key
from reportflow.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text):
    """Number of words of a text column; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(totals: DataFrame, weights: tuple[int, ...] = (3, 1, 2),
                   share: float = 1.5, passes: int = 2) -> DataFrame:
    """(source, source_size) to (source, source_size, target), one row per source.

    Water-filling in closed form: a source is full when the level that fills it
    exactly, with every source of a lower ratio full as well, stays within the
    budget.  The windows here see one small row per distinct source.
    """
    names = W.orderBy(F.col("source").asc_nulls_last())
    nth = F.pmod(F.row_number().over(names) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (nth + 1).cast("int"))
    everything = W.partitionBy()
    t = (totals.withColumn("_w", weight.cast("bigint"))
         .withColumn("_cap", F.col("source_size") * F.lit(passes))
         .withColumn("_ratio", F.col("_cap") / F.col("_w"))
         .withColumn("_budget", F.sum("source_size").over(everything) * F.lit(float(share)))
         .withColumn("_all_w", F.sum("_w").over(everything)))
    lower = W.orderBy("_ratio").rangeBetween(W.unboundedPreceding, W.currentRow)
    t = (t.withColumn("_cap_upto", F.sum("_cap").over(lower))
         .withColumn("_w_upto", F.sum("_w").over(lower)))
    level = F.col("_cap_upto") + F.col("_ratio") * (F.col("_all_w") - F.col("_w_upto"))
    t = t.withColumn("_full", level <= F.col("_budget"))
    spent = F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(everything), F.lit(0))
    rest_w = F.sum(F.when(~F.col("_full"), F.col("_w"))).over(everything)
    t = t.withColumn("_level", (F.col("_budget") - spent) / rest_w)
    target = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(
        F.col("_w") * F.col("_level"))
    return t.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights: tuple[int, ...] = (3, 1, 2),
                share: float = 1.5, passes: int = 2, seed: int = 17) -> DataFrame:
    """One row per document: (id, source, size, source_size, target, copies, taken)."""
    ensure_checkpoint_dir(docs.sparkSession)
    sized = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"),
                        word_count(F.col(text_col)).alias("size"))
    # Ids, sources and sizes only: the texts are read once.
    sized = sized.withColumn("_key", shuffle_key(F.lit(seed), F.col("_id"))).checkpoint()
    rows, words = sized.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = range_count(rows)
    sized = sized.withColumn("_at", key_range(F.col("_key"), ranges))

    totals = (sized.groupBy("source", "_at").agg(F.sum("size").alias("_s"))
              .groupBy("source").agg(F.sum("_s").alias("source_size")))
    targets = source_targets(totals, weights, share, passes)
    placed = running_total(sized, ["source"], "_at", ["_key", "_id", "size"], "size", "_cum",
                           extra=targets).drop("_at").checkpoint()

    # Virtual finish times of all copies; sources without words queue nothing.
    copies = (placed.filter((F.col("size") > 0) & (F.col("target") > 0))
              .withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
              .withColumn("_finish", (F.col("_cum") + F.col("_pass") * F.col("source_size"))
                          / F.col("target"))
              .withColumn("_slot", F.floor(F.least(F.col("_finish"), F.lit(float(4)))
                                           * F.lit(ranges)).cast("bigint")))
    budget = share * words
    slots = copies.groupBy("_slot").agg(F.sum("size").alias("_words"))
    slots = slots.withColumn("_upto", F.sum("_words").over(W.orderBy("_slot")))
    cut = (slots.filter(F.col("_upto") > F.lit(budget))
           .agg(F.min("_slot"), F.min("_upto"), F.min_by("_words", "_slot")).first())
    if cut[0] is None:
        at, left = math.inf, 0
    else:
        at, left = cut[0], budget - (cut[1] - cut[2])

    order = W.partitionBy("_slot").orderBy("_finish", "_key", "_id", "_pass", "size").rowsBetween(
        W.unboundedPreceding, 0)
    if cut[0] is None:
        passed = copies.select("_id", "source", "_key", "size", F.lit(1).alias("_n"))
    else:
        whole = copies.filter(F.col("_slot") < F.lit(at))
        edge = (copies.filter(F.col("_slot") == F.lit(at))
                .withColumn("_run", F.sum("size").over(order)).filter(F.col("_run") <= F.lit(left)))
        passed = whole.select("_id", "source", "_key", "size").unionByName(
            edge.select("_id", "source", "_key", "size")).withColumn("_n", F.lit(1))
    base = placed.select("_id", "source", "_key", "size", "source_size", "target",
                         F.lit(0).alias("_n"))
    both = base.unionByName(passed, allowMissingColumns=True)
    # Rows that agree in every column share their copies evenly, first ones first.
    out = (both.groupBy("_id", "source", "_key", "size")
           .agg(F.sum("_n").alias("_copies"), F.max("source_size").alias("source_size"),
                F.max("target").alias("target"),
                F.sum(F.when(F.col("_n") == 0, 1).otherwise(0)).alias("_rows")))
    out = (out.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_rows"))))
           .withColumn("copies", F.floor((F.col("_copies") + F.col("_rows") - F.col("_nth"))
                                         / F.col("_rows")).cast("bigint")))
    return out.select(F.col("_id").alias(id_col), "source", "size", "source_size", "target",
                      "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every taken copy is a row with the columns of ``docs``.

    Copies are decided per (id, source, size), which is how they are joined back.
    Rows that agree in all three get the copies of the first of them.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    source_col = options.get("source_col", "source")
    plan = mix_sources(docs, **options).filter(F.col("copies") > 0)
    plan = plan.groupBy(F.col(id_col).alias("plan_id"), F.col("source").alias("plan_source"),
                        F.col("size").alias("plan_size")).agg(F.max("copies").alias("copies"))
    # Rows travel as one struct column, so that no name of theirs can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"),
                       F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    hit = rows.join(plan, F.col("id").eqNullSafe(F.col("plan_id"))
                    & rows["source"].eqNullSafe(F.col("plan_source")) & (rows["size"] == F.col("plan_size")), "inner")
    return hit.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select("row.*")
