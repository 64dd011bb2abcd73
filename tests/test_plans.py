"""Scale properties of the physical plans, checked on the plans themselves."""

import random

from pyspark.sql import functions as F

from reportflow.operators import dedup, gates, joins
from reportflow.plans.ingest import prior_max


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_last_combines_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = plan_of(dedup.keep_last(df, ["k"], ["v"]))
    # a group limit runs before the exchange: a hot key shrinks to a row per task
    assert "WindowGroupLimit" in plan and ", Partial" in plan and ", Final" in plan
    assert plan.index(", Final") < plan.index("Exchange") < plan.index(", Partial")   # printed top-down


def test_date_slice_pushes_a_range(spark, tmp_path):
    spark.range(10).select(F.col("id"), F.timestamp_seconds(F.col("id") * 86400).alias("t")) \
        .write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    plan = plan_of(gates.date_slice(df, "t", "1970-01", ["id"]))
    assert "PushedFilters: [IsNotNull(t), GreaterThanOrEqual(t," in plan


def test_full_outer_is_split_into_left_and_anti_joins(spark):
    a = spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("x"))
    b = spark.range(50, 150).select(F.col("id").alias("k"), F.lit("b").alias("y"))
    out = joins.outer_on_keys(a, b, ["k"])
    plan = plan_of(out)
    assert "LeftOuter" in plan and "LeftAnti" in plan and "FullOuter" not in plan
    assert out.count() == 150


def test_full_enrich_with_not_null_filter_becomes_left_join(spark):
    a = spark.range(10).select(F.col("id").alias("k"))
    b = spark.range(5, 15).select(F.col("id").alias("kk"))
    out = joins.enrich(a, b, ["k"], ["kk"], "full").where(F.col("k").isNotNull())
    plan = plan_of(out)
    assert "LeftOuter" in plan and "LeftAnti" not in plan and "Union" not in plan


def test_prior_max_matches_brute_force_on_a_hot_group(spark):
    random.seed(3)
    rows = [("hot" if i % 3 else f"g{i % 5}", i, random.randint(0, 50)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, o long, v int")
    got = {r.o: r.p for r in prior_max(df, ["g"], "o", "v", "p", bucket=8).collect()}
    for g, o, _ in rows:
        earlier = [v for gg, oo, v in rows if gg == g and oo < o]
        assert got[o] == (max(earlier) if earlier else None)


def test_hot_key_is_split_by_aqe_in_outer_joins(spark):
    """A key with a third of the rows: the left join of the full-outer decomposition is skew-split."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 30000
        left = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
            F.col("id").alias("x"))
        right = spark.range(n // 2).select(F.col("id").cast("string").alias("k"),
                                            F.lit(1).alias("y"))
        right = right.unionByName(spark.createDataFrame([("hot", 2)], "k string, y int"))
        out = joins.outer_on_keys(left, right, ["k"])
        got = out.collect()                 # runs this DataFrame's own (adaptive) plan
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final
        # every left row once (right keys are unique) plus the right keys that never occur left
        assert len(got) == n + len(range(0, n // 2, 3))
        assert sum(1 for r in got if r.k == "hot") == n // 3
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_prior_max_sparse_order_values(spark):
    rows = [("g", 10**12 + i * 10**6, i % 7) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, o long, v int")
    got = {r.o: r.p for r in prior_max(df, ["g"], "o", "v", "p", rows_per_bucket=16).collect()}
    for _, o, _ in rows:
        earlier = [v for _, oo, v in rows if oo < o]
        assert got[o] == (max(earlier) if earlier else None)
