"""Joins, de-dup, upsert, gates and ledger: properties and hand-written cases."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from reportflow.operators import dedup, gates, joins, ledger, project, setops
from reportflow.operators.upsert import merge_snapshot
from reportflow.sinks.snapshot import SnapshotTable


def test_joins_match_null_keys(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, x int")
    right = spark.createDataFrame([("a", 10), (None, 20), ("c", 30)], "k string, y int")
    got = rows(joins.outer_on_keys(left, right, ["k"]))
    assert got == rows(spark.createDataFrame(
        [("a", 1, 10), (None, 2, 20), ("b", 3, None), ("c", None, 30)], "k string, x int, y int"))


def test_enrich_different_key_names_and_left_reduction(spark):
    sites = spark.createDataFrame([("s1", "b1"), (None, "b2"), ("s3", "b3")], "bts_name string, bsc string")
    co = spark.createDataFrame([("s1", "ne1"), (None, "ne0"), ("s9", "ne9")], "gbts string, ne string")
    full = joins.enrich(sites, co, ["bts_name"], ["gbts"], "full")
    assert full.count() == 4           # s1, null-null, s3, s9
    kept = full.where(F.col("bts_name").isNotNull())
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" in plan           # Catalyst reduces the full join
    assert rows(kept.select("bts_name", "ne")) == [("s1", "ne1"), ("s3", None)]


def test_natural_outer_suffixes_and_keys(spark):
    a = spark.createDataFrame([(1, "x", "p")], "id int, k string, v string")
    b = spark.createDataFrame([(1, "x", "q"), (2, None, "r")], "id int, k string, w string")
    got = joins.natural_outer(a, b)
    assert got.columns == ["id", "k", "v", "w"]
    assert rows(got) == [(1, "x", "p", "q"), (2, None, None, "r")]


def test_diff_join_properties(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    b = spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string")
    assert joins.diff_join(a, a, ["id"]).count() == 0          # diff(a, a) is empty
    got = rows(joins.diff_join(a, b, ["id"]))
    assert got == [(1, "a", None, "left_only"), (3, None, "c", "right_only")]
    assert rows(joins.diff_join(a, b, ["id"], "left_only")) == [(1, "a", None, "left_only")]
    assert rows(joins.diff_join(a, b, ["id"], "both")) == [(2, "b", "B", "both")]


def test_keep_first_last_nulls_last(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", "b", 2), ("k", "a", 3), (None, "z", 4),
                                (None, "y", 5)], "k string, o string, s int")
    assert rows(dedup.keep_first(df, ["k"], ["o"], "s")) == [(None, "y", 5), ("k", "a", 3)]
    # nulls sort last, so the last row of k is the one with a null order value
    assert rows(dedup.keep_last(df, ["k"], ["o"], "s")) == [(None, "z", 4), ("k", None, 1)]


def test_drop_tail_row(spark):
    df = spark.createDataFrame([("f1", 1), ("f1", 2), ("f2", 7)], "f string, s int")
    assert rows(dedup.drop_tail_row(df, "f", "s")) == [("f1", 1)]


def _upsert_inputs(spark):
    existing = spark.createDataFrame(
        [("k1", "old1", "2024-01-02"), ("k2", "old2", "2024-01-02"), ("k3", "old3", "2024-01-01")],
        "key string, v string, update_date string")
    incoming = spark.createDataFrame(
        [("k1", "new1a", "2024-01-02", 1), ("k1", "new1b", "2024-01-02", 2),
         ("k4", "new4", "2024-01-02", 3), (None, "nokey", "2024-01-02", 4)],
        "key string, v string, update_date string, seq int")
    return existing, incoming


def test_upsert_rules(spark):
    existing, incoming = _upsert_inputs(spark)
    out = merge_snapshot(existing, incoming, "key", ["update_date"], seq="seq",
                         scope="report_date", date_col="update_date", report_date="2024-01-02")
    # incoming beats existing, later row beats earlier, null key dropped, k3 (older date) leaves
    assert rows(out) == [("k1", "new1b", "2024-01-02"), ("k2", "old2", "2024-01-02"),
                         ("k4", "new4", "2024-01-02")]
    all_dates = merge_snapshot(existing, incoming, "key", ["update_date"], seq="seq", scope="all")
    assert ("k3", "old3", "2024-01-01") in rows(all_dates)


def test_upsert_idempotent_and_order_free(spark):
    existing, incoming = _upsert_inputs(spark)
    once = merge_snapshot(existing, incoming, "key", ["update_date"], seq="seq",
                          scope="report_date", date_col="update_date", report_date="2024-01-02")
    twice = merge_snapshot(once, incoming, "key", ["update_date"], seq="seq",
                           scope="report_date", date_col="update_date", report_date="2024-01-02")
    assert rows(once) == rows(twice)
    shuffled = incoming.repartition(3).orderBy(F.rand(7))
    again = merge_snapshot(existing, shuffled, "key", ["update_date"], seq="seq",
                           scope="report_date", date_col="update_date", report_date="2024-01-02")
    assert rows(again) == rows(once)
    keys = [r[0] for r in once.collect()]
    assert len(keys) == len(set(keys))


def test_upsert_on_create(spark):
    _, incoming = _upsert_inputs(spark)
    as_is = merge_snapshot(None, incoming, "key", ["update_date"], seq="seq", on_create="as_is")
    assert as_is.count() == 4
    clean = merge_snapshot(None, incoming, "key", ["update_date"], seq="seq")
    assert clean.count() == 2


def test_snapshot_table_versions(spark, tmp_path):
    existing, incoming = _upsert_inputs(spark)
    tbl = SnapshotTable(spark, str(tmp_path / "t"))
    assert tbl.read() is None
    first = tbl.commit(existing)
    cur = tbl.upsert(incoming, "key", ["update_date"], seq="seq", scope="report_date",
                     date_col="update_date", report_date="2024-01-02")
    assert cur.count() == 3
    assert len(tbl.versions()) == 2 and tbl.current_path() != first
    # the version being read is never the one being written (no read/overwrite hazard)
    assert spark.read.parquet(first).count() == 3


def test_gates(spark):
    df = spark.createDataFrame([("d1", "a", None), ("d1", "b", "x"), ("d2", None, "y"),
                                ("d2", "c", None)], "d string, a string, b string")
    assert rows(gates.complete_row_gate(df, ["d"])) == [("d1", "a", None), ("d1", "b", "x")]
    assert gates.drop_null_keys(df, ["a", "b"]).count() == 1


def test_watermark_and_ledger(spark):
    led = spark.createDataFrame([
        ("NETWORKS", "REGION_A", dt.date(2024, 1, 2), "200", "SUCCESS", "", None, 0),
        ("networks", "region_a", dt.date(2024, 1, 5), "500", "INTERNAL ERROR", "Code Bug", None, 0),
        ("EXTERNALS", "REGION_A", dt.date(2024, 1, 2), "200", "SUCCESS", "", None, 0),
        ("EXTERNALS", "REGION_B", dt.date(2024, 1, 3), "200", "SUCCESS", "", None, 0),
    ], ledger.LEDGER_SCHEMA)
    last = ledger.last_success(led)
    assert rows(last.where("report_name = 'NETWORKS'")) == [("NETWORKS", "REGION_A", dt.date(2024, 1, 2))]
    deliveries = spark.createDataFrame([
        ("Networks", "region_a", dt.date(2024, 1, 2)),    # strict: equal date rejected
        ("NETWORKS", "REGION_A", dt.date(2024, 1, 3)),
        ("EXTERNALS", "REGION_A", dt.date(2024, 1, 2)),   # inclusive: equal date accepted
        ("PKI", "REGION_A", dt.date(2020, 1, 1)),         # no history accepts
    ], "report_name string, oss string, report_date date")
    got = {(r[0], r[2]): r[-1] for r in gates.watermark_gate(deliveries, last).collect()}
    assert got == {("Networks", dt.date(2024, 1, 2)): False, ("NETWORKS", dt.date(2024, 1, 3)): True,
                   ("EXTERNALS", dt.date(2024, 1, 2)): True, ("PKI", dt.date(2020, 1, 1)): True}
    ready = rows(ledger.batch_ready(led, dt.date(2024, 1, 1)))
    assert ready == [("EXTERNALS", 2, True), ("NETWORKS", 1, False)]
    sent = ledger.mark_sent(led, dt.date(2024, 1, 1))
    assert sorted(r.email_sent for r in sent.where("report_name = 'EXTERNALS'").collect()) == [1, 1]
    assert [r.email_sent for r in sent.where("report_name = 'NETWORKS' AND error_code = '200'")
            .collect()] == [0]


def test_ledger_rows(spark):
    outcomes = spark.createDataFrame([("networks", "region_a", "02-01-2024", True),
                                      ("pki", None, "2024-1-3", False)],
                                     "report_name string, oss string, report_date_text string, ok boolean")
    got = rows(ledger.ledger_rows(outcomes, dt.datetime(2024, 1, 3, 8, 0)))
    assert got == [("NETWORKS", "REGION_A", dt.date(2024, 1, 2), "200", "SUCCESS", "",
                    dt.datetime(2024, 1, 3, 8, 0), 0),
                   ("PKI", "", dt.date(2024, 1, 3), "500", "INTERNAL ERROR", "Code Bug",
                    dt.datetime(2024, 1, 3, 8, 0), 0)]


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, 2.5, None)], "a int, b double, c string")
    assert project.all_text(df).collect()[0] == ("1", "2.5", None)
    r = project.rename(df, {"a": "b", "b": "a", "zz": "q"})          # simultaneous, absent ignored
    assert r.columns == ["b", "a", "c"]
    assert project.prefix_columns(df, "t").columns == ["t_a", "t_b", "t_c"]
    u = setops.append(df.select("a"), df.select("c"))
    assert u.columns == ["a", "c"] and u.count() == 2


def test_mark_sent_limited_to_released_reports(spark):
    led = spark.createDataFrame([
        ("HCMD", "A", dt.date(2024, 1, 2), "200", "SUCCESS", "", None, 0),
        ("HCMD", "B", dt.date(2024, 1, 2), "200", "SUCCESS", "", None, 0),
        ("PKI", "", dt.date(2024, 1, 2), "200", "SUCCESS", "", None, 0),
        ("PKI", "", dt.date(2024, 1, 3), "200", "SUCCESS", "", None, 0),
    ], ledger.LEDGER_SCHEMA)
    out = ledger.mark_sent(led, dt.date(2024, 1, 1), reports=ledger.RELEASED_REPORTS)
    assert sorted((r.report_name, r.email_sent) for r in out.collect()) == [
        ("HCMD", 0), ("HCMD", 0), ("PKI", 1), ("PKI", 1)]


def test_snapshot_retention(spark, tmp_path):
    tbl = SnapshotTable(spark, str(tmp_path / "r"))
    df = spark.createDataFrame([("k", "1", "d")], "k string, v string, update_date string")
    names = [tbl.commit(df).rsplit("/", 1)[-1] for _ in range(4)]
    removed = tbl.retain(keep=2)
    assert removed == sorted(names[:2])
    assert tbl.versions() == sorted(names[2:])
    assert tbl.read().count() == 1


def test_snapshot_retention_removes_failed_writes(spark, tmp_path):
    import os
    tbl = SnapshotTable(spark, str(tmp_path / "f"))
    df = spark.createDataFrame([("k", "1", "d")], "k string, v string, update_date string")
    first = tbl.commit(df).rsplit("/", 1)[-1]
    failed = f"snap-{'0' * 19}1-deadbeef"             # older than everything, never committed
    os.makedirs(tmp_path / "f" / failed)
    (tmp_path / "f" / failed / "part-0.parquet").write_bytes(b"partial")
    second = tbl.commit(df).rsplit("/", 1)[-1]
    assert tbl.versions() == sorted([first, second])  # the failed write is never visible
    assert tbl.retain(keep=2) == [failed]
    assert sorted(os.listdir(tmp_path / "f")) == sorted([first, second])
