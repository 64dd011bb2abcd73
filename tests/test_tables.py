"""Dated snapshots, append tables, ledger segments, ordered exports, staged archives, one-pass scans."""

import datetime as dt
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from conftest import rows, write_report
from reportflow.operators import ledger
from reportflow.plans.router import dispatch_scan
from reportflow.sinks.export import write_export
from reportflow.sinks.ledger import LedgerTable
from reportflow.operators.upsert import merge_keyed, merge_snapshot
from reportflow.sinks.snapshot import KeyedTable, SnapshotTable, append_table, read_append
from reportflow.sources import archive
from reportflow.sources.reports import scan_reports


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, kind: str) -> int:
    return plan_of(df).count(f"FileScan {kind}")


# ---- snapshots by date -----------------------------------------------------------------------

def day(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, update_date string")


def test_dates_are_partitions_and_prune(spark, tmp_path):
    tbl = SnapshotTable(spark, str(tmp_path / "t"))
    for d in ("2024-01-02", "2024-01-03"):
        tbl.upsert(day(spark, ("a", d), ("b", d)), "k", ["update_date"], date_col="update_date", report_date=d)
    tbl.upsert(day(spark, ("c", "2024-01-03")), "k", ["update_date"], date_col="update_date", report_date="2024-01-03")
    assert rows(tbl.read()) == [(k, "2024-01-03") for k in "abc"]            # current: the last date's
    assert tbl.dates() == ["2024-01-02", "2024-01-03"] and len(tbl.versions()) == 3
    every = tbl.read_dates()
    assert rows(every.select("k", F.col("report_date").cast("string"))) == [
        ("a", "2024-01-02"), ("a", "2024-01-03"), ("b", "2024-01-02"), ("b", "2024-01-03"), ("c", "2024-01-03")]
    one = every.where(F.col("report_date") == dt.date(2024, 1, 2))
    assert "PartitionFilters: [isnotnull(report_date" in plan_of(one)
    assert {os.path.basename(os.path.dirname(os.path.dirname(p))) for p in one.inputFiles()} >= {"report_date=2024-01-02"}
    assert one.count() == 2
    # retention keeps the newest version of every date
    assert len(tbl.retain(keep=1)) == 1 and tbl.dates() == ["2024-01-02", "2024-01-03"]


def test_a_second_writer_of_the_same_version_fails(spark, tmp_path):
    tbl = SnapshotTable(spark, str(tmp_path / "t"))
    tbl.commit(day(spark, ("a", "d")))

    class Raced(SnapshotTable):
        def _list(self):
            found = super()._list()
            if not getattr(self, "raced", False):       # after the number was chosen
                self.raced = True
                tbl.commit(day(spark, ("b", "d")))
            return found

    with pytest.raises(RuntimeError, match="another writer"):
        Raced(spark, str(tmp_path / "t")).commit(day(spark, ("c", "d")))
    assert rows(tbl.read()) == [("b", "d")] and len(tbl.versions()) == 2


# ---- tables in buckets of their key ------------------------------------------------------------

def test_a_keyed_merge_shuffles_only_the_delivery(spark, tmp_path):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        tbl = KeyedTable(spark, str(tmp_path / "k"), "k", buckets=4)
        first = spark.range(1000).select(F.concat(F.lit("k"), F.col("id") % 700).alias("k"),
                                         F.col("id").cast("string").alias("v"), F.lit("2024-01-02").alias("day"))
        first = first.unionByName(spark.createDataFrame([(None, "x", "2024-01-09")], "k string, v string, day string"))
        tbl.merge(first, ["day"])
        assert tbl.read().count() == 700
        second = spark.createDataFrame([("k1", "new", "2024-01-02", 1), ("k1", "newer", "2024-01-02", 2),
                                        ("k2", "old", "2024-01-01", 3), ("k9999", "more", None, 4), (None, "z", "d", 5)],
                                       "k string, v string, day string, seq int")
        plan = plan_of(merge_keyed(tbl.read(), second, "k", ["day"], seq="seq"))
        scan = plan.index("FileScan parquet")
        assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
        assert scan < plan.index("Exchange hashpartitioning")       # printed first: the table's side has none
        want = rows(merge_snapshot(tbl.read(), second, "k", ["day"], seq="seq", scope="all"))
        tbl.merge(second, ["day"], seq="seq")
        assert rows(tbl.read()) == want and len(want) == 701
        assert {r.v for r in tbl.read().where("k in ('k1', 'k2')").collect()} == {"newer", "702"}
        assert rows(SnapshotTable(spark, str(tmp_path / "k")).read()) == want       # also readable as a plain table
        assert [t for t in spark.catalog.listTables() if t.name.startswith("keyed_")] == []
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


# ---- append tables --------------------------------------------------------------------------------

def test_append_keeps_columns_of_all_deliveries(spark, tmp_path):
    root = str(tmp_path / "a")
    append_table(spark.createDataFrame([("1", "x", "A")], "a string, b string, oss string"), root, ["oss"], True)
    append_table(spark.createDataFrame([("2", "y", "B")], "a string, c string, oss string"), root, ["oss"], True)
    append_table(spark.createDataFrame([("3", "z", "A")], "a string, b string, oss string"), root, ["oss"], True)
    got = read_append(spark, root)
    assert got.columns == ["a", "b", "oss", "c"]
    assert rows(got) == [("2", None, "B", "y"), ("3", "z", "A", None)]          # the A delivery was replaced
    assert len(os.listdir(tmp_path / "a" / "_columns")) == 2                    # written only for new columns
    with pytest.raises(ValueError, match="changed their type"):
        append_table(spark.createDataFrame([(4, "B")], "a int, oss string"), root, ["oss"], True)
    plain = str(tmp_path / "p")                                                 # a table without a column list
    spark.createDataFrame([("1",)], "a string").write.parquet(plain)
    spark.createDataFrame([("2",)], "b string").write.mode("append").parquet(plain)
    assert rows(read_append(spark, plain).select("a", "b")) == [(None, "2"), ("1", None)]


# ---- ledger ---------------------------------------------------------------------------------------

TODAY = dt.date(2024, 1, 2)


def run_rows(spark, *outcomes):
    full = [(n, o, TODAY, "200" if ok else "500", "", "", None, 0) for n, o, ok in outcomes]
    return spark.createDataFrame(full, ledger.LEDGER_SCHEMA)


def size_of(folder) -> int:
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs)


def test_ledger_segments_mark_like_a_rewrite(spark, tmp_path):
    led = LedgerTable(spark, str(tmp_path / "l"))
    assert led.read() is None and not led.has("t1")
    runs = [[("PKI", "A", True), ("HCMD", "A", True)], [("PKI", "B", False), ("HCMD", "B", True)],
            [("PKI", "C", True)], [("PKI", "D", True)]]
    whole = None
    for i, outcomes in enumerate(runs):
        new = run_rows(spark, *outcomes)
        led.append(new, TODAY, 2, ledger.RELEASED_REPORTS, tag=f"t{i}")
        whole = new if whole is None else whole.unionByName(new)
        whole = ledger.mark_sent(whole, TODAY, 2, ledger.RELEASED_REPORTS)
        assert rows(led.read()) == rows(whole)
        assert led.has(f"t{i}") and not led.has("t9")
    assert led.compact() == 4 and len(led.segments()) == 1
    assert rows(led.read()) == rows(whole) and led.has("t0") and led.has("t3")
    led.append(run_rows(spark, ("PKI", "E", True)), TODAY, 1, ledger.RELEASED_REPORTS)
    assert [r.email_sent for r in led.read().where("report_oss = 'E'").collect()] == [1]


def test_ledger_writes_do_not_grow_with_history(spark, tmp_path):
    led = LedgerTable(spark, str(tmp_path / "l"))
    led.append(run_rows(spark, *[("HCMD", f"R{i}", True) for i in range(5000)]), TODAY, 2, ("PKI",))
    first = size_of(tmp_path / "l")
    led.append(run_rows(spark, ("PKI", "A", True)), TODAY, 2, ("PKI",))
    second = size_of(tmp_path / "l") - first
    led.append(run_rows(spark, ("PKI", "B", True)), TODAY, 2, ("PKI",))
    third = size_of(tmp_path / "l") - first - second
    assert led.read().count() == 5002
    assert abs(third - second) < 1000 and second < first / 3      # a mark more


def test_a_ledger_kept_as_snapshots_goes_on(spark, tmp_path):
    SnapshotTable(spark, str(tmp_path / "l")).commit(run_rows(spark, ("PKI", "A", True)))
    led = LedgerTable(spark, str(tmp_path / "l"))
    assert led.read().count() == 1
    led.append(run_rows(spark, ("PKI", "B", True)), TODAY, 2, ("PKI",))
    assert [r.email_sent for r in led.read().collect()] == [1, 1]
    led.append(run_rows(spark, ("PKI", "C", True)))
    led.compact()
    assert sorted((r.report_oss, r.email_sent) for r in led.read().collect()) == [("A", 1), ("B", 1), ("C", 0)]


def test_an_unfinished_segment_is_not_read(spark, tmp_path):
    led = LedgerTable(spark, str(tmp_path / "l"))
    led.append(run_rows(spark, ("PKI", "A", True)))
    led.append(run_rows(spark, ("PKI", "B", True)), tag="x")
    os.remove(tmp_path / "l" / led.segments()[-1] / "rows" / "_SUCCESS")
    assert led.read().count() == 1 and not led.has("x")


# ---- exports --------------------------------------------------------------------------------------

def test_exports_are_sorted_over_their_files(spark, tmp_path):
    n = 3000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("v"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("g"), F.col("id") % 5)).alias("g"), F.col("id").alias("__seq"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_export(df, str(tmp_path / "x"), partition_by=["g"], order_by=["v", "__seq"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    for g in os.listdir(tmp_path / "x"):
        if not g.startswith("g="):
            continue
        names = sorted(f for f in os.listdir(tmp_path / "x" / g) if f.endswith(".csv"))
        values = []
        for name in names:
            lines = (tmp_path / "x" / g / name).read_text().splitlines()
            assert lines[0] == "v"                              # helper columns are not written
            values += [int(x) for x in lines[1:]]
        assert values == sorted(values)
        if g == "g=hot":
            assert len(names) > 1 and len(values) == n // 3     # one region, several tasks


# ---- archives and scans ---------------------------------------------------------------------------

def test_members_of_one_archive_are_dealt_and_pruned(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(40):
            z.writestr(f"m{i}.csv", "a,b\n" + "".join(f"{i},{k}\r\n" for k in range(50)) + "last,é")
        z.writestr("stored.bin", b"\xff\xfe\n\x00", zipfile.ZIP_STORED)
        z.writestr("bz.csv", "x\ny", zipfile.ZIP_BZIP2)
        z.writestr("lzma.csv", "x\n\ny\n", zipfile.ZIP_LZMA)
        z.writestr("none.csv", "")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        members = archive.stage_members(spark, [str(tmp_path / "big.zip")])
        assert members.select(F.input_file_name()).distinct().count() > 1       # many files, hence tasks
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert members.count() == 44
    assert "ReadSchema: struct<member:string>" in plan_of(members.select("member"))     # names without contents
    lines = archive.member_lines(members)
    one = rows(lines.where("member = 'm7.csv'").select("number", "line"))
    assert len(one) == 52 and (0, "a,b") in one and (1, "7,0") in one and (51, "last,é") in one
    other = {m: sorted((r.number, r.line) for r in lines.where(F.col("member") == m).collect())
             for m in ("bz.csv", "lzma.csv", "none.csv", "stored.bin")}
    assert other["bz.csv"] == [(0, "x"), (1, "y")] and other["lzma.csv"] == [(0, "x"), (1, ""), (2, "y")]
    assert other["none.csv"] == [] and len(other["stored.bin"]) == 2


def test_damaged_members_fail(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "d.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("a.csv", "abcdefgh\n" * 10)
    raw = (tmp_path / "d.zip").read_bytes()
    (tmp_path / "d.zip").write_bytes(raw.replace(b"abcdefgh", b"abcdefgX", 1))
    with pytest.raises(Exception, match="damaged"):
        archive.member_lines(archive.stage_members(spark, [str(tmp_path / "d.zip")])).collect()


def test_one_scan_for_all_layouts_and_preambles(spark, tmp_path):
    d = tmp_path / "land"
    write_report(str(d / "2G_Site_List.csv"), ["pre", "a,b", "1,2"])
    write_report(str(d / "5G_Site_List.csv"), ["pre", "a;c", "3;4"])
    write_report(str(d / "NodeB Info.csv"), ["a,b,e", "5,6,7"])
    write_report(str(d / "notes.csv"), ["never read"])
    got = dispatch_scan(spark, str(d), "NETWORKS")
    assert scans(got, "text") == 1
    assert rows(got.select("a", "b", "c", "e", "target_table")) == [
        ("1", "2", None, None, "huawei_2g_site"), ("3", None, "4", None, "huawei_5g_site"),
        ("5", "6", None, "7", None)]


def test_a_scan_keeps_only_facts(spark, tmp_path):
    """Nothing of the size of the input is written while it is scanned."""
    write_report(str(tmp_path / "r" / "x.csv"), ["pre", "a,b"] + [f"{i},{'v' * 200}" for i in range(20000)])
    base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = size_of(base)
    got = scan_reports(spark, str(tmp_path / "r"), preamble=1)
    assert got.count() == 20000
    assert size_of(base) - before < 40_000 < os.path.getsize(tmp_path / "r" / "x.csv") / 100


def test_lines_numbered_differently_fail(spark, tmp_path):
    for i in range(6):
        write_report(str(tmp_path / "r" / f"{i}.csv"), ["pre", "a"] + [f"{i}-{k}" for k in range(50)])
    conf = {"spark.sql.files.maxPartitionBytes": "1m", "spark.sql.files.openCostInBytes": "0",
            "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = scan_reports(spark, str(tmp_path / "r"), preamble=1)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        with pytest.raises(Exception, match="numbered differently"):
            got.select("a").distinct().collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
