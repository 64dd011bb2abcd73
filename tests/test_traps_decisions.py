"""One test per semantic trap (T1-T9) and deliberate decision (D1-D11) of the survey."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows, write_report
from reportflow.functions import dates, keys, text
from reportflow.operators import gates, ledger, project
from reportflow.operators.upsert import merge_snapshot
from reportflow.plans import pipelines as P
from reportflow.plans import specs as S
from reportflow.sources.reports import scan_reports


def test_t1_preamble_counts_physical_lines_and_blank_lines_are_dropped(spark, tmp_path):
    write_report(str(tmp_path / "r" / "a.csv"), ["", "Report", "h1,h2", "1,2", "", "3,4"])
    got = scan_reports(spark, str(tmp_path / "r"), preamble=2)
    assert rows(got.select("h1", "h2")) == [("1", "2"), ("3", "4")]


def test_t2_duplicate_headers_named_like_pandas(spark, tmp_path):
    write_report(str(tmp_path / "r" / "t.csv"), ["Cell Index,Cell Index,Cell Index", "1,2,3"])
    got = scan_reports(spark, str(tmp_path / "r"), preamble=0)
    assert got.columns[:3] == ["cell_index", "cell_index1", "cell_index2"]


def test_t3_ties_are_defined(spark):
    existing = spark.createDataFrame([("k", "old", "d")], "k string, v string, update_date string")
    incoming = spark.createDataFrame([("k", "a", "d", 2), ("k", "b", "d", 1)],
                                     "k string, v string, update_date string, s int")
    out = merge_snapshot(existing, incoming, "k", ["update_date"], seq="s", scope="all")
    assert rows(out) == [("k", "a", "d")]     # incoming beats existing; the later row (s=2) wins


def test_t4_python_regex_meaning(spark):
    df = spark.createDataFrame([("/*9\r*/X",), ("٣x",)], "v string")
    got = [tuple(r) for r in df.select(F.regexp_replace("v", r"/\*[^\n]*\*/", ""),
                                       text.digits_only("v")).collect()]
    assert got == [("X", "9"), ("٣x", "٣")]     # CR does not stop '.', Arabic-Indic digit is \d


def test_t5_empty_report_is_a_noop(spark, tmp_path):
    write_report(str(tmp_path / "r" / "e.csv"), ["Report", ",".join(P.contract_columns(S.CELL_2G))])
    got = scan_reports(spark, str(tmp_path / "r"), preamble=1)
    assert got.count() == 0
    staged = P.cell_2g(got, "REGION_A", "2024-01-02")
    assert staged.rows.count() == 0
    with pytest.raises(P.MissingColumns, match="mnc"):          # a report without a contract column is an error
        P.cell_2g(got.drop("mnc"), "REGION_A", "2024-01-02")


def test_t6_new_snapshot_never_overwrites_the_one_read(spark, tmp_path):
    from reportflow.sinks.snapshot import SnapshotTable
    tbl = SnapshotTable(spark, str(tmp_path / "t"))
    first = tbl.commit(spark.createDataFrame([("k", "1", "d")], "k string, v string, update_date string"))
    tbl.upsert(spark.createDataFrame([("k", "2", "d")], "k string, v string, update_date string"),
               "k", ["update_date"], scope="all")
    assert tbl.current_path() != first and rows(spark.read.parquet(first)) == [("k", "1", "d")]


def test_t7_one_character_patterns_are_literal():
    assert text.normalise_header("Freq. Band") == "freq_band"
    assert text.normalise_header("TRX No.") == "trx_no"


def test_t8_composite_ids_are_bigint_text(spark):
    df = spark.createDataFrame([("1", "1"), (None, "1")], "n string, c string")
    assert [r[0] for r in df.select(keys.cell_identity("n", "c")).collect()] == ["257", None]


def test_t9_wall_clock_timestamps(spark):
    out = ledger.ledger_rows(spark.createDataFrame([("a", "b", "2024-01-02", True)],
                                                   "report_name string, oss string, report_date_text string, ok boolean"),
                             dt.datetime(2024, 1, 2, 23, 30))
    assert dict(out.dtypes)["ingest_date"] == "timestamp_ntz"
    assert out.collect()[0].ingest_date == dt.datetime(2024, 1, 2, 23, 30)


def test_d1_on_create(spark):
    inc = spark.createDataFrame([("k", "1", "d"), ("k", "2", "d")], "k string, v string, update_date string")
    assert merge_snapshot(None, inc, "k", ["update_date"], on_create="as_is").count() == 2
    assert merge_snapshot(None, inc, "k", ["update_date"]).count() == 1


def test_d3_nulls_stay_null(spark):
    df = spark.createDataFrame([(None, 1.5)], "a string, b double")
    assert project.all_text(df).collect()[0] == (None, "1.5")


def test_d4_scope(spark):
    ex = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "k string, update_date string")
    inc = spark.createDataFrame([("c", "2024-01-02")], "k string, update_date string")
    by_date = merge_snapshot(ex, inc, "k", ["update_date"], scope="report_date",
                             date_col="update_date", report_date="2024-01-02")
    assert sorted(r.k for r in by_date.collect()) == ["b", "c"]
    assert sorted(r.k for r in merge_snapshot(ex, inc, "k", ["update_date"], scope="all").collect()) == [
        "a", "b", "c"]


def test_d5_no_surrogate_id(spark):
    inc = spark.createDataFrame([("k", "d")], "k string, update_date string")
    assert merge_snapshot(None, inc, "k", ["update_date"]).columns == ["k", "update_date"]


def test_d6_malformed_subject_quarantined(spark):
    df = spark.createDataFrame([("[Report]",), ("no brackets",)], "s string")
    got = [r.p.status for r in df.select(dates.parse_subject("s", ["A"]).alias("p")).collect()]
    assert got == ["too_few_parts", "too_few_parts"]


def test_d7_5g_export_has_ne_name_once():
    labels = [label for _, label in S.CELL_5G.export_pairs()]
    assert labels.count("NE Name") == 1


def test_d9_nodeb_info_has_no_preamble(spark, tmp_path):
    write_report(str(tmp_path / "n" / "NodeB Info.csv"), ["nodeb_name,nodeb_version", "A,V1"])
    got = scan_reports(spark, str(tmp_path / "n"), preamble=0)
    assert rows(got.select("nodeb_name")) == [("A",)]


def test_d10_dates_compare_as_dates(spark):
    led = spark.createDataFrame([("NETWORKS", "R", dt.date(2024, 1, 9), "200", "SUCCESS", "", None, 0)],
                                ledger.LEDGER_SCHEMA)
    d = spark.createDataFrame([("NETWORKS", "R", "2024-1-10")], "report_name string, oss string, t string")
    d = d.withColumn("report_date", dates.report_date("t"))
    # as text '2024-1-10' < '2024-01-09'; as dates the delivery is newer
    assert gates.watermark_gate(d, ledger.last_success(led)).collect()[0].accepted


def test_d11_email_sent_in_schema():
    assert "email_sent" in ledger.LEDGER_SCHEMA.fieldNames()
