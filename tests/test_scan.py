"""Report scan traps: preamble (T1), duplicate headers (T2), null tokens, footer, quoting."""

import os

from pyspark.sql import functions as F

from conftest import rows, write_report
from reportflow.sources.reports import report_sep, scan_reports


def test_preamble_duplicates_tokens_and_footer(spark, tmp_path):
    d = tmp_path / "in"
    write_report(str(d / "BSC1_a.csv"), [
        "Report generated", "", "Cell Index;Name;Cell Index;Note",
        "1;a;10;NA", "2;\"b;c\";20;None", "", "3;d;30;", "Total: 3"])
    write_report(str(d / "BSC2_b.csv"), [
        "Report generated", "x", "Cell Index;Name;Cell Index;Note", "4;é;40;ok", "Total: 1"])
    got = scan_reports(spark, str(d), preamble=2, footer=1)
    assert got.columns[:4] == ["cell_index", "name", "cell_index1", "note"]
    assert rows(got.select("cell_index", "name", "cell_index1", "note", "_file")) == [
        ("1", "a", "10", None, "BSC1_a.csv"), ("2", "b;c", "20", "None", "BSC1_a.csv"),
        ("3", "d", "30", None, "BSC1_a.csv"), ("4", "é", "40", "ok", "BSC2_b.csv")]


def test_delimiter_sniffing():
    assert report_sep("pre", "a,b", "a,b") == ","
    assert report_sep("pre;x", "a;b", "a;b") == ";"
    assert report_sep("one, two", "three", "a;b") == ";"


def test_quoted_newline_and_encoded_names(spark, tmp_path):
    d = tmp_path / "in2"
    write_report(str(d / "NodeB Info.csv"), ['nodeb_name,nodeb_version', '"a\nb",V1', 'c,V2'])
    got = scan_reports(spark, str(d), preamble=0)
    assert rows(got.select("nodeb_name", "nodeb_version", "_file")) == [
        ("a\nb", "V1", "NodeB Info.csv"), ("c", "V2", "NodeB Info.csv")]


def test_mixed_layouts_union_by_name(spark, tmp_path):
    d = tmp_path / "in3"
    write_report(str(d / "one.csv"), ["a,b", "1,2"])
    write_report(str(d / "two.csv"), ["a;c", "3;4"])
    got = scan_reports(spark, str(d), preamble=0)
    assert rows(got.select("a", "b", "c")) == [("1", "2", None), ("3", None, "4")]
    assert os.path.exists(str(d / "one.csv"))


def test_split_large_file_matches_whole_read(spark, tmp_path):
    lines = ["Report generated", "x", "a;b;c"] + [f"{i};v{i};{i * 3}" for i in range(400)] + ["Total"]
    write_report(str(tmp_path / "big" / "BSC9_big.csv"), lines)
    whole = scan_reports(spark, str(tmp_path / "big"), preamble=2, footer=1)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        split = scan_reports(spark, str(tmp_path / "big"), preamble=2, footer=1)
        got = rows(split.select("a", "b", "c"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == rows(whole.select("a", "b", "c"))
    assert len(got) == 400 and ("0", "v0", "0") in got and ("399", "v399", "1197") in got


def test_footer_of_several_rows_across_splits(spark, tmp_path):
    lines = ["pre", "a,b"] + [f"{i},x" for i in range(300)] + ["f1,", "f2,", "f3,"]
    write_report(str(tmp_path / "ft" / "x.csv"), lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        got = scan_reports(spark, str(tmp_path / "ft"), preamble=1, footer=3)
        vals = sorted(int(r.a) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert vals == list(range(300))


def _scan_split(spark, path, size, **kw):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = scan_reports(spark, path, **kw)
        return rows(got.drop("_path")), got.columns
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_split_size_never_changes_a_scan(spark, tmp_path):
    """Quoted line breaks, a header of over 16 KiB, a bracketed folder: alike at any split size."""
    d = tmp_path / "[Report][REGION_A] x{1}"
    header = ",".join(f"a_rather_long_column_name_number_{i:05d}" for i in range(440))
    body = [f'"line\n\nstill {i}\ntwo ""quoted"", end",{i}' if i % 3 == 0 else f'{i},"x, ""{i}"""'
            for i in range(20)]
    write_report(str(d / "wide.csv"), ["pre", header, *body, "Total"])
    assert len(header) > 1 << 14
    whole, columns = _scan_split(spark, str(d), "128m", preamble=1, footer=1)
    tiny, _ = _scan_split(spark, str(d), "64", preamble=1, footer=1)
    assert len(columns) == 443 and len(whole) == 20
    assert whole == tiny
    assert any(r[:2] == ('line\n\nstill 0\ntwo "quoted", end', "0") for r in whole)
    assert any(r[:2] == ("1", 'x, "1"') for r in whole)


def test_long_rows_and_open_quotes_fail(spark, tmp_path):
    import pytest
    write_report(str(tmp_path / "long" / "a.csv"), ["a,b", "1,2", "3,4,5"])
    with pytest.raises(Exception, match="more fields"):
        scan_reports(spark, str(tmp_path / "long"), preamble=0).collect()
    write_report(str(tmp_path / "short" / "a.csv"), ["a,b", "1", "3,4"])
    assert rows(scan_reports(spark, str(tmp_path / "short"), preamble=0).select("a", "b")) == [
        ("1", None), ("3", "4")]
    write_report(str(tmp_path / "open" / "a.csv"), ["a,b", '1,"2', "3,4"])
    with pytest.raises(ValueError, match="without an end"):
        scan_reports(spark, str(tmp_path / "open"), preamble=0)


def test_hidden_files_are_not_skipped(spark, tmp_path):
    import pytest
    write_report(str(tmp_path / "h" / "a.csv"), ["a,b", "1,2"])
    write_report(str(tmp_path / "h" / "_b.csv"), ["a,b", "3,4"])
    with pytest.raises(ValueError, match="_b.csv"):
        scan_reports(spark, str(tmp_path / "h"), preamble=0)


def test_listed_files_are_literal(spark, tmp_path):
    a = write_report(str(tmp_path / "x[1]" / "a.csv"), ["a,b", "1,2"])
    b = write_report(str(tmp_path / "x1" / "b.csv"), ["a,b", "3,4"])
    assert rows(scan_reports(spark, [a, b], preamble=0).select("a", "b")) == [("1", "2"), ("3", "4")]


def test_header_only_report(spark, tmp_path):
    write_report(str(tmp_path / "e" / "a.csv"), ["pre", "a,b"])
    got = scan_reports(spark, str(tmp_path / "e"), preamble=1)
    assert got.columns[:2] == ["a", "b"] and got.count() == 0


def test_zip_members_scan_like_files(spark, tmp_path):
    import zipfile
    lines = "pre\nCell Name,Cell ID\nA,1\n\"B\nb\",2\nTotal\n"
    (tmp_path / "z").mkdir()
    with zipfile.ZipFile(tmp_path / "z" / "d.zip", "w") as zf:
        zf.writestr("sub/one.csv", lines)
        zf.writestr("two.csv", lines.replace("A,1", "C,3"))
    got = scan_reports(spark, str(tmp_path / "z"), preamble=1, footer=1)
    assert rows(got.select("cell_name", "cell_id", "_file")) == [
        ("A", "1", "one.csv"), ("B\nb", "2", "one.csv"), ("B\nb", "2", "two.csv"), ("C", "3", "two.csv")]
    one = scan_reports(spark, str(tmp_path / "z"), preamble=1, footer=1, names=["two.csv"])
    assert {r._file for r in one.collect()} == {"two.csv"}


def test_utf8_bom(spark, tmp_path):
    d = tmp_path / "bom"
    d.mkdir()
    (d / "a.csv").write_bytes("﻿Cell Name,Cell ID\nA,1\nB,2\n".encode("utf-8"))
    (d / "b.csv").write_bytes("﻿pre\nCell Name,Cell ID\nC,3\n".encode("utf-8"))
    got0 = scan_reports(spark, str(d / "a.csv"), preamble=0)
    assert got0.columns[:2] == ["cell_name", "cell_id"]
    assert rows(got0.select("cell_name", "cell_id")) == [("A", "1"), ("B", "2")]
    got1 = scan_reports(spark, str(d / "b.csv"), preamble=1)
    assert rows(got1.select("cell_name", "cell_id")) == [("C", "3")]


def test_dispatch_without_allowed_files(spark, tmp_path):
    import pytest

    from reportflow.plans.router import dispatch_scan
    write_report(str(tmp_path / "land" / "notes.csv"), ["pre", "a,b", "1,2"])
    with pytest.raises(FileNotFoundError):
        dispatch_scan(spark, str(tmp_path / "land"), "NETWORKS")


def _noted(n, seed):
    """A report with quoted line breaks, and its rows by Python's reader."""
    import csv
    import io
    import random
    rng = random.Random(seed)
    words = ["a", "", "b,c", 'say "hi"', "x\ny", "\n\n", 'p\n"q",\nr', '"', "long " * 9, "1\n2\n3\n4"]
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(["id", "no\nte", "state"])
    for i in range(n):
        w.writerow([i, rng.choice(words), rng.choice(words[:5])])
    want = [tuple(r) for r in csv.reader(io.StringIO(buf.getvalue()))][1:]
    return "notes\n\n" + buf.getvalue(), sorted(want)


def test_records_over_splits_match_a_csv_reader(spark, tmp_path, monkeypatch):
    """Any split size, with and without broadcast joins by size, from files and from archive members."""
    import zipfile

    from reportflow.sources import reports
    want = []
    (tmp_path / "f").mkdir()
    (tmp_path / "z").mkdir()
    with zipfile.ZipFile(tmp_path / "z" / "all.zip", "w") as zf:
        for i in range(3):
            text, rows_of = _noted(40, i)
            (tmp_path / "f" / f"n{i}.csv").write_text(text)
            zf.writestr(f"in/n{i}.csv", text)
            want += [(f"n{i}.csv", *r) for r in rows_of]
    monkeypatch.setattr(reports, "MEMBER_LINES", 7)
    conf = {"spark.sql.files.maxPartitionBytes": "128m", "spark.sql.autoBroadcastJoinThreshold": "10m"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for folder, size, limit in (("f", "128m", "10m"), ("f", "40", "-1"), ("z", "128m", "-1")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            got = scan_reports(spark, str(tmp_path / folder), preamble=1, map_null_tokens=False)
            assert got.columns[:3] == ["id", "no\nte", "state"]
            assert rows(got.select("_file", F.col("id"), F.coalesce("`no\nte`", F.lit("")),
                                   F.coalesce("state", F.lit("")))) == sorted(want, key=lambda t: tuple(map(str, t)))
            footed = scan_reports(spark, str(tmp_path / folder), preamble=1, footer=2)
            assert sorted(int(r.id) for r in footed.select("id").collect()) == sorted(list(range(38)) * 3)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_records_within_splits_are_not_shuffled(spark, tmp_path):
    """Lines meet in their split as they are read; before, windows sorted every line of a file."""
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.csv").write_text(_noted(300, 5)[0])
    got = scan_reports(spark, str(tmp_path / "w"), preamble=1)
    assert got.count() == 300
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "MapInArrow" in plan
    got.collect()
    final = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Exchange hashpartitioning" not in final and final.count("FileScan text") == 1


def test_file_names_are_worked_out_once_a_split(spark, tmp_path):
    write_report(str(tmp_path / "a b" / "c+d e.csv"), ["a,b", "1,2", "3,4"])
    got = scan_reports(spark, str(tmp_path / "a b"), preamble=0)
    assert {r._file for r in got.collect()} == {"c+d e.csv"}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "decode" not in plan.lower()
