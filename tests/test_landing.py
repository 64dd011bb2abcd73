"""Reports laid down by many tasks, and read back as one file each."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from conftest import rows
from reportflow.plans import ingest as I
from reportflow.plans import pipelines as P
from reportflow.sources.reports import list_files, scan_reports
from reportflow.suite import landing


def _report(spark, n, files=2):
    data = spark.range(n).select(F.concat(F.lit("r/list-"), (F.col("id") % files).cast("string"), F.lit(".csv")).alias("file"),
                                 (n - F.col("id")).alias("k"), F.col("id").cast("string").alias("a"),
                                 F.when(F.col("id") % 7 == 0, F.lit('x, "y"\nz')).otherwise("w").alias("b"))
    return landing.report_lines(data, "file", "k", ["a", "b"], ",", ["Exported"], "a,b", "Total: ")


def test_report_in_parts_reads_as_one_file(spark, tmp_path):
    lines = _report(spark, 400)
    whole, cut = str(tmp_path / "whole"), str(tmp_path / "cut")
    assert len(landing.write_files(spark, lines, whole)) == 2
    paths = landing.write_files(spark, lines, cut, lines_per_task=90)
    assert [p.rsplit("/", 1)[-1] for p in paths] == ["list-0.csv", "list-1.csv"]
    assert all(len(list((tmp_path / "cut/r" / f).glob("part-*"))) > 1 for f in ("list-0.csv", "list-1.csv"))
    assert [p.rsplit("/", 1)[-1] for p in list_files(spark, f"{cut}/r")] == ["list-0.csv", "list-1.csv"]
    for paths in ("r", "r/list-0.csv"):
        got = [rows(scan_reports(spark, f"{root}/{paths}", 1, footer=1).select("a", "b", "_file", "_seq.line"))
               for root in (whole, cut)]
        assert got[0] == got[1] and len(got[0]) == (400 if paths == "r" else 200)


def test_no_task_gets_a_whole_delivery(spark):
    deliveries = [{"delivery": d, "oss": "A", "report_date": I.dt.date(2024, 1, 2), "arrival": 1,
                   "subject": d, "folder": d} for d in ("x", "y")]
    of = F.when(F.col("id") % 2 == 0, "x").otherwise("y")
    staged = spark.range(100).select(of.alias(I.DELIVERY), F.lit("f").alias("_file"), F.concat("id", of).alias("_path"),
                                     F.col("id").cast("string").alias("a"), F.struct(F.col("id").alias("line")).alias("_seq"))
    tagged = I._rows_of(spark, SimpleNamespace(rows=staged), deliveries)
    loaded = P.generic(tagged, F.col(I.OSS), I.dt.datetime(2024, 1, 2), meta=(I.DELIVERY, I.OSS, I.DATE, I.ARRIVAL, I.PART))
    assert loaded.count() == 100
    plan = loaded._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan


def test_archives_are_deflated_by_many_tasks(spark, tmp_path):
    import zipfile
    lines = _report(spark, 400).withColumn("file", F.replace("file", F.lit("r/"), F.lit("r/one.zip/in/")))
    lines = lines.unionByName(lines.withColumn("file", F.replace("file", F.lit("one"), F.lit("two"))))
    want = {}
    for r in lines.orderBy("file", "n").collect():
        want.setdefault(tuple(r.file.split(".zip/")), []).append(r.line + "\n")
    landing.write_archives(spark, lines, str(tmp_path), lines_per_task=90)
    got = {}
    for p in (tmp_path / "r").glob("*.zip"):
        with zipfile.ZipFile(p) as zf:
            assert zf.testzip() is None
            got |= {(f"r/{p.stem}", m): zf.read(m).decode() for m in zf.namelist()}
    assert got == {k: "".join(v) for k, v in want.items()}
    found = scan_reports(spark, f"{tmp_path}/r", 1, footer=1)
    assert found.count() == 800 and found.where("try_cast(a AS INT) % 7 = 0 AND b = 'x, \"y\"\nz'").count() == 116


def test_inflating_copies_no_more_than_a_slice(spark):
    import zlib

    from reportflow.sources import archive
    raw = b"a line of text\n" * 4_000_000
    z = zlib.compressobj(wbits=-15)
    data = z.compress(raw) + z.flush()
    slices = [data[i:i + 50_000] for i in range(0, len(data), 50_000)]
    assert len(slices) > 1 and b"".join(archive._inflated(archive.DEFLATED, iter(slices))) == raw
