"""Archive members (S7) and the consume-once landing folder."""

import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from reportflow.sources import archive
from reportflow.sources.reports import literal
from reportflow.streaming.inbox import consume_once


def test_zip_members_and_guard(spark, tmp_path):
    d = tmp_path / "zips"
    d.mkdir()
    with zipfile.ZipFile(d / "good.zip", "w") as z:
        z.writestr("a.csv", "x\n1\n")
        z.writestr("dir/b.csv", "x\n2\n")
        z.writestr("dir/../c.csv", "x\n3\n")
    with zipfile.ZipFile(d / "bad.zip", "w") as z:
        z.writestr("a.csv", "x\n1\n")
        z.writestr("../c.csv", "x\n3\n")
    members = archive.expand_archives(spark, str(d))
    assert members.count() == 5
    named = members.withColumn("archive", F.element_at(F.split("archive", "/"), -1))
    verdict = rows(archive.guard(named, "/landing/in").select("archive", "members", "accepted"))
    assert verdict == [("bad.zip", 2, False), ("good.zip", 3, True)]
    kept = archive.accepted_members(named, "/landing/in")
    assert sorted(r.member for r in kept.collect()) == ["a.csv", "dir/../c.csv", "dir/b.csv"]


@pytest.mark.parametrize("before, comment", [(b"", b"\n" * 65535), (b"\xef\xbb\xbf", b"no break at the end"), (b"#!x\n" * 300, b"")])
def test_no_row_holds_an_archive_or_a_member(spark, tmp_path, before, comment):
    """Archives are cut by many tasks into short slices, wherever their members and their directory lie."""
    draw = random.Random(1)
    body = "".join(f"{i},{draw.getrandbits(400):x}\n" for i in range(6000))
    want = {f"in/{m}.csv": f"{m}\n{body}" for m in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA)}
    path = tmp_path / "big [1]+2.zip"
    with open(path, "wb") as out:
        out.write(before)
        with zipfile.ZipFile(out, "w") as z:
            z.mkdir("in")
            z.writestr("none.csv", "")
            for name, text in want.items():
                info = zipfile.ZipInfo(name)
                info.compress_type = int(name[3:-4])
                with z.open(info, "w", force_zip64=info.compress_type == zipfile.ZIP_DEFLATED) as f:
                    f.write(text.encode())
            for i in range(4000):                           # a directory of more than one slice
                z.writestr(f"{'d' * 60}/{i}.csv", f"{i}\n")
            z.comment = comment
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150000")
    try:
        members = archive.stage_members(spark, [literal(str(path))])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert members.agg(F.max(F.length("data"))).first()[0] <= 1 << 16 < os.path.getsize(path) // 32
    assert members.where("slice = 0").count() == 4005
    lines = archive.member_lines(members)
    assert lines.where("member LIKE 'd%'").agg(F.count("*"), F.sum("line"), F.max("number")).first()[:] == (4000, 7998000, 0)
    for name, text in want.items():
        got = lines.where(F.col("member") == name).orderBy("number").collect()
        assert "".join(f"{r.line}\n" for r in got) == text and [r.number for r in got] == list(range(6001))


@pytest.mark.parametrize("raw", [b"no archive\n", b"x" * 200_000])
def test_files_that_are_no_archives_fail(spark, tmp_path, raw):
    (tmp_path / "x.zip").write_bytes(raw)
    with pytest.raises(Exception, match="not a zip file"):
        archive.stage_members(spark, [str(tmp_path / "x.zip")])


def test_member_resolution(spark):
    cases = [("a.csv", True), ("dir/b.csv", True), ("../c.csv", False), ("/abs.csv", False),
             ("a/../../in/x.csv", True), ("a/../../other/x.csv", False), (".", True),
             ("../../../landing/in/y", True), ("x/./y/../z", True)]
    df = spark.createDataFrame(cases, "m string, expected boolean")
    got = df.select("expected", archive.member_is_safe(F.col("m"), "/landing/in").alias("ok"))
    assert all(r.expected == r.ok for r in got.collect())


def test_consume_once(spark, tmp_path):
    land, sink, ckpt = str(tmp_path / "land"), str(tmp_path / "sink"), str(tmp_path / "ckpt")
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    df.write.parquet(land)
    consume_once(spark, land, df.schema, ckpt, sink=sink)
    consume_once(spark, land, df.schema, ckpt, sink=sink)       # nothing new
    assert spark.read.parquet(sink).count() == 10
    spark.range(10, 13).withColumn("v", F.col("id") * 2).write.mode("append").parquet(land)
    consume_once(spark, land, df.schema, ckpt, sink=sink)       # only the new file
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == list(range(13))
    assert os.path.isdir(ckpt)


def test_consume_once_route(spark, tmp_path):
    land, out, ckpt = str(tmp_path / "land"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    df = spark.range(5)
    df.write.parquet(land)
    consume_once(spark, land, df.schema, ckpt, route=lambda b, _: b.write.mode("append").parquet(out))
    consume_once(spark, land, df.schema, ckpt, route=lambda b, _: b.write.mode("append").parquet(out))
    assert spark.read.parquet(out).count() == 5
