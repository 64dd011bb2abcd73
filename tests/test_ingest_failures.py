"""Runs with bad deliveries, archives, re-sends and replays."""

import datetime as dt
import os
import zipfile

from fixtures import write_csv, write_full
from reportflow.plans import specs as S
from reportflow.plans.ingest import Warehouse, ingest

NOW = dt.datetime(2024, 1, 2, 6, 0, 0)
REGIONS = ["REGION_A", "REGION_B"]


def run(spark, wh, *deliveries):
    """Ingest (subject, folder) pairs in order; {(report, region): [codes]} of the whole ledger."""
    rows = [(s, str(f), i) for i, (s, f) in enumerate(deliveries)]
    ingest(spark, spark.createDataFrame(rows, "subject string, folder string, arrival long"), str(wh), REGIONS, NOW)
    out = {}
    for r in Warehouse(str(wh)).ledger(spark).read().collect():
        out.setdefault((r.report_name, r.report_oss), []).append(r.error_code)
    return {k: sorted(v) for k, v in out.items()}


def cells(folder, bsc, n=2, but=(), **ids):
    header = ["bsc_name", "mcc", "mnc", "cell_lac", "cell_ci"]
    rows = [[bsc, "268", "01", "5", str(i)] for i in range(n)]
    write_full(str(folder), S.CELL_2G, [h for h in header if h not in but],
               [[v for h, v in zip(header, r) if h not in but] for r in rows], but=but)


def table(spark, wh, name):
    return Warehouse(str(wh)).table(spark, name).read()


NET_A, NET_B = "[Report][REGION_A][NETWORKS][2024-01-02]", "[Report][REGION_B][NETWORKS][2024-01-02]"


def test_bad_delivery_fails_alone_and_its_resend_loads(spark, tmp_path):
    cells(tmp_path / "good", "B1")
    cells(tmp_path / "bad", "B2", but=("bsc_name",))
    cells(tmp_path / "resend", "B3")
    led = run(spark, tmp_path / "wh", (NET_A, tmp_path / "good"), (NET_B, tmp_path / "bad"),
              (NET_B, tmp_path / "resend"))
    assert led == {("NETWORKS", "REGION_A"): ["200"], ("NETWORKS", "REGION_B"): ["200", "500"]}
    assert {r.huawei_2g_cell_parent for r in table(spark, tmp_path / "wh", "huawei_2g_cell").collect()} == {"B1", "B3"}


def test_ids_long_rows_and_side_files(spark, tmp_path):
    header = ["ne_name", "nr_cell_id", "gnodeb_id", "gnodeb_function_name"]
    write_full(str(tmp_path / "ok"), S.CELL_5G, header, [["N", "1", "7", "F"]])
    write_full(str(tmp_path / "id"), S.CELL_5G, header, [["N", "1", "7", "F"], ["N", "2", "abc", "F"]])
    cells(tmp_path / "long", "B1")
    with open(tmp_path / "long" / "2G_Cell_List.csv", "a") as fh:
        fh.write(",".join(["x"] * 90) + "\n")
    write_full(str(tmp_path / "side"), S.SITE_2G, ["bsc_name"], [["B"]])
    for i, (name, code) in enumerate([("ok", "200"), ("id", "500"), ("long", "500"), ("side", "500")]):
        led = run(spark, tmp_path / f"wh{i}", (NET_A, tmp_path / name))
        assert led == {("NETWORKS", "REGION_A"): [code]}, name


def test_generic_regions_and_batching(spark, tmp_path):
    for r in ("A", "B"):
        write_csv(str(tmp_path / r / "plan.csv"), ["Week", "Owner"], [[r, "x"]], preamble=())
    a, b = [(f"[Report][REGION_{r}][Rota][2024-01-02]", tmp_path / r) for r in "AB"]
    run(spark, tmp_path / "one", a, b)
    run(spark, tmp_path / "two", a)
    led = run(spark, tmp_path / "two", b)
    assert led == {("ROTA", "REGION_A"): ["200"], ("ROTA", "REGION_B"): ["200"]}
    for wh in ("one", "two"):
        rows = spark.read.parquet(Warehouse(str(tmp_path / wh)).append_path("rota")).collect()
        assert sorted((r.week, r.oss, r.report_oss) for r in rows) == [
            ("A", "REGION_A", "REGION_A"), ("B", "REGION_B", "REGION_B")]


def test_zip_deliveries(spark, tmp_path):
    cells(tmp_path / "plain", "B1", 3)
    body = (tmp_path / "plain" / "2G_Cell_List.csv").read_text()
    for name, members in (("zip", {"x/2G_Cell_List.csv": body}),
                          ("unsafe", {"2G_Cell_List.csv": body, "../out.csv": "a"})):
        os.makedirs(tmp_path / name)
        with zipfile.ZipFile(tmp_path / name / "d.zip", "w") as zf:
            for m, text in members.items():
                zf.writestr(m, text)
    led = run(spark, tmp_path / "wh", (NET_A, tmp_path / "zip"), (NET_B, tmp_path / "unsafe"))
    assert led == {("NETWORKS", "REGION_A"): ["200"], ("NETWORKS", "REGION_B"): ["500"]}
    assert table(spark, tmp_path / "wh", "huawei_2g_cell").count() == 3


def test_unknown_file_type_fails(spark, tmp_path):
    write_csv(str(tmp_path / "g" / "plan.xlsx"), ["Week"], [["1"]], preamble=())
    assert run(spark, tmp_path / "wh", ("[Report][Rota][2024-01-02]", tmp_path / "g")) == {("ROTA", ""): ["500"]}


def test_old_files_are_consumed_and_replays_skipped(spark, tmp_path):
    import json
    import time

    from reportflow.streaming.inbox import ingest_stream
    write_csv(str(tmp_path / "g" / "plan.csv"), ["Week"], [["1"]], preamble=())
    (tmp_path / "m").mkdir()

    def manifest(name, region, age):
        path = tmp_path / "m" / name
        path.write_text(json.dumps({"subject": f"[Report][{region}][Rota][2024-01-02]",
                                    "folder": str(tmp_path / "g"), "arrival": 1}) + "\n")
        os.utime(path, (time.time() - age, time.time() - age))

    wh = str(tmp_path / "wh")
    ledger = Warehouse(wh).ledger(spark)
    manifest("new.json", "REGION_A", 0)
    ingest_stream(spark, str(tmp_path / "m"), wh, REGIONS, str(tmp_path / "c"), lambda: NOW)
    manifest("old.json", "REGION_B", 9 * 86400)
    ingest_stream(spark, str(tmp_path / "m"), wh, REGIONS, str(tmp_path / "c"), lambda: NOW)
    assert ledger.read().count() == 2
    # the second batch is replayed: its commit mark is lost after the ledger was written
    os.remove(tmp_path / "c" / "commits" / "1")
    crc = tmp_path / "c" / "commits" / ".1.crc"
    if crc.exists():
        os.remove(crc)
    ingest_stream(spark, str(tmp_path / "m"), wh, REGIONS, str(tmp_path / "c"), lambda: NOW)
    assert ledger.read().count() == 2


def test_shared_folders_are_named_on_a_cluster(spark):
    import pytest

    from reportflow import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
