"""R1-R21 end to end: a run of deliveries through gate, pipelines, tables, exports and ledger."""

import datetime as dt
import os

import pytest

from fixtures import networks_delivery, source_headers, write_csv, write_full, write_spec
from reportflow.plans import specs as S
from reportflow.plans.ingest import Warehouse, ingest

# rows may end early: missing fields are null
PKI_HEADER = ["Site Name", "CA Name", "OSS", "Type", "Certificate Date", *[
    h for h in source_headers(S.PKI) if h not in ("site_name", "ca_name", "oss", "type", "certificate_date")]]
NOW = dt.datetime(2024, 1, 2, 6, 0, 0)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    land = root / "landing"
    networks_delivery(str(land / "netA"), "A")
    networks_delivery(str(land / "netB"), "B")
    networks_delivery(str(land / "netOld"), "O")
    write_spec(str(land / "extA"), S.EXT_2G_2G, 2, "E", {1: {"bsc_name": None}})
    write_csv(str(land / "extA" / "Some other list.csv"), ["a"], [["1"]])
    write_csv(str(land / "pki" / "certs.csv"),
              PKI_HEADER,
              [["S1", "CA", "REGION_A", "macro", "2024"], [None, "CA", "REGION_A", "x", "y"]],
              preamble=())
    write_csv(str(land / "logs" / "BSC7_ops.csv"),
              ["Source", "Operator Name", "DN", "IP Address", "Command Code", "Command Type",
               "Operation Time", "Return Code", "Result", "Operation End Time", "Operation Command"],
              [["NMS", " admin ", "dn", "1.2.3.4", "1", "t", "09:00", "0", "ok", "09:01",
                "/*12*/DSP CELL:;"],
               ["NMS", "admin", "dn", "1.2.3.4", "2", "t", "09:02", "0", "ok", "09:03",
                "CmdCode=1, CmdName=a, CmdContent=b"],
               ["NMS", "admin", "dn", "1.2.3.4", "3", "t", "09:04", "0", "ok", "09:05", "login"]],
              preamble=("Log", "Export"), footer="Total: 3")
    write_csv(str(land / "gen" / "plan.csv"), ["Week", "Owner"], [["1", "ana"], ["2", None]],
              preamble=())
    subjects = spark.createDataFrame([
        ("[Report][REGION_A][NETWORKS][2024-01-02]", str(land / "netA"), 1),
        ("[Report][REGION_B][NETWORKS][02-01-2024]", str(land / "netB"), 2),
        ("[Report][REGION_A][NETWORKS][2024-01-01]", str(land / "netOld"), 3),
        ("[Report][REGION_A][EXTERNALS][2024-01-02]", str(land / "extA"), 4),
        ("[Report][PKI][2024-01-02]", str(land / "pki"), 5),
        ("[Report][REGION_A][HCMD][2024-01-02]", str(land / "logs"), 6),
        ("[Report][Sales Plan.v2][2024-01-02]", str(land / "gen"), 7),
        ("[Hello][x]", str(land / "none"), 8),
    ], "subject string, folder string, arrival long")
    wh_root = str(root / "warehouse")
    gate = ingest(spark, subjects, wh_root, ["REGION_A", "REGION_B"], NOW, today=dt.date(2024, 1, 1))
    return spark, Warehouse(wh_root), {r.arrival: r for r in gate.collect()}


def table(run, name):
    spark, wh, _ = run
    return wh.table(spark, name).read()


def test_gate(run):
    _, _, gate = run
    assert [a for a in sorted(gate) if gate[a].accepted] == [1, 2, 4, 5, 6, 7]
    assert gate[3].status == "ok" and not gate[3].accepted        # older than the run's A delivery
    assert gate[8].status == "not_a_report"
    assert gate[2].report_date == dt.date(2024, 1, 2)             # day-first date parsed


def test_parent(run):
    rows = {r.huawei_parent_name: r for r in table(run, "huawei_parent").collect()}
    assert {"RNC-A", "RNC-B", "bsc_name-A-0", "bsc_name-B-0"} == set(rows)   # null name dropped
    assert rows["RNC-A"].huawei_parent_osp_code == "77"


def test_site_2g(run):
    rows = sorted(table(run, "huawei_2g_site").collect(), key=lambda r: r.huawei_2g_site_oss)
    assert [(r.huawei_2g_site_oss, r.huawei_2g_site_bts_index, r.huawei_2g_site_sran,
             r.huawei_2g_site_numb_name) for r in rows] == [
        ("REGION_A", "1", "SRAN-A", "0120"), ("REGION_B", "1", "SRAN-A", "0120")]
    # empty own version -> UNKNOWN -> the CO-MPT product version is used, SP -> SPC
    assert rows[0].huawei_2g_site_bts_software_version == "V100R012C10SPC7"


def test_cell_2g_and_trx(run):
    cells = table(run, "huawei_2g_cell").collect()
    assert len(cells) == 6     # bsc names differ per row and delivery
    trx = table(run, "huawei_2g_trx").collect()
    assert len(trx) == 1
    t = trx[0]
    assert (t.huawei_2g_trx_bsc_cell_index, t.huawei_2g_trx_cell_index, t.huawei_2g_trx_name,
            t.huawei_2g_trx_oss) == ("10", "100", "T1", "REGION_B")   # first row; later delivery wins


def test_site_3g(run):
    rows = {r.huawei_3g_site_name: r for r in table(run, "huawei_3g_site").collect()
            if r.huawei_3g_site_oss == "REGION_A"}
    a, b = rows["NB00042"], rows["NB7"]
    assert (a.huawei_3g_site_cabinet, a.huawei_3g_site_software, a.huawei_3g_site_sran_name,
            a.huawei_3g_site_numb) == ("APM30", "V200R001SPC2", "SRAN-3", "42")
    assert (b.huawei_3g_site_cabinet, b.huawei_3g_site_software, b.huawei_3g_site_sran_name) == (
        "DBS3900", "V300R1SPC4", "")


def test_site_4g(run):
    rows = {r.huawei_4g_site_unique_id: r for r in table(run, "huawei_4g_site").collect()}
    a = rows["REGION_A-ENB00123"]
    assert (a.huawei_4g_site_type, a.huawei_4g_site_sw, a.huawei_4g_site_number) == (
        "APM", "V100R015SPC1", "123")
    c = rows["REGION_A-ENB00999"]
    assert (c.huawei_4g_site_sran_name, c.huawei_4g_site_sw) == ("SRAN-4", "V500SPC3")


def test_cells_4g_5g(run):
    c4 = [r for r in table(run, "huawei_4g_cell").collect() if r.huawei_4g_cell_oss == "REGION_A"]
    assert [(r.huawei_4g_cell_ecgi, r.huawei_4g_cell_rsi, r.huawei_4g_cell_unique_id) for r in c4] == [
        ("268-01-31491", "600", "REGION_A-ENB00123-268-01-31491")]
    c5 = [r for r in table(run, "huawei_5g_cell").collect() if r.huawei_5g_cell_oss == "REGION_A"]
    assert [(r.huawei_5g_cell_ncgi, r.huawei_5g_cell_unique_id) for r in c5] == [
        ("14081", "GNB-F-REGION_A-14081")]


def test_externals(run):
    rows = table(run, "huawei_2g_ext_to_2g").collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.huawei_2g_ext_to_2g_unique_id == "bsc_name-E-0-cell_index-E-0"
    assert r.huawei_2g_ext_to_2g_cgi == "mcc-E-0-mnc-E-0-cell_lac-E-0-cell_ci-E-0"


def test_pki_logs_generic(run):
    spark, wh, _ = run
    pki = table(run, "pki_project").collect()
    assert [(r.site_name, r.site_type, r.insert_time) for r in pki] == [
        ("S1", "macro", "2024-01-02 06:00:00")]
    logs = spark.read.parquet(wh.append_path("huawei_log")).collect()
    assert sorted((r.huawei_log_cmd, r.huawei_log_cmd_type, r.huawei_log_opr_code,
                   r.huawei_log_bsc, r.huawei_log_operator) for r in logs) == [
        ("DSP CELL:;", "DSP", "12", "BSC7", "admin"), ("login", "LOGIN", "OTHER", "BSC7", "admin")]
    gen = spark.read.parquet(wh.append_path("sales_planv2")).collect()
    assert sorted((r.week, r.owner, r.oss) for r in gen) == [("1", "ana", ""), ("2", None, "")]


def test_exports_and_ledger(run):
    spark, wh, _ = run
    raw = spark.read.option("header", True).csv(f"{wh.export_path('EXTERNALS')}/unrecognised")
    assert [(r.a, r.source_file) for r in raw.collect()] == [("1", "Some other list.csv")]
    exp = spark.read.option("header", True).csv(f"{wh.export_path('NETWORKS')}/huawei_2g_site")
    assert "NE Name" in exp.columns and exp.count() == 2
    assert os.path.isdir(f"{wh.export_path('NETWORKS')}/nodeb_info")
    led = wh.ledger(spark).read().collect()
    assert sorted((r.report_name, r.report_oss, r.error_code) for r in led) == [
        ("EXTERNALS", "REGION_A", "200"), ("HCMD", "REGION_A", "200"),
        ("NETWORKS", "REGION_A", "200"), ("NETWORKS", "REGION_B", "200"),
        ("PKI", "", "200"), ("SALES PLAN.V2", "", "200")]
    sent = {(r.report_name, r.report_oss): r.email_sent for r in led}
    assert sent[("NETWORKS", "REGION_A")] == 1 and sent[("NETWORKS", "REGION_B")] == 1
    assert sent[("EXTERNALS", "REGION_A")] == 0


def test_rerun_is_idempotent(run):
    spark, wh, _ = run
    before = {t: wh.table(spark, t).read().count()
              for t in ("huawei_2g_site", "huawei_2g_ext_to_2g", "pki_project")}
    logs_before = spark.read.parquet(wh.append_path("huawei_log")).count()
    # the same deliveries again: NETWORKS/PKI are rejected (strict gate), EXTERNALS and HCMD
    # (inclusive) are loaded again and must not duplicate anything
    root = wh.root.rsplit("/", 1)[0]
    subjects = spark.createDataFrame([
        ("[Report][REGION_A][NETWORKS][2024-01-02]", f"{root}/landing/netA", 11),
        ("[Report][REGION_A][EXTERNALS][2024-01-02]", f"{root}/landing/extA", 12),
        ("[Report][PKI][2024-01-02]", f"{root}/landing/pki", 13),
        ("[Report][REGION_A][HCMD][2024-01-02]", f"{root}/landing/logs", 14),
    ], "subject string, folder string, arrival long")
    gate = {r.arrival: r.accepted for r in
            ingest(spark, subjects, wh.root, ["REGION_A", "REGION_B"], NOW).collect()}
    assert gate == {11: False, 12: True, 13: False, 14: True}
    after = {t: wh.table(spark, t).read().count() for t in before}
    assert after == before
    assert spark.read.parquet(wh.append_path("huawei_log")).count() == logs_before


def test_ingest_stream_consumes_manifests_once(spark, tmp_path):
    import json

    from fixtures import write_csv
    from reportflow.streaming.inbox import ingest_stream
    land = tmp_path / "land"
    write_csv(str(land / "g1" / "plan.csv"), ["Week", "Owner"], [["1", "ana"]], preamble=())
    (tmp_path / "manifests").mkdir()
    with open(tmp_path / "manifests" / "m1.json", "w") as fh:
        fh.write(json.dumps({"subject": "[Report][Rota][2024-01-02]", "folder": str(land / "g1"),
                             "arrival": 1}) + "\n")
    wh = str(tmp_path / "wh")
    ckpt = str(tmp_path / "ckpt")
    for _ in range(2):    # the second run finds no new manifest
        ingest_stream(spark, str(tmp_path / "manifests"), wh, ["REGION_A"], ckpt, lambda: NOW)
    rows = spark.read.parquet(Warehouse(wh).append_path("rota")).collect()
    assert [(r.week, r.owner) for r in rows] == [("1", "ana")]
    led = Warehouse(wh).ledger(spark).read().collect()
    assert [(r.report_name, r.error_code) for r in led] == [("ROTA", "200")]


def test_snapshot_dates_across_runs(spark, tmp_path):
    """Same date merges regions; a newer date replaces the current snapshot."""
    def site_delivery(folder, names):
        write_full(str(folder), S.SITE_2G, ["bsc_name", "bts_index", "bts_name"],
                   [[f"BSC-{folder.name}", str(i), n] for i, n in enumerate(names)])
        write_csv(str(folder / "CO-MPT 2G.csv"), ["gbts_function_name", "ne_name", "product_version"],
                  [[names[0], "SR", "V1SP2"]])

    site_delivery(tmp_path / "a1", ["SA1", "SA2"])
    site_delivery(tmp_path / "b1", ["SB1"])
    site_delivery(tmp_path / "a2", ["SA9"])
    wh = str(tmp_path / "wh")
    runs = [("[Report][REGION_A][NETWORKS][2024-01-02]", "a1"),
            ("[Report][REGION_B][NETWORKS][2024-01-02]", "b1"),
            ("[Report][REGION_A][NETWORKS][2024-01-03]", "a2")]
    seen = []
    for i, (subject, folder) in enumerate(runs):
        subj = spark.createDataFrame([(subject, str(tmp_path / folder), i)],
                                     "subject string, folder string, arrival long")
        ingest(spark, subj, wh, ["REGION_A", "REGION_B"], NOW)
        tbl = Warehouse(wh).table(spark, "huawei_2g_site").read()
        seen.append(sorted((r.huawei_2g_site_bts_name, r.huawei_2g_site_update_date)
                           for r in tbl.collect()))
    assert seen == [
        [("SA1", "2024-01-02"), ("SA2", "2024-01-02")],
        [("SA1", "2024-01-02"), ("SA2", "2024-01-02"), ("SB1", "2024-01-02")],
        [("SA9", "2024-01-03")],
    ]
    # every run left its own version; the first one is still readable
    assert len(Warehouse(wh).table(spark, "huawei_2g_site").versions()) == 3


def test_trailing_run_follows_arrival_order():
    from reportflow.plans.ingest import trailing_run
    d = lambda a, day: {"arrival": a, "report_date": dt.date(2024, 1, day), "delivery": a}
    tail, keep = trailing_run([d(1, 3), d(2, 2)])            # a region sends an older date last
    assert [x["arrival"] for x in tail] == [2] and not keep
    tail, keep = trailing_run([d(1, 2), d(2, 2)])
    assert sorted(x["arrival"] for x in tail) == [1, 2] and keep
    tail, keep = trailing_run([d(1, 2), d(2, 3), d(3, 3)])
    assert sorted(x["arrival"] for x in tail) == [2, 3] and not keep


def test_run_without_accepted_deliveries(spark, tmp_path):
    subj = spark.createDataFrame([("[Hello][x]", str(tmp_path / "none"), 1),
                                  ("[Report][REGION_A][NETWORKS][31/12/2024]", str(tmp_path / "n"), 2)],
                                 "subject string, folder string, arrival long")
    gate = {r.arrival: (r.status, r.accepted) for r in
            ingest(spark, subj, str(tmp_path / "wh"), ["REGION_A"], NOW).collect()}
    assert gate == {1: ("not_a_report", False), 2: ("bad_date", False)}
    assert Warehouse(str(tmp_path / "wh")).ledger(spark).read() is None
