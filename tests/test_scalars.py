"""Scalar rules against hand-written cases and against Python's own regex semantics."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reportflow.functions import commands, dates, keys, software, text


def one_col(spark, values, expr_fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr_fn(F.col("v"))).collect()]


# cases from the command-log contract
COMMAND_CASES = [
    ("/*123*/DSP CELL:ID=1;", "DSP CELL:ID=1;", "DSP", "123"),
    ("lst brd", "lst brd", "LST", "OTHER"),
    ("EMS user", "EMS user", "LOGIN", "OTHER"),
    ("Login", "Login", "LOGIN", "OTHER"),
    ("/* x */MOD A", "MOD A", "MOD", "OTHER"),
    ("run BulkCM job", "run BulkCM job", "BulkCM", "OTHER"),
    ("a TaskNo.=7", "a TaskNo.=7", "CmdTask", "OTHER"),
    ("<get file>[a]", "<get file>[a]", "FTP", "OTHER"),
    ("reset", "reset", "UNKNOWN", "OTHER"),
]


def test_command_rules(spark):
    orgs = [c[0] for c in COMMAND_CASES]
    cmd = one_col(spark, orgs, commands.command_text)
    assert cmd == [c[1] for c in COMMAND_CASES]
    assert one_col(spark, cmd, commands.command_class) == [c[2] for c in COMMAND_CASES]
    assert one_col(spark, orgs, commands.operator_code) == [c[3] for c in COMMAND_CASES]


def test_config_echo_filter(spark):
    vals = ["CmdCode=1, CmdName=a, CmdContent=b", None, "DSP X", "xCmdCode=1, CmdName=a, CmdContent=b"]
    assert one_col(spark, vals, commands.is_config_echo) == [True, False, False, False]


def test_comment_stops_at_newline_not_carriage_return(spark):
    # Python '.' excludes only '\n'; Java's would also stop at '\r'
    assert one_col(spark, ["/*1\r2*/A", "/*1*/A\n/*2*/B"], commands.command_text) == ["A", "A\nB"]


SW_CASES = [
    (("BTS3900 V100R012C10SPC320", "UNKNOWN", "UNKNOWN"), "V100R012C10SPC320"),
    (("UNKNOWN", "V100R015SP100", "UNKNOWN"), "V100R015SPC100"),
    (("none", "V1", "UNKNOWN"), "UNKNOWN"),
    (("UNKNOWN", "UNKNOWN", "UNKNOWN"), "UNKNOWN"),
    (("Server V1", "UNKNOWN", "UNKNOWN"), "ver"),
    ((None, None, "V2SP3"), "V2SPC3"),
    (("v1SP2", "UNKNOWN", "UNKNOWN"), "v1SP2"),       # replacement needs an uppercase V
    (("xV9SP10yV8", "UNKNOWN", "UNKNOWN"), "V9SPC10yV8"),  # token starts at the first v/V
]


def test_software_merge(spark):
    df = spark.createDataFrame([c[0] for c in SW_CASES], "h string, s string, p string")
    got = [r[0] for r in df.select(software.software_merge("h", "s", "p")).collect()]
    assert got == [c[1] for c in SW_CASES]


def _py_tags(values):
    """Reference semantics: sequential literal replacements, SPC->SP then SP->SPC."""
    pairs = [("Micro", ""), ("Pico", ""), ("BTS3902E", ""), ("BTS5900", ""), ("BTS3202E", ""),
             ("BTS3000", ""), (" ", ""), ("SPC", "SP"), ("SP", "SPC"), ("BTS3900_5900", ""),
             ("BTS3900", "")]
    out = []
    for v in values:
        if v is None:
            out.append(None)
            continue
        for a, b in pairs:
            v = v.replace(a, b)
        out.append(v)
    return out


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="VSPC0123 _MicroBTS390E", max_size=16), min_size=1, max_size=8))
def test_strip_tags_matches_sequential_replacement(spark, values):
    assert one_col(spark, values, software.strip_tags) == _py_tags(values)


ALPHABET = st.sampled_from(list("ab0129٣ _-/*\n\r\t  　éÉ#x"))


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(ALPHABET, max_size=12), min_size=1, max_size=10))
def test_regex_classes_follow_python(spark, values):
    assert one_col(spark, values, text.digits_only) == [re.sub(r"\D", "", v) for v in values]
    assert one_col(spark, values, text.trim_unicode) == [v.strip() for v in values]
    assert one_col(spark, values, commands.command_text) == [
        re.sub(r"\/\*\d*.*\*\/", "", v) for v in values]

    def py_code(v):
        m = re.search(r"\/\*(\d*).*\*\/", v)
        return "OTHER" if m is None or m.group(1).strip() == "" else m.group(1)
    assert one_col(spark, values, commands.operator_code) == [py_code(v) for v in values]


def test_text_rules(spark):
    assert one_col(spark, ["Site0120", "000", "ab", None], text.site_number) == ["120", "", "", None]
    assert one_col(spark, ["ENB0001200", "12", "x00012"], lambda c: text.site_number(c, 5)) == [
        "1200", "12", "12"]
    assert one_col(spark, [" My Report.v2 ", "A b"], text.table_name) == ["my_reportv2", "a_b"]
    assert one_col(spark, ["", "SR1", None], lambda c: text.choose_name(c, F.lit("N"))) == [
        "N", "SR1", None]
    assert one_col(spark, ["UMTS", None, "X"], lambda c: text.sentinel_coalesce(
        c, F.lit("CAB"))) == ["CAB", "CAB", "X"]


def test_header_normalisation():
    raw = ["BSC Name", "Cell Index", "Cell Index", "OSP code[Whole Number]", "TRX No.", "a", "a",
           "a.1"]
    assert text.normalise_headers(raw) == ["bsc_name", "cell_index", "cell_index1",
                                           "osp_code[whole_number]", "trx_no", "a", "a1", "a11"]


def test_composite_key_propagates_null(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    assert [r[0] for r in df.select(keys.composite_key("x", "y")).collect()] == ["a-b", None]


def test_cell_identity(spark):
    df = spark.createDataFrame([("1", "2"), (None, "3")], "n string, c string")
    assert [r[0] for r in df.select(keys.cell_identity("n", "c")).collect()] == ["258", None]


def test_cell_identity_flags_non_numeric(spark):
    df = spark.createDataFrame([("x1", "2"), ("1", "2"), (None, "2")], "n string, c string")
    got = [tuple(r) for r in df.select(keys.cell_identity("n", "c"),
                                       keys.invalid_identity("n", "c")).collect()]
    assert got == [(None, True), ("258", False), (None, False)]


def test_report_dates(spark):
    got = one_col(spark, ["2024-1-2", "02-01-2024", "2-1-2024", "2024-01-02x"], dates.try_report_date)
    assert [str(g) if g else None for g in got] == ["2024-01-02", "2024-01-02", "2024-01-02", None]
    with pytest.raises(Exception):
        one_col(spark, ["31/12/2024"], dates.report_date)


def test_subject_parse(spark):
    subjects = ["[Report][REGION_A][NETWORKS][2024-01-02]", "[Report][PKI][02-01-2024]",
                "[Report][REGION_Z][HCMD][2024-01-02]", "[Report]", "[Other][A][B]"]
    df = spark.createDataFrame([(s,) for s in subjects], "s string")
    got = [tuple(r) for r in df.select(dates.parse_subject("s", ["REGION_A", "REGION_B"])
                                       .alias("p")).select("p.*").collect()]
    assert got == [
        ("Report", "REGION_A", "NETWORKS", "2024-01-02", "ok"),
        ("Report", "", "PKI", "02-01-2024", "ok"),
        ("Report", "", "REGION_Z", "HCMD", "ok"),   # unknown region: three-part form
        ("Report", None, None, None, "too_few_parts"),
        ("Other", None, None, None, "not_a_report"),
    ]
