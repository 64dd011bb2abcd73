"""The report scan against pandas' CSV reader (what the reference used) on random files."""

import csv
import io
import os

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reportflow.sources.reports import NA_TOKENS, scan_reports

VALUES = st.sampled_from(["a", "b c", "x;y", "q,r", 'say "hi"', "", "NA", "None", "null", "n/a",
                          "é", "12", " pad ", "#N/A", "nan", "-NaN", "<NA>"])
HEADERS = st.lists(st.sampled_from(["Cell Index", "Name", "B.S.C", "Cell Index", "x"]),
                   min_size=1, max_size=4)


def write(path, header, rows, sep, preamble):
    buf = io.StringIO()
    w = csv.writer(buf, delimiter=sep, quoting=csv.QUOTE_MINIMAL, lineterminator="\n")
    for p in preamble:
        buf.write(p + "\n")
    w.writerow(header)
    for r in rows:
        w.writerow(r)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(buf.getvalue())


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(header=HEADERS, data=st.data(), sep=st.sampled_from([",", ";"]),
       preamble=st.integers(0, 2))
def test_scan_matches_pandas(spark, tmp_path_factory, header, data, sep, preamble):
    rows = data.draw(st.lists(st.lists(VALUES, min_size=len(header), max_size=len(header)),
                              min_size=1, max_size=6))
    # a row with every field empty is a blank line to both readers; keep one non-empty field
    rows = [r if any(v != "" for v in r) else ["z"] + r[1:] for r in rows]
    d = tmp_path_factory.mktemp("pd")
    path = os.path.join(d, "r.csv")
    write(path, header, rows, sep, [f"preamble line {i}" for i in range(preamble)])
    want = pd.read_csv(path, skiprows=preamble, dtype=str, sep=sep, keep_default_na=False,
                       na_values=list(NA_TOKENS))
    want.columns = want.columns.str.lower().str.strip().str.replace(" ", "_", regex=False) \
        .str.replace(".", "", regex=False)
    got = scan_reports(spark, str(d), preamble=preamble, sep=sep).toPandas()
    got = got[list(want.columns)]
    def norm(df):
        rows = [tuple(None if pd.isna(v) else v for v in r) for r in df.itertuples(index=False)]
        return sorted(rows, key=lambda t: tuple("\0" if v is None else v for v in t))
    assert list(got.columns) == list(want.columns)
    assert norm(got) == norm(want)
