"""Report-file fixtures generated from the report specs (small, hand-checkable)."""

import os

from reportflow.plans import specs as S
from reportflow.spec import DERIVED


def write_csv(path, header, rows, sep=",", preamble=("Exported report",), footer=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)

    def cell(v):
        if v is None:
            return ""
        v = str(v)
        return '"' + v.replace('"', '""') + '"' if (sep in v or '"' in v or "\n" in v) else v
    lines = list(preamble) + [sep.join(header)] + [sep.join(cell(v) for v in r) for r in rows]
    if footer:
        lines.append(footer)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write("\n".join(lines) + "\n")


def source_headers(spec):
    seen, out = set(), []
    for c in spec.columns:
        if c.source != DERIVED and c.source not in seen:
            seen.add(c.source)
            out.append(c.source)
    return out


def spec_rows(spec, n, tag, overrides=None):
    """n rows for the spec's source headers; values ``<header>-<tag>-<i>``."""
    heads = source_headers(spec)
    rows = []
    for i in range(n):
        row = {h: f"{h}-{tag}-{i}" for h in heads}
        row.update((overrides or {}).get(i, {}))
        rows.append(row)
    return heads, rows


def write_spec(folder, spec, n, tag, overrides=None, extra_cols=(), preamble=("Exported",)):
    heads, rows = spec_rows(spec, n, tag, overrides)
    heads = heads + [c for c in extra_cols if c not in heads]
    write_csv(os.path.join(folder, spec.file_name), heads,
              [[r.get(h) for h in heads] for r in rows], preamble=preamble)


def write_full(folder, spec, header, rows, but=()):
    """Rows with some columns given; the contract's other columns are there, but empty."""
    more = [h for h in source_headers(spec) if h not in header and h not in but]
    write_csv(os.path.join(folder, spec.file_name), header + more, [r + [None] * len(more) for r in rows])


def networks_delivery(folder, tag):
    """A full NETWORKS delivery: every report file and side file, 2-3 rows each."""
    write_spec(folder, S.PARENT, 2, tag, {1: {"bsc_name": None}})
    write_csv(os.path.join(folder, "3G_RNC_List.csv"), ["bsc_name", "node_id", "nedspver"],
              [[f"RNC-{tag}", "77", "V9"]])
    write_spec(folder, S.SITE_2G, 3, tag,
               {0: {"bts_name": "SITE0120", "bts_index": "1"},
                1: {"bts_name": "SITE0120", "bts_index": "2"},    # duplicate BTS name: first wins
                2: {"bts_name": None}},
               extra_cols=("bts_software_version_1",))
    write_csv(os.path.join(folder, "CO-MPT 2G.csv"), ["gbts_function_name", "ne_name", "product_version"],
              [["SITE0120", "SRAN-A", "BTS3900 V100R012C10SP7"]])
    write_spec(folder, S.CELL_2G, 3, tag,
               {0: {"mcc": "268", "mnc": "01", "cell_lac": "5", "cell_ci": "9", "routing_area": "2"},
                1: {"mcc": "268", "mnc": "01", "cell_lac": "5", "cell_ci": "9", "routing_area": None},
                2: {"mcc": "268", "mnc": "01", "cell_lac": "5", "cell_ci": "9", "routing_area": "3"}})
    # TRX: the header holds "Cell Index" twice (BSC cell index, then the TRX cell index)
    write_csv(os.path.join(folder, "2G_Cell_TRX.csv"),
              ["BSC Name", "BTS Name", "Cell Name", "Cell Index", "Cell Index", "Is Main BCCH TRX",
               "Frequency", "TRX No.", "TRX ID", "Active Status", "Administrative State", "TRX Name"],
              [["B1", "S1", "C1", "10", "100", "Yes", "512", "0", "1", "Active", "Unlocked", "T1"],
               ["B1", "S1", "C1", "10", "101", "No", "514", "1", "1", "Active", "Unlocked", "T1b"]])
    write_spec(folder, S.SITE_3G, 2, tag,
               {0: {"nodeb_name": "NB00042", "nodeb_id": "42"}, 1: {"nodeb_name": "NB7", "nodeb_id": "7"}})
    write_csv(os.path.join(folder, "CO-MPT 3G.csv"),
              ["nodeb_function_name", "ne_name", "product_version", "cabinet_type"],
              [["NB00042", "SRAN-3", "V200R001SP2", "APM30"], [None, "X", "Y", "Z"]])
    write_csv(os.path.join(folder, "NodeB Info.csv"), ["nodeb_name", "nodeb_version", "nodeb_type"],
              [["NB00042", "UNKNOWN", "UMTS"], ["NB7", "BTS V300R1SP4", "DBS3900"]], preamble=())
    write_spec(folder, S.CELL_3G, 2, tag)
    write_full(folder, S.SITE_4G, ["ne_name", "cabinet_type", "enodeb_id", "software_version"],
              [["ENB00123", "APM", "123", "V100R015SP1"], ["ENB00123", None, "123", "V1"]])
    write_csv(os.path.join(folder, "CO-MPT 4G.csv"),
              ["enodeb_function_name", "ne_name", "product_version"],
              [["ENB00999", "SRAN-4", "BTS5900 V500SP3"], ["ENB00999", "dup", "x"], [None, "n", "p"]])
    write_full(folder, S.CELL_4G,
               ["ne_name", "local_cell_id", "cell_name", "cell_id", "mobile_country_code",
                "mobile_network_code", "enodeb_id", "enodeb_function_name"],
               [["ENB00123", "0", "L1", "3", "268", "01", "123", "ENB00123"]], but=("root_sequence_index",))
    write_csv(os.path.join(folder, "CO-MPT 4G_Cell_List.csv"),
              ["enodeb_function_name", "cell_name", "root_sequence_index"],
              [["ENB00123", "L1", "600"], ["ENB00777", "L9", "700"]])
    write_full(folder, S.SITE_5G, ["ne_name", "cabinet_type", "gnodeb_id", "hot_patch_version"],
              [["GNB00055", "BBU", "55", "UNKNOWN"]])
    write_full(folder, S.CELL_5G, ["ne_name", "nr_cell_id", "cell_name", "gnodeb_id", "gnodeb_function_name"],
              [["GNB00055", "1", "N1", "55", "GNB-F"]])
