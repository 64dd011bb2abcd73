"""Report pipelines (R1-R20) as DataFrame compositions driven by the specs.

Every builder takes scanned report frames (normalised all-text columns plus
``_file``/``_path``/``_seq``) and returns the delivery as table rows: the
spec's prefixed columns plus ``__seq``, the within-delivery order that decides
keep-first/keep-last ties.  ``load`` merges a staged delivery into its
snapshot table; ``export`` produces the readable, relabelled rows.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportflow.functions import commands as cmdf
from reportflow.functions.keys import cell_identity, composite_key
from reportflow.functions.software import software_merge
from reportflow.functions.text import (choose_name, digits_only, fill_default, last_chars,
                                       sentinel_coalesce, strip_leading_zeros, trim_unicode)
from reportflow.operators.dedup import keep_first, nulls_last_key
from reportflow.operators.gates import complete_row_gate, drop_matching, drop_null_keys
from reportflow.operators.joins import enrich, natural_outer, outer_on_keys
from reportflow.operators.project import all_text, rename
from reportflow.operators.setops import append
from reportflow.plans import specs as S
from reportflow.sinks.snapshot import SnapshotTable
from reportflow.sources.reports import FILE, PATH, SEQ, file_prefix
from reportflow.spec import DERIVED, ReportSpec

ORDER = "__seq"
META = (FILE, PATH, SEQ)


@dataclass
class Staged:
    spec: ReportSpec
    rows: DataFrame            # prefixed table columns + ORDER


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _v(value) -> Column:
    """A literal, or a Column when a batch of deliveries carries per-row values."""
    return value if isinstance(value, Column) else F.lit(value)


def _ensure(df: DataFrame, cols) -> DataFrame:
    """Add absent columns as null text (those that no contract asks for)."""
    missing = [c for c in cols if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else df


class MissingColumns(ValueError):
    """A report lacks columns of its contract."""


def contract_columns(spec: ReportSpec) -> list[str]:
    """Source columns that a report must have."""
    return list(dict.fromkeys(c.source for c in spec.columns if c.source != DERIVED))


def _sources(df: DataFrame, spec: ReportSpec, *optional: str) -> DataFrame:
    """The report, which must have every source column of ``spec``; absent ``optional`` ones are null."""
    missing = [c for c in contract_columns(spec) if c not in df.columns]
    if missing:
        raise MissingColumns(f"{spec.file_name} lacks {missing}")
    return _ensure(df, optional)


def _order(*parts) -> Column:
    """Within-delivery order: nulls-last struct of the given columns."""
    return nulls_last_key(list(parts))


def _finish(spec: ReportSpec, df: DataFrame, oss, report_date, order: Column,
            by: tuple[str, ...] = ()) -> Staged:
    df = _sources(df, spec)
    stamped = {}
    if oss is not None and "oss" in spec.table_columns:
        stamped["oss"] = _v(oss)
    if report_date is not None and "update_date" in spec.table_columns:
        stamped["update_date"] = _v(report_date)
    df = df.withColumn(ORDER, order)
    renamed = rename(df, spec.renames)
    if stamped:
        renamed = renamed.withColumns(stamped)
    renamed = _ensure(renamed, [c for c in spec.table_columns])
    rows = renamed.select(*[_col(c).cast("string").alias(f"{spec.table}_{c}")
                            for c in spec.table_columns], F.col(ORDER),
                          *[_col(b) for b in by if b in renamed.columns])
    return Staged(spec, rows)


def _side(df: DataFrame, cols, seq_name: str, by: tuple[str, ...] = ()) -> DataFrame:
    df = _ensure(df, cols)
    return df.select(*[_col(c) for c in cols], F.col(SEQ).alias(seq_name),
                     *[_col(b).alias(f"{b}_r") for b in by])


# --- NETWORKS ----------------------------------------------------------------
# ``by`` names delivery columns (e.g. a delivery id): side-file joins and de-dup
# then stay inside each delivery, so many deliveries run as one job.

def _enrich(left: DataFrame, side: DataFrame, lk: str, rk: str, by: tuple[str, ...]) -> DataFrame:
    m = enrich(left, side, [lk, *by], [rk, *[f"{b}_r" for b in by]], "full")
    if by:
        m = m.withColumns({b: F.coalesce(_col(b), _col(f"{b}_r")) for b in by}).drop(
            *[f"{b}_r" for b in by])
    return m


def parent(bsc: DataFrame, rnc: DataFrame, oss, report_date, by: tuple[str, ...] = ()) -> Staged:
    """BSC list with the RNC list appended (node_id is the OSP code)."""
    r = rename(rnc, {"node_id": "osp_code[whole_number]"})
    both = append(bsc.withColumn("__part", F.lit(0)), r.withColumn("__part", F.lit(1)))
    return _finish(S.PARENT, both, oss, report_date, _order("__part", SEQ), by)


def site_2g(sites: DataFrame, co_mpt: DataFrame, oss, report_date,
            by: tuple[str, ...] = ()) -> Staged:
    """R2: 2G sites enriched with the 2G CO-MPT list, first row per BTS name."""
    t = _sources(sites, S.SITE_2G, "bts_software_version_1").withColumn(
        "unique_id", composite_key("bsc_name", "bts_index"))
    side = _side(co_mpt, ["gbts_function_name", "ne_name", "product_version"], "__rseq", by)
    m = _enrich(t, side, "bts_name", "gbts_function_name", by)
    # rows without a BTS name are dropped next, so Catalyst turns the full join into a left join
    m = m.where(_col("bts_name").isNotNull())
    m = m.withColumns({
        "bts_software_version": software_merge(fill_default("bts_software_version_1"),
                                               fill_default("product_version"), F.lit("UNKNOWN")),
        "sran": F.coalesce(_col("ne_name"), F.lit("")),
        "numb_name": digits_only("bts_name"),
    })
    m = keep_first(m, ["bts_name", *by], order_by=[SEQ, "__rseq"])
    return _finish(S.SITE_2G, m, oss, report_date, _order(SEQ, "__rseq"), by)


def cell_2g(cells: DataFrame, oss, report_date, by: tuple[str, ...] = ()) -> Staged:
    """2G cells; on equal keys the row with the last routing area wins."""
    t = _sources(cells, S.CELL_2G).withColumn("cgi", composite_key("mcc", "mnc", "cell_lac",
                                                                    "cell_ci"))
    t = t.withColumns({"unique_id": composite_key("bsc_name", "cgi"),
                       "name_numb": digits_only("bts_name")})
    return _finish(S.CELL_2G, t, oss, report_date, _order("routing_area", SEQ), by)


def trx_2g(trx: DataFrame, oss, report_date, by: tuple[str, ...] = ()) -> Staged:
    """2G TRX, first row per four-part key (depends on the duplicate Cell Index)."""
    t = _sources(trx, S.TRX_2G).withColumn(
        "unique_id", composite_key("bsc_name", "cell_name", "cell_index", "trx_id"))
    t = keep_first(t, ["unique_id", *by], seq=SEQ)
    return _finish(S.TRX_2G, t, oss, report_date, _order(SEQ), by)


def site_3g(sites: DataFrame, co_mpt: DataFrame, nodeb_info: DataFrame, oss, report_date,
            by: tuple[str, ...] = ()) -> Staged:
    """3G sites enriched with CO-MPT 3G (different key names) and NodeB Info."""
    co = drop_null_keys(_ensure(co_mpt, ["nodeb_function_name"]), ["nodeb_function_name"])
    side = _side(co, ["nodeb_function_name", "ne_name", "product_version", "cabinet_type"],
                 "__rseq", by)
    info = _ensure(nodeb_info, ["nodeb_name", "nodeb_version", "nodeb_type"]).select(
        "nodeb_name", "nodeb_version", "nodeb_type", F.col(SEQ).alias("__iseq"), *by)
    sites = _sources(sites, S.SITE_3G)
    # The table's rows come from the sites.  Sites without a name match NodeB Info rows without
    # one; of those only the last can win a key, so only that one takes part.
    null_name = F.col("nodeb_name").isNull()
    nameless = info.where(null_name).groupBy(*by).agg(
        F.max_by(F.struct("nodeb_version", "nodeb_type"), "__iseq").alias("x"), F.max("__iseq").alias("__iseq"))
    nameless = nameless.select(F.lit(None).cast("string").alias("nodeb_name"), "x.nodeb_version", "x.nodeb_type",
                               "__iseq", *by)
    named = info.where(~null_name)
    left, right = ["nodeb_name", *by], ["nodeb_function_name", *[f"{b}_r" for b in by]]
    m = enrich(sites, side, left, right, "left").drop(*[f"{b}_r" for b in by])
    m = outer_on_keys(m, named.unionByName(nameless), left, "left")
    # For the export only: rows without a site stay alone; null names are not paired.
    keys = sites.select(*left)
    apart = side.join(keys, [side[r] == keys[k] for k, r in zip(left, right, strict=True)], "left_anti")
    apart = apart.withColumnsRenamed({f"{b}_r": b for b in by})
    alone = named.join(keys, left, "left_anti")
    m = m.unionByName(apart, allowMissingColumns=True).unionByName(alone, allowMissingColumns=True)
    m = m.withColumns({
        "unique_id": composite_key("bsc_name", "nodeb_id"),
        "cabinet": sentinel_coalesce("nodeb_type", "cabinet_type", "UMTS", "UNKNOWN"),
        "software": software_merge(fill_default("nodeb_version"), fill_default("product_version"),
                                   F.lit("UNKNOWN")),
        "sran_name": F.coalesce(_col("ne_name"), F.lit("")),
        "numb": strip_leading_zeros(digits_only("nodeb_name")),
    })
    return _finish(S.SITE_3G, m, oss, report_date,
                   _order("ne_name", SEQ, "__rseq", "__iseq"), by)


def cell_3g(cells: DataFrame, oss, report_date, by: tuple[str, ...] = ()) -> Staged:
    """3G cells keyed by BSC and CGI."""
    t = _sources(cells, S.CELL_3G).withColumn(
        "cgi", composite_key("mobile_country_code", "mobile_network_code",
                             "location_area_code", "cell_id"))
    t = t.withColumn("unique_id", composite_key("bsc_name", "cgi"))
    return _finish(S.CELL_3G, t, oss, report_date, _order(SEQ), by)


def _site_sw(df: DataFrame) -> DataFrame:
    df = _ensure(df, ["hot_patch_version", "software_version", "product_version"])
    return df.withColumn("sw", software_merge(fill_default("hot_patch_version"),
                                              fill_default("software_version"),
                                              fill_default("product_version")))


def site_4g(sites: DataFrame, co_mpt: DataFrame, oss, report_date,
            by: tuple[str, ...] = ()) -> Staged:
    """4G sites plus the CO-MPT 4G list appended; first row per (oss, NE name)."""
    co = drop_null_keys(_ensure(co_mpt, ["enodeb_function_name"]), ["enodeb_function_name"])
    co = keep_first(co, ["enodeb_function_name", *by], seq=SEQ)
    co = rename(co, {"ne_name": "sran_name", "enodeb_function_name": "ne_name"})
    both = append(_ensure(sites, ["ne_name"]).withColumn("__part", F.lit(0)),
                  co.withColumn("__part", F.lit(1)))
    both = _ensure(_site_sw(both), ["cabinet_type", "sran_name"])
    both = both.withColumns({
        "number": strip_leading_zeros(last_chars("ne_name", 5)),
        "unique_id": composite_key(_v(oss), "ne_name"),
        "sran_name": F.coalesce(_col("sran_name"), F.lit("")),
    })
    both = keep_first(both, ["unique_id", *by], order_by=["cabinet_type", "__part"], seq=SEQ)
    return _finish(S.SITE_4G, both, oss, report_date, _order("cabinet_type", "__part", SEQ), by)


def cell_4g(cells: DataFrame, co_mpt_cells: DataFrame, oss, report_date,
            by: tuple[str, ...] = ()) -> Staged:
    """4G cells naturally joined with the CO-MPT cell list; ECGI from eNodeB and cell.

    The natural join uses every shared report column (the delivery columns in
    ``by`` are shared too, so matches stay inside a delivery).
    """
    co = drop_null_keys(_ensure(co_mpt_cells, ["enodeb_function_name"]),
                        ["enodeb_function_name"])
    left = cells.drop(FILE, PATH).withColumnRenamed(SEQ, "__lseq")
    right = co.drop(FILE, PATH).withColumnRenamed(SEQ, "__rseq")
    m = natural_outer(left, right)
    ecgi = composite_key("mobile_country_code", "mobile_network_code",
                         cell_identity("enodeb_id", "cell_id"))
    m = m.withColumn("ecgi", ecgi)
    m = m.withColumn("unique_id", composite_key(_v(oss), "ne_name", "ecgi"))
    return _finish(S.CELL_4G, m, oss, report_date, _order("__lseq", "__rseq"), by)


def site_5g(sites: DataFrame, oss, report_date, by: tuple[str, ...] = ()) -> Staged:
    """5G sites."""
    t = _site_sw(_sources(sites, S.SITE_5G)).withColumns({
        "unique_id": composite_key(_v(oss), "ne_name"),
        "number": strip_leading_zeros(last_chars("ne_name", 5)),
    })
    return _finish(S.SITE_5G, t, oss, report_date, _order(SEQ), by)


def cell_5g(cells: DataFrame, oss, report_date, by: tuple[str, ...] = ()) -> Staged:
    """5G cells; NCGI from gNodeB and NR cell."""
    t = _sources(cells, S.CELL_5G).withColumn("ncgi", cell_identity("gnodeb_id", "nr_cell_id"))
    t = t.withColumn("unique_id", composite_key("gnodeb_function_name", _v(oss), "ncgi"))
    return _finish(S.CELL_5G, t, oss, report_date, _order(SEQ), by)


# --- EXTERNALS --------------------------------------------------------------------

def external(spec: ReportSpec, df: DataFrame, oss, report_date,
             by: tuple[str, ...] = ()) -> Staged:
    """CGI/ECGI and key from the raw headers, null keys dropped."""
    id_name, id_parts, key_parts = S.EXTERNAL_KEYS[spec.file_name]
    t = _sources(df, spec)
    lacking = [c for c in (*id_parts, *key_parts) if c not in t.columns]
    if lacking:
        raise MissingColumns(f"{spec.file_name} lacks {lacking}")
    t = t.withColumns({id_name: composite_key(*id_parts), "unique_id": composite_key(*key_parts)})
    t = drop_null_keys(t, ["unique_id"])
    return _finish(spec, t, oss, report_date, _order(SEQ), by)


# --- HCMD, PKI, generic -----------------------------------------------------------

LOG_RENAMES = {"operation_command": "org_cmd", "operator_name": "operator", "ip_address": "ip",
               "command_code": "cmd_code", "command_type": "opr_type",
               "operation_time": "start_time", "operation_end_time": "end_time"}


LOG_COLUMNS = (*LOG_RENAMES, "source", "dn", "return_code", "result")


def command_log(logs: DataFrame, insert_time: dt.datetime, keep: tuple[str, ...] = ()) -> DataFrame:
    """Command logs -> table rows (text, prefixed); appended, not merged.

    ``logs`` is a scan with two preamble lines and the footer row removed.
    Every value is stripped, configuration echo lines are dropped and the
    command text, class and operator code are derived; the BSC is the file
    name before its first underscore.
    """
    data_cols = [c for c in logs.columns if c not in META and c not in keep]
    t = logs.select(*[trim_unicode(c).alias(c) for c in data_cols], *META,
                    *[_col(k) for k in keep if k not in META])
    t = rename(t, LOG_RENAMES)
    t = drop_matching(t, "org_cmd")
    t = t.withColumn("cmd", cmdf.command_text("org_cmd"))
    t = t.withColumns({"cmd_type": cmdf.command_class("cmd"),
                       "opr_code": cmdf.operator_code("org_cmd"),
                       "bsc": file_prefix(FILE),
                       "insert_time": F.lit(insert_time.strftime("%Y-%m-%d %H:%M:%S"))})
    spec = S.COMMAND_LOG
    t = _ensure(t, spec.table_columns)
    return all_text(t.select(*[_col(c).alias(f"{spec.table}_{c}") for c in spec.table_columns],
                             *[_col(k) for k in keep]))


def pki(report: DataFrame, insert_time: dt.datetime, by: tuple[str, ...] = ()) -> Staged:
    """Certificate inventory, null site dropped, merged over all dates."""
    t = drop_null_keys(_sources(report, S.PKI), ["site_name"])
    t = t.withColumn("insert_time", F.lit(insert_time.strftime("%Y-%m-%d %H:%M:%S")))
    spec = S.PKI
    # several certificate files in one delivery: a later file (by name) beats an earlier one
    t = _ensure(t, [FILE]).withColumn(ORDER, _order(FILE, SEQ))
    t = rename(t, spec.renames)
    t = _ensure(t, spec.table_columns)
    rows = t.select(*[_col(c).cast("string") for c in spec.table_columns], F.col(ORDER),
                    *[_col(b) for b in by])
    return Staged(spec, rows)


def generic(report: DataFrame, oss, insert_time: dt.datetime,
            meta: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """Any report; a file loads only if it has at least one complete row.

    Returns text rows plus ``oss`` and ``insert_time``; the target table is the
    canonical report name (``functions.text.table_name``).  ``meta`` names
    further non-report columns (e.g. delivery columns of a batch).
    """
    data_cols = [c for c in report.columns if c not in META and c not in meta]
    t = complete_row_gate(report, [PATH], data_cols, few=True)
    t = t.select(*[_col(c) for c in data_cols], _v(oss).alias("oss"),
                 F.lit(insert_time.strftime("%Y-%m-%d %H:%M:%S")).alias("insert_time"),
                 *[_col(k) for k in keep])
    return all_text(t)


def generic_table_name(report_name: str) -> str:
    return report_name.lower().strip().replace(" ", "_").replace(".", "")


# --- loading and export -------------------------------------------------------------

def load(staged: Staged, table: SnapshotTable, report_date: str | None = None,
         on_create: str = "clean") -> DataFrame:
    """Merge a staged delivery into its snapshot table (U1) and return the new version."""
    spec = staged.spec
    key = f"{spec.table}_{spec.key}" if spec.table != "pki_project" else spec.key
    sort_col = (f"{spec.table}_{spec.sort_col}" if spec.table != "pki_project"
                else spec.sort_col)
    date_col = f"{spec.table}_update_date" if spec.scope == "report_date" else None
    return table.upsert(staged.rows, key=key, sort_cols=[sort_col], seq=ORDER,
                        scope=spec.scope, date_col=date_col, report_date=report_date,
                        on_create=on_create)


# The columns by which the readable exports are sorted, before a row's own order (which is the
# file's; for 3G sites the enriching name and then the file's).
EXPORT_ORDER = {
    "huawei_2g_cell": ("unique_id", "rac"),
    "huawei_2g_trx": ("unique_id",),
    "huawei_3g_cell": ("unique_id",),
    "huawei_4g_site": ("unique_id", "type"),
    "huawei_5g_cell": ("unique_id",),
}

# Readable-export extras: the computed "NE Name" of the site exports.
_NE_NAME = {
    "huawei_2g_site": ("SRAN", "BTS Name"),
    "huawei_3g_site": ("SRAN", "NodeB Name"),
    "huawei_4g_site": ("SRAN", "eNodeB Function Name"),
}


def export_order(spec: ReportSpec) -> list[str]:
    """Table columns that a report's readable export is sorted by, before the rows' own order."""
    return [f"{spec.table}_{c}" for c in EXPORT_ORDER.get(spec.table, ())]


def export(rows: DataFrame, spec: ReportSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Table rows -> readable export rows (labels, export order, NE Name) + ``keep``."""
    extra = [F.col(f"`{c}`") for c in keep]
    if spec.table == S.PKI.table:
        return rows.select(*[_col(c) for c in spec.table_columns], *extra)
    pairs = spec.export_pairs()
    out = rows.select(*[_col(c).alias(label) for c, label in pairs], *extra)
    if spec.table in _NE_NAME:
        sran, name = _NE_NAME[spec.table]
        out = out.withColumn("NE Name", choose_name(_col(sran), _col(name)))
        order = list(spec.export_order)
        if "NE Name" not in order:
            order.append("NE Name")
        out = out.select(*[_col(c) for c in order], *extra)
    return out


__all__ = ["Staged", "parent", "site_2g", "cell_2g", "trx_2g", "site_3g", "cell_3g", "site_4g",
           "cell_4g", "site_5g", "cell_5g", "external", "command_log", "pki", "generic", "load",
           "export", "generic_table_name"]
