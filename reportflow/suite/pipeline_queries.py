"""Report pipelines (R1, R4-R10, R12-R17, R19, R20) and the run gate (R21) as queries.

Each query feeds report-shaped rows derived from the supplied tables through a
pipeline of ``plans.pipelines`` and merges the delivery into an empty snapshot
(keep-last per key, null keys dropped).  The oracle spells the same pipeline
in SQL: joins with ``IS NOT DISTINCT FROM``, the derived columns, and the
keep-first / keep-last ordering written out with ``QUALIFY``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from reportflow.operators.upsert import merge_snapshot
from reportflow.plans import ingest, pipelines as P, specs as S
from reportflow.spec import DERIVED
from reportflow.suite.base import (query, recipe, reported, sql_digits, sql_key, sql_strip_zeros,
                                   sql_sw_merge, with_ctes)
from reportflow.suite.ledger_queries import LEDGER

OSS, DATE = "REGION_A", "2024-01-02"
NOW = dt.datetime(2024, 1, 2, 6, 0, 0)


def _merged(staged):
    """Merge a staged delivery into an empty snapshot (clean create)."""
    spec = staged.spec
    key = spec.key if spec.table == S.PKI.table else f"{spec.table}_{spec.key}"
    sort = spec.sort_col if spec.table == S.PKI.table else f"{spec.table}_{spec.sort_col}"
    return merge_snapshot(None, staged.rows, key, [sort], seq=P.ORDER)


def _last(*cols: str) -> str:
    """SQL ORDER BY for 'last' under nulls-last ascending order of ``cols``."""
    return ", ".join(f"{c} IS NULL DESC, {c} DESC" for c in cols)


def _first(*cols: str) -> str:
    return ", ".join(f"{c} IS NULL, {c}" for c in cols)


def _select(spec, derived: dict[str, str], available: set[str]) -> str:
    """SELECT list of the spec's table columns from renamed/derived SQL expressions."""
    out = []
    for c in spec.columns:
        if c.name in derived:
            e = derived[c.name]
        elif c.source != DERIVED and c.source in available:
            e = f'"{c.source}"'
        else:
            e = "CAST(NULL AS VARCHAR)"
        name = c.name if spec.table == S.PKI.table else f"{spec.table}_{c.name}"
        out.append(f"{e} AS {name}")
    return ",\n       ".join(out)


STAMP = {"oss": f"'{OSS}'", "update_date": f"'{DATE}'"}

# ---- R1 parents ----------------------------------------------------------------------------

BSC = """
SELECT s_suppkey AS _seq, 'BSC' || CAST(s_suppkey % 37 AS STRING) AS bsc_name,
       CAST(s_suppkey AS STRING) AS osp_code, 'V' || CAST(s_nationkey AS STRING) AS nedspver
FROM {supplier}
"""
RNC = """
SELECT n_nationkey AS _seq, CASE WHEN n_nationkey % 9 = 0 THEN NULL ELSE 'BSC' || CAST(n_nationkey AS STRING) END AS bsc_name,
       CAST(n_nationkey * 7 AS STRING) AS node_id, 'R' || CAST(n_regionkey AS STRING) AS nedspver
FROM {nation}
"""


def q_parent(spark, d):
    """BSC list with the RNC list appended (node id as OSP code), last row per name."""
    bsc = recipe(spark, d, BSC).withColumnRenamed("osp_code", "osp_code[whole_number]")
    return _merged(P.parent(reported(bsc, S.PARENT), recipe(spark, d, RNC), OSS, DATE))


query("q_parent", with_ctes({"b": BSC, "r": RNC}, f"""
, u AS (SELECT bsc_name, osp_code, nedspver, 0 AS part, _seq FROM b
        UNION ALL SELECT bsc_name, node_id, nedspver, 1 AS part, _seq FROM r)
SELECT bsc_name AS huawei_parent_name, osp_code AS huawei_parent_osp_code, nedspver AS huawei_parent_sw,
       '{OSS}' AS huawei_parent_oss, '{DATE}' AS huawei_parent_update_date
FROM u WHERE bsc_name IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY bsc_name ORDER BY {_last('part', '_seq')}) = 1"""))(q_parent)

# ---- R4 TRX ----------------------------------------------------------------------------------

TRX = """
SELECT o_orderkey AS _seq, 'BSC' || CAST(o_custkey % 20 AS STRING) AS bsc_name,
       'S' || CAST(o_custkey AS STRING) AS bts_name, 'C' || CAST(o_custkey AS STRING) AS cell_name,
       CAST(o_custkey % 7 AS STRING) AS cell_index, CAST(o_orderkey AS STRING) AS cell_index1,
       o_orderstatus AS is_main_bcch_trx, CAST(o_orderkey % 1024 AS STRING) AS frequency,
       CAST(o_orderkey % 12 AS STRING) AS trx_no, CAST(o_orderkey % 3 AS STRING) AS trx_id,
       o_orderpriority AS active_status, 'Unlocked' AS administrative_state,
       'T' || CAST(o_orderkey AS STRING) AS trx_name
FROM {orders}
"""


def q_trx_2g(spark, d):
    """2G TRX; four-part key, first row per key (the second Cell Index column of the
    report arrives as ``cell_index1``, as the scan names a duplicated header)."""
    return _merged(P.trx_2g(reported(recipe(spark, d, TRX), S.TRX_2G), OSS, DATE))


_TRX_COLS = {"bsc_name", "bts_name", "cell_name", "cell_index", "cell_index1", "is_main_bcch_trx",
             "frequency", "trx_no", "trx_id", "active_status", "administrative_state", "trx_name"}
query("q_trx_2g", with_ctes({"t": TRX}, f"""
, k AS (SELECT *, {sql_key('bsc_name', 'cell_name', 'cell_index', 'trx_id')} AS unique_id FROM t)
SELECT {_select(S.TRX_2G, {**STAMP, 'unique_id': 'unique_id'}, _TRX_COLS)}
FROM k WHERE unique_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY _seq) = 1"""))(q_trx_2g)

# ---- R5 3G sites -------------------------------------------------------------------------------

SITES_3G = """
SELECT c_custkey AS _seq, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name END AS nodeb_name,
       CAST(c_custkey AS STRING) AS nodeb_id, 'RNC' || CAST(c_nationkey AS STRING) AS bsc_name,
       c_mktsegment AS sharing_type_of_nodeb, 'ATM' AS iub_transport_bearer_type
FROM {customer}
"""
CO_MPT_3G = """
SELECT o_orderkey AS _seq,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderstatus <> 'F' THEN 'X' ELSE '' END || 'Customer#' || lpad(CAST(o_custkey AS STRING), 9, '0') AS nodeb_function_name,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'SRAN-' || CAST(o_orderkey % 97 AS STRING) END AS ne_name,
       'BTS3900 V200R0' || CAST(o_orderkey % 9 AS STRING) || 'SP' || CAST(o_orderkey % 5 AS STRING) AS product_version,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'APM' || CAST(o_orderkey % 4 AS STRING) END AS cabinet_type
FROM {orders}
"""
NODEB_INFO_3G = """
SELECT o_orderkey AS _seq, CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderstatus <> 'O' THEN 'X' ELSE '' END
         || 'Customer#' || lpad(CAST(o_custkey AS STRING), 9, '0') AS nodeb_name,
       CASE WHEN o_orderkey % 5 = 0 THEN 'UNKNOWN' ELSE 'V300R' || CAST(o_orderkey % 8 AS STRING) || 'SP1' END AS nodeb_version,
       CASE WHEN o_orderkey % 2 = 0 THEN 'UMTS' ELSE 'DBS' || CAST(o_orderkey % 3 AS STRING) END AS nodeb_type
FROM {orders}
"""


def q_sites_3g(spark, d):
    """3G sites with CO-MPT 3G (different key names) and NodeB Info (shared key)."""
    return _merged(P.site_3g(reported(recipe(spark, d, SITES_3G), S.SITE_3G), recipe(spark, d, CO_MPT_3G),
                             recipe(spark, d, NODEB_INFO_3G), OSS, DATE))


query("q_sites_3g", with_ctes({"s": SITES_3G, "c": CO_MPT_3G, "i": NODEB_INFO_3G}, f"""
, c1 AS (SELECT nodeb_function_name, ne_name, product_version, cabinet_type, _seq AS rseq
         FROM c WHERE nodeb_function_name IS NOT NULL)
, m1 AS (SELECT s.*, c1.* FROM s FULL JOIN c1 ON s.nodeb_name IS NOT DISTINCT FROM c1.nodeb_function_name)
, m2 AS (SELECT m1.* EXCLUDE (nodeb_name), COALESCE(m1.nodeb_name, i.nodeb_name) AS nodeb_name,
                i.nodeb_version, i.nodeb_type, i._seq AS iseq
         FROM m1 FULL JOIN i ON m1.nodeb_name IS NOT DISTINCT FROM i.nodeb_name)
, k AS (SELECT *, {sql_key('bsc_name', 'nodeb_id')} AS unique_id FROM m2)
SELECT {_select(S.SITE_3G, {
    **STAMP, 'unique_id': 'unique_id',
    'cabinet': "COALESCE(NULLIF(nodeb_type, 'UMTS'), cabinet_type, 'UNKNOWN')",
    'software': sql_sw_merge('nodeb_version', 'product_version', "'UNKNOWN'"),
    'sran_name': "COALESCE(ne_name, '')",
    'numb': sql_strip_zeros(sql_digits('nodeb_name'))},
    {'nodeb_name', 'nodeb_id', 'bsc_name', 'sharing_type_of_nodeb', 'iub_transport_bearer_type'})}
FROM k WHERE unique_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY {_last('ne_name', '_seq', 'rseq', 'iseq')}) = 1
"""))(q_sites_3g)

# ---- R6 3G cells --------------------------------------------------------------------------------

CELLS_3G = """
SELECT o_orderkey AS _seq, 'RNC' || CAST(o_custkey % 30 AS STRING) AS bsc_name,
       '268' AS mobile_country_code, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE '06' END AS mobile_network_code,
       CAST(o_custkey % 60 AS STRING) AS location_area_code, CAST(o_orderkey - o_orderkey % 3 AS STRING) AS cell_id,
       'U' || CAST(o_orderkey AS STRING) AS cell_name, 'NB' || CAST(o_custkey AS STRING) AS nodeb_name,
       o_orderpriority AS cn_operator_name
FROM {orders}
"""


def q_cells_3g(spark, d):
    """3G cells keyed by RNC and CGI; last row per key."""
    return _merged(P.cell_3g(reported(recipe(spark, d, CELLS_3G), S.CELL_3G), OSS, DATE))


query("q_cells_3g", with_ctes({"c": CELLS_3G}, f"""
, k AS (SELECT *, {sql_key('mobile_country_code', 'mobile_network_code', 'location_area_code', 'cell_id')} AS cgi FROM c)
, u AS (SELECT *, {sql_key('bsc_name', 'cgi')} AS unique_id FROM k)
SELECT {_select(S.CELL_3G, {**STAMP, 'unique_id': 'unique_id', 'cgi': 'cgi'},
                {'bsc_name', 'mobile_country_code', 'mobile_network_code', 'location_area_code',
                 'cell_id', 'cell_name', 'nodeb_name', 'cn_operator_name'})}
FROM u WHERE unique_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY _seq DESC) = 1"""))(q_cells_3g)

# ---- R7 4G sites ----------------------------------------------------------------------------------

SITES_4G = """
SELECT c_custkey AS _seq, 'ENB' || lpad(CAST(c_custkey % 700 AS STRING), 5, '0') AS ne_name,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS cabinet_type,
       CAST(c_custkey AS STRING) AS enodeb_id,
       CASE c_custkey % 4 WHEN 0 THEN 'UNKNOWN' ELSE 'SPH' || CAST(c_custkey % 10 AS STRING) END AS hot_patch_version,
       'V100R01' || CAST(c_nationkey % 10 AS STRING) || 'SP' || CAST(c_custkey % 30 AS STRING) AS software_version
FROM {customer}
"""
CO_MPT_4G = """
SELECT s_suppkey AS _seq,
       CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE 'ENB' || lpad(CAST(s_suppkey % 900 AS STRING), 5, '0') END AS enodeb_function_name,
       'SRAN-' || CAST(s_suppkey AS STRING) AS ne_name,
       'BTS5900 V500R00' || CAST(s_nationkey % 10 AS STRING) || 'SP' || CAST(s_suppkey % 7 AS STRING) AS product_version
FROM {supplier}
"""


def q_sites_4g(spark, d):
    """4G sites plus the CO-MPT list appended; first row per (oss, NE name)."""
    return _merged(P.site_4g(reported(recipe(spark, d, SITES_4G), S.SITE_4G), recipe(spark, d, CO_MPT_4G), OSS, DATE))


query("q_sites_4g", with_ctes({"s": SITES_4G, "c": CO_MPT_4G}, f"""
, c1 AS (SELECT * FROM c WHERE enodeb_function_name IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY enodeb_function_name ORDER BY _seq) = 1)
, u AS (SELECT ne_name, cabinet_type, enodeb_id, hot_patch_version, software_version,
               CAST(NULL AS VARCHAR) AS product_version, CAST(NULL AS VARCHAR) AS sran_name, 0 AS part, _seq FROM s
        UNION ALL
        SELECT enodeb_function_name, NULL, NULL, NULL, NULL, product_version, ne_name, 1, _seq FROM c1)
, k AS (SELECT *, '{OSS}' || '-' || ne_name AS unique_id FROM u)
SELECT {_select(S.SITE_4G, {
    **STAMP, 'unique_id': 'unique_id', 'name': 'ne_name', 'type': 'cabinet_type',
    'sw': sql_sw_merge('hot_patch_version', 'software_version', 'product_version'),
    'number': sql_strip_zeros('right(ne_name, 5)'), 'sran_name': "COALESCE(sran_name, '')"},
    {'enodeb_id'})}
FROM k WHERE unique_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY {_first('cabinet_type', 'part', '_seq')}) = 1
"""))(q_sites_4g)

# ---- R8 4G cells ----------------------------------------------------------------------------------

CELLS_4G = """
SELECT o_orderkey AS _seq, 'ENB' || CAST(o_custkey AS STRING) AS ne_name,
       'ENB' || CAST(o_custkey AS STRING) AS enodeb_function_name,
       'L' || CAST(o_orderkey % 3 AS STRING) AS cell_name, CAST(o_custkey AS STRING) AS enodeb_id,
       CAST(o_orderkey % 3 AS STRING) AS cell_id, '268' AS mobile_country_code,
       CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE '01' END AS mobile_network_code,
       CAST(o_orderkey % 504 AS STRING) AS physical_cell_id
FROM {orders}
"""
CO_MPT_CELLS_4G = """
SELECT c_custkey AS _seq,
       CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE 'ENB' || CAST(c_custkey AS STRING) END AS enodeb_function_name,
       'L' || CAST(c_custkey % 3 AS STRING) AS cell_name, CAST(c_custkey % 838 AS STRING) AS root_sequence_index
FROM {customer}
"""


def q_cells_4g(spark, d):
    """4G cells naturally joined with the CO-MPT cell list; ECGI = mcc-mnc-(eNB*256+cell)."""
    co = recipe(spark, d, CO_MPT_CELLS_4G)
    return _merged(P.cell_4g(reported(recipe(spark, d, CELLS_4G), S.CELL_4G, co), co, OSS, DATE))


query("q_cells_4g", with_ctes({"l": CELLS_4G, "r": CO_MPT_CELLS_4G}, f"""
, r1 AS (SELECT enodeb_function_name, cell_name, root_sequence_index, _seq AS rseq FROM r
         WHERE enodeb_function_name IS NOT NULL)
, m AS (SELECT COALESCE(l.enodeb_function_name, r1.enodeb_function_name) AS enodeb_function_name,
               COALESCE(l.cell_name, r1.cell_name) AS cell_name, l.* EXCLUDE (enodeb_function_name, cell_name),
               r1.root_sequence_index, r1.rseq
        FROM l FULL JOIN r1 ON l.enodeb_function_name IS NOT DISTINCT FROM r1.enodeb_function_name
                           AND l.cell_name IS NOT DISTINCT FROM r1.cell_name)
, e AS (SELECT *, mobile_country_code || '-' || mobile_network_code || '-' ||
                  CAST(TRY_CAST(enodeb_id AS BIGINT) * 256 + TRY_CAST(cell_id AS BIGINT) AS VARCHAR) AS ecgi FROM m)
, k AS (SELECT *, '{OSS}' || '-' || ne_name || '-' || ecgi AS unique_id FROM e)
SELECT {_select(S.CELL_4G, {**STAMP, 'unique_id': 'unique_id', 'ecgi': 'ecgi'},
                {'ne_name', 'enodeb_function_name', 'cell_name', 'enodeb_id', 'cell_id',
                 'mobile_country_code', 'mobile_network_code', 'physical_cell_id', 'root_sequence_index'})}
FROM k WHERE unique_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY {_last('_seq', 'rseq')}) = 1
"""))(q_cells_4g)

# ---- R9 / R10 5G -----------------------------------------------------------------------------------

SITES_5G = """
SELECT s_suppkey AS _seq, 'GNB' || lpad(CAST(s_suppkey % 400 AS STRING), 5, '0') AS ne_name,
       'BBU' || CAST(s_nationkey AS STRING) AS cabinet_type, CAST(s_suppkey AS STRING) AS gnodeb_id,
       CASE WHEN s_suppkey % 2 = 0 THEN 'UNKNOWN' ELSE 'Patch v' || CAST(s_suppkey AS STRING) END AS hot_patch_version,
       CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE '5G V100R' || CAST(s_suppkey % 4 AS STRING) || 'SP2' END AS software_version
FROM {supplier}
"""


def q_sites_5g(spark, d):
    """5G sites; software merge, key oss-NE name, site number from the last five characters."""
    return _merged(P.site_5g(reported(recipe(spark, d, SITES_5G), S.SITE_5G), OSS, DATE))


query("q_sites_5g", with_ctes({"s": SITES_5G}, f"""
, k AS (SELECT *, '{OSS}' || '-' || ne_name AS unique_id FROM s)
SELECT {_select(S.SITE_5G, {
    **STAMP, 'unique_id': 'unique_id',
    'sw': sql_sw_merge('hot_patch_version', 'software_version', 'CAST(NULL AS VARCHAR)'),
    'number': sql_strip_zeros('right(ne_name, 5)')}, {'ne_name', 'cabinet_type', 'gnodeb_id'})}
FROM k WHERE unique_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY _seq DESC) = 1"""))(q_sites_5g)

CELLS_5G = """
SELECT o_orderkey AS _seq, 'GNB' || CAST(o_custkey AS STRING) AS ne_name,
       CAST(o_orderkey % 4 AS STRING) AS nr_cell_id, 'N' || CAST(o_orderkey AS STRING) AS cell_name,
       CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS gnodeb_id,
       'GF' || CAST(o_custkey % 300 AS STRING) AS gnodeb_function_name, 'TDD' AS duplex_mode
FROM {orders}
"""


def q_cells_5g(spark, d):
    """5G cells; NCGI = gNB*256 + NR cell, key gNB function-oss-NCGI."""
    return _merged(P.cell_5g(reported(recipe(spark, d, CELLS_5G), S.CELL_5G), OSS, DATE))


query("q_cells_5g", with_ctes({"c": CELLS_5G}, f"""
, n AS (SELECT *, CAST(TRY_CAST(gnodeb_id AS BIGINT) * 256 + TRY_CAST(nr_cell_id AS BIGINT) AS VARCHAR) AS ncgi FROM c)
, k AS (SELECT *, gnodeb_function_name || '-' || '{OSS}' || '-' || ncgi AS unique_id FROM n)
SELECT {_select(S.CELL_5G, {**STAMP, 'unique_id': 'unique_id', 'ncgi': 'ncgi'},
                {'ne_name', 'nr_cell_id', 'cell_name', 'gnodeb_id', 'gnodeb_function_name', 'duplex_mode'})}
FROM k WHERE unique_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY _seq DESC) = 1"""))(q_cells_5g)

# ---- R12-R17 externals -------------------------------------------------------------------------------

EXTERNAL_ROWS = """
SELECT o_orderkey AS _seq,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'BSC' || CAST(o_custkey % 25 AS STRING) END AS bsc_name,
       CAST(o_orderkey % 300 AS STRING) AS cell_index, 'C' || CAST(o_orderkey AS STRING) AS cell_name,
       '268' AS mcc, '01' AS mnc, CAST(o_custkey % 90 AS STRING) AS cell_lac,
       CAST(o_orderkey AS STRING) AS cell_ci, CAST(o_orderkey % 504 AS STRING) AS physical_cell_id,
       '268' AS mobile_country_code, '06' AS mobile_network_code,
       CAST(o_custkey % 90 AS STRING) AS location_area_code, 'G' || CAST(o_orderkey % 500 AS STRING) AS gsm_cell_name,
       CAST(o_orderkey AS STRING) AS gsm_cell_id, CAST(o_custkey % 9 AS STRING) AS neighboring_rnc_id,
       CAST(o_orderkey % 400 AS STRING) AS cell_id_of_neighboring_rnc,
       CAST(o_orderkey * 3 AS STRING) AS eutran_cell_identity,
       CAST(o_orderkey % 504 AS STRING) AS lte_physical_cell_identity,
       CAST(o_orderkey % 200 AS STRING) AS lte_cell_index
FROM {orders}
"""
_EXT_COLS = {"bsc_name", "cell_index", "cell_name", "mcc", "mnc", "cell_lac", "cell_ci",
             "physical_cell_id", "mobile_country_code", "mobile_network_code",
             "location_area_code", "gsm_cell_name", "gsm_cell_id", "neighboring_rnc_id",
             "cell_id_of_neighboring_rnc", "eutran_cell_identity", "lte_physical_cell_identity",
             "lte_cell_index"}
_EXT_SPECS = [S.EXT_2G_2G, S.EXT_2G_3G, S.EXT_2G_4G, S.EXT_3G_2G, S.EXT_3G_3G, S.EXT_3G_4G]


def q_externals(spark, d):
    """The six external-cell reports; CGI/ECGI and key per report, last row per key."""
    rows = recipe(spark, d, EXTERNAL_ROWS)
    out = None
    for spec in _EXT_SPECS:
        id_name, id_parts, key_parts = S.EXTERNAL_KEYS[spec.file_name]
        own = {c.source for c in spec.columns} | {*id_parts, *key_parts}    # a report carries its own headers only
        report = rows.select("_seq", *[c for c in rows.columns if c in own])
        m = _merged(P.external(spec, reported(report, spec), OSS, DATE)).select(
            F.lit(spec.table).alias("report_table"),
            F.col(f"{spec.table}_unique_id").alias("unique_id"),
            F.col(f"{spec.table}_{id_name}").alias("cell_global_id"),
            F.col(f"{spec.table}_parent").alias("parent"),
            F.col(f"{spec.table}_oss").alias("oss"))
        out = m if out is None else out.unionByName(m)
    return out


def _ext_oracle() -> str:
    parts = []
    for spec in _EXT_SPECS:
        _, id_parts, key_parts = S.EXTERNAL_KEYS[spec.file_name]
        parts.append(f"""
SELECT '{spec.table}' AS report_table, unique_id, cell_global_id, bsc_name AS parent, '{OSS}' AS oss
FROM (SELECT *, {sql_key(*key_parts)} AS unique_id, {sql_key(*id_parts)} AS cell_global_id FROM x)
WHERE unique_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY _seq DESC) = 1""")
    return with_ctes({"x": EXTERNAL_ROWS}, "\nUNION ALL\n".join(parts))


query("q_externals", _ext_oracle())(q_externals)

# ---- R19 PKI ------------------------------------------------------------------------------------------

PKI_EXISTING = """
SELECT CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'SITE' || CAST(c_custkey % 400 AS STRING) END AS site_name,
       'CA-OLD' AS ca_name, CAST(c_custkey AS STRING) AS certificate_serial_number,
       CASE WHEN c_custkey % 2 = 0 THEN 'REGION_A' ELSE 'REGION_B' END AS oss, c_mktsegment AS site_type,
       '2024-01-0' || CAST(1 + c_custkey % 2 AS STRING) || ' 05:00:00' AS insert_time
FROM {customer}
"""
PKI_INCOMING = """
SELECT s_suppkey AS _seq,
       CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE 'SITE' || CAST(s_suppkey % 600 AS STRING) END AS site_name,
       'CA-NEW' AS ca_name, CAST(s_suppkey AS STRING) AS certificate_serial_number,
       'REGION_A' AS oss, CASE WHEN s_suppkey % 2 = 0 THEN 'macro' ELSE 'small' END AS type
FROM {supplier}
"""


def q_pki(spark, d):
    """Certificates merged over all dates by site; latest insert time wins."""
    spec = S.PKI
    staged = P.pki(reported(recipe(spark, d, PKI_INCOMING), S.PKI), NOW)
    existing = recipe(spark, d, PKI_EXISTING)
    for c in spec.table_columns:
        if c not in existing.columns:
            existing = existing.withColumn(c, F.lit(None).cast("string"))
    existing = existing.select(*spec.table_columns)
    return merge_snapshot(existing, staged.rows, "site_name", ["insert_time"], seq=P.ORDER,
                          scope="all")


_PKI_NOW = NOW.strftime("%Y-%m-%d %H:%M:%S")
_PKI_COLS = ", ".join(c for c in S.PKI.table_columns)
query("q_pki", with_ctes({"e": PKI_EXISTING, "i": PKI_INCOMING}, f"""
, inc AS (SELECT {_select(S.PKI, {'insert_time': f"'{_PKI_NOW}'"},
                          {'site_name', 'ca_name', 'certificate_serial_number', 'oss', 'type'})},
                 1 AS b, _seq FROM i WHERE site_name IS NOT NULL)
, ex AS (SELECT site_name, ca_name, certificate_serial_number, oss, site_type, insert_time,
                0 AS b, CAST(NULL AS BIGINT) AS _seq FROM e)
, u AS (SELECT * FROM inc UNION ALL BY NAME SELECT * FROM ex)
SELECT {_PKI_COLS} FROM u WHERE site_name IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY site_name
        ORDER BY insert_time DESC, b DESC, _seq DESC NULLS LAST, certificate_serial_number DESC) = 1
"""))(q_pki)

# ---- R20 generic report ---------------------------------------------------------------------------------

GENERIC_ROWS = """
SELECT 'plan-' || CAST(o_custkey % 40 AS STRING) || '.csv' AS _path, o_orderkey AS _seq,
       'plan-' || CAST(o_custkey % 40 AS STRING) || '.csv' AS _file,
       CAST(o_orderkey AS STRING) AS week,
       CASE WHEN o_custkey % 40 < 6 OR o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS owner,
       o_orderstatus AS state
FROM {orders}
"""


def q_generic(spark, d):
    """A generic report file loads only if at least one of its rows is complete."""
    return P.generic(recipe(spark, d, GENERIC_ROWS), OSS, NOW)


query("q_generic", with_ctes({"g": GENERIC_ROWS}, f"""
SELECT week, owner, state, '{OSS}' AS oss, '{_PKI_NOW}' AS insert_time FROM g
WHERE _path IN (SELECT _path FROM g GROUP BY _path
                HAVING bool_or(week IS NOT NULL AND owner IS NOT NULL AND state IS NOT NULL))
"""))(q_generic)

# ---- R21 run gate ------------------------------------------------------------------------------------------

RUN_SUBJECTS = """
SELECT '[Report][' || CASE WHEN o_custkey % 3 = 0 THEN 'REGION_A' WHEN o_custkey % 3 = 1 THEN 'REGION_B' ELSE 'REGION_X' END
       || '][' || CASE o_orderpriority WHEN '1-URGENT' THEN 'NETWORKS' WHEN '2-HIGH' THEN 'externals'
                   WHEN '3-MEDIUM' THEN 'PKI' WHEN '4-NOT SPECIFIED' THEN 'HCMD' ELSE 'WeekPlan' END
       || '][' || CAST(CAST(o_orderdate AS DATE) AS STRING) || ']' AS subject,
       'landing/' || CAST(o_orderkey AS STRING) AS folder, o_orderkey AS arrival
FROM {orders}
"""


def q_route(spark, d):
    """Every delivery of a run parsed and gated against the ledger and earlier arrivals."""
    return ingest.gate_deliveries(recipe(spark, d, RUN_SUBJECTS), recipe(spark, d, LEDGER),
                                  ["REGION_A", "REGION_B"])


query("q_route", with_ctes({"s": RUN_SUBJECTS, "l": LEDGER}, """
, p AS (SELECT *, list_filter(regexp_split_to_array(subject, '[\\[\\]]'), lambda x: x <> '') AS parts FROM s)
, q AS (SELECT subject, folder, arrival, parts[1] AS report_id,
               parts[2] IN ('REGION_A', 'REGION_B') AS regional, len(parts) AS n, parts FROM p)
, r AS (SELECT subject, folder, arrival, report_id,
               CASE WHEN regional THEN parts[2] ELSE '' END AS oss0,
               CASE WHEN regional THEN parts[3] ELSE parts[2] END AS name0,
               CASE WHEN regional THEN parts[4] ELSE parts[3] END AS report_date_text,
               FROM q)
, t AS (SELECT subject, folder, arrival, report_id, upper(oss0) AS oss, upper(name0) AS report_name,
               report_date_text,
               CAST(COALESCE(try_strptime(report_date_text, '%Y-%m-%d'), try_strptime(report_date_text, '%d-%m-%Y')) AS DATE) AS report_date
        FROM r)
, t2 AS (SELECT *, CASE WHEN report_date IS NULL THEN 'bad_date' ELSE 'ok' END AS status,
                CASE WHEN report_name IN ('NETWORKS', 'EXTERNALS', 'HCMD', 'PKI', 'WEEKPLAN') THEN report_name ELSE 'GENERIC' END AS family
         FROM t)
, a AS (SELECT upper(report_name) AS report_name, upper(report_oss) AS report_oss, max(report_date) AS last_date
        FROM l WHERE error_code = '200' GROUP BY 1, 2)
, g AS (SELECT t2.*, a.last_date,
               max(t2.report_date) OVER (PARTITION BY t2.report_name, t2.oss ORDER BY t2.arrival
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior
        FROM t2 LEFT JOIN a ON t2.report_name = a.report_name AND t2.oss = a.report_oss
        WHERE t2.status = 'ok')
SELECT subject, folder, arrival, report_id, oss, report_name, report_date_text, status, report_date, family,
       last_date,
       COALESCE(greatest(last_date, prior) IS NULL OR CASE WHEN report_name IN ('WEEKPLAN', 'EXTERNALS', 'HCMD')
                THEN report_date >= greatest(last_date, prior) ELSE report_date > greatest(last_date, prior) END, false) AS accepted
FROM g
UNION ALL
SELECT subject, folder, arrival, report_id, oss, report_name, report_date_text, status, report_date, family,
       CAST(NULL AS DATE), false FROM t2 WHERE status <> 'ok'"""))(q_route)
