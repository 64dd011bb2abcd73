"""File-based queries: report scans, dispatch, command logs, archives, exports,
the consume-once landing folder and the text leak audit.

Report files are laid down by Spark from the supplied tables under the shared
scratch folder (``spark.checkpoint.dir``), then read back through the
library's scan; each call uses a fresh folder so calls are independent.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from reportflow.operators.audit import leak_findings
from reportflow.operators.upsert import merge_snapshot
from reportflow.plans import pipelines, router
from reportflow.plans import specs as S
from reportflow.session import scratch_path
from reportflow.sinks.export import write_export
from reportflow.sinks.snapshot import SnapshotTable
from reportflow.sources import archive
from reportflow.sources.reports import FILE, NA_TOKENS, scan_reports
from reportflow.streaming.inbox import consume_once
from reportflow.suite import landing
from reportflow.suite.base import (NOT_WORD, SPACE, WORD, duck, query, recipe, reported, sql_key, sql_trim,
                                   table, with_ctes)
from reportflow.suite.scalars import ORG_CMD

NOW = dt.datetime(2024, 1, 2, 6, 0, 0)

# ---- customer reports, one file per region ---------------------------------------------

CUSTOMER_ROWS = """
SELECT r_name || '.csv' AS file, c_custkey AS line_no,
       CAST(c_custkey AS STRING) AS f1,
       CASE c_custkey % 23 WHEN 0 THEN 'NA' WHEN 1 THEN 'N/A' WHEN 2 THEN 'null' WHEN 3 THEN '#N/A'
         WHEN 4 THEN 'None' WHEN 5 THEN '' WHEN 6 THEN ' NA' WHEN 7 THEN 'nan'
         ELSE c_name || CASE WHEN c_custkey % 31 = 0 THEN '; "quoted"' ELSE '' END END AS f2,
       CAST(c_nationkey AS STRING) AS f3,
       CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS STRING) AS f4,
       CASE c_custkey % 19 WHEN 0 THEN 'NULL' WHEN 1 THEN '-NaN' WHEN 2 THEN '<NA>' WHEN 3 THEN NULL
         ELSE c_mktsegment END AS f5
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""
CUSTOMER_HEADER = ["Cust Key", "Customer Name", "Nation.Key", "Acct Bal", "Mkt Segment"]
CUSTOMER_COLS = ["cust_key", "customer_name", "nationkey", "acct_bal", "mkt_segment"]


def _land(spark, d, rows_sql, header, sep, preamble, footer=None, value_cols=None, bare=()):
    root = scratch_path(spark, "landing")
    rows = recipe(spark, d, rows_sql)
    cols = value_cols or [c for c in rows.columns if c != "file" and c.startswith("f")]
    lines = landing.report_lines(rows, "file", "line_no", cols, sep, preamble,
                                 sep.join(header), footer, bare)
    landing.write_files(spark, lines, root)
    return root


def _tokens_sql(col: str) -> str:
    toks = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)
    return f"CASE WHEN {col} IN ({toks}) THEN NULL ELSE {col} END"


def _customer_scan(spark, d, tokens: bool):
    root = _land(spark, d, CUSTOMER_ROWS, CUSTOMER_HEADER, ";",
                 ["Customer export", "Generated 2024-01-02"])
    rows = scan_reports(spark, root, preamble=2, map_null_tokens=tokens)
    return rows.select(*CUSTOMER_COLS, F.col(FILE).alias("file_name"))


def q_report_scan(spark, d):
    """S1: ';' reports with a two-line preamble, one file per region, read as text."""
    return _customer_scan(spark, d, tokens=False)


query("q_report_scan", with_ctes({"r": CUSTOMER_ROWS}, """
SELECT f1 AS cust_key, NULLIF(f2, '') AS customer_name, f3 AS nationkey, f4 AS acct_bal,
       f5 AS mkt_segment, file AS file_name FROM r"""))(q_report_scan)


def q_null_tokens(spark, d):
    """S3: pandas' default null tokens read as null ('None' and ' NA' are not tokens)."""
    return _customer_scan(spark, d, tokens=True)


query("q_null_tokens", with_ctes({"r": CUSTOMER_ROWS}, f"""
SELECT {_tokens_sql('f1')} AS cust_key, {_tokens_sql('f2')} AS customer_name,
       {_tokens_sql('f3')} AS nationkey, {_tokens_sql('f4')} AS acct_bal,
       {_tokens_sql('f5')} AS mkt_segment, file AS file_name FROM r"""))(q_null_tokens)

SUPPLIER_ROWS = """
SELECT r_name || '_suppliers.csv' AS file, s_suppkey AS line_no, CAST(s_suppkey AS STRING) AS f1,
       s_name AS f2, CAST(s_nationkey AS STRING) AS f3, s_name || ' (copy)' AS f4,
       CAST(CAST(s_acctbal AS DECIMAL(15,2)) AS STRING) AS f5
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""


def q_header_normalise(spark, d):
    """Headers lower-cased, stripped, blanks to _, dots removed, duplicates x / x1."""
    root = _land(spark, d, SUPPLIER_ROWS, [" Supp Key ", "Name", "Nation.Key", "Name", "Acct.Bal"],
                 ",", ["Supplier export"])
    rows = scan_reports(spark, root, preamble=1)
    return rows.drop("_path", "_seq").withColumnRenamed(FILE, "file_name")


query("q_header_normalise", with_ctes({"r": SUPPLIER_ROWS}, """
SELECT f1 AS supp_key, f2 AS name, f3 AS nationkey, f4 AS name1, f5 AS acctbal, file AS file_name
FROM r"""))(q_header_normalise)

# ---- command logs, one file per (BSC, event type) ----------------------------------------------

LOG_HEADER = ["Source", "Operator Name", "DN", "IP Address", "Command Code", "Command Type",
              "Operation Time", "Return Code", "Result", "Operation End Time", "Operation Command"]
LOG_COLS = ["source", "operator_name", "dn", "ip_address", "command_code", "command_type",
            "operation_time", "return_code", "result", "operation_end_time", "operation_command"]

LOG_ROWS = f"""
SELECT 'BSC' || CAST(user_id % 8 AS STRING) || '_' || event_type || '.csv' AS file,
       event_id AS line_no, 'NMS' AS f01, ' user' || CAST(user_id AS STRING) AS f02,
       'DN=' || CAST(event_id AS STRING) AS f03,
       '10.0.' || CAST(user_id % 256 AS STRING) || '.' || CAST(event_id % 256 AS STRING) AS f04,
       CAST(event_id % 1000 AS STRING) AS f05, event_type AS f06,
       'T' || CAST(event_id AS STRING) AS f07,
       CASE WHEN event_type = 'error' THEN '1' ELSE '0' END AS f08,
       CASE WHEN event_type = 'error' THEN 'Failed ' ELSE 'Succeeded' END AS f09,
       'T' || CAST(event_id + 1 AS STRING) AS f10,
{ORG_CMD.strip()} AS f11
FROM {{events}}
"""


def _logs_root(spark, d):
    return _land(spark, d, LOG_ROWS, LOG_HEADER, ",",
                 ["Operation log export", "Exported at 2024-01-02 06:00:00"], footer="Total: ")


def q_footer_trim(spark, d):
    """S4+O3: two preamble lines, and the last row of every file (a footer) dropped."""
    rows = scan_reports(spark, _logs_root(spark, d), preamble=2, footer=1, sep=",")
    return rows.select(*LOG_COLS, F.col(FILE).alias("file_name"))


_LOG_ORACLE_COLS = ", ".join(f"f{i + 1:02d} AS {c}" for i, c in enumerate(LOG_COLS))
query("q_footer_trim", with_ctes({"r": LOG_ROWS}, f"""
SELECT {_LOG_ORACLE_COLS}, file AS file_name FROM r"""))(q_footer_trim)


def q_file_derived(spark, d):
    """S5+R18: command-log pipeline over a folder; BSC from the file name, text parsed."""
    rows = scan_reports(spark, _logs_root(spark, d), preamble=2, footer=1, sep=",")
    return pipelines.command_log(rows, NOW)


def _log_oracle() -> str:
    t = {c: sql_trim(f"f{i + 1:02d}") for i, c in enumerate(LOG_COLS)}
    cmd = "regexp_replace(org_cmd, '/\\*[^\\n]*\\*/', '', 'g')"
    w = f"upper(regexp_extract(cmd, '^({WORD}+){SPACE}', 1))"
    cls = (f"CASE WHEN cmd IS NULL THEN NULL WHEN contains(cmd, 'BulkCM') THEN 'BulkCM' "
           f"WHEN contains(cmd, 'TaskNo.=') THEN 'CmdTask' WHEN {w} IN ('EMS', 'LOGIN') THEN 'LOGIN' "
           f"WHEN {w} <> '' THEN {w} "
           f"WHEN regexp_matches(cmd, '^{NOT_WORD}[a-zA-Z][^\\n]+{NOT_WORD}\\[') THEN 'FTP' "
           f"WHEN upper(cmd) = 'LOGIN' THEN 'LOGIN' ELSE 'UNKNOWN' END")
    opr = ("CASE WHEN org_cmd IS NULL THEN NULL "
           "WHEN regexp_extract(org_cmd, '/\\*(\\p{Nd}*)[^\\n]*\\*/', 1) = '' THEN 'OTHER' "
           "ELSE regexp_extract(org_cmd, '/\\*(\\p{Nd}*)[^\\n]*\\*/', 1) END")
    p = "huawei_log_"
    return with_ctes({"r": LOG_ROWS}, f"""
, t AS (SELECT {t['source']} AS source, {t['operator_name']} AS operator, {t['dn']} AS dn,
               {t['ip_address']} AS ip, {t['command_code']} AS cmd_code, {t['command_type']} AS opr_type,
               {t['operation_time']} AS start_time, {t['return_code']} AS return_code,
               {t['result']} AS result, {t['operation_end_time']} AS end_time,
               {t['operation_command']} AS org_cmd, split_part(file, '_', 1) AS bsc FROM r)
, f AS (SELECT *, {cmd} AS cmd FROM t
        WHERE NOT COALESCE(regexp_matches(org_cmd, '^CmdCode=[^\\n]*, CmdName=[^\\n]*, CmdContent=[^\\n]*'), false))
SELECT source AS {p}source, operator AS {p}operator, dn AS {p}dn, ip AS {p}ip, cmd_code AS {p}cmd_code,
       opr_type AS {p}opr_type, start_time AS {p}start_time, return_code AS {p}return_code,
       result AS {p}result, end_time AS {p}end_time, org_cmd AS {p}org_cmd, cmd AS {p}cmd,
       {cls} AS {p}cmd_type, {opr} AS {p}opr_code, bsc AS {p}bsc,
       '{NOW.strftime('%Y-%m-%d %H:%M:%S')}' AS {p}insert_time
FROM f""")


query("q_file_derived", _log_oracle())(q_file_derived)

# ---- file allow-list and dispatch -----------------------------------------------------------------

DISPATCH_ROWS = """
SELECT CASE r_name WHEN 'AFRICA' THEN '2G_Site_List.csv' WHEN 'AMERICA' THEN '3G_RNC_List.csv'
         WHEN 'ASIA' THEN '5G_Site_List.csv' WHEN 'EUROPE' THEN 'NodeB Info.csv'
         ELSE 'notes.csv' END AS file,
       c_custkey AS line_no, CAST(c_custkey AS STRING) AS f1, c_name AS f2,
       CAST(c_nationkey AS STRING) AS f3, CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS STRING) AS f4,
       c_mktsegment AS f5
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""


def q_file_dispatch(spark, d):
    """Only allow-listed report files are read; each row tagged with its target table."""
    root = _land(spark, d, DISPATCH_ROWS, CUSTOMER_HEADER, ",", ["Network export"], bare=[S.NODEB_INFO])
    rows = router.dispatch_scan(spark, root, "NETWORKS")
    return rows.select(*CUSTOMER_COLS, F.col(FILE).alias("file_name"), "target_table")


query("q_file_dispatch", with_ctes({"r": DISPATCH_ROWS}, f"""
SELECT f1 AS cust_key, f2 AS customer_name, f3 AS nationkey, f4 AS acct_bal, f5 AS mkt_segment,
       file AS file_name,
       CASE file WHEN '2G_Site_List.csv' THEN '{S.SITE_2G.table}' WHEN '5G_Site_List.csv' THEN '{S.SITE_5G.table}'
         END AS target_table
FROM r WHERE file IN ({", ".join("'" + f + "'" for f in S.NETWORK_FILES)})"""))(q_file_dispatch)

# ---- archive members ---------------------------------------------------------------------------

DEST = "/landing/in"
MEMBERS = """
SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS archive,
  CASE WHEN page_id % 11 = 0 THEN '/abs/' || CAST(page_id AS STRING) || '.csv'
       WHEN page_id % 5 = 0 THEN '../' || CAST(page_id AS STRING) || '.csv'
       WHEN page_id % 7 = 0 THEN 'a/../../in/' || CAST(page_id AS STRING) || '.csv'
       WHEN page_id % 3 = 0 THEN 'dir/./x/../' || CAST(page_id AS STRING) || '.csv'
       WHEN page_id % 13 = 1 THEN 'x/../../../landing/in/y/' || CAST(page_id AS STRING) || '.csv'
       ELSE 'dir/' || CAST(page_id AS STRING) || '.csv' END AS member
FROM {pages}
"""


def q_archive_guard(spark, d):
    """Members resolved against the destination; one escaping member rejects its archive."""
    return archive.guard(recipe(spark, d, MEMBERS), DEST)


_DEST_LIST = "['landing', 'in']"
query("q_archive_guard", with_ctes({"m": MEMBERS}, f"""
, r AS (SELECT archive,
               list_reduce(list_concat(CASE WHEN starts_with(member, '/') THEN []::VARCHAR[] ELSE {_DEST_LIST} END,
                                       string_split(member, '/')),
                           lambda acc, x: CASE WHEN x = '..' THEN acc[1:len(acc) - 1]
                                               WHEN x = '' OR x = '.' THEN acc
                                               ELSE list_append(acc, x) END,
                           []::VARCHAR[]) AS res
        FROM m)
, s AS (SELECT archive, len(res) >= 2 AND res[1:2] = {_DEST_LIST} AS safe FROM r)
SELECT archive, count(*) AS members, CAST(sum(CASE WHEN safe THEN 0 ELSE 1 END) AS BIGINT) AS unsafe_members,
       sum(CASE WHEN safe THEN 0 ELSE 1 END) = 0 AS accepted
FROM s GROUP BY archive"""))(q_archive_guard)

# ---- 2G cells: flagship, readable export ------------------------------------------------------------

CELLS_2G = """
SELECT o_orderkey AS _seq, 'BSC' || CAST(pair % 50 AS STRING) AS bsc_name,
  CAST(o_orderkey AS STRING) AS cell_index, 'C' || CAST(o_orderkey AS STRING) AS cell_name,
  CASE WHEN o_orderkey % 4 = 0 THEN 'GSM900' ELSE 'DCS1800' END AS freq_band,
  '268' AS mcc, CASE WHEN o_custkey % 2 = 0 THEN '01' ELSE '06' END AS mnc,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(pair % 100 AS STRING) END AS cell_lac,
  CAST(pair AS STRING) AS cell_ci, CAST(o_orderkey % 8 AS STRING) AS ncc,
  CAST(o_custkey % 8 AS STRING) AS bcc,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey % 4 AS STRING) END AS routing_area,
  CAST(o_custkey AS STRING) AS bts_index, 'Customer#' || lpad(CAST(o_custkey AS STRING), 9, '0') AS bts_name,
  CASE WHEN o_orderstatus = 'F' THEN 'Unlocked' ELSE 'Locked' END AS administrative_state,
  CASE WHEN o_orderstatus = 'O' THEN 'Inactive' ELSE 'Active' END AS active_status,
  o_orderpriority AS operator_name, CAST(o_orderkey % 3 AS STRING) AS local_cell_id
FROM (SELECT *, o_orderkey - o_orderkey % 2 AS pair FROM {orders}) o
"""


def _cells_2g_table(spark, d):
    staged = pipelines.cell_2g(reported(recipe(spark, d, CELLS_2G), S.CELL_2G), "REGION_A", "2024-01-02")
    spec = staged.spec
    return merge_snapshot(None, staged.rows, key=f"{spec.table}_unique_id",
                          sort_cols=[f"{spec.table}_update_date"], seq=pipelines.ORDER)


def q_cells_2g(spark, d):
    """R3+U1: 2G cell report -> CGI and key -> last row per key (null routing area wins)."""
    return _cells_2g_table(spark, d)


def _cells_oracle(select: str) -> str:
    p = "huawei_2g_cell_"
    return with_ctes({"c": CELLS_2G}, f"""
, k AS (SELECT *, {sql_key('mcc', 'mnc', 'cell_lac', 'cell_ci')} AS cgi,
               bsc_name || '-' || ({sql_key('mcc', 'mnc', 'cell_lac', 'cell_ci')}) AS unique_id FROM c)
, t AS (SELECT unique_id AS {p}unique_id, cell_index AS {p}index, cgi AS {p}cgi, cell_name AS {p}name,
               freq_band AS {p}freq, mcc AS {p}mcc, mnc AS {p}mnc, cell_lac AS {p}lac, cell_ci AS {p}ci,
               ncc AS {p}ncc, bcc AS {p}bcc, routing_area AS {p}rac, bts_index AS {p}bts_index,
               bts_name AS {p}bts_name, regexp_replace(bts_name, '\\P{{Nd}}', '', 'g') AS {p}name_numb,
               administrative_state AS {p}state, active_status AS {p}active, operator_name AS {p}operator,
               bsc_name AS {p}parent, local_cell_id AS {p}local_cell_id, 'REGION_A' AS {p}oss,
               '2024-01-02' AS {p}update_date, routing_area IS NULL AS rac_null, _seq
        FROM k WHERE unique_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY unique_id
                                   ORDER BY rac_null DESC, routing_area DESC, _seq DESC) = 1)
{select}""")


query("q_cells_2g", _cells_oracle(
    "SELECT * EXCLUDE (rac_null, _seq) FROM t"))(q_cells_2g)


def q_readable_export(spark, d):
    """U1+P7+U5: cells merged into a snapshot table, relabelled, written as headed CSV."""
    staged = pipelines.cell_2g(reported(recipe(spark, d, CELLS_2G), S.CELL_2G), "REGION_A", "2024-01-02")
    tbl = SnapshotTable(spark, scratch_path(spark, "tables", staged.spec.table))
    current = pipelines.load(staged, tbl, report_date="2024-01-02")
    readable = pipelines.export(current, staged.spec)
    root = scratch_path(spark, "exports")
    write_export(readable, root, partitions={"report": "NETWORKS", "oss": "REGION_A", "date": "2024-01-02"})
    # what was written, read back; an empty text and a null are alike in the file
    schema = ", ".join(f"`{c}` string" for c in [*readable.columns, "report", "oss", "date"])
    return (spark.read.schema(schema).option("header", True).option("escape", '"').csv(root)
            .select(*[f"`{c}`" for c in readable.columns]))


def _readable_select() -> str:
    pairs = S.CELL_2G.export_pairs()
    return "SELECT " + ", ".join(f'{c} AS "{label}"' for c, label in pairs) + " FROM t"


query("q_readable_export", _cells_oracle(_readable_select()))(q_readable_export)

# ---- consume-once landing folder ---------------------------------------------------------------


def q_consume_once(spark, d):
    """Events land as files; two availableNow runs on one checkpoint load each file once."""
    base = scratch_path(spark, "inbox")
    landing_dir, sink, ckpt = f"{base}/landing", f"{base}/sink", f"{base}/checkpoint"
    events = table(spark, d, "events")
    events.repartition(4).write.parquet(landing_dir)
    for _ in range(2):   # the second run finds no new file and adds nothing
        consume_once(spark, landing_dir, events.schema, ckpt, sink=sink)
    return spark.read.parquet(sink)


query("q_consume_once", "SELECT * FROM events")(q_consume_once)

# ---- text leak audit -----------------------------------------------------------------------------

AUDIT_TEXTS = """
SELECT 'documents' AS source, doc_id, text FROM {documents}
UNION ALL
SELECT 'events' AS source, event_id AS doc_id,
  'user' || CAST(user_id AS STRING) || ' ' || event_type || ' from ' ||
  CASE event_id % 4
    WHEN 0 THEN '10.' || CAST(user_id % 256 AS STRING) || '.' || CAST(event_id % 256 AS STRING) || '.7'
    WHEN 1 THEN '172.' || CAST(10 + user_id % 30 AS STRING) || '.0.' || CAST(event_id % 300 AS STRING)
    WHEN 2 THEN '192.168.' || CAST(event_id % 256 AS STRING) || '.1'
    ELSE '8.8.' || CAST(user_id % 256 AS STRING) || '.8' END ||
  ' mail u' || CAST(user_id AS STRING) ||
  CASE WHEN event_id % 3 = 0 THEN '@corp.example.com' ELSE '@example.invalid' END ||
  CASE WHEN event_id % 7 = 0 THEN ' see /app/users/' || CAST(user_id AS STRING)
       WHEN event_id % 7 = 1 THEN ' via Webmail-' || event_type || '.example.org'
       ELSE '' END AS text
FROM {events}
"""


def q_leak_audit(spark, d):
    """private IPv4 (one per text), non-.invalid e-mails (each), internal markers (one)."""
    return leak_findings(recipe(spark, d, AUDIT_TEXTS), keep=["source"])


_W = r"[\p{L}\p{Mn}\p{Nd}\p{Pc}]"
_NW = r"[^\p{L}\p{Mn}\p{Nd}\p{Pc}]"
_IP = (rf"(?:^|{_NW})(10\.(?:\p{{Nd}}{{1,3}}\.){{2}}\p{{Nd}}{{1,3}}|192\.168\.\p{{Nd}}{{1,3}}\.\p{{Nd}}{{1,3}}"
       rf"|172\.(?:1[6-9]|2\p{{Nd}}|3[01])\.\p{{Nd}}{{1,3}}\.\p{{Nd}}{{1,3}})(?:{_NW}|$)")
_MAIL = rf"(?:^|{_NW})([A-Za-z0-9_][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}})(?:{_NW}|$)"
_MARK = r"(?i)/app/users/|outlook-[a-z]+\.|webmail-[a-z]+\."
query("q_leak_audit", f"""
WITH t AS ({duck(AUDIT_TEXTS)})
SELECT source, doc_id, 'private_ipv4' AS rule, regexp_extract(text, '{_IP}', 1) AS match
FROM t WHERE regexp_matches(text, '{_IP}')
UNION ALL
SELECT source, doc_id, 'email' AS rule, m AS match
FROM (SELECT source, doc_id, unnest(regexp_extract_all(text, '{_MAIL}', 1)) AS m FROM t) e
WHERE NOT lower(m) LIKE '%.invalid'
UNION ALL
SELECT source, doc_id, 'internal_marker' AS rule, regexp_extract(text, '{_MARK}', 0) AS match
FROM t WHERE regexp_matches(text, '{_MARK}')""")(q_leak_audit)

# ---- a whole run: landing files -> gate -> scan -> pipeline -> snapshot merge ---------------

CELL_REPORT_ROWS = CELLS_2G.replace(
    "SELECT o_orderkey AS _seq,",
    "SELECT CASE WHEN o_custkey % 2 = 0 THEN 'REGION_A' ELSE 'REGION_B' END || '/2G_Cell_List.csv' AS file,\n"
    "  o_orderkey AS line_no, o_orderkey AS _seq,", 1)
CELL_REPORT_COLS = ["bsc_name", "cell_index", "cell_name", "freq_band", "mcc", "mnc", "cell_lac",
                    "cell_ci", "ncc", "bcc", "routing_area", "bts_index", "bts_name",
                    "administrative_state", "active_status", "operator_name", "local_cell_id"]


def q_ingest_cells(spark, d):
    """R21 end to end: two regional 2G cell deliveries are gated, scanned, staged and merged.

    Report files for REGION_A and REGION_B are laid down from orders; both
    deliveries of 2024-01-02 run through ``plans.ingest.ingest``; the result is
    the current 2G cell snapshot (a later delivery wins a key shared by both).
    """
    from reportflow.plans.ingest import Warehouse, ingest
    base = scratch_path(spark, "run")
    rows = recipe(spark, d, CELL_REPORT_ROWS)
    lines = landing.report_lines(rows, "file", "line_no", CELL_REPORT_COLS, ",",
                                 ["2G cell export"], ",".join(CELL_REPORT_COLS))
    landing.write_files(spark, lines, f"{base}/landing")
    subjects = spark.createDataFrame(
        [("[Report][REGION_A][NETWORKS][2024-01-02]", f"{base}/landing/REGION_A", 1),
         ("[Report][REGION_B][NETWORKS][2024-01-02]", f"{base}/landing/REGION_B", 2)],
        "subject string, folder string, arrival long")
    ingest(spark, subjects, f"{base}/warehouse", ["REGION_A", "REGION_B"], NOW)
    return Warehouse(f"{base}/warehouse").table(spark, S.CELL_2G.table).read()


def _ingest_cells_oracle() -> str:
    p = "huawei_2g_cell_"
    return with_ctes({"c": CELLS_2G}, f"""
, r AS (SELECT *, CASE WHEN o_custkey % 2 = 0 THEN 'REGION_A' ELSE 'REGION_B' END AS oss,
               CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE 2 END AS arrival
        FROM c JOIN (SELECT o_orderkey, o_custkey FROM orders) o ON c._seq = o.o_orderkey)
, k AS (SELECT *, {sql_key('mcc', 'mnc', 'cell_lac', 'cell_ci')} AS cgi,
               bsc_name || '-' || ({sql_key('mcc', 'mnc', 'cell_lac', 'cell_ci')}) AS unique_id FROM r)
SELECT unique_id AS {p}unique_id, cell_index AS {p}index, cgi AS {p}cgi, cell_name AS {p}name,
       freq_band AS {p}freq, mcc AS {p}mcc, mnc AS {p}mnc, cell_lac AS {p}lac, cell_ci AS {p}ci,
       ncc AS {p}ncc, bcc AS {p}bcc, routing_area AS {p}rac, bts_index AS {p}bts_index,
       bts_name AS {p}bts_name, regexp_replace(bts_name, '\\P{{Nd}}', '', 'g') AS {p}name_numb,
       administrative_state AS {p}state, active_status AS {p}active, operator_name AS {p}operator,
       bsc_name AS {p}parent, local_cell_id AS {p}local_cell_id, oss AS {p}oss,
       '2024-01-02' AS {p}update_date
FROM k WHERE unique_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY arrival DESC, routing_area IS NULL DESC,
                                                           routing_area DESC, _seq DESC) = 1""")


query("q_ingest_cells", _ingest_cells_oracle())(q_ingest_cells)

# ---- R11: NodeB Info passes through to a raw export --------------------------------------------

NODEB_ROWS = """
SELECT CASE WHEN c_custkey % 2 = 0 THEN 'REGION_A' ELSE 'REGION_B' END || '/NodeB Info.csv' AS file,
       c_custkey AS line_no, c_name AS nodeb_name,
       CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 'V' || CAST(c_nationkey AS STRING) || ', R1' END AS nodeb_version,
       c_mktsegment AS nodeb_type
FROM {customer}
"""
NODEB_COLS = ["nodeb_name", "nodeb_version", "nodeb_type"]


def q_raw_export(spark, d):
    """R11+U5: NodeB Info deliveries of two regions are exported raw, per region and date."""
    from reportflow.plans.ingest import Warehouse, ingest
    base = scratch_path(spark, "run")
    rows = recipe(spark, d, NODEB_ROWS)
    landing.write_files(spark, landing.report_lines(rows, "file", "line_no", NODEB_COLS, ",", [],
                                                    ",".join(NODEB_COLS)), f"{base}/landing")
    subjects = spark.createDataFrame(
        [("[Report][REGION_A][NETWORKS][2024-01-02]", f"{base}/landing/REGION_A", 1),
         ("[Report][REGION_B][NETWORKS][2024-01-02]", f"{base}/landing/REGION_B", 2)],
        "subject string, folder string, arrival long")
    ingest(spark, subjects, f"{base}/warehouse", ["REGION_A", "REGION_B"], NOW)
    export = f"{Warehouse(f'{base}/warehouse').export_path('NETWORKS')}/nodeb_info"
    schema = ", ".join(f"{c} string" for c in [*NODEB_COLS, "report_oss", "report_date", "delivery_id"])
    return spark.read.schema(schema).option("header", True).csv(export).drop("delivery_id")


query("q_raw_export", with_ctes({"n": NODEB_ROWS}, """
SELECT nodeb_name, nodeb_version, nodeb_type, split_part(file, '/', 1) AS report_oss,
       '2024-01-02' AS report_date
FROM n"""))(q_raw_export)
