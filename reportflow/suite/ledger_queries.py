"""Ledger and gate queries (A1, A2, F3, F4, U3, U4) over a ledger derived from orders."""

from __future__ import annotations

import datetime as dt

from reportflow.operators import gates, ledger
from reportflow.suite.base import query, recipe, with_ctes

TODAY = dt.date(2000, 6, 1)
NOW = dt.datetime(2024, 1, 2, 6, 0, 0)

LEDGER = """
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'NETWORKS' WHEN '2-HIGH' THEN 'externals'
         WHEN '3-MEDIUM' THEN 'PKI' WHEN '4-NOT SPECIFIED' THEN 'HCMD' ELSE 'WeekPlan' END AS report_name,
       CASE WHEN o_custkey % 2 = 0 THEN 'REGION_A' ELSE 'region_b' END AS report_oss,
       CAST(o_orderdate AS DATE) AS report_date,
       CASE WHEN o_orderstatus = 'F' THEN '200' ELSE '500' END AS error_code,
       CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' ELSE 'INTERNAL ERROR' END AS error_type,
       CASE WHEN o_orderstatus = 'F' THEN '' ELSE 'Code Bug' END AS description,
       o_orderdate AS ingest_date,
       CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS email_sent
FROM {orders}
"""

DELIVERIES = """
SELECT CASE l_linenumber % 5 WHEN 0 THEN 'networks' WHEN 1 THEN 'EXTERNALS' WHEN 2 THEN 'PKI'
         WHEN 3 THEN 'hcmd' ELSE 'WEEKPLAN' END AS report_name,
       CASE WHEN l_suppkey % 2 = 0 THEN 'REGION_A' ELSE 'REGION_B' END AS oss,
       CAST(l_shipdate AS DATE) AS report_date, l_orderkey, l_linenumber
FROM {lineitem}
"""

_A1 = """SELECT upper(report_name) AS report_name, upper(report_oss) AS report_oss,
       max(report_date) AS last_date FROM l WHERE error_code = '200' GROUP BY 1, 2"""


def q_last_success(spark, d):
    """A1: latest successful report date per (report, region), case-insensitive names."""
    return ledger.last_success(recipe(spark, d, LEDGER))


query("q_last_success", with_ctes({"l": LEDGER}, _A1))(q_last_success)


def q_watermark_gate(spark, d):
    """every delivery against the last success of its (report, region) and family rule."""
    return gates.watermark_gate(recipe(spark, d, DELIVERIES),
                                ledger.last_success(recipe(spark, d, LEDGER)))


query("q_watermark_gate", with_ctes({"l": LEDGER, "d": DELIVERIES}, f"""
, a AS ({_A1})
SELECT d.report_name, d.oss, d.report_date, d.l_orderkey, d.l_linenumber, a.last_date,
       COALESCE(a.last_date IS NULL OR CASE WHEN upper(d.report_name) IN ('WEEKPLAN', 'EXTERNALS', 'HCMD')
                THEN d.report_date >= a.last_date ELSE d.report_date > a.last_date END, false) AS accepted
FROM d LEFT JOIN a ON upper(d.report_name) = a.report_name AND upper(d.oss) = a.report_oss
"""))(q_watermark_gate)

_PENDING = f"report_date >= DATE '{TODAY.isoformat()}' AND error_code = '200' AND email_sent = 0"


def q_batch_ready(spark, d):
    """A2: unsent successes dated today or later per report; ready at two."""
    return ledger.batch_ready(recipe(spark, d, LEDGER), TODAY, 2)


query("q_batch_ready", with_ctes({"l": LEDGER}, f"""
SELECT report_name, count(*) AS pending, count(*) >= 2 AS ready
FROM l WHERE {_PENDING} GROUP BY report_name"""))(q_batch_ready)

OUTCOMES = """
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'networks' WHEN '2-HIGH' THEN 'Externals'
         ELSE 'pki' END AS report_name,
       CASE WHEN o_custkey % 3 = 0 THEN '' WHEN o_custkey % 3 = 1 THEN 'region_a' ELSE 'REGION_B' END AS oss,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
            ELSE CAST(day(o_orderdate) AS STRING) || '-' || CAST(month(o_orderdate) AS STRING) || '-' || CAST(year(o_orderdate) AS STRING)
       END AS report_date_text,
       o_orderstatus <> 'P' AS ok
FROM {orders}
"""


def q_ledger_append(spark, d):
    """One ledger row per delivery outcome, appended to the existing ledger."""
    new_rows = ledger.ledger_rows(recipe(spark, d, OUTCOMES), NOW)
    return recipe(spark, d, LEDGER).unionByName(new_rows)


query("q_ledger_append", with_ctes({"l": LEDGER, "o": OUTCOMES}, f"""
SELECT * FROM l
UNION ALL
SELECT upper(report_name), upper(COALESCE(oss, '')),
       CAST(COALESCE(try_strptime(report_date_text, '%Y-%m-%d'), try_strptime(report_date_text, '%d-%m-%Y')) AS DATE),
       CASE WHEN ok THEN '200' ELSE '500' END, CASE WHEN ok THEN 'SUCCESS' ELSE 'INTERNAL ERROR' END,
       CASE WHEN ok THEN '' ELSE 'Code Bug' END, TIMESTAMP '{NOW.isoformat(sep=" ")}', 0
FROM o"""))(q_ledger_append)


def q_mark_sent(spark, d):
    """U4: pending rows of released reports that reached the threshold are marked sent."""
    return ledger.mark_sent(recipe(spark, d, LEDGER), TODAY, 2, reports=ledger.RELEASED_REPORTS)


_RELEASED = ", ".join(f"'{r}'" for r in ledger.RELEASED_REPORTS)
query("q_mark_sent", with_ctes({"l": LEDGER}, f"""
, r AS (SELECT report_name FROM l WHERE {_PENDING} AND report_name IN ({_RELEASED})
        GROUP BY report_name HAVING count(*) >= 2)
SELECT l.report_name, report_oss, report_date, error_code, error_type, description, ingest_date,
       CAST(CASE WHEN {_PENDING} AND r.report_name IS NOT NULL THEN 1 ELSE email_sent END AS INTEGER)
         AS email_sent
FROM l LEFT JOIN r ON l.report_name = r.report_name"""))(q_mark_sent)

DELIVERED_ROWS = """
SELECT o_custkey AS delivery, o_orderkey,
       CASE WHEN o_custkey % 4 = 0 OR o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       o_orderstatus
FROM {orders}
"""


def q_complete_gate(spark, d):
    """a delivery loads all its rows iff at least one row has no null."""
    r = recipe(spark, d, DELIVERED_ROWS)
    return gates.complete_row_gate(r, ["delivery"])


query("q_complete_gate", with_ctes({"r": DELIVERED_ROWS}, """
SELECT * FROM r WHERE delivery IN (
  SELECT delivery FROM r GROUP BY delivery
  HAVING bool_or(o_orderkey IS NOT NULL AND o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL))
"""))(q_complete_gate)
