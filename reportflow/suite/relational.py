"""Relational queries: slices, projection, null-safe joins, de-dup, upsert, appends."""

from __future__ import annotations


from reportflow.operators import dedup, gates, joins, project, setops
from reportflow.operators.upsert import merge_snapshot
from reportflow.plans import pipelines
from reportflow.plans import specs as S
from reportflow.sinks.snapshot import append_table
from reportflow.session import scratch_path
from reportflow.suite.base import (query, recipe, reported, sql_digits, sql_key, sql_sw_merge, table,
                                   with_ctes)

# ---- slices and projection (orders) -------------------------------------------------------


def q_date_slice(spark, d):
    """S9+F5: projection plus date-prefix predicate (a month), pushed to the scan."""
    return gates.date_slice(table(spark, d, "orders"), "o_orderdate", "1998-07",
                            ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])


query("q_date_slice", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders
WHERE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') LIKE '1998-07%'""")(q_date_slice)


def q_provenance(spark, d):
    """Provenance columns (region, report date, insert time) stamped on a delivery."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return project.stamp(o, {"oss": "REGION_A", "update_date": "2024-01-02",
                             "insert_time": "2024-01-02 06:00:00"})


query("q_provenance", """
SELECT o_orderkey, o_custkey, 'REGION_A' AS oss, '2024-01-02' AS update_date,
       '2024-01-02 06:00:00' AS insert_time FROM orders""")(q_provenance)


def q_project_reorder(spark, d):
    """Select and reorder to a fixed column list."""
    return project.select_fixed(table(spark, d, "orders"),
                                ["o_orderpriority", "o_orderkey", "o_orderstatus", "o_custkey"])


query("q_project_reorder", """
SELECT o_orderpriority, o_orderkey, o_orderstatus, o_custkey FROM orders""")(q_project_reorder)


def q_rename_prefix(spark, d):
    """P2+P3: rename by map (absent names ignored) then prefix with the table name."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                         "o_orderpriority")
    r = project.rename(o, {"o_orderkey": "key", "o_custkey": "parent", "o_missing": "x"})
    return project.prefix_columns(r, "huawei_parent")


query("q_rename_prefix", """
SELECT o_orderkey AS huawei_parent_key, o_custkey AS huawei_parent_parent,
       o_orderstatus AS huawei_parent_o_orderstatus, o_orderpriority AS huawei_parent_o_orderpriority
FROM orders""")(q_rename_prefix)

PRICED = """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice,
       o_orderdate, o_orderpriority FROM {orders}
"""


def q_all_text(spark, d):
    """Every column as text; nulls stay null."""
    return project.all_text(recipe(spark, d, PRICED))


query("q_all_text", with_ctes({"r": PRICED}, """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM r"""))(q_all_text)


def q_sorted_export(spark, d):
    """O1: rows sorted by (customer, order date, order) nulls last, relabelled for export."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey",
                                         "o_orderstatus")
    s = dedup.sort_rows(o, ["o_custkey", "o_orderdate", "o_orderkey"])
    return project.relabel(s, [("o_custkey", "Customer"), ("o_orderdate", "Order Date"),
                               ("o_orderkey", "Order"), ("o_orderstatus", "Status")])


query("q_sorted_export", """
SELECT o_custkey AS "Customer", o_orderdate AS "Order Date", o_orderkey AS "Order",
       o_orderstatus AS "Status" FROM orders ORDER BY 1, 2, 3""")(q_sorted_export)

NULLABLE = """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE 'BSC' || CAST(o_custkey % 50 AS STRING) END AS bsc_name,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS cell_index
FROM {orders}
"""


def q_drop_null_key(spark, d):
    """rows whose composite key is null are dropped."""
    from reportflow.functions.keys import composite_key
    r = recipe(spark, d, NULLABLE).withColumn("unique_id",
                                             composite_key("bsc_name", "cell_index"))
    return gates.drop_null_keys(r, ["unique_id"])


query("q_drop_null_key", with_ctes({"r": NULLABLE}, f"""
SELECT *, {sql_key('bsc_name', 'cell_index')} AS unique_id FROM r
WHERE {sql_key('bsc_name', 'cell_index')} IS NOT NULL"""))(q_drop_null_key)

# ---- joins --------------------------------------------------------------------------------

SITES_2G = """
SELECT c_custkey AS _seq,
  'BSC' || CAST(c_nationkey AS STRING) AS bsc_name,
  CAST(c_custkey AS STRING) AS bts_index,
  CASE WHEN c_custkey % 11 = 0 THEN NULL
       WHEN c_custkey % 5 = 0 THEN 'Customer#' || lpad(CAST(c_custkey - 1 AS STRING), 9, '0')
       ELSE c_name END AS bts_name,
  c_mktsegment AS bts_type,
  CASE WHEN c_custkey % 2 = 0 THEN 'GSM' ELSE 'GSM+UMTS' END AS service_type,
  CASE WHEN c_acctbal > 0 THEN 'Active' ELSE 'Inactive' END AS active_status,
  CASE c_custkey % 4 WHEN 0 THEN NULL
    WHEN 1 THEN 'BTS3900 V100R0' || CAST(c_nationkey AS STRING) || 'C10SP' || CAST(c_custkey % 300 AS STRING)
    WHEN 2 THEN 'UNKNOWN' ELSE 'none' END AS bts_software_version_1
FROM {customer}
"""

CO_MPT_2G = """
SELECT o_orderkey AS _seq,
  CASE WHEN o_orderstatus = 'F' THEN '' ELSE 'X' END || 'Customer#' || lpad(CAST(o_custkey AS STRING), 9, '0')
    AS gbts_function_name,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'SRAN-' || CAST(o_custkey AS STRING) END AS ne_name,
  'BTS3900 V100R0' || CAST(o_custkey % 10 AS STRING) || 'SP' || CAST(o_orderkey % 1000 AS STRING) AS product_version
FROM {orders}
"""


def q_site_reconcile(spark, d):
    """J1+P6+F1+O2 (2G sites): enrichment by differently named keys, first row per BTS."""
    staged = pipelines.site_2g(reported(recipe(spark, d, SITES_2G), S.SITE_2G), recipe(spark, d, CO_MPT_2G),
                               "REGION_A", "2024-01-02")
    return staged.rows.drop(pipelines.ORDER)


_T2 = "huawei_2g_site_"
query("q_site_reconcile", with_ctes({"s": SITES_2G, "c": CO_MPT_2G}, f"""
, m AS (SELECT s.*, c.gbts_function_name, c.ne_name, c.product_version, c._seq AS rseq
        FROM s LEFT JOIN c ON s.bts_name IS NOT DISTINCT FROM c.gbts_function_name
        WHERE s.bts_name IS NOT NULL)
, k AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY bts_name ORDER BY _seq, rseq NULLS LAST) = 1)
SELECT {sql_key('bsc_name', 'bts_index')} AS {_T2}unique_id, bts_index AS {_T2}bts_index,
       bts_name AS {_T2}bts_name, {sql_digits('bts_name')} AS {_T2}numb_name,
       bts_type AS {_T2}bts_type, service_type AS {_T2}serv_type, active_status AS {_T2}status,
       {sql_sw_merge('bts_software_version_1', 'product_version', "'UNKNOWN'")} AS {_T2}bts_software_version,
       bsc_name AS {_T2}parent, COALESCE(ne_name, '') AS {_T2}sran, 'REGION_A' AS {_T2}oss,
       '2024-01-02' AS {_T2}update_date
FROM k"""))(q_site_reconcile)

NODEB_LEFT = """
SELECT CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name END AS nodeb_name,
       'BSC' || CAST(c_nationkey AS STRING) AS bsc_name, CAST(c_custkey AS STRING) AS nodeb_id
FROM {customer}
"""
NODEB_INFO = """
SELECT CASE WHEN o_orderstatus = 'O' THEN '' ELSE 'X' END || 'Customer#' || lpad(CAST(o_custkey AS STRING), 9, '0')
         AS nodeb_name,
       'V' || CAST(o_orderkey % 50 AS STRING) AS nodeb_version, o_orderpriority AS nodeb_type,
       CAST(o_orderkey AS STRING) AS bsc_name
FROM {orders}
"""


def q_outer_shared_key(spark, d):
    """Full outer join on a shared key (null-safe), key coalesced, clashes suffixed.

    Null keys occur on one side only, so the output grows linearly with the
    input (null-to-null matching is covered by the unit tests).
    """
    return joins.outer_on_keys(recipe(spark, d, NODEB_LEFT), recipe(spark, d, NODEB_INFO),
                               ["nodeb_name"])


query("q_outer_shared_key", with_ctes({"l": NODEB_LEFT, "r": NODEB_INFO}, """
SELECT COALESCE(l.nodeb_name, r.nodeb_name) AS nodeb_name, l.bsc_name AS bsc_name_x,
       l.nodeb_id AS nodeb_id, r.nodeb_version AS nodeb_version, r.nodeb_type AS nodeb_type,
       r.bsc_name AS bsc_name_y
FROM l FULL JOIN r ON l.nodeb_name IS NOT DISTINCT FROM r.nodeb_name"""))(q_outer_shared_key)

CELLS_A = """
SELECT o_orderkey, CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
       o_orderstatus
FROM {orders} WHERE o_orderdate < CAST('1999-01-01' AS TIMESTAMP)
"""
CELLS_B = """
SELECT CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_orderkey,
       o_orderpriority
FROM {orders} WHERE o_orderdate >= CAST('1997-01-01' AS TIMESTAMP)
"""


def q_natural_outer(spark, d):
    """Null-safe natural full outer join on every common column, keys coalesced."""
    return joins.natural_outer(recipe(spark, d, CELLS_A), recipe(spark, d, CELLS_B))


query("q_natural_outer", with_ctes({"a": CELLS_A, "b": CELLS_B}, """
SELECT COALESCE(a.o_orderkey, b.o_orderkey) AS o_orderkey,
       COALESCE(a.o_custkey, b.o_custkey) AS o_custkey, a.o_orderstatus, b.o_orderpriority
FROM a FULL JOIN b ON a.o_orderkey IS NOT DISTINCT FROM b.o_orderkey
                  AND a.o_custkey IS NOT DISTINCT FROM b.o_custkey"""))(q_natural_outer)

SNAP_A = """
SELECT o_orderkey, o_custkey, o_orderstatus FROM {orders} WHERE o_orderdate < CAST('1999-01-01' AS TIMESTAMP)
"""
SNAP_B = """
SELECT o_orderkey, o_custkey, o_orderpriority FROM {orders} WHERE o_orderdate >= CAST('1997-01-01' AS TIMESTAMP)
"""
_DIFF_SELECT = """
SELECT COALESCE(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.o_custkey AS o_custkey_x,
       a.o_orderstatus, b.o_custkey AS o_custkey_y, b.o_orderpriority,
       CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN 'both'
            WHEN a.o_orderkey IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS _merge
FROM (SELECT *, true AS __in FROM a) a FULL JOIN (SELECT *, true AS __in FROM b) b
  ON a.o_orderkey IS NOT DISTINCT FROM b.o_orderkey
"""


def q_diff_join(spark, d):
    """Rows present in exactly one of two snapshots, with a _merge marker."""
    return joins.diff_join(recipe(spark, d, SNAP_A), recipe(spark, d, SNAP_B), ["o_orderkey"])


query("q_diff_join", with_ctes({"a": SNAP_A, "b": SNAP_B}, f"""
SELECT * FROM ({_DIFF_SELECT}) x WHERE _merge <> 'both'"""))(q_diff_join)


def q_diff_left_only(spark, d):
    """J4 (left_only): rows only in the first snapshot, planned as an anti join."""
    return joins.diff_join(recipe(spark, d, SNAP_A), recipe(spark, d, SNAP_B), ["o_orderkey"],
                           which="left_only")


query("q_diff_left_only", with_ctes({"a": SNAP_A, "b": SNAP_B}, f"""
SELECT * FROM ({_DIFF_SELECT}) x WHERE _merge = 'left_only'"""))(q_diff_left_only)

# ---- de-dup and upsert ------------------------------------------------------------------------

FIRST = """
SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate, o_orderstatus
FROM {orders}
"""


def q_keep_first(spark, d):
    """O2: first row per key by (order date nulls last, sequence); null key is one group."""
    return dedup.keep_first(recipe(spark, d, FIRST), ["o_custkey"], order_by=["o_orderdate"],
                            seq="o_orderkey")


query("q_keep_first", with_ctes({"r": FIRST}, """
SELECT * FROM r
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC NULLS LAST, o_orderkey) = 1
"""))(q_keep_first)

EXISTING = """
SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS cust,
       o_orderkey, o_orderstatus, o_orderpriority,
       CASE WHEN year(o_orderdate) % 2 = 0 THEN '2024-01-01' ELSE '2024-01-02' END AS update_date
FROM {orders} WHERE o_orderdate < CAST('1998-01-01' AS TIMESTAMP)
"""
INCOMING = """
SELECT CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS cust,
       o_orderkey, o_orderstatus, o_orderpriority, '2024-01-02' AS update_date,
       o_orderkey AS file_seq
FROM {orders} WHERE o_orderdate >= CAST('1997-01-01' AS TIMESTAMP)
"""


def _upsert_oracle(scope_filter: str) -> str:
    return with_ctes({"e": EXISTING, "i": INCOMING}, f"""
, u AS (SELECT cust, o_orderkey, o_orderstatus, o_orderpriority, update_date, 0 AS b,
               CAST(NULL AS BIGINT) AS s FROM e {scope_filter}
        UNION ALL
        SELECT cust, o_orderkey, o_orderstatus, o_orderpriority, update_date, 1 AS b, file_seq AS s
        FROM i)
SELECT cust, o_orderkey, o_orderstatus, o_orderpriority, update_date FROM u
WHERE cust IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY cust ORDER BY update_date DESC, b DESC, s DESC,
                                                      o_orderkey DESC) = 1""")


def q_snapshot_upsert(spark, d):
    """Merge a delivery into the rows of its report date; incoming wins, keys unique."""
    return merge_snapshot(recipe(spark, d, EXISTING), recipe(spark, d, INCOMING), key="cust",
                          sort_cols=["update_date"], seq="file_seq", scope="report_date",
                          date_col="update_date", report_date="2024-01-02")


query("q_snapshot_upsert", _upsert_oracle("WHERE update_date LIKE '2024-01-02%'"))(
    q_snapshot_upsert)


def q_snapshot_upsert_all_dates(spark, d):
    """U1 (scope all): merge over every date, the later update date wins first."""
    return merge_snapshot(recipe(spark, d, EXISTING), recipe(spark, d, INCOMING), key="cust",
                          sort_cols=["update_date"], seq="file_seq", scope="all")


query("q_snapshot_upsert_all_dates", _upsert_oracle(""))(q_snapshot_upsert_all_dates)

# ---- appends --------------------------------------------------------------------------------

SUPPLIERS = """
SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nation,
       CAST(s_acctbal AS DECIMAL(15,2)) AS acctbal FROM {supplier}
"""
CUSTOMERS = """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment
FROM {customer}
"""


def q_union_missing(spark, d):
    """V1: append with differing columns, missing ones null."""
    return setops.append(recipe(spark, d, SUPPLIERS), recipe(spark, d, CUSTOMERS))


query("q_union_missing", with_ctes({"s": SUPPLIERS, "c": CUSTOMERS}, """
SELECT * FROM s UNION ALL BY NAME SELECT * FROM c"""))(q_union_missing)


def q_union_same(spark, d):
    """V2: append with the same columns."""
    cols = ["key", "name", "nation"]
    return setops.append(recipe(spark, d, SUPPLIERS).select(*cols),
                         recipe(spark, d, CUSTOMERS).select(*cols), allow_missing=False)


query("q_union_same", with_ctes({"s": SUPPLIERS, "c": CUSTOMERS}, """
SELECT key, name, nation FROM s UNION ALL SELECT key, name, nation FROM c"""))(q_union_same)


def q_append_create(spark, d):
    """First delivery creates the table, the next one appends; read back whole."""
    root = scratch_path(spark, "append_create")
    append_table(recipe(spark, d, SUPPLIERS).select("key", "name", "nation"), root)
    append_table(recipe(spark, d, CUSTOMERS).select("key", "name", "nation"), root)
    return spark.read.parquet(root)


query("q_append_create", with_ctes({"s": SUPPLIERS, "c": CUSTOMERS}, """
SELECT key, name, nation FROM s UNION ALL SELECT key, name, nation FROM c"""))(q_append_create)

