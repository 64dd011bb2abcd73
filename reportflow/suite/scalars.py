"""Scalar-rule queries (X1-X16, P5) over whole customer, orders and events tables."""

from __future__ import annotations


from reportflow.functions import commands as cmdf
from reportflow.functions import dates, keys, software, text
from reportflow.suite.base import (NOT_WORD, SPACE, WORD, query, recipe, sql_digits, sql_key,
                                   sql_strip_zeros, sql_sw_merge, sql_trim, with_ctes)

REGIONS = ["REGION_A", "REGION_B"]

# ---- site names (customer) -------------------------------------------------------

NAMES = """
SELECT c_custkey,
       CASE WHEN c_custkey % 17 = 0 THEN NULL
            WHEN c_custkey % 13 = 0 THEN c_name || ' ٣٤'
            ELSE c_name END AS site_name
FROM {customer}
"""


def q_digits(spark, d):
    """X1+X2: digits of a site name (Unicode digits too) and the site id without zeros."""
    r = recipe(spark, d, NAMES)
    return r.select("c_custkey", text.digits_only("site_name").alias("digits"),
                    text.site_number("site_name").alias("site_id"))


query("q_digits", with_ctes({"r": NAMES}, f"""
SELECT c_custkey, {sql_digits('site_name')} AS digits,
       {sql_strip_zeros(sql_digits('site_name'))} AS site_id FROM r"""))(q_digits)


def q_suffix_number(spark, d):
    """X3+X2: last five characters of a name, leading zeros removed."""
    r = recipe(spark, d, NAMES)
    return r.select("c_custkey", text.last_chars("site_name", 5).alias("suffix"),
                    text.site_number("site_name", 5).alias("number"))


query("q_suffix_number", with_ctes({"r": NAMES}, f"""
SELECT c_custkey, right(site_name, 5) AS suffix,
       {sql_strip_zeros('right(site_name, 5)')} AS number FROM r"""))(q_suffix_number)

# ---- software versions ---------------------------------------------------------------

VERSIONS = """
SELECT c_custkey,
  CASE c_custkey % 6 WHEN 0 THEN 'UNKNOWN'
    WHEN 1 THEN 'BTS3900 V100R0' || CAST(c_nationkey AS STRING) || 'C10SP' || CAST(c_custkey % 500 AS STRING)
    WHEN 2 THEN 'none' WHEN 3 THEN NULL
    WHEN 4 THEN 'Server v' || CAST(c_custkey AS STRING) || 'SP3' ELSE 'UNKNOWN' END AS hot_patch_version,
  CASE c_custkey % 5 WHEN 0 THEN 'V100R015SP' || CAST(c_custkey % 100 AS STRING)
    WHEN 1 THEN 'UNKNOWN'
    WHEN 2 THEN 'BTS5900 V200R0' || CAST(c_nationkey AS STRING) || 'SPC1'
    WHEN 3 THEN NULL ELSE 'release ' || c_mktsegment END AS software_version,
  CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'UNKNOWN'
    ELSE 'eRAN V' || CAST(c_custkey % 9 AS STRING) || 'SP' || CAST(c_custkey % 4 AS STRING) END AS product_version
FROM {customer}
"""


def q_software_merge(spark, d):
    """Version from the first known of (hotpatch, software, product), SP -> SPC."""
    r = recipe(spark, d, VERSIONS)
    return r.select("c_custkey", software.software_merge(
        "hot_patch_version", "software_version", "product_version").alias("sw"))


query("q_software_merge", with_ctes({"r": VERSIONS}, f"""
SELECT c_custkey, {sql_sw_merge('hot_patch_version', 'software_version', 'product_version')} AS sw
FROM r"""))(q_software_merge)

TAGGED = """
SELECT c_custkey,
  CASE c_custkey % 4 WHEN 0 THEN NULL
    WHEN 1 THEN 'BTS3900 V100R012C10SP' || CAST(c_custkey % 50 AS STRING)
    WHEN 2 THEN 'Micro BTS3202E V300SPC' || CAST(c_custkey % 7 AS STRING)
    ELSE 'BTS3900_5900 Pico V1' END AS sw1,
  CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'BTS5900 V500 SP2' ELSE 'BTS3000V9SPC1' END AS sw2,
  CASE c_custkey % 5 WHEN 0 THEN NULL ELSE 'BTS3902E V7SP' || CAST(c_nationkey AS STRING) END AS sw3
FROM {customer}
"""


def _sql_strip_tags(x: str) -> str:
    for tag in software.REMOVED_TAGS_BEFORE_SP:
        x = f"replace({x}, '{tag}', '')"
    x = f"regexp_replace({x}, 'SPC?', 'SPC', 'g')"
    for tag in software.REMOVED_TAGS_AFTER_SP:
        x = f"replace({x}, '{tag}', '')"
    return x


def q_software_tags(spark, d):
    """Tag-stripping merge over one and over three software columns."""
    r = recipe(spark, d, TAGGED)
    return r.select("c_custkey", software.software_tags(["sw1"]).alias("sw_one"),
                    software.software_tags(["sw1", "sw2", "sw3"]).alias("sw_all"))


query("q_software_tags", with_ctes({"r": TAGGED}, f"""
, s1 AS (SELECT c_custkey, sw2, sw3, {_sql_strip_tags('sw1')} AS o1 FROM r)
, s2 AS (SELECT c_custkey, sw3, o1, COALESCE({_sql_strip_tags('COALESCE(o1, sw2)')}, 'UNKNOWN') AS o2 FROM s1)
SELECT c_custkey, o1 AS sw_one,
       COALESCE({_sql_strip_tags('COALESCE(o2, sw3)')}, 'UNKNOWN') AS sw_all FROM s2
"""))(q_software_tags)

# ---- fills, sentinels, names -------------------------------------------------------------

CABINETS = """
SELECT c_custkey, c_name,
  CASE c_custkey % 3 WHEN 0 THEN 'UMTS' WHEN 1 THEN NULL ELSE 'BTS3900' END AS nodeb_type,
  CASE c_custkey % 4 WHEN 0 THEN NULL ELSE 'APM' || CAST(c_nationkey AS STRING) END AS cabinet_type,
  CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'SRAN_' || CAST(c_custkey AS STRING) END AS ne_name
FROM {customer}
"""


def q_fill_default(spark, d):
    """Nulls filled with UNKNOWN (software-like) or '' (SRAN-like)."""
    r = recipe(spark, d, CABINETS)
    return r.select("c_custkey", text.fill_default("cabinet_type").alias("cabinet"),
                    text.fill_default("ne_name", "").alias("sran"))


query("q_fill_default", with_ctes({"r": CABINETS}, """
SELECT c_custkey, COALESCE(cabinet_type, 'UNKNOWN') AS cabinet, COALESCE(ne_name, '') AS sran
FROM r"""))(q_fill_default)


def q_sentinel_coalesce(spark, d):
    """NodeB type unless null or UMTS, then cabinet type, then UNKNOWN."""
    r = recipe(spark, d, CABINETS)
    return r.select("c_custkey",
                    text.sentinel_coalesce("nodeb_type", "cabinet_type").alias("cabinet"))


query("q_sentinel_coalesce", with_ctes({"r": CABINETS}, """
SELECT c_custkey, COALESCE(NULLIF(nodeb_type, 'UMTS'), cabinet_type, 'UNKNOWN') AS cabinet
FROM r"""))(q_sentinel_coalesce)


def q_conditional_name(spark, d):
    """NE name is the site name when SRAN is '' and the SRAN otherwise."""
    r = recipe(spark, d, CABINETS)
    return r.select("c_custkey", text.choose_name("ne_name", "c_name").alias("ne"))


query("q_conditional_name", with_ctes({"r": CABINETS}, """
SELECT c_custkey, CASE WHEN ne_name = '' THEN c_name ELSE ne_name END AS ne FROM r"""
                                      ))(q_conditional_name)

REPORT_NAMES = """
SELECT o_orderkey,
  chr(160) || ' Rep.' || o_orderpriority || ' ' || lower(o_orderstatus) || chr(9) AS report_text,
  CASE WHEN o_custkey % 2 = 0 THEN 'region_a' ELSE 'Region_b' END AS region
FROM {orders}
"""


def q_canonical_name(spark, d):
    """Upper-cased report and region; generic table name (lower, strip, _, no dots)."""
    r = recipe(spark, d, REPORT_NAMES)
    return r.select("o_orderkey", text.canonical_upper("report_text").alias("report_upper"),
                    text.canonical_upper("region").alias("region_upper"),
                    text.table_name("report_text").alias("table_name"))


query("q_canonical_name", with_ctes({"r": REPORT_NAMES}, f"""
SELECT o_orderkey, upper(report_text) AS report_upper, upper(region) AS region_upper,
       replace(replace({sql_trim('lower(report_text)')}, ' ', '_'), '.', '') AS table_name
FROM r"""))(q_canonical_name)

# ---- keys ------------------------------------------------------------------------------

CELL_PARTS = """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE '268' END AS mcc,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS mnc,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS enodeb_id,
  CAST(o_orderkey % 256 AS STRING) AS cell_id
FROM {orders}
"""


def q_composite_key(spark, d):
    """P5: null-propagating composite keys (any null part -> null key)."""
    r = recipe(spark, d, CELL_PARTS)
    return r.select("o_orderkey",
                    keys.composite_key("mcc", "mnc", "enodeb_id", "cell_id").alias("cgi"),
                    keys.composite_key("mcc", "mnc").alias("plmn"))


query("q_composite_key", with_ctes({"r": CELL_PARTS}, f"""
SELECT o_orderkey, {sql_key('mcc', 'mnc', 'enodeb_id', 'cell_id')} AS cgi,
       {sql_key('mcc', 'mnc')} AS plmn FROM r"""))(q_composite_key)


def q_cell_identity(spark, d):
    """ECGI = mcc-mnc-(eNodeB id * 256 + cell id), BIGINT text, null in -> null out."""
    r = recipe(spark, d, CELL_PARTS)
    return r.select("o_orderkey", keys.composite_key(
        "mcc", "mnc", keys.cell_identity("enodeb_id", "cell_id")).alias("ecgi"))


query("q_cell_identity", with_ctes({"r": CELL_PARTS}, """
SELECT o_orderkey,
       mcc || '-' || mnc || '-' || CAST(CAST(enodeb_id AS BIGINT) * 256 + CAST(cell_id AS BIGINT) AS STRING) AS ecgi
FROM r"""))(q_cell_identity)

# ---- command logs (events) ------------------------------------------------------------------

# The command text of an event (shared by the command queries and the log files).
ORG_CMD = """
  CASE event_type
    WHEN 'view' THEN '/*' || CAST(event_id AS STRING) || '*/DSP CELL:ID=' || CAST(user_id AS STRING) || ';'
    WHEN 'click' THEN CASE WHEN event_id % 3 = 0 THEN 'lst brd:' || CAST(user_id AS STRING)
                           ELSE 'LST' || chr(160) || 'ALMAF:' || CAST(user_id AS STRING) END
    WHEN 'purchase' THEN '/* op ' || CAST(user_id AS STRING) || ' */MOD CELL:ID=' || CAST(event_id AS STRING)
    WHEN 'signup' THEN CASE event_id % 3 WHEN 0 THEN 'login' WHEN 1 THEN 'EMS user' || CAST(user_id AS STRING)
                                         ELSE 'LogIn' END
    ELSE CASE event_id % 6 WHEN 0 THEN 'a TaskNo.=' || CAST(event_id AS STRING)
                           WHEN 1 THEN 'run BulkCM job ' || CAST(user_id AS STRING)
                           WHEN 2 THEN '<get ' || props || '>[a]'
                           WHEN 3 THEN 'CmdCode=' || CAST(user_id AS STRING) || ', CmdName=x, CmdContent=' || props
                           WHEN 4 THEN NULL
                           ELSE 'reset' END
  END
"""

COMMANDS = f"""
SELECT event_id,
{ORG_CMD.strip()} AS org_cmd
FROM {{events}}
"""

_CMD = "regexp_replace(org_cmd, '/\\*[^\\n]*\\*/', '', 'g')"


def _sql_cmd_class(cmd: str) -> str:
    w = f"upper(regexp_extract({cmd}, '^({WORD}+){SPACE}', 1))"
    return (f"CASE WHEN {cmd} IS NULL THEN NULL WHEN contains({cmd}, 'BulkCM') THEN 'BulkCM' "
            f"WHEN contains({cmd}, 'TaskNo.=') THEN 'CmdTask' "
            f"WHEN {w} IN ('EMS', 'LOGIN') THEN 'LOGIN' WHEN {w} <> '' THEN {w} "
            f"WHEN regexp_matches({cmd}, '^{NOT_WORD}[a-zA-Z][^\\n]+{NOT_WORD}\\[') THEN 'FTP' "
            f"WHEN upper({cmd}) = 'LOGIN' THEN 'LOGIN' ELSE 'UNKNOWN' END")


_OPR = ("CASE WHEN org_cmd IS NULL THEN NULL "
        "WHEN regexp_extract(org_cmd, '/\\*(\\p{Nd}*)[^\\n]*\\*/', 1) = '' THEN 'OTHER' "
        "ELSE regexp_extract(org_cmd, '/\\*(\\p{Nd}*)[^\\n]*\\*/', 1) END")


def q_command_parse(spark, d):
    """Command text without operator comment, command class, operator code."""
    r = recipe(spark, d, COMMANDS).withColumn("cmd", cmdf.command_text("org_cmd"))
    return r.select("event_id", "org_cmd", "cmd", cmdf.command_class("cmd").alias("cmd_type"),
                    cmdf.operator_code("org_cmd").alias("opr_code"))


query("q_command_parse", with_ctes({"r": COMMANDS}, f"""
, c AS (SELECT event_id, org_cmd, {_CMD} AS cmd FROM r)
SELECT event_id, org_cmd, cmd, {_sql_cmd_class('cmd')} AS cmd_type, {_OPR} AS opr_code FROM c
"""))(q_command_parse)


def q_regex_antifilter(spark, d):
    """configuration echo lines dropped; null commands kept."""
    from reportflow.operators.gates import drop_matching
    return drop_matching(recipe(spark, d, COMMANDS), "org_cmd")


query("q_regex_antifilter", with_ctes({"r": COMMANDS}, """
SELECT * FROM r
WHERE NOT COALESCE(regexp_matches(org_cmd, '^CmdCode=[^\\n]*, CmdName=[^\\n]*, CmdContent=[^\\n]*'), false)
"""))(q_regex_antifilter)

PADDED = """
SELECT event_id,
  chr(160) || ' ' || event_type || chr(9) AS event_type,
  CASE WHEN event_id % 4 = 0 THEN '　' || props ELSE props || ' ' || chr(10) END AS props,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE '  ' || CAST(user_id AS STRING) || ' ' END AS user_text
FROM {events}
"""


def q_trim_all(spark, d):
    """Every text column stripped of Unicode whitespace at both ends."""
    r = recipe(spark, d, PADDED)
    return r.select("event_id", *[text.trim_unicode(c).alias(c)
                                  for c in ("event_type", "props", "user_text")])


query("q_trim_all", with_ctes({"r": PADDED}, f"""
SELECT event_id, {sql_trim('event_type')} AS event_type, {sql_trim('props')} AS props,
       {sql_trim('user_text')} AS user_text FROM r"""))(q_trim_all)

# ---- dates and subjects ----------------------------------------------------------------------

DATE_TEXTS = """
SELECT o_orderkey,
  CASE o_orderkey % 4
    WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
    WHEN 1 THEN lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '-' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '-' || CAST(year(o_orderdate) AS STRING)
    WHEN 2 THEN CAST(year(o_orderdate) AS STRING) || '-' || CAST(month(o_orderdate) AS STRING) || '-' || CAST(day(o_orderdate) AS STRING)
    ELSE CAST(day(o_orderdate) AS STRING) || '-' || CAST(month(o_orderdate) AS STRING) || '-' || CAST(year(o_orderdate) AS STRING)
  END AS date_text
FROM {orders}
"""


def q_two_format_date(spark, d):
    """X11: report dates in ISO or day-first form (one-digit parts allowed) as DATE."""
    r = recipe(spark, d, DATE_TEXTS)
    return r.select("o_orderkey", "date_text", dates.report_date("date_text").alias("report_date"))


query("q_two_format_date", with_ctes({"r": DATE_TEXTS}, """
SELECT o_orderkey, date_text,
       CAST(COALESCE(try_strptime(date_text, '%Y-%m-%d'), try_strptime(date_text, '%d-%m-%Y')) AS DATE)
         AS report_date
FROM r"""))(q_two_format_date)

SUBJECTS = """
SELECT o_orderkey,
  CASE o_orderkey % 7
    WHEN 0 THEN '[Report][REGION_A][' || fam || '][' || iso || ']'
    WHEN 1 THEN '[Report][' || fam || '][' || iso || ']'
    WHEN 2 THEN '[Report][REGION_Z][' || fam || '][' || iso || ']'
    WHEN 3 THEN '[Report]'
    WHEN 4 THEN '[Notice][REGION_B][' || fam || '][' || iso || ']'
    WHEN 5 THEN '[Report][REGION_B][' || fam || ']'
    ELSE '[][Report][][REGION_B][' || fam || '][' || iso || ']'
  END AS subject
FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS iso,
             CASE o_orderpriority WHEN '1-URGENT' THEN 'NETWORKS' WHEN '2-HIGH' THEN 'EXTERNALS'
               WHEN '3-MEDIUM' THEN 'PKI' WHEN '4-NOT SPECIFIED' THEN 'HCMD' ELSE 'Weekly Plan' END AS fam
      FROM {orders}) s
"""


def q_subject_parse(spark, d):
    """Subject -> (report id, region, report name, date text, status)."""
    r = recipe(spark, d, SUBJECTS).select("o_orderkey", "subject")
    return dates.with_subject(r, "subject", REGIONS)


query("q_subject_parse", with_ctes({"r": SUBJECTS}, """
, p AS (SELECT o_orderkey, subject,
               list_filter(regexp_split_to_array(subject, '[\\[\\]]'), lambda x: x <> '') AS parts FROM r)
, q AS (SELECT *, len(parts) AS n, parts[2] IN ('REGION_A', 'REGION_B') AS regional FROM p)
, s AS (SELECT *, CASE WHEN subject IS NULL THEN 'no_subject' WHEN n < 2 THEN 'too_few_parts'
                       WHEN parts[1] <> 'Report' THEN 'not_a_report'
                       WHEN n < CASE WHEN regional THEN 4 ELSE 3 END THEN 'too_few_parts'
                       ELSE 'ok' END AS status FROM q)
SELECT o_orderkey, subject, parts[1] AS report_id,
       CASE WHEN status = 'ok' THEN CASE WHEN regional THEN parts[2] ELSE '' END END AS oss,
       CASE WHEN status = 'ok' THEN CASE WHEN regional THEN parts[3] ELSE parts[2] END END AS report_name,
       CASE WHEN status = 'ok' THEN CASE WHEN regional THEN parts[4] ELSE parts[3] END END AS report_date_text,
       status
FROM s"""))(q_subject_parse)

