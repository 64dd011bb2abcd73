"""Batch ingestion of deliveries (R21 end to end).

A *delivery* is one report sent for one region and date: a folder of files
plus its subject.  ``ingest`` takes every delivery of a run at once:

1. subjects are parsed and gated against the ledger; the files (and ZIP members)
   of those that pass are scanned and validated: missing contract columns or side
   files, records longer than their header, cell ids that are no integers and
   archive members outside the archive make a delivery fail.  Each report file is
   parsed once: its rows go to a staging table, and the deliveries with rejected
   records are observed while it is written;
2. deliveries are gated against earlier valid deliveries of the same (report,
   region) in the run as well (a running maximum over arrival order), which gives
   the same accept/reject decisions as handling the deliveries one by one;
3. each report table of a family is built from all its accepted deliveries in
   one Spark job (the delivery id scopes side-file joins and de-dup);
4. snapshot tables are merged once per run.  Handling deliveries one by one
   leaves, for a table scoped by report date, the rows of the trailing run of
   deliveries that share the last delivery's date (plus the old rows of that
   date when no other date came in between); the batch merge keeps exactly
   those rows (``trailing_run``), later arrivals winning ties;
5. readable exports are written per (report, region, date, delivery) partition,
   the ledger gets one row per accepted delivery, failed ones included, and reports
   that reached the threshold are marked as sent.

The driver holds one row per delivery, per listed file and archive, and per
distinct header.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import logging
import uuid
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from reportflow.functions.dates import try_report_date, with_subject
from reportflow.functions.keys import invalid_identity
from reportflow.operators import gates, ledger
from reportflow.operators.upsert import merge_snapshot
from reportflow.plans import pipelines as P
from reportflow.plans import specs as S
from reportflow.sinks.export import write_export
from reportflow.sinks.ledger import LedgerTable
from reportflow.sinks.snapshot import KeyedTable, SnapshotTable, append_table
from reportflow.session import hadoop_fs
from reportflow.sources.archive import member_is_safe, stage_members
from reportflow.sources.reports import BAD, PATH, list_files, literal, marked_scan

LOG = logging.getLogger(__name__)

DELIVERY, OSS, DATE, ARRIVAL, PART = "__delivery", "__oss", "__date", "__arrival", "__part_id"
BY = (DELIVERY,)
# Export partition columns.  The delivery (its subject and folder) is one of them, so a delivery
# adds its rows whatever else came before, and handling the same one again replaces them.
PARTS = {OSS: "report_oss", DATE: "report_date", PART: "delivery_id"}


@dataclass
class Warehouse:
    """Folder layout of a run's outputs (all below one shared root)."""
    root: str

    def table(self, spark: SparkSession, name: str) -> SnapshotTable:
        return SnapshotTable(spark, f"{self.root}/tables/{name}")

    def keyed(self, spark: SparkSession, name: str, key: str) -> KeyedTable:
        return KeyedTable(spark, f"{self.root}/tables/{name}", key)

    def append_path(self, name: str) -> str:
        return f"{self.root}/append/{name}"

    def export_path(self, family: str) -> str:
        return f"{self.root}/exports/{family}"

    def ledger(self, spark: SparkSession) -> LedgerTable:
        return LedgerTable(spark, f"{self.root}/ledger")


# ---- 1. gate ------------------------------------------------------------------------------

def gate_deliveries(subjects: DataFrame, ledger_df: DataFrame | None, regions: list[str],
                    failed: list[str] = (), in_run: bool = True) -> DataFrame:
    """Parsed and gated deliveries (``subject``, ``folder``, ``arrival`` in).

    ``failed`` names deliveries (subject|folder|arrival) that raise nobody's
    watermark; ``in_run=False`` gates against the ledger alone.
    """
    parsed = with_subject(subjects, "subject", regions)
    parsed = parsed.withColumn("report_date", try_report_date("report_date_text"))
    parsed = parsed.withColumn("status", F.when(
        (F.col("status") == "ok") & F.col("report_date").isNull(), F.lit("bad_date"))
        .otherwise(F.col("status")))
    name = F.upper("report_name")
    parsed = parsed.withColumns({
        "family": F.when(name.isin(*S.FAMILIES), name).otherwise(F.lit("GENERIC")),
        "report_name": name, "oss": F.upper("oss")})
    if ledger_df is None:
        ledger_df = parsed.sparkSession.createDataFrame([], ledger.LEDGER_SCHEMA)
    # No filter on the parse status: a pushed-down filter would inline (and so
    # repeat) the subject split.  Rows that are not 'ok' take part with a null
    # date, so they neither pass the gate nor raise anybody's watermark.
    ok = F.col("status") == "ok"
    parsed = parsed.withColumn("__gate_date", F.when(ok, F.col("report_date")))
    gated = gates.watermark_gate(parsed, ledger.last_success(ledger_df))
    gated = gated.withColumn("last_date", F.when(ok, F.col("last_date")))
    # earlier deliveries of the run raise the watermark for later ones
    # bucket width from the input's arrival column (a plain scan, not the gate pipeline)
    if not in_run:
        gated = gated.withColumn("__prior", F.lit(None).cast("date"))
    else:
        if failed:
            spark = parsed.sparkSession
            out = spark.createDataFrame([(x, True) for x in failed], "__failed string, __out boolean")
            name = F.concat_ws("|", "subject", "folder", F.col("arrival").cast("string"))
            gated = gated.join(out, name == F.col("__failed"), "left").withColumn(
                "__gate_date", F.when(F.col("__out").isNull(), F.col("__gate_date"))).drop("__failed", "__out")
        gated = prior_max(gated, ["report_name", "oss"], "arrival", "__gate_date", "__prior",
                          bucket=bucket_width(subjects, "arrival"))
    mark = F.greatest(F.col("last_date"), F.col("__prior"))
    inclusive = F.col("report_name").isin(*gates.INCLUSIVE_FAMILIES)
    accepted = ok & (mark.isNull() | F.when(inclusive, F.col("report_date") >= mark)
                     .otherwise(F.col("report_date") > mark))
    return (gated.withColumn("accepted", F.coalesce(accepted, F.lit(False)))
            .drop("__prior", "__gate_date"))


def bucket_width(df: DataFrame, order: str, rows_per_bucket: int = 1 << 16) -> int:
    """Width of ``order`` buckets holding about ``rows_per_bucket`` rows on average."""
    lo, hi, n = df.agg(F.min(order), F.max(order), F.count(order)).first()
    span = 0 if lo is None else int(hi) - int(lo) + 1
    return max(1, -(-span * rows_per_bucket // max(n, 1)))


def prior_max(df: DataFrame, group: list[str], order: str, value: str, out: str,
              bucket: int | None = None, rows_per_bucket: int = 1 << 16) -> DataFrame:
    """``out`` = max of ``value`` over the rows of the same group with a smaller ``order``.

    A distributed prefix maximum: ``order`` is cut into buckets; a window runs
    inside each (group, bucket), so no task holds more than one bucket of a
    group however large the group is; the maxima of earlier buckets come from a
    window over the per-bucket maxima (one row per bucket), joined back.  The
    bucket width comes from one small aggregate (min, max, count of ``order``)
    so that buckets hold about ``rows_per_bucket`` rows on average, dense or
    sparse order values alike (pass ``bucket`` to fix the width).
    """
    if bucket is None:
        bucket = bucket_width(df, order, rows_per_bucket)
    b = F.floor(F.col(order) / F.lit(bucket)).alias("__bucket")
    df = df.withColumn("__bucket", b)
    inside = (Window.partitionBy(*group, "__bucket").orderBy(order)
              .rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("__in", F.max(value).over(inside))
    per_bucket = df.groupBy(*group, "__bucket").agg(F.max(value).alias("__bmax"))
    before = (Window.partitionBy(*group).orderBy("__bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    per_bucket = per_bucket.withColumn("__before", F.max("__bmax").over(before)).drop("__bmax")
    pb = per_bucket.select(*[F.col(g).alias(f"__pb_{g}") for g in group],
                           F.col("__bucket").alias("__pb_bucket"), "__before")
    on = [F.col(g).eqNullSafe(F.col(f"__pb_{g}")) for g in group] + [
        F.col("__bucket") == F.col("__pb_bucket")]
    res = df.join(pb, on, "left").drop(*[f"__pb_{g}" for g in group], "__pb_bucket")
    return (res.withColumn(out, F.greatest(F.col("__before"), F.col("__in")))
            .drop("__bucket", "__in", "__before"))


# ---- 2. scan the files of candidate deliveries and validate them ------------------------------

@dataclass
class Found:
    """A file of a delivery, or the members of one name in one of its ZIP archives."""
    path: str                 # file path; of a member, its archive's
    name: str
    delivery: str
    count: int = 1


@dataclass
class Scan:
    rows: DataFrame           # staged rows tagged with their delivery
    having: set               # deliveries that hold the file
    columns: dict             # columns of each delivery's files


@dataclass
class Landed:
    """What the deliveries of a run hold."""
    files: list[Found]
    members: DataFrame | None   # staged members of their archives
    unsafe: set                 # deliveries that cannot be taken


def _listing(spark: SparkSession, deliveries: list, staging: str) -> Landed:
    """Files and archive members of the deliveries (one listing per folder, one row per archive).

    An archive with a member that leaves its folder makes its delivery fail.
    """
    found, unsafe, archives, members = [], set(), {}, None
    for d in deliveries:
        try:
            paths = list_files(spark, d["folder"])
        except ValueError:
            LOG.exception("delivery %s holds files that cannot be read", d["delivery"])
            unsafe.add(d["delivery"])
            continue
        for path in paths:
            if path.lower().endswith(".zip"):
                archives[path] = d["delivery"]
            else:
                found.append(Found(path, path.rsplit("/", 1)[-1], d["delivery"]))
    if archives:
        members = stage_members(spark, [literal(p) for p in archives], f"{staging}/members-{uuid.uuid4().hex}")
        name = F.element_at(F.split("member", "/"), -1).alias("name")
        per_name = members.where("slice = 0").groupBy("archive", name).agg(
            F.count(F.lit(1)).alias("n"), F.min(member_is_safe(F.col("member"), "archive")).alias("safe"))
        per_archive = per_name.groupBy(_decoded("archive").alias("archive")).agg(
            F.min("safe").alias("safe"), F.collect_list(F.struct("name", "n")).alias("names"))
        by_uri = {_uri(p): p for p in archives}
        for r in per_archive.collect():
            path = by_uri[_uri(r["archive"])]
            found += [Found(path, x["name"], archives[path], x["n"]) for x in r["names"]]
            if not r["safe"]:
                unsafe.add(archives[path])
    return Landed(found, members, unsafe)


def _decoded(c: str):
    return F.url_decode(F.replace(F.col(c), F.lit("+"), F.lit("%2B")))


def _uri(path: str) -> str:
    """One spelling for ``file:/x`` and ``file:///x``."""
    return path.replace(":///", ":/", 1) if path.startswith("file:") else path


def _scan(spark: SparkSession, landed: Landed, file_name: str, preamble: int, failed: set, staging: str,
          required: tuple[str, ...] = (), integers: tuple[str, ...] = (), without: tuple[str, ...] = (),
          **kw) -> Scan | None:
    """One report file name across all deliveries of a run: a single scan, parsed once.

    Deliveries whose file has no header, lacks a required column, has a record
    longer than its header or a cell id that is no integer are added to ``failed``.
    """
    mine = [f for f in landed.files if (f.name not in without if file_name == "*" else f.name == file_name)]
    if file_name == "*":
        failed.update(f.delivery for f in mine if not f.name.lower().endswith(".csv"))
        mine = [f for f in mine if f.name.lower().endswith(".csv")]
    mine = [f for f in mine if f.delivery not in failed]
    if not mine:
        return None
    names = sorted({f.name for f in mine})
    rows, heads, layouts = marked_scan(spark, sorted({f.path for f in mine}), preamble, names=names,
                                       members=landed.members, **kw)
    meta = spark.createDataFrame(sorted({(_uri(f.path), f.delivery) for f in mine}),
                                 f"__mpath string, {DELIVERY} string")

    def tag(df: DataFrame) -> DataFrame:
        # a member's path is its archive's, then "!/" and its name
        own = F.regexp_replace(F.regexp_replace(_decoded(PATH), r"^file:///", "file:/"), r"(?i)(\.zip)!/.*$", "$1")
        tagged = df.join(F.broadcast(meta), own == F.col("__mpath"), "left").drop("__mpath")
        return tagged.withColumn(DELIVERY, F.coalesce(F.col(DELIVERY), F.raise_error(
            F.concat(F.lit("file not mapped to a delivery: "), F.col(PATH))).cast("string")))

    rows, heads = tag(rows), tag(heads)
    lacking = [k for k, columns in layouts.items() if not set(required) <= set(columns)]
    bad = F.lit(False)
    for sep, header in lacking:
        bad = bad | ((F.col("sep") == sep) & (F.col("header") == header))
    # one row per delivery; its distinct headers are few
    states = heads.groupBy(DELIVERY).agg(
        F.max(bad).alias("bad"), F.count_distinct(PATH).alias("files"),
        F.collect_set(F.struct("sep", "header")).alias("layouts"))
    wanted = Counter()
    for f in mine:
        wanted[f.delivery] += f.count
    found = states.collect()
    got = {r[DELIVERY]: (r["bad"], r["files"]) for r in found}
    columns = {r[DELIVERY]: {c for x in r["layouts"] for c in layouts[x["sep"], x["header"]]} for r in found}
    for d, n in wanted.items():
        bad_header, files_read = got.get(d, (False, 0))
        if bad_header or files_read < n:
            LOG.error("delivery %s: %s lacks its header or a contract column", d, file_name)
            failed.add(d)
    wrong = F.col(BAD)
    if integers and set(integers) <= set(rows.columns):
        wrong = wrong | invalid_identity(*integers)
    rejects = Observation()
    path = f"{staging}/{uuid.uuid4().hex}"
    # one file of rows per task; the set of rejected deliveries comes with the same pass
    rows.observe(rejects, F.collect_set(F.when(wrong, F.col(DELIVERY))).alias("deliveries")).drop(BAD) \
        .write.parquet(path)
    for d in rejects.get["deliveries"]:
        LOG.error("delivery %s: %s has a record longer than its header or a cell id that is no integer",
                  d, file_name)
        failed.add(d)
    return Scan(spark.read.schema(rows.drop(BAD).schema).parquet(path), set(wanted), columns)


# Columns that the pipelines read beside those of the contracts.
SIDE_COLUMNS = {
    "3G_RNC_List.csv": ("bsc_name", "node_id"),
    "CO-MPT 2G.csv": ("gbts_function_name", "ne_name", "product_version"),
    "CO-MPT 3G.csv": ("nodeb_function_name", "ne_name", "product_version", "cabinet_type"),
    "CO-MPT 4G.csv": ("enodeb_function_name", "ne_name", "product_version"),
    "CO-MPT 4G_Cell_List.csv": ("enodeb_function_name",),
    S.NODEB_INFO: ("nodeb_name", "nodeb_version", "nodeb_type"),
}
CELLS_4G, CO_MPT_CELLS = "4G_Cell_List.csv", "CO-MPT 4G_Cell_List.csv"
SIDE_FILES = {
    "2G_BSC_List.csv": ("3G_RNC_List.csv",), "2G_Site_List.csv": ("CO-MPT 2G.csv",),
    "3G_Site_List.csv": ("CO-MPT 3G.csv", S.NODEB_INFO), "4G_Site_List.csv": ("CO-MPT 4G.csv",),
    "4G_Cell_List.csv": ("CO-MPT 4G_Cell_List.csv",),
}
CELL_IDS = {"4G_Cell_List.csv": ("enodeb_id", "cell_id"), "5G_Cell_List.csv": ("gnodeb_id", "nr_cell_id")}


def scan_family(spark: SparkSession, family: str, deliveries: list,
                staging: str) -> tuple[dict[str, Scan], set]:
    """Scans per report file of a family, and the deliveries that fail validation."""
    landed = _listing(spark, deliveries, staging)
    files, failed = landed.files, landed.unsafe
    scans: dict[str, Scan] = {}
    tasks: list[Callable[[], None]] = []

    def scan(key: str, *args, **kw) -> None:
        def task() -> None:
            got = _scan(spark, landed, *args, failed=failed, staging=staging, **kw)
            if got is not None:
                scans[key] = got
        tasks.append(task)

    if family == "NETWORKS":
        have: dict[str, set] = {}
        for f in files:
            have.setdefault(f.delivery, set()).add(f.name)
        for d, names in have.items():
            for report, sides in SIDE_FILES.items():
                if report in names and not set(sides) <= names:
                    LOG.error("delivery %s: %s needs %s", d, report, sides)
                    failed.add(d)
        for name in dict.fromkeys([*S.NETWORK_FILES, *SIDE_COLUMNS]):
            spec = S.REGISTRY.get(name)
            required = SIDE_COLUMNS.get(name) or (tuple(P.contract_columns(spec)) if spec else ())
            if name == CELLS_4G:
                required = ()           # its contract is met together with the CO-MPT list's columns
            scan(name, name, 0 if name == S.NODEB_INFO else 1, required=required,
                 integers=CELL_IDS.get(name, ()))
        _run_all(tasks)
        tasks.clear()
        if CELLS_4G in scans:
            own, other = scans[CELLS_4G].columns, scans.get(CO_MPT_CELLS)
            for d, columns in own.items():
                both = columns | (other.columns.get(d, set()) if other else set())
                if not set(P.contract_columns(S.CELL_4G)) <= both:
                    LOG.error("delivery %s: %s lacks a contract column", d, CELLS_4G)
                    failed.add(d)
    elif family == "EXTERNALS":
        known = {s.file_name: s for s in S.REGISTRY.for_family("EXTERNALS")}
        for name, spec in known.items():
            _, id_parts, key_parts = S.EXTERNAL_KEYS[name]
            scan(name, name, 1, required=(*P.contract_columns(spec), *id_parts, *key_parts))
        scan("*", "*", 1, without=tuple(known))
    else:
        options = {"PKI": (0, {}), "HCMD": (2, {"footer": 1, "sep": ","})}.get(family, (0, {}))
        required = {"PKI": P.contract_columns(S.PKI), "HCMD": P.LOG_COLUMNS}.get(family, ())
        scan("*", "*", options[0], required=required, **options[1])
    _run_all(tasks)
    if family in ("PKI", "HCMD"):
        held = {f.delivery for f in files}
        failed.update(d["delivery"] for d in deliveries if d["delivery"] not in held)
    return scans, failed


def _deliveries_frame(spark: SparkSession, deliveries: list) -> DataFrame:
    """One row per delivery, to be joined where the rows lie: dealt by delivery, one task would get a whole one."""
    return F.broadcast(spark.createDataFrame(
        [(d["delivery"], d["oss"], d["report_date"].isoformat(), d["arrival"],
          hashlib.md5(f"{d['subject']}|{d['folder']}".encode()).hexdigest()) for d in deliveries],
        f"{DELIVERY} string, {OSS} string, {DATE} string, {ARRIVAL} long, {PART} string"))


def _rows_of(spark: SparkSession, scan: Scan, deliveries: list, stamp: bool = True) -> DataFrame:
    """Rows of the given deliveries, with their region, date, arrival and partition name."""
    meta = _deliveries_frame(spark, deliveries)
    if not stamp:
        return scan.rows.join(F.broadcast(meta.select(DELIVERY)), DELIVERY, "left_semi")
    return scan.rows.join(meta, DELIVERY)


# ---- 3. merge and export ---------------------------------------------------------------------

ROWS_PER_TASK = 400_000


def trailing_run(deliveries: list) -> tuple[list, bool]:
    """Deliveries whose rows survive in a date-scoped snapshot, and whether the old rows do.

    Taking deliveries one by one in arrival order, each merge keeps only rows of
    its own report date; so the result holds the trailing run of deliveries that
    share the last delivery's date, plus the existing rows of that date only if
    no delivery of another date came in between (the run covers them all).
    """
    ordered = sorted(deliveries, key=lambda d: d["arrival"])
    last = ordered[-1]["report_date"]
    tail = []
    for d in reversed(ordered):
        if d["report_date"] != last:
            break
        tail.append(d)
    return tail, len(tail) == len(ordered)


def _merge_and_export(spark: SparkSession, wh: Warehouse, family: str, staged: P.Staged,
                      deliveries: list) -> None:
    spec, rows = staged.spec, staged.rows
    tagged = rows.join(_deliveries_frame(spark, deliveries), on=DELIVERY, how="inner")
    # The staged delivery feeds both the merge and the export: write it once to a
    # staging table in the shared warehouse and read it back.  The reports are
    # parsed once, and the lineage is cut (a lost executor later re-reads Parquet,
    # not the report files).
    staging = f"{wh.root}/staging/{spec.table}/{uuid.uuid4().hex}"
    tagged.write.parquet(staging)
    tagged = spark.read.parquet(staging)
    dealt, n = tagged, tagged.count()
    if n > ROWS_PER_TASK:           # the merge sorts what a task reads, and packed files hold many rows
        dealt = tagged.repartition(-(-n // ROWS_PER_TASK), DELIVERY, P.ORDER)
    ordered = dealt.withColumn("__bseq", F.struct(ARRIVAL, P.ORDER))
    payload = [c for c in rows.columns if c not in (P.ORDER, DELIVERY)]
    key = spec.key if spec.table == S.PKI.table else f"{spec.table}_{spec.key}"
    sort_col = spec.sort_col if spec.table == S.PKI.table else f"{spec.table}_{spec.sort_col}"
    if spec.scope == "all":
        wh.keyed(spark, spec.table, key).merge(ordered.select(*payload, "__bseq"), [sort_col], seq="__bseq")
    else:
        tbl = wh.table(spark, spec.table)
        tail, keep_existing = trailing_run(deliveries)
        last = tail[0]["report_date"].isoformat()
        incoming = ordered.join(F.broadcast(_deliveries_frame(spark, tail).select(DELIVERY)), DELIVERY, "left_semi") \
            .select(*payload, "__bseq")
        existing = tbl.read() if keep_existing else None
        merged = merge_snapshot(existing, incoming, key, [sort_col], seq="__bseq",
                                scope="report_date", date_col=f"{spec.table}_update_date",
                                report_date=last)
        tbl.commit(merged, report_date=last)
    order = P.export_order(spec)
    tagged = tagged.withColumns({f"__by{i}": F.col(f"`{c}`") for i, c in enumerate(order)})
    order = [*[f"__by{i}" for i in range(len(order))], P.ORDER]
    out = P.export(tagged, spec, keep=(*PARTS, *order)).withColumnsRenamed(PARTS)
    write_export(out, f"{wh.export_path(family)}/{spec.table}", partition_by=list(PARTS.values()), order_by=order)
    fs, path = hadoop_fs(spark, staging)
    fs.delete(path, True)


# ---- family runners ----------------------------------------------------------------------------

TABLE_THREADS = 4


def _run_all(tasks: list) -> None:
    """Run independent table jobs concurrently (Spark schedules jobs from several threads).

    Every task runs to its end; the first failure is raised afterwards, so the
    family is logged as failed while the other tables still commit.
    """
    from concurrent.futures import ThreadPoolExecutor
    if not tasks:
        return
    with ThreadPoolExecutor(max_workers=min(TABLE_THREADS, len(tasks))) as pool:
        futures = [pool.submit(t) for t in tasks]
    errors = [f.exception() for f in futures if f.exception() is not None]
    if errors:
        raise errors[0]


def _run_networks(spark, wh, scans, deliveries, now):
    f = {name: _rows_of(spark, x, deliveries).drop(ARRIVAL, PART) for name, x in scans.items()}
    side = {name: df.drop(OSS, DATE) for name, df in f.items()}
    oss, date = F.col(OSS), F.col(DATE)
    builders: dict[str, Callable[[], P.Staged]] = {
        "2G_BSC_List.csv": lambda: P.parent(f["2G_BSC_List.csv"], f["3G_RNC_List.csv"], oss, date, BY),
        "2G_Site_List.csv": lambda: P.site_2g(f["2G_Site_List.csv"], side["CO-MPT 2G.csv"], oss, date, BY),
        "2G_Cell_List.csv": lambda: P.cell_2g(f["2G_Cell_List.csv"], oss, date, BY),
        "2G_Cell_TRX.csv": lambda: P.trx_2g(f["2G_Cell_TRX.csv"], oss, date, BY),
        "3G_Site_List.csv": lambda: P.site_3g(f["3G_Site_List.csv"], side["CO-MPT 3G.csv"],
                                              side[S.NODEB_INFO], oss, date, BY),
        "3G_Cell_List.csv": lambda: P.cell_3g(f["3G_Cell_List.csv"], oss, date, BY),
        "4G_Site_List.csv": lambda: P.site_4g(f["4G_Site_List.csv"], f["CO-MPT 4G.csv"], oss, date, BY),
        "4G_Cell_List.csv": lambda: P.cell_4g(f["4G_Cell_List.csv"], f["CO-MPT 4G_Cell_List.csv"],
                                              oss, date, BY),
        "5G_Site_List.csv": lambda: P.site_5g(f["5G_Site_List.csv"], oss, date, BY),
        "5G_Cell_List.csv": lambda: P.cell_5g(f["5G_Cell_List.csv"], oss, date, BY),
    }
    tasks = []
    for name, build in builders.items():
        present = [d for d in deliveries if name in scans and d["delivery"] in scans[name].having]
        if present:
            tasks.append(lambda build=build, present=present:
                         _merge_and_export(spark, wh, "NETWORKS", build(), present))
    _run_all(tasks)
    if S.NODEB_INFO in scans:         # exported raw (no table)
        raw = _rows_of(spark, scans[S.NODEB_INFO], deliveries).withColumnRenamed("_seq", "__seq").drop(
            "_file", "_path", DELIVERY, ARRIVAL)
        write_export(raw.withColumnsRenamed(PARTS), f"{wh.export_path('NETWORKS')}/nodeb_info",
                     partition_by=list(PARTS.values()), order_by=["__seq"])


def _run_externals(spark, wh, scans, deliveries, now):
    tasks = []
    for spec in S.REGISTRY.for_family("EXTERNALS"):
        if spec.file_name not in scans:
            continue
        x = scans[spec.file_name]
        present = [d for d in deliveries if d["delivery"] in x.having]
        if not present:
            continue
        staged = P.external(spec, _rows_of(spark, x, present).drop(ARRIVAL, PART), F.col(OSS), F.col(DATE), BY)
        tasks.append(lambda staged=staged, present=present:
                     _merge_and_export(spark, wh, "EXTERNALS", staged, present))
    # files of an EXTERNALS delivery that no spec knows are exported raw, not loaded
    if "*" in scans:
        out = _rows_of(spark, scans["*"], deliveries).withColumnsRenamed(
            {"_file": "source_file", "_seq": "__seq"}).drop("_path", DELIVERY, ARRIVAL)
        tasks.append(lambda: write_export(
            out.withColumnsRenamed(PARTS), f"{wh.export_path('EXTERNALS')}/unrecognised",
            partition_by=[*PARTS.values(), "source_file"], order_by=["__seq"]))
    _run_all(tasks)


def _run_pki(spark, wh, scans, deliveries, now):
    rows = _rows_of(spark, scans["*"], deliveries, stamp=False)
    _merge_and_export(spark, wh, "PKI", P.pki(rows, now, BY), deliveries)


def _run_logs(spark, wh, scans, deliveries, now):
    df = _rows_of(spark, scans["*"], deliveries).drop(DELIVERY, ARRIVAL)
    rows = P.command_log(df, now, keep=(*PARTS, "_file")).withColumnsRenamed({**PARTS, "_file": "source_file"})
    # handling a delivery again replaces its own partitions, other deliveries only add
    append_table(rows, wh.append_path(S.COMMAND_LOG.table),
                 partition_by=[*PARTS.values(), "source_file"], replace_partitions=True)


def _run_generic(spark, wh, scans, deliveries, now):
    if "*" not in scans:
        return
    by_name: dict[str, list] = {}
    for d in deliveries:
        by_name.setdefault(d["report_name"], []).append(d)
    for name, ds in by_name.items():
        mine = [d for d in ds if d["delivery"] in scans["*"].having]
        if not mine:
            continue
        df = _own_columns(spark, scans["*"], mine)
        rows = P.generic(df, F.col(OSS), now, meta=(DELIVERY, OSS, DATE, ARRIVAL, PART),
                         keep=(*PARTS, "_file")).withColumnsRenamed({**PARTS, "_file": "source_file"})
        append_table(rows, wh.append_path(P.generic_table_name(name)),
                     partition_by=[*PARTS.values(), "source_file"], replace_partitions=True)


def _own_columns(spark: SparkSession, scan: Scan, deliveries: list) -> DataFrame:
    """Rows of some deliveries without the columns that only other reports' files have."""
    rows = _rows_of(spark, scan, deliveries)
    wanted = {d["delivery"] for d in deliveries}
    names = {c for d, columns in scan.columns.items() if d in wanted for c in columns}
    fixed = {DELIVERY, OSS, DATE, ARRIVAL, PART, "_file", "_path", "_seq"}
    return rows.select(*[f"`{c}`" for c in rows.columns if c in names or c in fixed])


RUNNERS = {"NETWORKS": _run_networks, "EXTERNALS": _run_externals, "PKI": _run_pki,
           "HCMD": _run_logs, "GENERIC": _run_generic}


def _run_family(spark, wh, family: str, scans: dict[str, Scan], deliveries: list, now) -> set:
    """Run a family's deliveries; returns those that failed.

    All run as one set of jobs.  If that fails, each delivery runs alone in
    arrival order, so that one bad delivery fails alone.
    """
    if not deliveries:
        return set()
    try:
        RUNNERS[family](spark, wh, scans, deliveries, now)
        return set()
    except Exception:   # noqa: BLE001 - the ledger records the failure
        LOG.exception("report family %s failed for %d deliveries", family, len(deliveries))
    if len(deliveries) == 1:
        return {deliveries[0]["delivery"]}
    return {x for d in deliveries for x in _run_family(spark, wh, family, scans, [d], now)}


# ---- 4. ledger -------------------------------------------------------------------------------------

def ingest(spark: SparkSession, subjects: DataFrame, warehouse_root: str, regions: list[str],
           now: dt.datetime, today: dt.date | None = None, threshold: int = 2,
           batch: str | None = None) -> DataFrame:
    """Run every delivery of ``subjects`` (subject, folder, arrival); return the gate table.

    Deliveries that the ledger alone would accept are scanned and validated first.
    Those that fail validation do not raise the watermark for later deliveries of
    the run; if the gate then accepts them, they are logged as failed.  ``batch``
    names the ledger segment that this run commits.  WEEKPLAN deliveries are gated
    and logged but their hand-off copy is not part of this engine.
    """
    wh = Warehouse(warehouse_root.rstrip("/"))
    ledger_tbl = wh.ledger(spark)
    current = ledger_tbl.read()

    def named(df: DataFrame) -> DataFrame:
        return df.withColumn(DELIVERY, F.concat_ws("|", "subject", "folder", F.col("arrival").cast("string")))

    def rows_of(df: DataFrame) -> list[dict]:
        return [{**r.asDict(), "delivery": r[DELIVERY]}
                for r in df.where("accepted").orderBy("arrival", DELIVERY).collect()]

    by_family: dict[str, list] = {}
    for d in rows_of(named(gate_deliveries(subjects, current, regions, in_run=False))):
        by_family.setdefault(d["family"], []).append(d)
    scans, failed = {}, set()
    staging = f"{wh.root}/staging/scan-{uuid.uuid4().hex}"
    for family, ds in by_family.items():
        if family not in RUNNERS:
            continue
        try:
            scans[family], bad = scan_family(spark, family, ds, staging)
            failed |= bad
        except Exception:   # noqa: BLE001 - found out one by one, so that the others still run
            LOG.exception("scanning family %s failed; deliveries are tried one by one", family)
            scans[family] = {}
            good = []
            for d in ds:
                try:
                    failed |= scan_family(spark, family, [d], staging)[1]
                    good.append(d)
                except Exception:   # noqa: BLE001
                    LOG.exception("delivery %s cannot be scanned", d["delivery"])
                    failed.add(d["delivery"])
            good = [d for d in good if d["delivery"] not in failed]
            if good:
                scans[family] = scan_family(spark, family, good, staging)[0]
    gated = named(gate_deliveries(subjects, current, regions, failed=sorted(failed)))
    accepted = rows_of(gated)
    for family in {d["family"] for d in accepted} & set(RUNNERS):
        good = [d for d in accepted if d["family"] == family and d["delivery"] not in failed]
        failed |= _run_family(spark, wh, family, scans[family], good, now)
    outcomes = [(d["report_name"], d["oss"] or "", d["report_date"].isoformat(), d["delivery"] not in failed)
                for d in accepted]
    if outcomes:
        new_rows = ledger.ledger_rows(spark.createDataFrame(
            outcomes, "report_name string, oss string, report_date_text string, ok boolean"), now)
        loaded = tuple(sorted({d["report_name"] for d in accepted
                               if d["report_name"] in ledger.RELEASED_REPORTS}))
        ledger_tbl.append(new_rows, today, threshold, loaded, tag=batch)
    fs, path = hadoop_fs(spark, staging)
    fs.delete(path, True)
    return gated.drop(DELIVERY)
