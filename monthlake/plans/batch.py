"""The monthly job: raw months in, curated and quarantined partitions and a report out.

Commit protocol per month: the old report goes first; judged rows are written once to the shared
folder; both outputs are cut from that copy without a second classification; what their writers
counted is reconciled with the source and the report; the report comes last. A loader that insists on the report never sees a torn month.
"""

from __future__ import annotations

from datetime import date

import pyspark
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.functions.contract import TRIPS, ContractViolation, check_schema, select_declared
from monthlake.functions.months import Month, layout_columns, month_path
from monthlake.operators.classify import classify
from monthlake.operators.dq import month_reports
from monthlake.operators.skew import DEFAULT_POLICY, HotPolicy
from monthlake.plans.joins import dimension
from monthlake.session import require_utc, shared_folder
from monthlake.sources import fs, lake, raw

CLUSTER = {"curated": ("pu_location_id", "do_location_id"), "quarantine": ("reject_reason",)}


#: What a month's own files can cause. Anything else is a fault of the cluster, and ends a backfill.
BAD_MONTH = (ContractViolation, FileNotFoundError, raw.UnreadableFiles, lake.LoadMismatch)


class ReconciliationError(RuntimeError):
    """Written rows do not account for every source row exactly once."""


def read_zone(spark: SparkSession, root: str, zone: str, schema: list[tuple[str, str]]) -> DataFrame:
    """One zone with the declared types plus its year/month directories, as text.

    Declaring the schema keeps a table with no partitions readable (as empty).
    """
    path = f"{root}/{zone}"
    ddl = ", ".join(f"{n} {t}" for n, t in [*schema, ("year", "string"), ("month", "string")])
    if not fs.exists(spark, path):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(path)


def curated(spark: SparkSession, root: str) -> DataFrame:
    return read_zone(spark, root, "curated", TRIPS.curated_schema())


def quarantine(spark: SparkSession, root: str) -> DataFrame:
    return read_zone(spark, root, "quarantine", TRIPS.quarantine_schema())


REPORT_SCHEMA = [
    ("month_start", "date"),
    ("source_rows", "bigint"),
    ("curated_rows", "bigint"),
    ("quarantined_rows", "bigint"),
    ("quarantine_rate", "double"),
    ("reject_reason_counts", "map<string,bigint>"),
    ("rule_hit_counts", "map<string,bigint>"),
    ("soft_flag_counts", "map<string,bigint>"),
    ("passenger_count_null_rows", "bigint"),
    ("processed_at", "timestamp"),
    ("source_file", "string"),
    ("spark_version", "string"),
]


def reports(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/reports"
    ddl = ", ".join(f"{n} {t}" for n, t in REPORT_SCHEMA)
    if not fs.exists(spark, path):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).json(path)


def committed(zone: DataFrame, reported: DataFrame, rows: str = "curated_rows") -> DataFrame:
    """Rows of months whose report tells of some in this zone; a crashed run's months stay invisible.

    `rows` is the report's count for the zone. Joined on the directory columns: the months found
    prune the directories at run time, and files of other months are not opened.
    """
    months = dimension(reported.filter(F.col(rows) > 0).select(*_directory(F.col("month_start"))))
    return zone.join(months, ["year", "month"], "left_semi").select(*zone.columns)


def _directory(month: Column) -> list[Column]:
    return [c.alias(n) for n, c in layout_columns(month).items()]


def _with_layout(df: DataFrame) -> DataFrame:
    return df.withColumns(layout_columns(F.col("source_month")))


def in_directories(months: list[Month]):
    """Rows of these months by directory, so the files of other months are not opened."""
    names = [f"{m.first:%Y-%m}" for m in months]
    return F.concat(F.col("year"), F.lit("-"), F.col("month")).isin(names)


def _counts(df: DataFrame) -> dict[date, int]:
    """Rows per month; as many driver rows as months."""
    rows = df.groupBy("source_month").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r.source_month: r.n for r in rows}


def _month_counts(firsts: list[date]) -> Column:
    """Rows per month as one aggregate, whatever the number of months: an expression for each would be evaluated for every row.

    The sketch keeps a counter for every item while there are no more than it may track, so its counts are exact here.
    """
    return F.call_function("approx_top_k", F.col("source_month"), F.lit(len(firsts)), F.lit(max(1000, 2 * len(firsts))))


def run_months(
    spark: SparkSession,
    typed: DataFrame,
    root: str,
    months: list[Month],
    *,
    policy: HotPolicy | None = DEFAULT_POLICY,
    sources: dict[date, str] | None = None,
    read_back: bool = False,
) -> DataFrame:
    """Process `months` of `typed` (contract columns, source_month, processed_at) in one job.

    Returns the reports of these months. Running it again replaces the same partitions. `sources`
    names the files each month was read from, for its report. Both outputs are reconciled by what their writers
    counted; with `read_back`, by reading them again.
    """
    require_utc(spark)
    for month in months:
        fs.delete(spark, month_path(root, "reports", month))
    firsts = [m.first for m in months]
    rows = typed.filter(F.col("source_month").isin(firsts))
    source = _counts(rows)

    staged_at = shared_folder(spark, "judged")
    classify(rows, policy=policy).write.mode("overwrite").parquet(staged_at)
    judged = spark.read.parquet(staged_at)
    kept = F.col("reject_reason").isNull()
    outputs = {
        "curated": (judged.filter(kept), TRIPS.curated_schema()),
        "quarantine": (judged.filter(~kept), TRIPS.quarantine_schema()),
    }
    named = [x for k, v in sorted((sources or {}).items()) for x in (F.lit(k), F.lit(v))]
    files = F.create_map(*named) if named else F.lit(None).cast("map<date,string>")
    fresh = month_reports(judged).withColumns(
        {
            "source_file": F.element_at(files, F.col("month_start")),
            "spark_version": F.lit(pyspark.__version__),
        }
    )
    said = {r.month_start: r for r in fresh.collect()}  # one row per month
    written = {}
    for zone, (part, schema) in outputs.items():
        declared = select_declared(part, schema)
        check_schema(declared.schema, schema, zone)
        seen = lake.swap_partitions(
            _with_layout(declared), f"{root}/{zone}", ["year", "month"], sort=CLUSTER[zone], observed={"n": _month_counts(firsts)}
        )
        written[zone] = {r["item"]: r["count"] for r in seen["n"]}
    for zone, column in (("curated", "curated_rows"), ("quarantine", "quarantined_rows")):
        for month in months:
            if month.first not in said or said[month.first][column] == 0:
                lake.clear_partition(
                    spark, f"{root}/{zone}", year=f"{month.first:%Y}", month=f"{month.first:%m}"
                )
        if read_back:
            zone_rows = curated(spark, root) if zone == "curated" else quarantine(spark, root)
            written[zone] = _counts(zone_rows.filter(in_directories(months)))
    _reconcile(months, source, said, written)
    spark.createDataFrame(list(said.values()), fresh.schema).withColumns(
        layout_columns(F.col("month_start"))
    ).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "year", "month"
    ).json(f"{root}/reports")
    fs.delete(spark, staged_at)
    return reports(spark, root).filter(F.col("month_start").isin(firsts))


def run_folder(
    spark: SparkSession,
    folder: str,
    root: str,
    months: list[Month],
    *,
    processed_at,
    policy: HotPolicy | None = DEFAULT_POLICY,
) -> DataFrame:
    """Read the files of `months` below `folder` and process them.

    The old reports go before a file is opened: a month whose file breaks the contract is left
    without a report, and cannot be loaded.
    """
    for month in months:
        fs.delete(spark, month_path(root, "reports", month))
    wanted = [f"{m.first:%Y-%m}" for m in months]
    files = raw.list_files(spark, folder).withColumn("period", raw.file_period(F.col("path")))
    files = files.filter(F.col("period").isin(wanted))
    names = files.groupBy("period").agg(F.sort_array(F.collect_list(F.regexp_extract("path", r"([^/]+)$", 1))).alias("f"))
    sources = {Month.of(r.period).first: ",".join(r.f) for r in names.collect()}  # one row per month
    absent = [str(m) for m in months if m.first not in sources]
    if absent:
        raise FileNotFoundError(f"no source file for {absent}")
    typed = raw.read_months(spark, folder, processed_at=processed_at, files=files)
    return run_months(spark, typed, root, months, policy=policy, sources=sources)


def backfill(
    spark: SparkSession, folder: str, root: str, warehouse: str, months: list[Month], *, processed_at
) -> DataFrame:
    """Process and load the months that are not done; a bad month is recorded and the rest go on.

    Returns month_start, status (skipped, loaded or failed) and error. All open months are tried in
    one job; only when that fails by the files' fault is each tried alone, so one bad file costs no other month.
    """
    status: dict[date, tuple[str, str | None]] = {}
    said = reports(spark, root)
    tables = {
        name: lake.read_table(spark, f"{warehouse}/{name}")
        for name in ("trips", "trips_quarantine")
        if fs.child_dirs(spark, f"{warehouse}/{name}")
    }
    if "trips" in tables:
        done = lake.done_months(said, lake.partition_counts(tables), "trips", "trips_quarantine")
        ready = {r.month_start for r in done.filter("done").collect()}  # one row per month
        status = {m.first: ("skipped", None) for m in months if m.first in ready}
    todo = [m for m in months if m.first not in status]

    def attempt(part: list[Month]) -> None:
        run_folder(spark, folder, root, part, processed_at=processed_at)
        load_months(spark, root, warehouse, part)
        status.update({m.first: ("loaded", None) for m in part})

    if todo:
        try:
            attempt(todo)
        except BAD_MONTH:
            for month in todo:
                try:
                    attempt([month])
                except BAD_MONTH as e:
                    status[month.first] = ("failed", f"{type(e).__name__}: {str(e)[:300]}")
    rows = [(m.first, *status[m.first]) for m in months]
    return spark.createDataFrame(rows, "month_start date, status string, error string")


def _reconcile(months, source, said, written) -> None:
    for month in months:
        m = month.first
        report = said.get(m)
        want = (report.curated_rows, report.quarantined_rows) if report else (0, 0)
        got = (written["curated"].get(m, 0), written["quarantine"].get(m, 0))
        if want != got or sum(got) != source.get(m, 0):
            raise ReconciliationError(f"{month}: source {source.get(m, 0)}, counted {want}, written {got}")


def load_months(
    spark: SparkSession, root: str, warehouse: str, months: list[Month]
) -> None:
    """Swap committed months into the warehouse tables and verify them against their reports."""
    firsts = [m.first for m in months]
    reported = reports(spark, root).filter(F.col("month_start").isin(firsts))
    said = {r.month_start: r for r in reported.collect()}  # one row per month
    missing = [str(m) for m in months if m.first not in said]
    if missing:
        raise lake.LoadMismatch(f"no report for {missing}: not reconciled, not loaded")
    for zone, table, column in (
        ("curated", "trips", "curated_rows"),
        ("quarantine", "trips_quarantine", "quarantined_rows"),
    ):
        rows = curated(spark, root) if zone == "curated" else quarantine(spark, root)
        path = f"{warehouse}/{table}"
        part = rows.filter(in_directories(months)).drop("year", "month")
        lake.swap_partitions(part, path, ["source_month"], sort=CLUSTER[zone])
        for month in months:
            if said[month.first][column] == 0:
                lake.clear_partition(spark, path, source_month=month.first.isoformat())
        if fs.child_dirs(spark, path):
            loaded = lake.read_table(spark, path).filter(F.col("source_month").isin(firsts))
            wrong = lake.verify_load(reported, loaded, column).collect()
            if wrong:
                raise lake.LoadMismatch(f"{table}: {wrong}")
