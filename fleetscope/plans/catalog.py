"""

Every query reads ``events`` from ``sf_dir`` (through the fixture mapping of
FIXTURES.md) over the whole table and returns a DataFrame.  Most plans are
lazy.  Four kinds run jobs while building, always writing to a fresh location
below the shared scratch folder (``sources.scratch``):

* source/sink queries, whose write *is* the operator; they return the
  read-back table;
* splits, which write the small membership table first so that the join to
  the facts is planned on its size;
* profiles, sizes, shares and distinct disks and x-values, which write their rollup (or
  distinct names) and derive membership from it: one scan of the facts each;
* reports, which write the family rollup once, and the chart fetched from one.

Aggregates use exact arithmetic at two decimals (``EXACT_SCALE``), which the
fixture's values satisfy (a value that does not would fail the query), so results are
independent of partitioning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope import schema as S
from fleetscope.functions import keys as K
from fleetscope.operators import distinct as D
from fleetscope.operators import membership as M
from fleetscope.operators import profiles as P
from fleetscope.operators import shares as W
from fleetscope.plans import fixtures as X
from fleetscope.plans import incremental as N
from fleetscope.plans import reports as R
from fleetscope.sources import ingest as I
from fleetscope.sources import readers as RD
from fleetscope.sources import sinks as SK
from fleetscope.sources.scratch import table_path
from fleetscope.streaming.ingest_stream import ingest_stream as ingest_stream_files

EXACT_SCALE = 2
MATCH = "contains"

# Parameters of the single-key filter queries (F1-F5, S6): the key a report page
# would filter on.  They select rows; the scan covers the whole table.
FILTER_CLIENT = "acm"
FILTER_HOST = "a"
FILTER_DISK = "c"
FILTER_HOUR = 13
FILTER_SECTION = "weekly"

CPU_COLS = [S.SERVER, S.TIME, S.PROCESSOR, S.CPU]
DISK_COLS = [S.SERVER, S.TIME, S.DISK, S.WRITES_AVG]
WIDE_COLS = [S.SERVER, S.TIME, S.PROCESSOR, S.DISK, S.CPU, S.MEM,
             S.WRITES_AVG, S.WRITES_MAX, S.READS_AVG, S.READS_MAX]


Query = Callable[[SparkSession, str], DataFrame]


def _cpu(spark, sf):
    return X.load_metrics(spark, sf, S.CPU_FAMILY)


def _mem(spark, sf):
    return X.load_metrics(spark, sf, S.MEM_FAMILY)


def _disk(spark, sf):
    return X.load_metrics(spark, sf, S.DISK_FAMILY)


def _wide(spark, sf):
    return X.load_metrics(spark, sf)


# --- sources and sinks (S1-S5) ---------------------------------------------------

def scan_metrics(spark, sf):
    """Generic reader (format + explicit schema) -> fixture mapping -> clean."""
    events = (spark.read.format("parquet").schema(X.EVENTS_SCHEMA)
              .load(f"{sf}/events.parquet"))
    return RD.clean(X.metrics_from_events(events)).select(*WIDE_COLS)


def ingest_append(spark, sf):
    """Land the CPU table as CSV files, ingest them, read the table back."""
    landing = table_path(spark, "landing-cpu")
    table = table_path(spark, "table-cpu")
    src = X.family_table(X.metrics_from_events(X.read_events(spark, sf)), S.CPU_FAMILY)
    I.write_landing(src, landing, fmt="csv")
    I.ingest_append(spark, landing, table, S.CPU_FAMILY, fmt="csv")
    return I.read_table(spark, table, S.CPU_FAMILY)


def ingest_stream(spark, sf):
    """S2 streamed: land the CPU table, ingest it exactly once with Structured
    Streaming (file source, checkpoint, ``availableNow``), run the stream a
    second time (nothing new: no duplicates), read the table back."""
    landing = table_path(spark, "landing-cpu-stream")
    table = table_path(spark, "table-cpu-stream")
    checkpoint = table_path(spark, "checkpoint-cpu-stream")
    src = X.family_table(X.metrics_from_events(X.read_events(spark, sf)), S.CPU_FAMILY)
    I.write_landing(src, landing, fmt="csv")
    for _ in range(2):
        ingest_stream_files(spark, landing, table, checkpoint, S.CPU_FAMILY, fmt="csv")
    return I.read_table(spark, table, S.CPU_FAMILY)


def sql_view_scan(spark, sf):
    """S3: temp view + ``SELECT *``."""
    return RD.sql_view_scan(spark, _wide(spark, sf).select(*WIDE_COLS), "metrics_view")


def cached_scan(spark, sf):
    """Rebalanced, cached view read back as a table (a former run's cache is released first)."""
    return RD.cached_scan(spark, _wide(spark, sf).select(*WIDE_COLS), "metrics_cached")


def _profile_schema():
    return T.StructType([T.StructField("client", T.StringType()),
                         T.StructField("host", T.StringType()),
                         T.StructField("x", T.IntegerType()),
                         T.StructField("y", T.DoubleType())])


def sink_skip_existing(spark, sf):
    """S5, force off: the second write finds every chart (client, host) written and adds nothing."""
    path = table_path(spark, "chart-skip")
    SK.write_table(cpu_hourly(spark, sf), path, force=False)
    SK.write_table(mem_hourly(spark, sf), path, force=False)
    return SK.read_written(spark, path, _profile_schema())


def sink_overwrite(spark, sf):
    """S5, force on: the second write replaces the first."""
    path = table_path(spark, "chart-force")
    SK.write_table(mem_hourly(spark, sf), path, force=True)
    SK.write_table(cpu_hourly(spark, sf), path, force=True)
    return SK.read_written(spark, path, _profile_schema())


# --- projections (P1-P10) -----------------------------------------------------------

def client_key(spark, sf):
    return _cpu(spark, sf).select(S.SERVER, K.client_key().alias("client"))


def host_key(spark, sf):
    return _cpu(spark, sf).select(S.SERVER, K.host_key().alias("host"))


def disk_key(spark, sf):
    return _disk(spark, sf).select(S.DISK, K.disk_key().alias("disk"))


def project_metric(spark, sf):
    return _cpu(spark, sf).select(S.SERVER, S.CPU, K.date_part("hour").alias("hour"))


def scalar_date_parts(spark, sf):
    return _cpu(spark, sf).select(
        S.TIME,
        K.date_part("hour").alias("hour"),
        K.date_part("dayofweek").alias("day_of_week"),
        K.day_label(K.date_part("dayofweek")).alias("day_name"),
        K.date_part("dayofmonth").alias("day_of_month"))


def report_titles(spark, sf):
    parts = []
    for fam, df in ((S.CPU_FAMILY, _cpu(spark, sf)), (S.MEM_FAMILY, _mem(spark, sf))):
        parts.append(R.titles(M.hosts(df, MATCH), fam).withColumn("family", F.lit(fam.name)))
    disk = _disk(spark, sf)
    parts.append(R.titles(M.hosts(disk, MATCH), S.DISK_FAMILY, M.disks(disk, MATCH))
                 .withColumn("family", F.lit("disk")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("family", "client", "host", "disk", "chart", "title")


# --- filters (F1-F5) ----------------------------------------------------------------

def filter_client(spark, sf):
    return _cpu(spark, sf).where(M.client_filter(FILTER_CLIENT)).select(*CPU_COLS)


def filter_host(spark, sf):
    return _cpu(spark, sf).where(M.host_filter(FILTER_CLIENT, FILTER_HOST)).select(*CPU_COLS)


def filter_disk(spark, sf):
    return (_disk(spark, sf).where(M.disk_filter(FILTER_CLIENT, FILTER_HOST, FILTER_DISK))
            .select(*DISK_COLS))


def filter_total(spark, sf):
    return _cpu(spark, sf).where(M.total_filter(FILTER_CLIENT)).select(*CPU_COLS)


def filter_hour(spark, sf):
    return _cpu(spark, sf).where(K.date_part("hour") == F.lit(FILTER_HOUR)).select(*CPU_COLS)


# --- membership splits (J1-J4) -----------------------------------------------------------

def split_client(spark, sf):
    return M.split(_cpu(spark, sf), "client", MATCH).select("client", *CPU_COLS)


def split_host(spark, sf):
    return M.split(_cpu(spark, sf), "host", MATCH).select("client", "host", *CPU_COLS)


def split_disk(spark, sf):
    return (M.split(_disk(spark, sf), "disk", MATCH)
            .select("client", "host", "disk", *DISK_COLS))


def split_disk_fleet(spark, sf):
    return M.split_fleet_disks(_disk(spark, sf), MATCH).select("client", "disk", *DISK_COLS)


def split_disk_factored(spark, sf):
    """J4 without expansion: every fact once with its disk keys; the (client, disk) side is ``distinct_disks_client``."""
    facts, _ = M.factor_fleet_disks(_disk(spark, sf), MATCH)
    return facts.select(F.array_join("disks", ",").alias("disks"), *DISK_COLS)


# --- distinct keys and x-values (D1-D7) ---------------------------------------------------

def distinct_clients(spark, sf):
    return D.distinct_clients(_cpu(spark, sf))


def distinct_hosts(spark, sf):
    return D.distinct_hosts(_cpu(spark, sf), MATCH)


def distinct_disks(spark, sf):
    return D.distinct_disks(_disk(spark, sf), MATCH, materialize_names=True)


def distinct_disks_client(spark, sf):
    return D.distinct_client_disks(_disk(spark, sf), MATCH, materialize_names=True)


def distinct_hours(spark, sf):
    return D.distinct_parts(_cpu(spark, sf), "hour", MATCH, materialize_names=True)


def distinct_weekdays(spark, sf):
    return D.distinct_parts(_cpu(spark, sf), "dayofweek", MATCH, materialize_names=True)


def distinct_monthdays(spark, sf):
    return D.distinct_parts(_cpu(spark, sf), "dayofmonth", MATCH, materialize_names=True)


# --- profiles (A1-A9) -------------------------------------------------------------------------

def _prof(loader, metric, section):
    def q(spark, sf):
        return P.profile(loader(spark, sf), metric, section, "host", MATCH, EXACT_SCALE,
                         materialize_rollup=True)
    q.__name__ = f"{metric}_{section}"
    return q


cpu_hourly = _prof(_cpu, S.CPU, "hourly")
cpu_weekly = _prof(_cpu, S.CPU, "weekly")
cpu_monthly = _prof(_cpu, S.CPU, "monthly")
mem_hourly = _prof(_mem, S.MEM, "hourly")
mem_weekly = _prof(_mem, S.MEM, "weekly")
mem_monthly = _prof(_mem, S.MEM, "monthly")


def disk_writes_hourly(spark, sf):
    return P.profile(_disk(spark, sf), [S.WRITES_AVG, S.WRITES_MAX], "hourly", "disk",
                     MATCH, EXACT_SCALE, materialize_rollup=True)


def disk_reads_hourly(spark, sf):
    return P.profile(_disk(spark, sf), [S.READS_AVG, S.READS_MAX], "hourly", "disk",
                     MATCH, EXACT_SCALE, materialize_rollup=True)


def cpu_total_usage(spark, sf):
    return P.total_usage(_cpu(spark, sf), S.CPU, MATCH, EXACT_SCALE,
                         materialize_rollup=True)


# --- sizes and shares (A10-A13, W1-W4) ---------------------------------------------------------

def cpu_host_sum(spark, sf):
    return W.host_sizes(_cpu(spark, sf), S.CPU, "sum", MATCH, EXACT_SCALE,
                        materialize_rollup=True)


def mem_host_avg(spark, sf):
    return W.host_sizes(_mem(spark, sf), S.MEM, "avg", MATCH, EXACT_SCALE,
                        materialize_rollup=True)


def disk_host_avg(spark, sf):
    return W.host_sizes(_disk(spark, sf), S.WRITES_AVG, "avg", MATCH, EXACT_SCALE,
                        materialize_rollup=True)


def cpu_client_sum(spark, sf):
    return W.client_sizes(_cpu(spark, sf), S.CPU, "sum", MATCH, EXACT_SCALE,
                        materialize_rollup=True)


def cpu_host_share(spark, sf):
    return W.host_share(_cpu(spark, sf), S.CPU, "sum", MATCH, EXACT_SCALE,
                        materialize_rollup=True)


def mem_host_share(spark, sf):
    return W.host_share(_mem(spark, sf), S.MEM, "avg", MATCH, EXACT_SCALE,
                        materialize_rollup=True)


def disk_host_share(spark, sf):
    return W.host_share(_disk(spark, sf), S.WRITES_AVG, "avg", MATCH, EXACT_SCALE,
                        materialize_rollup=True)


def cpu_client_share(spark, sf):
    return W.client_share(_cpu(spark, sf), S.CPU, "sum", MATCH, EXACT_SCALE,
                        materialize_rollup=True)


# --- reports (R1, R2) ------------------------------------------------------------------------------

def client_report_cpu(spark, sf):
    return R.client_report(_cpu(spark, sf), S.CPU_FAMILY, MATCH, EXACT_SCALE)


def client_report_mem(spark, sf):
    return R.client_report(_mem(spark, sf), S.MEM_FAMILY, MATCH, EXACT_SCALE)


def client_report_disk(spark, sf):
    return R.client_report(_disk(spark, sf), S.DISK_FAMILY, MATCH, EXACT_SCALE)


def client_report_incremental(spark, sf):
    """R1 from kept partial sums: the CPU table comes in two loads, and the second report scans the second only."""
    table = table_path(spark, "table-cpu-rolled")
    cpu = _cpu(spark, sf)
    late = F.coalesce(K.date_part("dayofmonth") > 15, F.lit(False))
    for i, part in enumerate((cpu.where(~late), cpu.where(late))):
        I.write_load(part, table, f"batch-{i}")
        N.refresh(spark, table, S.CPU_FAMILY, EXACT_SCALE)
    rolled = N.table_rollup(spark, table, S.CPU_FAMILY, EXACT_SCALE)
    return R.client_report(None, S.CPU_FAMILY, MATCH, EXACT_SCALE, rolled=rolled)


def overall_report(spark, sf):
    return R.overall_report(_cpu(spark, sf), _mem(spark, sf), _disk(spark, sf), MATCH,
                            EXACT_SCALE)


def chart_points(spark, sf):
    """The points of one chart, fetched to the driver (at most seven)."""
    points = R.chart_series(client_report_cpu(spark, sf), FILTER_CLIENT, FILTER_HOST, FILTER_SECTION)
    return spark.createDataFrame(points.astype(object).where(points.notna(), None).values.tolist(),
                                 "x int, x_label string, y double, y2 double")


QUERIES: dict[str, Query] = {
    "scan_metrics": scan_metrics,
    "ingest_append": ingest_append,
    "ingest_stream": ingest_stream,
    "sql_view_scan": sql_view_scan,
    "cached_scan": cached_scan,
    "sink_skip_existing": sink_skip_existing,
    "sink_overwrite": sink_overwrite,
    "client_key": client_key,
    "host_key": host_key,
    "disk_key": disk_key,
    "project_metric": project_metric,
    "scalar_date_parts": scalar_date_parts,
    "report_titles": report_titles,
    "filter_client": filter_client,
    "filter_host": filter_host,
    "filter_disk": filter_disk,
    "filter_total": filter_total,
    "filter_hour": filter_hour,
    "split_client": split_client,
    "split_host": split_host,
    "split_disk": split_disk,
    "split_disk_fleet": split_disk_fleet,
    "split_disk_factored": split_disk_factored,
    "distinct_clients": distinct_clients,
    "distinct_hosts": distinct_hosts,
    "distinct_disks": distinct_disks,
    "distinct_disks_client": distinct_disks_client,
    "distinct_hours": distinct_hours,
    "distinct_weekdays": distinct_weekdays,
    "distinct_monthdays": distinct_monthdays,
    "cpu_hourly": cpu_hourly,
    "cpu_weekly": cpu_weekly,
    "cpu_monthly": cpu_monthly,
    "mem_hourly": mem_hourly,
    "mem_weekly": mem_weekly,
    "mem_monthly": mem_monthly,
    "disk_writes_hourly": disk_writes_hourly,
    "disk_reads_hourly": disk_reads_hourly,
    "cpu_total_usage": cpu_total_usage,
    "cpu_host_sum": cpu_host_sum,
    "mem_host_avg": mem_host_avg,
    "disk_host_avg": disk_host_avg,
    "cpu_client_sum": cpu_client_sum,
    "cpu_host_share": cpu_host_share,
    "mem_host_share": mem_host_share,
    "disk_host_share": disk_host_share,
    "cpu_client_share": cpu_client_share,
    "client_report_cpu": client_report_cpu,
    "client_report_mem": client_report_mem,
    "client_report_disk": client_report_disk,
    "client_report_incremental": client_report_incremental,
    "overall_report": overall_report,
    "chart_points": chart_points,
}
