"""Per-client reports (R1) and the overall report (R2).

A report is a long table instead of a PDF: every chart's series becomes rows

    client, host, disk, section, x, x_label, y, y2, title

and the overall report stacks the share tables

    section_no, section, client, host, size, share, title.

Each metric family is scanned **once**: ``family_rollup`` computes partial sums
per server name and bucket for every section the reports need (hourly, weekly,
monthly, the whole period, and the ``_Total`` processor rows for CPU).  The
rollup is ``names x buckets`` rows however large the fact table is; it is
written to the shared scratch folder (``spark.checkpoint.dir``) so that
membership, all profiles and all shares read it instead of the facts, lineage is
cut, and join planning sees its real size.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope import schema as S
from fleetscope.functions import keys as K
from fleetscope.operators import membership as M
from fleetscope.operators import profiles as P
from fleetscope.operators import shares as W
from fleetscope.sources.scratch import materialize, materialize_all, scope
from fleetscope.sources.sinks import CHART_KEYS, finished, missing, read_written, write_table

DATE_SECTIONS = ("hourly", "weekly", "monthly")

# Sections of the overall report, in page order.
OVERALL_SECTIONS = [(1, "cpu_host_share"), (2, "cpu_client_share"),
                    (3, "mem_host_share"), (4, "disk_host_share")]


def family_metrics(family: S.MetricFamily) -> list[str]:
    if family.has_disk:
        return [m for _, a, b in S.DISK_CHARTS for m in (a, b)]
    return list(family.profile_metrics)


def report_sections(family: S.MetricFamily) -> tuple[str, ...]:
    """Date sections a family's report draws: the disk report only hourly charts."""
    return ("hourly",) if family.has_disk else DATE_SECTIONS


def family_rollup(facts: DataFrame, family: S.MetricFamily, exact_scale: int | None = None,
                  sections: tuple[str, ...] | None = None,
                  processor_total: bool = True, further: tuple[str, ...] = ()) -> DataFrame:
    """One scan: partial sums of the family's metrics for every report bucket (and every value of ``further`` columns).

    Buckets: the report's date sections, the whole period (every row, so every
    name is present for membership) and, for CPU with ``processor_total``, the
    ``_Total`` processor rows behind the client shares of the overall report.
    """
    if sections is None:
        sections = report_sections(family)
    buckets = [P.date_bucket(s) for s in sections] + [P.whole_bucket()]
    if family.name == "cpu" and processor_total:
        buckets.append(W.total_bucket())
    names = [*P.name_keys("disk" if family.has_disk else "host"), *further]
    return P.rollup(facts, family_metrics(family), buckets, names, exact_scale)


def _rows(df: DataFrame, section, x=None, y="y", y2=None, disk=None) -> DataFrame:
    def lit_or_col(v, dtype):
        if v is None:
            return F.lit(None).cast(dtype)
        return F.col(v).cast(dtype) if isinstance(v, str) else v.cast(dtype)
    return df.select(
        F.col("client"), F.col("host"), lit_or_col(disk, "string").alias("disk"),
        (F.lit(section) if isinstance(section, str) else section).alias("section"),
        lit_or_col(x, "int").alias("x"), lit_or_col(y, "double").alias("y"),
        lit_or_col(y2, "double").alias("y2"))


REPORT_COLUMNS = ["client", "host", "disk", "section", "x", "x_label", "y", "y2", "title"]
OVERALL_COLUMNS = ["section_no", "section", "client", "host", "size", "share", "title"]


def chart_title(family: S.MetricFamily) -> Column:
    """Title of a report row's chart, from client, host, disk and section (P10)."""
    c, h, d = F.col("client"), F.col("host"), F.upper(F.col("disk"))
    out = F.when(F.col("section") == "share", F.format_string(SHARE_TITLE_FORMATS[family.name], c))
    for chart, fmt in TITLE_FORMATS[family.name]:
        args = (c, h, d) if family.has_disk else (c, h)
        out = out.when(F.col("section") == chart, F.format_string(fmt, *args))
    return out.when(F.col("section") == "total", F.lit(TOTAL_LABEL))


def client_report(facts: DataFrame | None, family: S.MetricFamily, match: str = "contains",
                  exact_scale: int | None = None, rolled: DataFrame | None = None,
                  materialize_rollup: bool = True, report_date: str | None = None) -> DataFrame:
    """All charts of every client's report for one metric family.

    * cpu: hourly, weekly, monthly series per host, and ``total`` (total
      processor time, the sum of daily means) per host;
    * mem: the three series per host, and ``share`` (y = mean, y2 = share of
      the client);
    * disk: ``share`` per host (mean disk writes), then per disk the hourly
      ``writes`` and ``reads`` charts (y = mean of AVG, y2 = mean of MAX).

    ``title`` is the chart's title, ``x_label`` the weekday of the weekly series.
    ``report_date`` (optional) adds the heading and date of the report's title page.
    """
    if rolled is None:
        rolled = family_rollup(facts, family, exact_scale, processor_total=False)
        if materialize_rollup:
            rolled = materialize(rolled, f"rollup-{family.name}")
    hm = M.host_members(rolled, match)
    if family.has_disk:
        dm = M.disk_members(rolled, match, members=hm)
        prof = P.profiles(None, family_metrics(family), ["hourly"], "disk", match, exact_scale,
                          members=dm, rolled=rolled)
        share = W.host_share(None, family.share_metric, family.share_agg, match, exact_scale,
                             members=hm, rolled=rolled.select(S.SERVER, "section", "x", "s0", "n0"))
        parts = [_rows(share, "share", y="size", y2="share")]
        # both charts come from one merged row, so membership is built and joined once
        ys = ["y"] + [f"y{i}" for i in range(2, 2 * len(S.DISK_CHARTS) + 1)]
        charts = F.array(*[F.struct(F.lit(chart).alias("chart"), F.col(ys[2 * i]).alias("ya"),
                                    F.col(ys[2 * i + 1]).alias("yb"))
                           for i, (chart, _, _) in enumerate(S.DISK_CHARTS)])
        each = prof.select("client", "host", "disk", "x", F.inline(charts))
        parts.append(_rows(each, F.col("chart"), x="x", y="ya", y2="yb", disk="disk"))
    else:
        prof = P.profiles(None, family_metrics(family), DATE_SECTIONS, "host", match,
                          exact_scale, members=hm, rolled=rolled)
        parts = [_rows(prof, F.col("section"), x="x", y="y")]
        if family.name == "cpu":
            total = P.total_usage(None, daily=prof)
            parts.append(_rows(total, "total", y="total_usage"))
        else:
            share = W.host_share(None, family.share_metric, family.share_agg, match,
                                 exact_scale, members=hm, rolled=rolled)
            parts.append(_rows(share, "share", y="size", y2="share"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    label = F.when(F.col("section") == "weekly", K.day_label("x"))
    out = out.withColumns({"x_label": label, "title": chart_title(family)}).select(*REPORT_COLUMNS)
    if report_date is not None:  # the reference prints a fixed date on every title page
        out = out.withColumns({"report_heading": F.format_string(REPORT_HEADINGS[family.name], F.col("client")),
                               "report_date": F.lit(report_date)})
    return out


def overall_report(cpu: DataFrame | None, mem: DataFrame | None, disk: DataFrame | None,
                   match: str = "contains", exact_scale: int | None = None,
                   rolled: dict[str, DataFrame] | None = None, materialize_rollup: bool = True,
                   report_date: str | None = None) -> DataFrame:
    """Every client's host shares of CPU, the clients' CPU shares, and the host
    shares of memory and disk, stacked in page order (R2).

    ``title`` is the section's title; ``report_date`` adds the heading and date of the title page.
    """
    rolled = dict(rolled or {})
    facts = {"cpu": cpu, "mem": mem, "disk": disk}
    todo = {f"rollup-{fam.name}": family_rollup(facts[fam.name], fam, exact_scale, sections=())
            for fam in (S.CPU_FAMILY, S.MEM_FAMILY, S.DISK_FAMILY) if fam.name not in rolled}
    if materialize_rollup:
        todo = materialize_all(todo)
    rolled.update({k.removeprefix("rollup-"): v for k, v in todo.items()})
    cpu_r = rolled["cpu"]
    if match == "contains":  # one table of names and clients serves both CPU sections
        rows = M.client_rows(cpu_r)
        rows = materialize(rows, "members-cpu") if materialize_rollup else rows
        cpu_cm, cpu_hm = rows.select(S.SERVER, "client"), M.host_members(cpu_r, match, members=rows)
    else:
        cpu_cm, cpu_hm = M.client_members(cpu_r, match), M.host_members(cpu_r, match)
    parts = {
        "cpu_host_share": W.host_share(None, S.CPU, "sum", match, exact_scale,
                                       members=cpu_hm, rolled=cpu_r),
        "cpu_client_share": W.client_share(None, S.CPU, "sum", match, exact_scale,
                                           members=cpu_cm, rolled=cpu_r)
        .withColumn("host", F.lit(None).cast("string")),
        "mem_host_share": W.host_share(None, S.MEM, "avg", match, exact_scale,
                                       members=M.host_members(rolled["mem"], match),
                                       rolled=rolled["mem"]),
    }
    disk_r = rolled["disk"].select(S.SERVER, "section", "x", "s0", "n0")
    parts["disk_host_share"] = W.host_share(None, S.WRITES_AVG, "avg", match, exact_scale,
                                            members=M.host_members(disk_r, match), rolled=disk_r)
    out = None
    for no, name in OVERALL_SECTIONS:
        p = parts[name].select(F.lit(no).alias("section_no"), F.lit(name).alias("section"),
                               "client", "host", "size", "share", F.lit(OVERALL_TITLES[no]).alias("title"))
        out = p if out is None else out.unionByName(p)
    if report_date is not None:
        out = out.withColumns({"report_heading": F.lit(OVERALL_HEADING), "report_date": F.lit(report_date)})
    return out.orderBy("section_no", "client", "host")


# --- which charts a job has to write ------------------------------------------------------

def _charts(names: DataFrame, family: S.MetricFamily, match: str) -> DataFrame:
    """``(client, host, disk, section)`` of every chart of a family's client reports."""
    null = F.lit(None).cast("string").alias("disk")

    def each(keys: DataFrame, disk, sections) -> DataFrame:
        return keys.select("client", "host", disk, F.explode(F.array(*map(F.lit, sections))).alias("section"))

    hosts = M.hosts(names, match)
    if not family.has_disk:
        return each(hosts, null, (*DATE_SECTIONS, "total" if family.name == "cpu" else "share"))
    return each(hosts, null, ("share",)).union(
        each(M.disks(names, match), F.col("disk"), [c for c, _, _ in S.DISK_CHARTS]))


def _overall_charts(names: dict[str, DataFrame], match: str) -> DataFrame:
    """``(section_no, client, host)`` of every row of the overall report."""
    parts = []
    for no, section in OVERALL_SECTIONS:
        family = section.split("_")[0]
        keys = (M.clients(names[family]).withColumn("host", F.lit(None).cast("string"))
                if section == "cpu_client_share" else M.hosts(names[family], match))
        parts.append(keys.select(F.lit(no).alias("section_no"), "client", "host"))
    return reduce(DataFrame.union, parts)


def _lacking(spark: SparkSession, path: str, wanted: DataFrame) -> bool:
    """Whether the table at ``path`` lacks any of the wanted charts."""
    if not finished(spark, path):
        return True
    written = read_written(spark, path, wanted.schema)
    return not missing(wanted, written, wanted.columns).isEmpty()


def write_reports(cpu: DataFrame, mem: DataFrame, disk: DataFrame, out_dir: str,
                  match: str = "contains", exact_scale: int | None = None,
                  force: bool = True, report_date: str | None = None) -> dict[str, str]:
    """The whole job: one rollup per family, three client reports, one overall.

    Client reports are written partitioned by client (S5), each client's files
    ordered by host, disk, section and x.  Without ``force`` only charts that are not there
    yet are written: the wanted charts follow from the distinct names alone, families that lack
    none get no rollup, and a job that lacks nothing ends there.  Returns the paths.
    """
    spark, root = cpu.sparkSession, out_dir.rstrip("/")
    families = (S.CPU_FAMILY, S.MEM_FAMILY, S.DISK_FAMILY)
    facts = {"cpu": cpu, "mem": mem, "disk": disk}
    paths = {fam.name: f"{root}/client_report_{fam.name}" for fam in families}
    paths["overall"] = f"{root}/overall_report"
    with scope(spark):
        todo = set(paths)
        if not force and any(finished(spark, p) for p in paths.values()):
            names = materialize_all({fam.name: facts[fam.name].select(
                *P.name_keys("disk" if fam.has_disk else "host")).distinct() for fam in families})
            todo = {fam.name for fam in families
                    if _lacking(spark, paths[fam.name], _charts(names[fam.name], fam, match))}
            if _lacking(spark, paths["overall"], _overall_charts(names, match)):
                todo.add("overall")
        need = [fam for fam in families if fam.name in todo or "overall" in todo]
        rolled = materialize_all({fam.name: family_rollup(
            facts[fam.name], fam, exact_scale, report_sections(fam) if fam.name in todo else ())
            for fam in need})
        outputs = {fam.name: (client_report(None, fam, match, exact_scale, rolled=rolled[fam.name],
                                            report_date=report_date), ("client",), CHART_KEYS)
                   for fam in need if fam.name in todo}
        if "overall" in todo:
            outputs["overall"] = (overall_report(None, None, None, match, exact_scale, rolled=rolled,
                                                 report_date=report_date), (), ("section_no", "client", "host"))

        def write(name: str) -> None:  # the jobs are independent: run them side by side
            df, parts, keys = outputs[name]
            write_table(df, paths[name], force=force, partition_by=parts, keys=keys)

        if outputs:
            with ThreadPoolExecutor(max_workers=len(outputs)) as pool:
                for f in [pool.submit(write, name) for name in outputs]:
                    f.result()
    return paths


def chart_series(report: DataFrame, client: str, host: str, section: str, disk: str | None = None):
    """One chart's points as a pandas table, ordered by x.

    A chart has at most one point for each hour, weekday or day of the month, which bounds
    what reaches the driver; anything larger is for a sink.
    """
    one = report.where((F.col("client") == client) & (F.col("host") == host)
                       & (F.col("section") == section) & F.col("disk").eqNullSafe(F.lit(disk)))
    return one.select("x", "x_label", "y", "y2").orderBy("x").toPandas()


def titles(host_keys: DataFrame, family: S.MetricFamily,
           disk_keys: DataFrame | None = None) -> DataFrame:
    """Titles of a client report (P10): ``(client, host, disk, chart, title)``.

    ``host_keys`` holds distinct ``(client, host)``; the disk family also needs
    ``disk_keys`` with distinct ``(client, host, disk)``.  Rows: one ``heading``
    per host, one title per chart of the host (per disk for the disk charts,
    with the disk letter upper-cased), and one ``share`` (pie) title per client.
    Each key row emits all its titles at once (``inline`` of an array).
    """
    c, h = F.col("client"), F.col("host")
    null = F.lit(None).cast("string")

    def charts(pairs):
        return F.inline(F.array(*[F.struct(F.lit(chart).alias("chart"), title.alias("title"))
                                  for chart, title in pairs]))

    host_titles = [("heading", F.format_string(HEADING_FORMAT, c, h))]
    if not family.has_disk:
        host_titles += [(chart, F.format_string(fmt, c, h)) for chart, fmt in TITLE_FORMATS[family.name]]
    parts = [host_keys.select(c, h, null.alias("disk"), charts(host_titles))]
    if family.has_disk:
        if disk_keys is None:
            raise ValueError("the disk family needs disk_keys")
        d = F.upper(F.col("disk"))
        parts.append(disk_keys.select(c, h, F.col("disk"), charts(
            [(chart, F.format_string(fmt, c, h, d)) for chart, fmt in TITLE_FORMATS["disk"]])))
    parts.append(host_keys.select("client").distinct().select(
        c, null.alias("host"), null.alias("disk"), F.lit("share").alias("chart"),
        F.format_string(SHARE_TITLE_FORMATS[family.name], c).alias("title")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- fixed values: report titles (client, host[, upper-case disk]) ---------------------
HEADING_FORMAT = "Charts for %s with host %s"
TITLE_FORMATS = {
    "cpu": [("hourly", "Hourly CPU Usage for %s with host %s"),
            ("weekly", "Weekly CPU Usage for %s with host %s"),
            ("monthly", "Monthly CPU Usage for %s with host %s")],
    "mem": [("hourly", "Hourly Memory Usage for %s with host %s"),
            ("weekly", "Weekly Memory Usage for %s with host %s"),
            ("monthly", "Monthly Memory Usage for %s with host %s")],
    "disk": [("writes", "Hourly Average Disk Write/Sec for %s with host %s Disk: %s:"),
             ("reads", "Hourly Average Disk Reads/Sec for %s with host %s Disk: %s:")],
}
# pie chart titles per client (the CPU one names no client)
SHARE_TITLE_FORMATS = {
    "cpu": "Total Percentage Usage per Host in 1 month",
    "mem": "Percentage Memory Usage for %s in 1 month",
    "disk": "Percentage Disk Usage for %s in 1 month",
}
# heading of a report's title page, and the label of the total under a host's charts
REPORT_HEADINGS = {"cpu": "%s CPU Report", "mem": "%s Memory Report", "disk": "%s Disk Report"}
OVERALL_HEADING = "Overall Report"
TOTAL_LABEL = "Total Processor Time"
# section titles of the overall report, by section number
OVERALL_TITLES = {
    1: "Percentage CPU usage of every client's hosts",
    2: "Total Percentage Usage per Host in 1 month",
    3: "Percentage Memory usage of every client's hosts",
    4: "Percentage Disk usage of every client's hosts",
}
# --- end of fixed values -----------------------------------------------------------------
