"""Client reports and the overall report."""

import math
import os
import tempfile

from pyspark.sql import functions as F

from fleetscope import schema as S
from fleetscope.operators import profiles as P
from fleetscope.plans import fixtures as X
from fleetscope.plans import reports as R
from tests.conftest import SF_SMALL


def test_cpu_report_sections_and_total(spark):
    cpu = X.load_metrics(spark, SF_SMALL, S.CPU_FAMILY)
    rep = R.client_report(cpu, S.CPU_FAMILY, exact_scale=2)
    assert rep.columns == R.REPORT_COLUMNS
    rows = rep.collect()
    assert {r.section for r in rows} == {"hourly", "weekly", "monthly", "total"}
    monthly = {}
    for r in rows:
        if r.section == "monthly":
            monthly.setdefault((r.client, r.host), []).append(r.y)
    for r in rows:
        if r.section == "total":
            assert math.isclose(r.y, sum(monthly[(r.client, r.host)]), rel_tol=1e-12)


def test_report_matches_single_profiles(spark):
    mem = X.load_metrics(spark, SF_SMALL, S.MEM_FAMILY)
    rep = R.client_report(mem, S.MEM_FAMILY, exact_scale=2, materialize_rollup=False)
    weekly = {(r.client, r.host, r.x): r.y for r in rep.where(F.col("section") == "weekly").collect()}
    single = {(r.client, r.host, r.x): r.y
              for r in P.profile(mem, S.MEM, "weekly", exact_scale=2).collect()}
    assert weekly == single


def test_disk_report_sections(spark):
    disk = X.load_metrics(spark, SF_SMALL, S.DISK_FAMILY)
    rows = R.client_report(disk, S.DISK_FAMILY, exact_scale=2).collect()
    assert {r.section for r in rows} == {"share", "writes", "reads"}
    assert all(r.disk is None for r in rows if r.section == "share")
    assert all(r.disk is not None and r.x is not None for r in rows if r.section != "share")


def test_overall_report_order_and_shares(spark):
    f = X.load_metrics(spark, SF_SMALL)
    cpu, mem, disk = (f.select(*fam.columns) for fam in (S.CPU_FAMILY, S.MEM_FAMILY, S.DISK_FAMILY))
    rows = R.overall_report(cpu, mem, disk, exact_scale=2).collect()
    nos = [r.section_no for r in rows]
    assert nos == sorted(nos) and set(nos) == {1, 2, 3, 4}
    for no in (1, 3, 4):
        by_client = {}
        for r in rows:
            if r.section_no == no:
                by_client[r.client] = by_client.get(r.client, 0.0) + r.share
        assert all(math.isclose(v, 1.0, rel_tol=1e-12) for v in by_client.values())
    assert all(r.host is None for r in rows if r.section_no == 2)


def test_write_reports(spark):
    f = X.load_metrics(spark, SF_SMALL)
    cpu, mem, disk = (f.select(*fam.columns) for fam in (S.CPU_FAMILY, S.MEM_FAMILY, S.DISK_FAMILY))
    out = tempfile.mkdtemp(prefix="fleetscope-reports-")
    paths = R.write_reports(cpu, mem, disk, out, exact_scale=2)
    assert set(paths) == {"cpu", "mem", "disk", "overall"}
    assert any(d.startswith("client_key=") for d in os.listdir(paths["cpu"]))
    assert spark.read.parquet(paths["overall"]).count() > 0


def test_titles(spark):
    from fleetscope.operators import membership as M

    cpu = X.load_metrics(spark, SF_SMALL, S.CPU_FAMILY)
    t = R.titles(M.hosts(cpu), S.CPU_FAMILY).where("client = 'acm' AND host = 'a'")
    got = {r.chart: r.title for r in t.collect()}
    assert got["hourly"] == "Hourly CPU Usage for acm with host a"


def test_chart_series_is_one_chart(spark):
    mem = X.load_metrics(spark, SF_SMALL, S.MEM_FAMILY)
    rep = R.client_report(mem, S.MEM_FAMILY, exact_scale=2, materialize_rollup=False)
    pdf = R.chart_series(rep, "acm", "a", "weekly")
    assert list(pdf["x"]) == sorted(pdf["x"]) and len(pdf) <= 7
    assert list(pdf["x_label"]) == [["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"][x - 1] for x in pdf["x"]]


def test_position_mode_report(spark):
    cpu = X.load_metrics(spark, SF_SMALL, S.CPU_FAMILY)
    rep = R.client_report(cpu, S.CPU_FAMILY, match="position", exact_scale=2,
                          materialize_rollup=False)
    hosts = {(r.client, r.host) for r in rep.where(F.col("section") == "total").collect()}
    # position mode: exactly the keys at fixed positions of the names
    expected = {(r[0][:3], r[0][4:5]) for r in cpu.select(S.SERVER).distinct().collect()}
    assert hosts == expected


def test_disk_titles(spark):
    from fleetscope.operators import membership as M

    disk = X.load_metrics(spark, SF_SMALL, S.DISK_FAMILY)
    t = R.titles(M.hosts(disk), S.DISK_FAMILY, M.disks(disk))
    got = {(r.chart, r.title) for r in t.where("client = 'acm'").collect()}
    assert ("share", "Percentage Disk Usage for acm in 1 month") in got
    assert ("writes", "Hourly Average Disk Write/Sec for acm with host a Disk: C:") in got


def test_command_line_job(spark):
    from fleetscope.__main__ import main
    from fleetscope.sources import ingest as I

    wide = X.metrics_from_events(X.read_events(spark, SF_SMALL))
    base = tempfile.mkdtemp(prefix="fleetscope-cli-")
    for fam in (S.CPU_FAMILY, S.MEM_FAMILY, S.DISK_FAMILY):
        I.write_landing(X.family_table(wide, fam), f"{base}/{fam.name}", fmt="parquet")
    paths = main(["--cpu", f"{base}/cpu", "--mem", f"{base}/mem", "--disk", f"{base}/disk",
                  "--out", f"{base}/out", "--exact-scale", "2", "--report-date", "2024-02-01"])
    overall = spark.read.parquet(paths["overall"])
    assert overall.select("section_no").distinct().count() == 4
    rep = spark.read.parquet(paths["cpu"])
    assert rep.where("section = 'total'").count() > 0
    assert [r.report_date for r in rep.select("report_date").distinct().collect()] == ["2024-02-01"]
    head = {(r.client, r.report_heading) for r in rep.select("client", "report_heading").distinct().collect()}
    assert ("acm", "acm CPU Report") in head
    assert overall.select("report_heading").first()[0] == "Overall Report"


def test_command_line_ingest_with_reader_options(spark):
    from fleetscope.__main__ import main
    from fleetscope.sources import ingest as I

    wide = X.metrics_from_events(X.read_events(spark, SF_SMALL))
    base = tempfile.mkdtemp(prefix="fleetscope-cli-")
    for fam in (S.CPU_FAMILY, S.MEM_FAMILY, S.DISK_FAMILY):
        (X.family_table(wide, fam).write.option("header", "true").option("sep", ";").csv(f"{base}/{fam.name}"))
    args = ["--cpu", f"{base}/cpu", "--mem", f"{base}/mem", "--disk", f"{base}/disk", "--out", f"{base}/out",
            "--format", "csv", "--option", "sep=;", "--ingest", f"{base}/tables", "--exact-scale", "2"]
    paths = main(args)
    n = wide.count()
    assert I.read_table(spark, f"{base}/tables/cpu", S.CPU_FAMILY).count() == n
    once = spark.read.parquet(paths["cpu"]).count()
    main(args)  # loads again: rows double, charts do not
    assert I.read_table(spark, f"{base}/tables/cpu", S.CPU_FAMILY).count() == 2 * n
    assert spark.read.parquet(paths["cpu"]).count() == once


def test_titles_and_labels_in_the_written_reports(spark):
    from fleetscope.operators import membership as M

    disk = X.load_metrics(spark, SF_SMALL, S.DISK_FAMILY)
    rep = R.client_report(disk, S.DISK_FAMILY, exact_scale=2)
    want = {(r.client, r.host, r.disk, r.chart): r.title
            for r in R.titles(M.hosts(disk), S.DISK_FAMILY, M.disks(disk)).collect() if r.host}
    for r in rep.collect():
        if r.section == "share":
            assert r.title == f"Percentage Disk Usage for {r.client} in 1 month"
        else:
            assert r.title == want[r.client, r.host, r.disk, r.section]


def facts_of(spark):
    f = X.load_metrics(spark, SF_SMALL)
    return [f.select(*fam.columns) for fam in (S.CPU_FAMILY, S.MEM_FAMILY, S.DISK_FAMILY)]


def test_second_run_without_force_builds_no_rollup(spark, monkeypatch):
    out = tempfile.mkdtemp(prefix="fleetscope-reports-")
    paths = R.write_reports(*facts_of(spark), out, exact_scale=2, force=False)
    before = {k: sorted(map(str, spark.read.parquet(p).collect())) for k, p in paths.items()}
    calls = []
    monkeypatch.setattr(R, "family_rollup", lambda *a, **k: calls.append(a))
    R.write_reports(*facts_of(spark), out, exact_scale=2, force=False)
    assert calls == []
    assert before == {k: sorted(map(str, spark.read.parquet(p).collect())) for k, p in paths.items()}


def test_new_client_without_force_adds_its_charts_only(spark):
    out = tempfile.mkdtemp(prefix="fleetscope-reports-")
    cpu, mem, disk = facts_of(spark)
    acm = F.col(S.SERVER).startswith("acm")
    paths = R.write_reports(cpu.where(acm), mem.where(acm), disk.where(acm), out, exact_scale=2, force=False)
    first = {str(r) for r in spark.read.parquet(paths["mem"]).where("client = 'acm'").collect()}
    R.write_reports(cpu, mem, disk, out, exact_scale=2, force=False)
    now = spark.read.parquet(paths["mem"])
    assert {r[0] for r in now.select("client").distinct().collect()} == {"acm", "bet", "cor", "dyn", "ech"}
    assert first <= {str(r) for r in now.where("client = 'acm'").collect()}
    keys = [*R.CHART_KEYS, "x"]
    assert now.groupBy(*keys).count().where("count > 1").count() == 0


def test_scratch_is_empty_once_a_scope_closes(spark):
    import pytest

    from fleetscope.operators import membership as M
    from fleetscope.session import scratch_root
    from fleetscope.sources.scratch import release, scope

    release(spark)
    root = scratch_root(spark).removeprefix("file:")

    def tables():
        return {d for d in os.listdir(root) if d.startswith(("rollup", "members", "names"))}

    before = tables()
    cpu, mem, disk = facts_of(spark)
    with scope(spark):
        assert M.split(cpu, "host").count() and R.client_report(cpu, S.CPU_FAMILY, exact_scale=2).count()
        assert R.overall_report(cpu, mem, disk, exact_scale=2).count() and tables() > before
    assert tables() == before
    R.write_reports(cpu, mem, disk, tempfile.mkdtemp(prefix="fleetscope-reports-"), exact_scale=2)
    assert tables() == before
    with pytest.raises(Exception):  # the last write fails: a file stands where its folder would be
        path = tempfile.mkdtemp(prefix="fleetscope-reports-") + "/file"
        open(path, "w").close()
        R.write_reports(cpu, mem, disk, path, exact_scale=2)
    assert tables() == before
    M.split(cpu, "client").count()
    assert tables() > before
    release(spark)
    assert tables() == before
