"""Plan checks: no nested-loop or cartesian joins, no Python in the plans, column
pruning reaches the scan, the facts are scanned once, shares carry no arrays, and
queries that write nothing run no action while their plan is built."""

import pytest

from fleetscope.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

# queries that are one lazy plan; the others write an intermediate table (or their result) first
LAZY = {"scan_metrics", "sql_view_scan", "cached_scan", "client_key", "host_key", "disk_key",
        "project_metric", "scalar_date_parts", "report_titles", "filter_client", "filter_host",
        "filter_disk", "filter_total", "filter_hour", "distinct_clients", "distinct_hosts"}
# queries that need one pass over the facts
ONE_SCAN = ["cpu_hourly", "cpu_weekly", "cpu_monthly", "mem_hourly", "mem_weekly", "mem_monthly",
            "disk_writes_hourly", "disk_reads_hourly", "cpu_total_usage", "cpu_host_sum",
            "mem_host_avg", "disk_host_avg", "cpu_client_sum", "cpu_host_share", "mem_host_share",
            "disk_host_share", "cpu_client_share", "distinct_hours", "distinct_weekdays",
            "distinct_monthdays", "distinct_disks", "distinct_disks_client", "client_report_cpu",
            "client_report_mem", "client_report_disk"]
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_enumeration_or_python(spark, name):
    plan = physical(QUERIES[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


@pytest.mark.parametrize("name", ["cpu_hourly", "cpu_host_share", "cpu_client_share",
                                  "distinct_hosts", "split_host"])
def test_cpu_queries_do_not_read_props(spark, name):
    plan = physical(QUERIES[name](spark, SF_SMALL))
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert scans
    for line in scans:
        schema = line.split("ReadSchema:")[1]
        assert "props" not in schema and "event_type" not in schema


@pytest.mark.parametrize("name", sorted(LAZY))
def test_building_runs_no_job(spark, name):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    QUERIES[name](spark, SF_SMALL)
    after = set(tracker.getJobIdsForGroup(None))
    assert after == before, f"{name} ran a job while building its plan"


@pytest.fixture
def written(monkeypatch):
    """Plans of the intermediate tables a query writes."""
    from fleetscope.plans import reports
    from fleetscope.sources import scratch

    plans, real = [], scratch.materialize_all

    def record(dfs):
        plans.extend(physical(df) for df in dfs.values())
        return real(dfs)

    monkeypatch.setattr(scratch, "materialize_all", record)
    monkeypatch.setattr(reports, "materialize_all", record)
    return plans


def fact_scans(plan):
    return [line for line in plan.splitlines() if "FileScan" in line and "events.parquet" in line]


@pytest.mark.parametrize("name", ONE_SCAN)
def test_facts_are_scanned_once(spark, written, name):
    df = QUERIES[name](spark, SF_SMALL)
    plans = [*written, physical(df)]
    assert sum(len(fact_scans(p)) for p in plans) == 1, plans


@pytest.mark.parametrize("name", ["cpu_hourly", "mem_weekly", "disk_writes_hourly",
                                  "cpu_host_sum", "cpu_client_sum", "distinct_hours"])
def test_facts_are_combined_map_side_before_any_shuffle(spark, written, name):
    """Skew safety: a partial aggregate stands between the facts' scan and the first
    shuffle, so a hot server ships one row per task and bucket."""
    QUERIES[name](spark, SF_SMALL)
    (plan,) = [p for p in written if fact_scans(p)]
    lines = plan.splitlines()
    (scan,) = [i for i, line in enumerate(lines) if "FileScan" in line]
    above = lines[:scan]
    exchange = max(i for i, line in enumerate(above) if "Exchange" in line)
    assert any("HashAggregate" in line and ("partial_" in line or "functions=[]" in line)
               for line in above[exchange:]), plan


@pytest.mark.parametrize("name", ["cpu_client_share", "cpu_host_share", "mem_host_share",
                                  "disk_host_share"])
def test_shares_gather_no_arrays_and_use_no_single_partition_window(spark, name):
    plan = physical(QUERIES[name](spark, SF_SMALL))
    main = plan.split("Subquery:")[0]
    assert "collect_list" not in plan
    for i, line in enumerate(main.splitlines()):
        if "Window" in line and "[" in line:
            assert "client" in line, line  # partitioned by client
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_a_million_client_shares_take_seconds(spark):
    import time

    from pyspark.sql import functions as F

    from fleetscope.operators import shares as W

    sizes = spark.range(1_000_000).select(F.col("id").cast("string").alias("client"),
                                          F.col("id").cast("double").alias("size"),
                                          (F.col("id") * 100).alias(W.UNITS))
    t0 = time.time()
    (n, total), = W.share_of_fleet(sizes, "sum", 2).agg(F.count("*"), F.sum("share")).collect()
    assert n == 1_000_000 and abs(total - 1) < 1e-9 and time.time() - t0 < 30


def test_candidates_have_the_lengths_of_the_keys(spark):
    from pyspark.sql import functions as F

    from fleetscope import schema as S
    from fleetscope.operators import membership as M

    names = [f"c{i % 7:02d}-h{i:04d}" for i in range(200)]
    grams = M._client_grams(spark.createDataFrame([(n,) for n in names], f"{S.SERVER} string"))
    per = grams.where("NOT is_key").groupBy(S.SERVER).agg(F.count("*").alias("n"), F.min(F.length("g")).alias("l"))
    assert all(r["l"] == 3 and r["n"] <= len(r[0]) - 2 for r in per.collect())
    short = M._client_grams(spark.createDataFrame([("ab",), ("",), ("abc-d",)], f"{S.SERVER} string"))
    assert {len(r["g"]) for r in short.where("NOT is_key").collect()} == {0, 2, 3}
