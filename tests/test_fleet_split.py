"""The fleet-wide disk split without expansion, one fetched chart, and reports of a period."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fleetscope import schema as S
from fleetscope.__main__ import main
from fleetscope.operators import membership as M
from fleetscope.plans import catalog as C
from fleetscope.plans import fixtures as X
from fleetscope.plans import reports as R
from fleetscope.sources import ingest as I
from fleetscope.sources import readers as RD
from tests.conftest import SF_SMALL
from tests.helpers import edge_table, table

COLS = ["client", "disk", S.SERVER, S.DISK, S.WRITES_AVG]


def sorted_rows(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=str)


@pytest.mark.parametrize("match", ["contains", "position"])
@pytest.mark.parametrize("source", ["edge", "fixture", "odd"])
def test_the_expanded_view_is_the_split(spark, match, source):
    odd = [("acm-a1", "", 1.0), ("acm-a1", "cd:", 2.0), ("bet-b1", "d", 3.0), ("x", "c", 4.0), (None, "dc", 5.0), ("bet-b1", None, 6.0)]
    df = {"edge": lambda: edge_table(spark), "fixture": lambda: X.load_metrics(spark, SF_SMALL, S.DISK_FAMILY),
          "odd": lambda: table(spark, [(s, "2024-01-01 10:00:00", "0", d, v) for s, d, v in odd + odd[:2]])}[source]()
    facts, members = M.factor_fleet_disks(df, match)
    assert sorted_rows(M.expand_fleet_disks(facts, members)) == sorted_rows(M.split_fleet_disks(df, match))


def test_the_output_does_not_grow_with_the_clients(spark):
    def size(clients):
        rows = [(f"{c:03d}-a1", "2024-01-01 10:00:00", "0", "c:", 1.0) for c in range(clients)] * (60 // clients)
        df = table(spark, rows)
        facts, members = M.factor_fleet_disks(df)
        return facts.count(), members.count(), M.split_fleet_disks(df).count()

    assert size(3) == (60, 3, 180) and size(30) == (60, 30, 1800)


def test_empty_facts(spark):
    facts, members = M.factor_fleet_disks(edge_table(spark).limit(0))
    assert facts.collect() == [] and members.collect() == [] and M.expand_fleet_disks(facts, members).collect() == []


def test_the_facts_are_not_shuffled(spark):
    facts, _ = M.factor_fleet_disks(X.load_metrics(spark, SF_SMALL, S.DISK_FAMILY))
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_a_chart_is_fetched_whole_and_in_order(spark):
    report = R.client_report(X.load_metrics(spark, SF_SMALL, S.CPU_FAMILY), S.CPU_FAMILY, exact_scale=2)
    got = [tuple(r) for r in C.chart_points(spark, SF_SMALL).collect()]
    want = report.where((F.col("client") == C.FILTER_CLIENT) & (F.col("host") == C.FILTER_HOST) & (F.col("section") == C.FILTER_SECTION))
    assert got == [tuple(r) for r in want.select("x", "x_label", "y", "y2").orderBy("x").collect()]
    assert len(got) == 7 and got[0][1] == "Sun"


def test_reports_of_a_period(spark):
    wide = X.metrics_from_events(X.read_events(spark, SF_SMALL))
    base = tempfile.mkdtemp(prefix="fleetscope-period-")
    for fam in (S.CPU_FAMILY, S.MEM_FAMILY, S.DISK_FAMILY):
        I.write_landing(X.family_table(wide, fam), f"{base}/{fam.name}", fmt="parquet")
    cpu = RD.read_metrics(spark, f"{base}/cpu", S.CPU_FAMILY)
    days = [str(r[0]) for r in cpu.select(F.to_date(S.TIME)).distinct().orderBy(F.to_date(S.TIME)).collect() if r[0]]
    since, until = days[len(days) // 3], days[2 * len(days) // 3]
    want = R.client_report(cpu.where(F.to_date(S.TIME).between(since, days[2 * len(days) // 3 - 1])), S.CPU_FAMILY, exact_scale=2)
    args = ["--cpu", f"{base}/cpu", "--mem", f"{base}/mem", "--disk", f"{base}/disk", "--exact-scale", "2",
            "--since", since, "--until", until]
    plain = main([*args, "--out", f"{base}/plain"])
    loaded = main([*args, "--out", f"{base}/loaded", "--ingest", f"{base}/tables"])
    keys = ["client", "host", "section", "x", "y"]
    rows = lambda df: sorted((tuple(r) for r in df.select(*keys).collect()), key=str)
    assert rows(want) == rows(spark.read.parquet(plain["cpu"])) == rows(spark.read.parquet(loaded["cpu"]))
    assert rows(want) != rows(R.client_report(cpu, S.CPU_FAMILY, exact_scale=2))
    with pytest.raises(SystemExit):
        main([*args, "--out", os.path.join(base, "x"), "--since", "soon"])

