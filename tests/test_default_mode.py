"""The default arithmetic (plain sum and avg) against DuckDB on values with many decimals, and
exact mode refusing what it can't represent."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from fleetscope import schema as S
from fleetscope.operators import profiles as P
from fleetscope.operators import shares as W
from fleetscope.plans import reports as R
from fleetscope.plans import fixtures as X
from fleetscope.plans import oracle as O
from tests.conftest import SF_SMALL

NOISE = "* 0.1234567 + 0.00098765"


def noisy(spark, family):
    wide = X.load_metrics(spark, SF_SMALL)
    return wide.select(*[F.expr(f"{c} {NOISE}").alias(c) if c in S.METRIC_COLUMNS else F.col(c) for c in family.columns])


def oracle(sql):
    """The query's SQL with noisy metrics and without units."""
    con = duckdb.connect()
    con.sql(f"CREATE VIEW raw AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    con.sql("CREATE VIEW events AS SELECT * FROM raw")
    facts = O._F.split("AS (", 1)[1].rsplit(")", 1)[0]
    cols = ", ".join(f"{c} {NOISE} AS {c}" if c in S.METRIC_COLUMNS else c
                     for c in ("server_name", "hr_time", "processor", "disk_name", "cpu_pct", "mem_pct",
                               "disk_writes_avg", "disk_writes_max", "disk_reads_avg", "disk_reads_max"))
    con.sql(f"CREATE VIEW f AS SELECT {cols} FROM ({facts})")
    return con.sql("WITH " + O._MEMBERS.strip() + " " + sql).fetchall()


def close(got, want, keys):
    a, b = ({tuple(r)[:keys]: tuple(r)[keys:] for r in rows} for rows in (got, want))
    assert a.keys() == b.keys() and len(a) == len(got)
    for k in a:
        assert all(x == y or math.isclose(x, y, rel_tol=1e-9) for x, y in zip(a[k], b[k], strict=True)), k


@pytest.mark.parametrize("section,part", [("hourly", "hour(hr_time)"), ("weekly", "dayofweek(hr_time) + 1"),
                                          ("monthly", "day(hr_time)")])
def test_profiles(spark, section, part):
    got = P.profile(noisy(spark, S.MEM_FAMILY), S.MEM, section).drop("day_name").collect()
    close(got, oracle(f"SELECT client, host, {part}, avg(mem_pct) FROM f JOIN hm USING (server_name) "
                      f"WHERE hr_time IS NOT NULL GROUP BY ALL"), 3)


def test_disk_profile(spark):
    got = P.profile(noisy(spark, S.DISK_FAMILY), [S.READS_AVG, S.READS_MAX], "hourly", "disk").collect()
    close(got, oracle("SELECT client, host, disk, hour(hr_time), avg(disk_reads_avg), avg(disk_reads_max) "
                      "FROM f JOIN dm USING (server_name, disk_name) GROUP BY ALL"), 4)


@pytest.mark.parametrize("agg", ["sum", "avg"])
def test_host_shares(spark, agg):
    got = W.host_share(noisy(spark, S.CPU_FAMILY), S.CPU, agg).drop("pct_label").collect()
    close(got, oracle(f"SELECT client, host, size, size / sum(size) OVER (PARTITION BY client) FROM (SELECT client, host, "
                      f"{agg}(cpu_pct) AS size FROM f JOIN hm USING (server_name) GROUP BY ALL)"), 2)


def test_client_shares(spark):
    got = W.client_share(noisy(spark, S.CPU_FAMILY)).drop("pct_label").collect()
    close(got, oracle("SELECT client, size, size / sum(size) OVER () FROM (SELECT client, sum(cpu_pct) FILTER "
                      "(contains(processor, '_Total')) AS size FROM f JOIN cm USING (server_name) GROUP BY ALL)"), 1)


def test_total_usage(spark):
    got = P.total_usage(noisy(spark, S.CPU_FAMILY)).collect()
    close(got, oracle("SELECT client, host, sum(y) FROM (SELECT client, host, day(hr_time), avg(cpu_pct) AS y FROM f "
                      "JOIN hm USING (server_name) GROUP BY ALL) GROUP BY ALL"), 2)


def table(spark, values):
    rows = [("acm-a1", "_Total", float(v)) for v in values]
    df = spark.createDataFrame(rows, f"{S.SERVER} string, {S.PROCESSOR} string, {S.CPU} double")
    return df.withColumn(S.TIME, F.lit("2024-01-01 05:00:00").cast("timestamp_ntz"))


@pytest.mark.parametrize("bad", [0.004, 1.005, float("nan"), float("inf"), -float("inf"), 1e15])
def test_exact_scale_refuses_what_it_would_round(spark, bad):
    df = table(spark, [0.25, bad])
    with pytest.raises(Exception, match="not representable"):
        W.host_sizes(df, S.CPU, "sum", exact_scale=2).collect()
    with pytest.raises(Exception, match="not representable"):
        R.client_report(df, S.CPU_FAMILY, exact_scale=2, materialize_rollup=False).collect()


def test_default_mode_keeps_small_values(spark):
    (r,) = W.host_sizes(table(spark, [0.004] * 3), S.CPU, "avg").where("host = 'a'").collect()
    assert math.isclose(r["size"], 0.004)
    (r,) = W.host_sizes(table(spark, [0.29, 0.57, 57.29, 1e9 + 0.01, -3.1]), S.CPU, "sum", exact_scale=2).where("host = 'a'").collect()
    assert r["size"] == (29 + 57 + 5729 + 100000000001 - 310) / 100
