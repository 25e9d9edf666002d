
import math

from pyspark.sql import functions as F

from fleetscope import schema as S
from fleetscope.operators import membership as M
from fleetscope.operators import profiles as P
from fleetscope.operators import shares as W
from tests.helpers import EXPECTED_HOST_MEMBERS, edge_table, table


def test_host_members_contains(spark):
    hm = M.host_members(edge_table(spark))
    got = {(r.client, r.host, r.server_name) for r in hm.collect()}
    assert got == EXPECTED_HOST_MEMBERS


def test_clients_drop_null_name(spark):
    got = sorted(r.client for r in M.clients(edge_table(spark)).collect())
    assert got == ["acm", "bet"]


def test_short_name_gives_empty_host(spark):
    hosts = {(r.client, r.host) for r in M.hosts(edge_table(spark)).collect()}
    assert ("bet", "") in hosts


def test_null_disk_dropped(spark):
    dm = M.disk_members(edge_table(spark))
    assert dm.where(F.col(S.DISK).isNull()).count() == 0
    keys = {(r.client, r.host, r.disk) for r in M.disks(edge_table(spark)).collect()}
    assert all(k[2] is not None for k in keys)
    # bet's only named disk rows come from bet-acm7 (c:)
    assert ("bet", "a", "c") in keys


def test_empty_name_is_a_client_of_everything(spark):
    df = table(spark, [("", "2024-01-01 00:00:00", "_Total", "c:", 1.0),
                       ("xyz-a1", "2024-01-01 00:00:00", "_Total", "c:", 2.0)])
    cm = {(r.client, r.server_name) for r in M.client_members(df).collect()}
    assert ("", "") in cm and ("", "xyz-a1") in cm and ("xyz", "xyz-a1") in cm


def test_position_mode_partitions_rows(spark):
    df = edge_table(spark)
    pos = {(r.client, r.host, r.server_name) for r in M.host_members(df, "position").collect()}
    assert pos == {("acm", "b", "acm-b001"), ("acm", "a", "acm-a002"),
                   ("bet", "", "bet"), ("bet", "a", "bet-acm7")}
    assert pos <= EXPECTED_HOST_MEMBERS


def test_null_time_dropped_from_profile_but_keeps_keys(spark):
    df = table(spark, [("abc-x1", None, "_Total", "c:", 5.0),
                       ("zzz-abc", "2024-01-01 03:00:00", "_Total", "c:", 7.0)])
    prof = P.profile(df, S.CPU, "hourly").collect()
    # abc is a client only because of the NULL-time row; zzz-abc belongs to it
    got = {(r.client, r.host, r.x, r.y) for r in prof}
    assert ("abc", "a", 3, 7.0) in got
    assert all(r.x is not None for r in prof)


def test_null_time_keys_survive_materialized_rollup(spark):
    df = table(spark, [("abc-x1", None, "_Total", "c:", 5.0),
                       ("zzz-abc", "2024-01-01 03:00:00", "_Total", "c:", 7.0)])
    got = {(r.client, r.host, r.x, r.y)
           for r in P.profile(df, S.CPU, "hourly", materialize_rollup=True).collect()}
    assert ("abc", "a", 3, 7.0) in got


def test_nan_is_skipped_like_null(spark):
    df = table(spark, [("acm-a1", "2024-01-01 03:00:00", "_Total", "c:", float("nan")),
                       ("acm-a1", "2024-01-01 03:30:00", "_Total", "c:", None),
                       ("acm-a1", "2024-01-01 03:45:00", "_Total", "c:", 4.0)])
    (row,) = [r for r in P.profile(df, S.CPU, "hourly").collect() if r.host == "a"]
    assert row.y == 4.0


def test_malformed_time_is_null(spark):
    df = table(spark, [("acm-a1", "not a time", "_Total", "c:", 1.0),
                       ("acm-a1", "2024-01-02 05:00:00", "_Total", "c:", 3.0)])
    rows = P.profile(df, S.CPU, "hourly").collect()
    assert {(r.x, r.y) for r in rows if r.host == "a"} == {(5, 3.0)}


def test_same_day_of_two_months_is_one_bucket(spark):
    df = table(spark, [("acm-a1", "2024-01-05 00:00:00", "_Total", "c:", 2.0),
                       ("acm-a1", "2024-02-05 00:00:00", "_Total", "c:", 4.0)])
    rows = [r for r in P.profile(df, S.CPU, "monthly").collect() if r.host == "a"]
    assert [(r.x, r.y) for r in rows] == [(5, 3.0)]


def test_weekday_numbering_and_label(spark):
    # 2024-01-07 is a Sunday
    df = table(spark, [("acm-a1", "2024-01-07 12:00:00", "_Total", "c:", 1.0)])
    (row,) = [r for r in P.profile(df, S.CPU, "weekly").collect() if r.host == "a"]
    assert (row.x, row.day_name) == (1, "Sun")


def test_total_usage_is_sum_of_daily_means(spark):
    df = table(spark, [("acm-a1", "2024-01-01 00:00:00", "_Total", "c:", 2.0),
                       ("acm-a1", "2024-01-01 01:00:00", "_Total", "c:", 4.0),
                       ("acm-a1", "2024-01-02 00:00:00", "_Total", "c:", 10.0)])
    rows = {(r.client, r.host): r.total_usage for r in P.total_usage(df).collect()}
    assert rows[("acm", "a")] == 3.0 + 10.0


def test_zero_total_share_is_null(spark):
    df = table(spark, [("acm-a1", "2024-01-01 00:00:00", "_Total", "c:", 0.0),
                       ("acm-b1", "2024-01-01 00:00:00", "_Total", "c:", 0.0)])
    rows = W.host_share(df, S.CPU, "sum").collect()
    assert rows and all(r.share is None and r.pct_label is None for r in rows)


def test_cpu_share_counts_double_membership(spark):
    rows = {(r.client, r.host): r.size
            for r in W.host_sizes(edge_table(spark), S.CPU, "sum").collect()}
    # acm-b001 (10) and bet-acm7 (50) are in both of acm's hosts
    assert rows[("acm", "a")] == 10 + 20 + 50
    assert rows[("acm", "b")] == 10 + 50


def test_client_sum_only_total_processor(spark):
    df = table(spark, [("acm-a1", "2024-01-01 00:00:00", "_Total", "c:", 5.0),
                       ("acm-a1", "2024-01-01 00:00:00", "0", "c:", 7.0),
                       ("bet-a1", "2024-01-01 00:00:00", "1", "c:", 9.0)])
    rows = {r.client: r.size for r in W.client_sizes(df).collect()}
    assert rows == {"acm": 5.0, "bet": None}


def test_mean_of_max_column(spark):
    df = table(spark, [("acm-a1", "2024-01-01 00:00:00", "_Total", "c:", 1.0),
                       ("acm-a1", "2024-01-01 00:30:00", "_Total", "c:", 3.0)])
    rows = P.profile(df, [S.WRITES_AVG, S.WRITES_MAX], "hourly", "disk").collect()
    (r,) = [r for r in rows if r.host == "a" and r.disk == "c"]
    assert r.y == 2.0 and r.y2 == 2.0 and not math.isnan(r.y)


def test_fleet_disk_split_takes_rows_of_every_client(spark):
    """Q18: a client's disk keys come from its own rows, its disk rows from the fleet."""
    df = table(spark, [("acm-a1", "2024-01-01 00:00:00", "_Total", "c:", 1.0),
                       ("bet-b1", "2024-01-01 00:00:00", "_Total", "c:", 2.0),
                       ("bet-b1", "2024-01-01 00:00:00", "_Total", "d:", 3.0)])
    rows = {(r.client, r.disk, r.server_name, r.disk_name)
            for r in M.split_fleet_disks(df).collect()}
    # acm has only disk c, but gets bet's c: row too; it never gets d:
    assert ("acm", "c", "bet-b1", "c:") in rows
    assert not any(c == "acm" and d == "d" for c, d, _, _ in rows)
    assert ("bet", "d", "bet-b1", "d:") in rows
