"""Properties: substring join == contains; shares sum to one; position mode."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetscope import schema as S
from fleetscope.operators import membership as M
from fleetscope.operators import shares as W
from fleetscope.plans import fixtures as X
from tests.conftest import SF_SMALL

names_st = st.lists(st.text(alphabet="ab-c1", min_size=0, max_size=7), min_size=1, max_size=8)


def brute_client_members(names):
    keys = {n[:3] for n in names}
    return {(n, k) for n in names for k in keys if k in n}


def brute_host_members(names):
    cm = brute_client_members(names)
    hosts = {(c, n[4:5]) for n, c in cm}
    return {(n, c, h) for n, c in cm for (c2, h) in hosts if c2 == c and h in n}


@settings(max_examples=15, deadline=None)
@given(names_st)
def test_substring_join_equals_contains(spark, names):
    df = spark.createDataFrame([(n,) for n in names], f"{S.SERVER} string")
    cm = {(r.server_name, r.client) for r in M.client_members(df).collect()}
    assert cm == brute_client_members(set(names))
    hm = {(r.server_name, r.client, r.host) for r in M.host_members(df).collect()}
    assert hm == brute_host_members(set(names))


def test_host_shares_sum_to_one(spark):
    df = X.load_metrics(spark, SF_SMALL, S.CPU_FAMILY)
    sums = (W.host_share(df, S.CPU, "sum", exact_scale=2).groupBy("client")
            .agg(F.sum("share").alias("t")).collect())
    assert sums and all(math.isclose(r.t, 1.0, rel_tol=1e-12) for r in sums)


def test_client_shares_sum_to_one(spark):
    df = X.load_metrics(spark, SF_SMALL, S.CPU_FAMILY)
    (row,) = W.client_share(df, exact_scale=2).agg(F.sum("share").alias("t")).collect()
    assert math.isclose(row.t, 1.0, rel_tol=1e-12)


def test_position_mode_keeps_each_row_once(spark):
    df = X.load_metrics(spark, SF_SMALL, S.CPU_FAMILY)
    n = df.where(F.col(S.SERVER).isNotNull()).count()
    assert M.split(df, "host", "position").count() == n


def test_contains_includes_position(spark):
    df = X.load_metrics(spark, SF_SMALL, S.CPU_FAMILY)
    pos = M.host_members(df, "position")
    con = M.host_members(df, "contains")
    assert pos.join(con, [S.SERVER, "client", "host"], "left_anti").count() == 0


def test_exact_mode_is_partition_independent(spark):
    from fleetscope.operators import profiles as P

    df = X.load_metrics(spark, SF_SMALL, S.CPU_FAMILY)
    a = {tuple(r) for r in P.profile(df, S.CPU, "hourly", exact_scale=2).collect()}
    b = {tuple(r) for r in P.profile(df.repartition(7), S.CPU, "hourly", exact_scale=2).collect()}
    assert a == b


def test_materialized_rollup_gives_same_profiles(spark):
    from fleetscope.operators import profiles as P

    df = X.load_metrics(spark, SF_SMALL, S.CPU_FAMILY)
    for section in ("hourly", "weekly"):
        a = {tuple(r) for r in P.profile(df, S.CPU, section, exact_scale=2).collect()}
        b = {tuple(r) for r in P.profile(df, S.CPU, section, exact_scale=2,
                                         materialize_rollup=True).collect()}
        assert a == b
    a = {tuple(r) for r in W.host_share(df, S.CPU, "sum", exact_scale=2).collect()}
    b = {tuple(r) for r in W.host_share(df, S.CPU, "sum", exact_scale=2,
                                        materialize_rollup=True).collect()}
    assert a == b


pairs_st = st.lists(st.tuples(st.text(alphabet="ab-c", min_size=0, max_size=6),
                              st.one_of(st.none(), st.text(alphabet="cd:_", min_size=0, max_size=3))),
                    min_size=1, max_size=8)


def brute_disk_members(pairs):
    hm = brute_host_members({n for n, _ in pairs})
    rows = [(n, d, c, h) for n, d in pairs if d is not None for (n2, c, h) in hm if n2 == n]
    keys = {(c, h, d[:1]) for n, d, c, h in rows}
    return {(n, d, c, h, k) for n, d, c, h in rows for (c2, h2, k) in keys
            if (c2, h2) == (c, h) and k in d}


@settings(max_examples=15, deadline=None)
@given(pairs_st)
def test_disk_substring_join_equals_contains(spark, pairs):
    df = spark.createDataFrame(pairs, f"{S.SERVER} string, {S.DISK} string")
    got = {tuple(r) for r in M.disk_members(df).select(
        S.SERVER, S.DISK, "client", "host", "disk").collect()}
    assert got == brute_disk_members(set(pairs))


def test_hot_server_profile_is_exact(spark):
    """One server with most of the rows: results equal a brute-force mean."""
    from fleetscope.operators import profiles as P
    from tests.helpers import table

    rows = [("acm-a001", f"2024-01-01 {h:02d}:00:00", "_Total", "c:", float(i % 97) / 4)
            for i in range(3000) for h in (i % 24,)]
    rows += [("bet-b002", "2024-01-01 05:00:00", "_Total", "c:", 1.25),
             ("cor-c003", "2024-01-01 05:00:00", "_Total", "c:", 2.5)]
    df = table(spark, rows).repartition(6)
    got = {(r.client, r.host, r.x): r.y for r in P.profile(df, S.CPU, "hourly", exact_scale=2).collect()}
    from collections import defaultdict
    acc = defaultdict(list)
    for name, ts, _, _, v in rows:
        hour = int(ts[11:13])
        for c in ("acm", "bet", "cor"):
            if c in name:
                for h in {n[4:5] for n, *_ in rows if c in n}:
                    if h in name:
                        acc[(c, h, hour)].append(v)
    want = {k: sum(round(v * 100) for v in vs) / 100 / len(vs) for k, vs in acc.items()}
    assert got == want
