"""The one-pass operators equal the reference's per-key loop (test-only loop)."""

import math

from pyspark.sql import functions as F

from fleetscope import schema as S
from fleetscope.operators import profiles as P
from fleetscope.operators import shares as W
from fleetscope.plans import fixtures as X
from tests.conftest import SF_SMALL


def loop_profiles(df, part):
    """Filter per client, per host, one aggregate per host: the reference's shape."""
    out = {}
    clients = [r[0] for r in df.select(F.substring(S.SERVER, 1, 3)).distinct().collect()]
    for c in clients:
        if c is None:
            continue
        cdf = df.where(F.col(S.SERVER).contains(c))
        hosts = sorted(r[0] for r in cdf.select(F.substring(S.SERVER, 5, 1)).distinct().collect())
        for h in hosts:
            hdf = cdf.where(F.col(S.SERVER).contains(h))
            for r in hdf.groupBy(part(F.col(S.TIME)).alias("x")).agg(F.avg(S.CPU).alias("y")).collect():
                if r.x is not None:
                    out[(c, h, r.x)] = r.y
    return out


def loop_host_sums(df):
    out = {}
    clients = [r[0] for r in df.select(F.substring(S.SERVER, 1, 3)).distinct().collect()]
    for c in clients:
        cdf = df.where(F.col(S.SERVER).contains(c))
        hosts = sorted(r[0] for r in cdf.select(F.substring(S.SERVER, 5, 1)).distinct().collect())
        for h in hosts:
            out[(c, h)] = cdf.where(F.col(S.SERVER).contains(h)).agg(F.sum(S.CPU)).first()[0]
    return out


def test_hourly_equals_loop(spark):
    df = X.load_metrics(spark, SF_SMALL, S.CPU_FAMILY).cache()
    one_pass = {(r.client, r.host, r.x): r.y for r in P.profile(df, S.CPU, "hourly").collect()}
    looped = loop_profiles(df, F.hour)
    assert one_pass.keys() == looped.keys()
    assert all(math.isclose(one_pass[k], looped[k], rel_tol=1e-12) for k in looped)
    df.unpersist()


def test_host_sums_equal_loop(spark):
    df = X.load_metrics(spark, SF_SMALL, S.CPU_FAMILY).cache()
    one_pass = {(r.client, r.host): r.size for r in W.host_sizes(df, S.CPU, "sum").collect()}
    looped = loop_host_sums(df)
    assert one_pass.keys() == looped.keys()
    assert all(math.isclose(one_pass[k], looped[k], rel_tol=1e-12) for k in looped)
    df.unpersist()
