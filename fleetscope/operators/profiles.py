"""Usage profiles: mean of a metric by hour of day, day of week, day of month
(A1-A8), and total processor time (A9).

The reference runs one Spark action per (client, host, x-value).  Here the
whole fleet is one plan in two steps:

1. ``rollup``: partial sums and counts per ``(server_name[, disk_name])`` and
   bucket.  Spark aggregates map-side before the shuffle, so even a server with
   a third of all rows ships one small row per task and bucket.  Several
   buckets (hourly, weekly, monthly, whole period, ``_Total`` rows) come from
   one scan: each row is expanded once per bucket before the aggregation.
2. ``merge``: join the rollup (``names x buckets`` rows, independent of the fact
   count) to the membership table on the name, and merge the partial sums per
   ``(client, host[, disk], bucket)``.  The mean is one division at the end.

Membership is derived from all rows (also those with NULL time or metric), as
the reference does; buckets whose date part is NULL are dropped (no x-value
can select them).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope import schema as S
from fleetscope.functions import arith as A
from fleetscope.functions import keys as K
from fleetscope.operators import membership as M
from fleetscope.sources.scratch import materialize

LEVEL_KEYS = {"client": ["client"], "host": ["client", "host"],
              "disk": ["client", "host", "disk"]}


@dataclass(frozen=True)
class Bucket:
    """A rollup section: its x-value and which rows it keeps (None: all)."""

    section: str
    x: Column
    keep: Column | None = None


def date_bucket(section: str) -> Bucket:
    if section not in K.SECTION_PARTS:
        raise ValueError(f"unknown section {section!r}; one of {sorted(K.SECTION_PARTS)}")
    return Bucket(section, K.date_part(K.SECTION_PARTS[section]))


def whole_bucket(section: str = "all", keep: Column | None = None) -> Bucket:
    """One bucket over the whole period (x = 0), optionally on some rows only."""
    return Bucket(section, F.lit(0), keep)


def name_keys(level: str) -> list[str]:
    return [S.SERVER, S.DISK] if level == "disk" else [S.SERVER]


def members_for(df: DataFrame, level: str, match: str) -> DataFrame:
    if level == "client":
        return M.client_members(df, match)
    if level == "host":
        return M.host_members(df, match)
    if level == "disk":
        return M.disk_members(df, match)
    raise ValueError(f"level must be client, host or disk, got {level!r}")


def rollup(facts: DataFrame, metrics: Sequence[str], buckets: Sequence[Bucket],
           names: Sequence[str] = (S.SERVER,), exact_scale: int | None = None) -> DataFrame:
    """``(names..., section, x, s0, n0, s1, n1, ...)``: partial sums per name and bucket."""
    names = list(names)
    if len(buckets) == 1 and buckets[0].keep is None:
        b = buckets[0]
        df = facts.select(*names, F.lit(b.section).alias("section"), b.x.alias("x"), *metrics)
    else:
        arr = F.array(*[F.struct(F.lit(b.section).alias("section"), b.x.cast("int").alias("x"),
                                 (F.lit(True) if b.keep is None else F.coalesce(b.keep, F.lit(False)))
                                 .alias("keep"))
                        for b in buckets])
        df = facts.select(*names, F.inline(arr), *metrics).where(F.col("keep")).drop("keep")
    aggs = []
    for i, m in enumerate(metrics):
        aggs += [A.partial_sum(m, exact_scale).alias(f"s{i}"), F.count(m).alias(f"n{i}")]
    return df.where(F.col("x").isNotNull()).groupBy(*names, "section", "x").agg(*aggs)


def merge(rolled: DataFrame, members: DataFrame, level: str, n_metrics: int,
          by_x: bool = True) -> DataFrame:
    """Join a rollup to membership and merge partial sums per member and bucket."""
    names = [c for c in (S.SERVER, S.DISK) if c in members.columns]
    group = LEVEL_KEYS[level] + (["section", "x"] if by_x else ["section"])
    return (rolled.join(members, names, "inner").groupBy(*group)
            .agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(n_metrics)],
                 *[F.sum(f"n{i}").alias(f"n{i}") for i in range(n_metrics)]))


def means(merged: DataFrame, n_metrics: int, exact_scale: int | None) -> list[Column]:
    return [A.mean(f"s{i}", f"n{i}", exact_scale).alias("y" if i == 0 else f"y{i + 1}")
            for i in range(n_metrics)]


def profiles(facts: DataFrame, metrics: Sequence[str], sections: Sequence[str] = ("hourly",),
             level: str = "host", match: str = "contains", exact_scale: int | None = None,
             row_filter: Column | None = None, members: DataFrame | None = None,
             rolled: DataFrame | None = None, materialize_rollup: bool = False) -> DataFrame:
    """``(client, host[, disk], section, x, y[, y2...])`` for every member.

    ``metrics`` gives the columns averaged into ``y``, ``y2``, ... (the disk
    charts draw the mean of the AVG column and the mean of the MAX column).
    ``row_filter`` restricts the rows averaged (e.g. one processor) without
    changing who belongs to which key.  ``members`` / ``rolled`` may pass a
    precomputed membership table and rollup (as the reports do).

    By default the plan scans the facts for the rollup and the name column once
    more for membership.  ``materialize_rollup=True`` scans the facts once: the
    rollup (plus one whole-period row per name, so names whose rows all lack a
    time still define keys) is written to the scratch folder and membership is
    derived from it - the better trade at fleet scale, where the extra name
    scan costs more than writing ``names x buckets`` rows.
    """
    names_src = facts
    if rolled is None:
        buckets = [date_bucket(s) for s in sections]
        if row_filter is not None:
            buckets = [Bucket(b.section, b.x, row_filter) for b in buckets]
        if materialize_rollup:
            buckets.append(whole_bucket("names"))
        rolled = rollup(facts, metrics, buckets, name_keys(level), exact_scale)
        if materialize_rollup:
            names_src = materialize(rolled, "rollup-profile")
            rolled = names_src.where(F.col("section").isin(list(sections)))
    else:
        rolled = rolled.where(F.col("section").isin(list(sections)))
    if members is None:
        members = members_for(names_src, level, match)
    merged = merge(rolled, members, level, len(metrics))
    group = LEVEL_KEYS[level] + ["section", "x"]
    return merged.select(*group, *means(merged, len(metrics), exact_scale))


def profile(facts: DataFrame, metric: str | Sequence[str], section: str = "hourly",
            level: str = "host", match: str = "contains", exact_scale: int | None = None,
            row_filter: Column | None = None, materialize_rollup: bool = False) -> DataFrame:
    """One chart's series for every member: ``(client, host[, disk], x, y[, y2])``.

    The weekly profile also carries ``day_name`` (``dayofweek`` 1 = Sunday is
    labelled ``Sun``).
    """
    metrics = [metric] if isinstance(metric, str) else list(metric)
    out = profiles(facts, metrics, [section], level, match, exact_scale, row_filter,
                   materialize_rollup=materialize_rollup).drop("section")
    if section == "weekly":
        cols = out.columns
        i = cols.index("x") + 1
        out = out.select(*cols[:i], K.day_label("x").alias("day_name"), *cols[i:])
    return out


def total_usage(facts: DataFrame, metric: str = S.CPU, match: str = "contains",
                exact_scale: int | None = None, daily: DataFrame | None = None,
                materialize_rollup: bool = False) -> DataFrame:
    """Total processor time per host: the sum of the host's daily means.

    ``(client, host, total_usage)``.  The daily means (at most 31 per host) are
    summed in ascending order, so the total does not depend on partitioning.
    ``daily`` may pass profile rows; only those of the monthly section count.
    """
    if daily is None:
        daily = profiles(facts, [metric], ["monthly"], "host", match, exact_scale,
                         materialize_rollup=materialize_rollup)
    y = F.when(F.col("section") == "monthly", F.col("y"))
    return (daily.groupBy("client", "host")
            .agg(A.ordered_sum(F.collect_list(y)).alias("total_usage")))
