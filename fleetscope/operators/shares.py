"""Sizes and shares of a total.

A size is one number per host (or client): the sum of a metric over the host's
rows for CPU, the mean for memory and disk.  A share is the size divided by the
total of the sizes within the client (host shares) or the fleet (client
shares).  Sizes use the same rollup and merge as the profiles, with one
whole-period bucket.

Totals are never gathered into arrays.  A client's total is a window over its hosts,
of which there are as many as a one-character key allows; the fleet's total is one
aggregate (partial sums, then their sum), read as a scalar subquery.  With
``exact_scale`` the totals of sums add the integer units.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope import schema as S
from fleetscope.functions import arith as A
from fleetscope.operators import membership as M
from fleetscope.operators import profiles as P
from fleetscope.sources.scratch import materialize

AGGS = ("sum", "avg")
TOTAL_SECTION = "total_processor"
UNITS = "_units"


def size_of(s: str, n: str, agg: str, exact_scale: int | None) -> Column:
    if agg == "sum":
        return A.as_value(s, exact_scale)
    if agg == "avg":
        return A.mean(s, n, exact_scale)
    raise ValueError(f"agg must be one of {AGGS}, got {agg!r}")


def total_bucket(processor: str = S.TOTAL_PROCESSOR) -> P.Bucket:
    """Whole-period bucket over the rows of one processor (``_Total``)."""
    return P.whole_bucket(TOTAL_SECTION, F.col(S.PROCESSOR).contains(processor))


def _sizes(rolled: DataFrame, members: DataFrame, level: str, section: str,
           agg: str, exact_scale: int | None) -> DataFrame:
    """``(keys..., size, units)``: units is what totals of sums add up (NULL for means)."""
    merged = P.merge(rolled.where(F.col("section") == section), members, level, 1, by_x=False)
    units = F.col("s0") if agg == "sum" else F.lit(None).cast("double")
    return merged.select(*P.LEVEL_KEYS[level], size_of("s0", "n0", agg, exact_scale).alias("size"),
                         units.alias(UNITS))


def _host_sizes(facts: DataFrame | None, metric: str, agg: str, match: str, exact_scale: int | None,
                members: DataFrame | None, rolled: DataFrame | None, materialize_rollup: bool) -> DataFrame:
    names_src = facts
    if rolled is None:
        rolled = P.rollup(facts, [metric], [P.whole_bucket()], [S.SERVER], exact_scale)
        if materialize_rollup:
            rolled = names_src = materialize(rolled, "rollup-sizes")
    if members is None:
        members = M.host_members(names_src if names_src is not None else rolled, match)
    return _sizes(rolled, members, "host", "all", agg, exact_scale)


def host_sizes(facts: DataFrame | None, metric: str, agg: str = "sum", match: str = "contains",
               exact_scale: int | None = None, members: DataFrame | None = None,
               rolled: DataFrame | None = None, materialize_rollup: bool = False) -> DataFrame:
    """``(client, host, size)``: a metric's sum or mean over each host's rows.

    A row that belongs to two hosts of a client counts in both (reference
    behaviour), so host sizes of a client can add up to more than its rows.
    ``rolled`` may pass a rollup with an ``all`` section of this metric as ``s0``.
    ``materialize_rollup`` writes the per-name rollup first and derives
    membership from it (one fact scan instead of two; see ``profiles``).
    """
    return _host_sizes(facts, metric, agg, match, exact_scale, members, rolled,
                       materialize_rollup).drop(UNITS)


def _client_sizes(facts: DataFrame | None, metric: str, agg: str, match: str, exact_scale: int | None,
                  processor: str | None, members: DataFrame | None, rolled: DataFrame | None,
                  materialize_rollup: bool) -> DataFrame:
    section = "all" if processor is None else TOTAL_SECTION
    names_src = facts
    if rolled is None:
        buckets = [P.whole_bucket() if processor is None else total_bucket(processor)]
        if materialize_rollup:  # a row for every name, also those without the processor
            buckets.append(P.whole_bucket("names"))
        rolled = P.rollup(facts, [metric], buckets, [S.SERVER], exact_scale)
        if materialize_rollup:
            rolled = names_src = materialize(rolled, "rollup-client-sizes")
    if members is None:
        members = M.client_members(names_src if names_src is not None else rolled, match)
    sizes = _sizes(rolled, members, "client", section, agg, exact_scale)
    # a client with no rows on that processor still gets a (NULL) size
    return members.select("client").distinct().join(sizes, "client", "left")


def client_sizes(facts: DataFrame | None, metric: str = S.CPU, agg: str = "sum",
                 match: str = "contains", exact_scale: int | None = None,
                 processor: str | None = S.TOTAL_PROCESSOR,
                 members: DataFrame | None = None, rolled: DataFrame | None = None,
                 materialize_rollup: bool = False) -> DataFrame:
    """``(client, size)`` over each client's rows on one processor.

    Clients come from all rows; only the sum is restricted to rows whose
    ``processor`` contains ``processor`` (``None``: all rows).
    """
    return _client_sizes(facts, metric, agg, match, exact_scale, processor, members, rolled,
                         materialize_rollup).drop(UNITS)


def _with_share(sizes: DataFrame, total: Column) -> DataFrame:
    out = sizes.withColumn("share", A.share(F.col("size"), total)).drop(UNITS)
    return out.withColumn("pct_label", A.pct_label("share"))


def share_within_client(sizes: DataFrame, agg: str, exact_scale: int | None = None) -> DataFrame:
    """Add ``share`` = size / total of the client's sizes, and ``pct_label``.

    ``sizes`` has one row per host, so a window holds as many rows as a client has
    one-character host keys.  Exact sums add their units; other sizes add in
    ascending order, so the total does not depend on how rows are distributed.
    A zero or NULL total gives a NULL share.
    """
    client = Window.partitionBy("client")
    if agg == "sum" and exact_scale is not None:
        total = A.as_value(F.sum(UNITS).over(client), exact_scale)
        return _with_share(sizes, total)
    upto = client.orderBy(F.col("size").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    whole = upto.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = sizes.withColumn("_running", F.sum("size").over(upto))
    return _with_share(running.withColumn("_total", F.last("_running").over(whole)),
                       F.col("_total")).drop("_running", "_total")


def share_of_fleet(sizes: DataFrame, agg: str, exact_scale: int | None = None) -> DataFrame:
    """Add ``share`` = size / total over all rows of ``sizes``, and ``pct_label``.

    The total is one aggregate over the sizes; no row carries more than this one number.
    """
    if agg == "sum" and exact_scale is not None:
        total = sizes.agg(A.as_value(F.sum(UNITS), exact_scale).alias("total"))
    else:
        total = sizes.agg(F.sum("size").alias("total"))
    return _with_share(sizes, total.scalar())


def host_share(facts: DataFrame | None, metric: str, agg: str, match: str = "contains",
               exact_scale: int | None = None, members: DataFrame | None = None,
               rolled: DataFrame | None = None, materialize_rollup: bool = False) -> DataFrame:
    """``(client, host, size, share, pct_label)``."""
    return share_within_client(_host_sizes(facts, metric, agg, match, exact_scale, members, rolled,
                                           materialize_rollup), agg, exact_scale)


def client_share(facts: DataFrame | None, metric: str = S.CPU, agg: str = "sum",
                 match: str = "contains", exact_scale: int | None = None,
                 processor: str | None = S.TOTAL_PROCESSOR, members: DataFrame | None = None,
                 rolled: DataFrame | None = None, materialize_rollup: bool = False) -> DataFrame:
    """``(client, size, share, pct_label)`` over the fleet."""
    sizes = _client_sizes(facts, metric, agg, match, exact_scale, processor, members, rolled,
                          materialize_rollup)
    return share_of_fleet(sizes, agg, exact_scale)
