"""Distinct keys and distinct x-values.

The reference collects these lists to the driver to loop over them; here they
are small DataFrames, sorted as the reference sorts them, for callers that
want the lists themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope import schema as S
from fleetscope.functions import keys as K
from fleetscope.operators import membership as M
from fleetscope.sources.scratch import materialize


def distinct_clients(facts: DataFrame) -> DataFrame:
    """``client``, every distinct client key."""
    return M.clients(facts).orderBy("client")


def distinct_hosts(facts: DataFrame, match: str = "contains") -> DataFrame:
    """``(client, host)``, hosts of each client, sorted."""
    return M.hosts(facts, match).orderBy("client", "host")


def _name_pairs(facts: DataFrame, materialize_names: bool) -> DataFrame:
    """The facts, or their distinct (name, disk name) pairs written by one scan."""
    return materialize(facts.select(S.SERVER, S.DISK).distinct(), "names") if materialize_names else facts


def distinct_disks(facts: DataFrame, match: str = "contains",
                   materialize_names: bool = False) -> DataFrame:
    """D3: ``(client, host, disk)``, disks of each host, sorted.

    ``materialize_names`` writes the distinct (name, disk name) pairs first, so the
    facts are scanned once.
    """
    return M.disks(_name_pairs(facts, materialize_names), match).orderBy("client", "host", "disk")


def distinct_client_disks(facts: DataFrame, match: str = "contains",
                          materialize_names: bool = False) -> DataFrame:
    """``(client, disk)``, disks seen on each client's rows."""
    return M.client_disks(_name_pairs(facts, materialize_names), match).orderBy("client", "disk")


def distinct_parts(facts: DataFrame, part: str, match: str = "contains",
                   materialize_names: bool = False) -> DataFrame:
    """``(client, host, x)``, the x-values each host has, ascending.

    Distinct ``(server_name, x)`` first (partial distinct before the shuffle),
    then the membership join; NULL date parts define keys but are no x-value.
    ``materialize_names`` writes the distinct pairs, so the facts are scanned once.
    """
    pairs = (facts.select(S.SERVER, K.date_part(part).alias("x"))
             .where(F.col(S.SERVER).isNotNull()).distinct())
    if materialize_names:
        facts = pairs = materialize(pairs, "name-parts")
    members = M.host_members(facts, match)
    return (pairs.where(F.col("x").isNotNull()).join(members, S.SERVER, "inner")
            .select("client", "host", "x").distinct().orderBy("client", "host", "x"))
