"""Which rows belong to which client, host and disk.

The reports split the metric table by keys taken from the server name (client =
characters 1-3, host = character 5) and the disk name (disk = character 1), and
a row belongs to a key when its name *contains* the key anywhere
(``match="contains"``, the default and the reference behaviour).  One row can
therefore belong to several clients or hosts.  ``match="position"`` is the
clean alternative: the row belongs exactly to the keys at the fixed positions.

How it runs
-----------
Membership only depends on names, so it is computed on the *distinct* names (a
small dimension even for a huge fact table) and joined back on the name with an
equi-join.  ``contains`` with keys of bounded length is turned into an equi-join
as well: each distinct name is expanded into its distinct substrings of the
lengths that occur among the keys - normally one length, ``len(name) - 2``
substrings - and those are joined on equality to the keys.  Shorter substrings, which
very many names share, are made only if some name is so short that it gives such a
key.  No theta join, no nested loop, no pair enumeration; the work grows linearly
with the number of distinct names.

Levels are built in order, as the reference does: host keys of a client come
from the rows already matched to that client, disk keys of a host from the rows
matched to that host.  NULL names and NULL keys belong to nothing.

Every function takes any DataFrame with ``server_name`` (and ``disk_name`` for
disks) - raw facts or a pre-aggregate of them - and returns a small mapping
table; none of them triggers an action.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from fleetscope import schema as S
from fleetscope.functions import keys as K
from fleetscope.sources.scratch import materialize

MATCH_MODES = ("contains", "position")


def _check_match(match: str) -> None:
    if match not in MATCH_MODES:
        raise ValueError(f"match must be one of {MATCH_MODES}, got {match!r}")


def substrings(s: str, lengths: Column) -> Column:
    """Distinct substrings of column ``s`` of the given lengths (an array).

    ``contains(s, k)`` with ``len(k)`` among the lengths holds exactly when ``k`` is in
    this array, so membership becomes an equality join on its elements.
    """
    c = F.col(s)

    def of(n: Column) -> Column:
        last = F.length(c) - n + 1
        some = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(c, i, n))
        return (F.when(n == 0, F.array(F.lit(""))).when(last >= 1, some)
                .otherwise(F.array().cast("array<string>")))

    return F.array_distinct(F.flatten(F.transform(lengths, of)))


def lengths_of(keys: DataFrame, key: Column) -> Column:
    """The lengths that occur among some keys, as a scalar subquery (an array of few numbers)."""
    return keys.agg(F.collect_set(F.length(key)).alias("lengths")).scalar()


def tagged(s: str, key: Column, lengths: Column) -> Column:
    """``array<struct<g, is_key>>``: the row's own key, then its substrings.

    Exploding this once per distinct name gives one relation from which both
    the key set (``is_key``) and the candidate matches (``not is_key``) are
    taken, so the names are shuffled once for a membership level.
    """
    grams = F.transform(substrings(s, lengths),
                        lambda x: F.struct(x.alias("g"), F.lit(False).alias("is_key")))
    return F.concat(F.array(F.struct(key.alias("g"), F.lit(True).alias("is_key"))), grams)


def _names(df: DataFrame) -> DataFrame:
    return df.select(S.SERVER).where(F.col(S.SERVER).isNotNull()).distinct()


def _client_grams(df: DataFrame) -> DataFrame:
    """``(server_name, g, is_key)`` over the distinct names."""
    names = _names(df)
    key = K.client_key(S.SERVER)
    named = names.withColumn("_lengths", lengths_of(names, key))
    return named.select(S.SERVER, F.inline(tagged(S.SERVER, key, F.col("_lengths"))))


def _client_keys(grams: DataFrame) -> DataFrame:
    """``(client, hosts)``: every client key with the host keys of its rows.

    One aggregation by substring: a substring is a client when some name has it
    as its own key, and the names containing it are that client's rows, whose
    fifth characters are its host keys.  The host set per client is bounded by
    the alphabet of one character; it is combined map-side before the shuffle.
    """
    return (grams.groupBy(F.col("g").alias("client"))
            .agg(F.max("is_key").alias("is_client"),
                 F.collect_set(K.host_key(S.SERVER)).alias("hosts"))
            .where(F.col("is_client")).select("client", "hosts"))


def clients(df: DataFrame) -> DataFrame:
    """Distinct client keys of all rows (D1): ``client``."""
    return (_names(df).select(K.client_key(S.SERVER).alias("client")).distinct())


def client_rows(df: DataFrame) -> DataFrame:
    """``(server_name, client, hosts)``: names joined once to their clients.

    Each row carries the client's host-key set, so host membership needs no
    second join: it keeps the host keys the name contains.
    """
    grams = _client_grams(df)
    keys = _client_keys(grams)
    cands = grams.where(~F.col("is_key"))
    return (cands.join(keys, cands["g"] == keys["client"], "inner")
            .select(S.SERVER, "client", "hosts"))


def client_members(df: DataFrame, match: str = "contains") -> DataFrame:
    """``(server_name, client)`` for every name and client it belongs to."""
    _check_match(match)
    if match == "position":
        return _names(df).select(S.SERVER, K.client_key(S.SERVER).alias("client"))
    return client_rows(df).select(S.SERVER, "client")


def hosts(df: DataFrame, match: str = "contains", members: DataFrame | None = None) -> DataFrame:
    """Distinct ``(client, host)`` pairs (D2); host keys come from the client's rows."""
    _check_match(match)
    if members is not None:
        return members.select("client", K.host_key(S.SERVER).alias("host")).distinct()
    if match == "position":
        return _names(df).select(K.client_key(S.SERVER).alias("client"),
                                 K.host_key(S.SERVER).alias("host")).distinct()
    return _client_keys(_client_grams(df)).select("client", F.explode("hosts").alias("host"))


def _contained(keys_col: str, s: str) -> Column:
    """The keys of a (small, bounded) key set that string column ``s`` contains."""
    return F.filter(F.col(keys_col), lambda k: F.col(s).contains(k))


def host_members(df: DataFrame, match: str = "contains",
                 members: DataFrame | None = None) -> DataFrame:
    """``(server_name, client, host)`` for every name, client and host.

    ``members`` may pass a precomputed ``client_rows`` or ``client_members`` table.
    """
    _check_match(match)
    if match == "position":
        return _names(df).select(S.SERVER, K.client_key(S.SERVER).alias("client"),
                                 K.host_key(S.SERVER).alias("host"))
    if members is not None and "hosts" in members.columns:
        rows = members
    elif members is not None:
        keys = (members.groupBy(F.col("client").alias("k_client"))
                .agg(F.collect_set(K.host_key(S.SERVER)).alias("hosts")))
        rows = (members.join(keys, members["client"] == keys["k_client"], "inner")
                .select(S.SERVER, "client", "hosts"))
    else:
        rows = client_rows(df)
    return rows.select(S.SERVER, "client", F.explode(_contained("hosts", S.SERVER)).alias("host"))


def _name_disk_pairs(df: DataFrame) -> DataFrame:
    return (df.select(S.SERVER, S.DISK)
            .where(F.col(S.SERVER).isNotNull() & F.col(S.DISK).isNotNull())
            .distinct())


def disks(df: DataFrame, match: str = "contains", members: DataFrame | None = None) -> DataFrame:
    """Distinct ``(client, host, disk)`` (D3); disk keys come from the host's rows."""
    hm = members if members is not None else host_members(df, match)
    pairs = _name_disk_pairs(df).join(hm, S.SERVER, "inner")
    return pairs.select("client", "host", K.disk_key(S.DISK).alias("disk")).distinct()


def disk_members(df: DataFrame, match: str = "contains",
                 members: DataFrame | None = None) -> DataFrame:
    """``(server_name, disk_name, client, host, disk)``.

    Disk keys of a host are the first characters of the disk names on the
    host's rows; a (name, disk name) pair belongs to the host's disk keys its
    disk name contains.  The disk-key set of a host is bounded by the alphabet
    of one character.  ``members`` may pass a precomputed ``host_members``.
    """
    _check_match(match)
    if match == "position":
        return (_name_disk_pairs(df)
                .select(S.SERVER, S.DISK, K.client_key(S.SERVER).alias("client"),
                        K.host_key(S.SERVER).alias("host"), K.disk_key(S.DISK).alias("disk")))
    hm = members if members is not None else host_members(df, match)
    pairs = _name_disk_pairs(df).join(hm, S.SERVER, "inner")
    keys = (pairs.groupBy(F.col("client").alias("k_client"), F.col("host").alias("k_host"))
            .agg(F.collect_set(K.disk_key(S.DISK)).alias("disks")))
    cond = (pairs["client"] == keys["k_client"]) & (pairs["host"] == keys["k_host"])
    return (pairs.join(keys, cond, "inner")
            .select(S.SERVER, S.DISK, "client", "host",
                    F.explode(_contained("disks", S.DISK)).alias("disk")))


def client_disks(df: DataFrame, match: str = "contains",
                 members: DataFrame | None = None) -> DataFrame:
    """Distinct ``(client, disk)``: disk keys of each client's rows."""
    cm = members if members is not None else client_members(df, match)
    pairs = _name_disk_pairs(df).join(cm, S.SERVER, "inner")
    return pairs.select("client", K.disk_key(S.DISK).alias("disk")).distinct()


def fleet_disk_members(df: DataFrame, match: str = "contains") -> DataFrame:
    """``(disk_name, client, disk)`` for the fleet-wide disk split.

    A client's disk keys come from its own rows, but the rows of a disk are taken
    from the *whole* table (every client), matching on the disk name only.
    """
    _check_match(match)
    cd = client_disks(df, match)
    names = df.select(S.DISK).where(F.col(S.DISK).isNotNull()).distinct()
    if match == "position":
        return (names.join(cd, K.disk_key(S.DISK) == cd["disk"], "inner")
                .select(S.DISK, "client", "disk"))
    named = names.withColumn("_lengths", lengths_of(names, K.disk_key(S.DISK)))
    grams = named.select(S.DISK, F.explode(substrings(S.DISK, F.col("_lengths"))).alias("g"))
    return grams.join(cd, grams["g"] == cd["disk"], "inner").select(S.DISK, "client", "disk")


# --- splits: the fact rows with their keys --------------------------------------

BROADCAST_BYTES = 64 << 20   # membership tables up to this size in memory are broadcast
ROW_BYTES = 64               # what a row of a hash relation takes besides its strings


def measured(members: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A written membership table with the join strategy that its size in memory allows.

    Files are dictionary-coded and compressed, so their size says little; the rows and the
    bytes of their strings are counted instead.  Up to ``limit`` the table is broadcast and
    the facts stay where they are; beyond, a sort-merge join with adaptive skew splitting takes over.
    """
    text = [F.array_join(f.name, "") if isinstance(f.dataType, ArrayType) else F.col(f.name) for f in members.schema.fields]
    bytes_ = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(c), F.lit(0)) for c in text])
    bytes_ += sum((16 * F.size(f.name) for f in members.schema.fields if isinstance(f.dataType, ArrayType)), F.lit(0))
    size = members.agg(F.sum((bytes_ + ROW_BYTES + 16 * len(members.columns)).cast("long"))).first()[0] or 0
    return F.broadcast(members) if size <= limit else members.hint("merge")


def split(df: DataFrame, level: str = "host", match: str = "contains",
          materialize_members: bool = True) -> DataFrame:
    """Fact rows with the keys of every member they belong to.

    A row that belongs to ``k`` keys appears ``k`` times, once per key, as the
    reference's per-key DataFrames would hold it.

    The membership table is written to the scratch folder first
    (``materialize_members``) and measured: its size in memory decides the join strategy when
    the plan is built - broadcast when it is small, so the facts are never
    shuffled, and a sort-merge join with AQE skew splitting otherwise.  Without
    it, the planner only has an estimate derived from the fact scan and would
    shuffle the facts before learning the membership table is tiny.
    """
    if level == "client":
        m, on = client_members(df, match), [S.SERVER]
    elif level == "host":
        m, on = host_members(df, match), [S.SERVER]
    elif level == "disk":
        m, on = disk_members(df, match), [S.SERVER, S.DISK]
    else:
        raise ValueError(f"level must be client, host or disk, got {level!r}")
    if materialize_members:
        m = measured(materialize(m, f"members-{level}"))
    return df.join(m, on, "inner")


def split_fleet_disks(df: DataFrame, match: str = "contains",
                      materialize_members: bool = True) -> DataFrame:
    """Fact rows of the whole fleet per (client, disk).

    The join key (disk name) has few distinct values, each holding a large part
    of the rows, so a shuffle on it would be badly skewed; the small membership
    table is materialized so the join is planned as a broadcast.
    """
    m = fleet_disk_members(df, match)
    if materialize_members:
        m = measured(materialize(m, "members-fleet-disk"))
    return df.join(m, S.DISK, "inner")


def disk_classes(df: DataFrame, match: str = "contains", keys: DataFrame | None = None) -> DataFrame:
    """``(disk_name, disks)``: each distinct disk name with the fleet's disk keys it belongs to, sorted.

    ``keys`` may pass a precomputed ``client_disks``.  Names that belong to no key are left out.
    """
    _check_match(match)
    fleet = (client_disks(df, match) if keys is None else keys).select("disk").distinct()
    names = df.select(S.DISK).where(F.col(S.DISK).isNotNull()).distinct()
    if match == "position":
        met = names.join(fleet, K.disk_key(S.DISK) == fleet["disk"], "inner")
    else:
        named = names.withColumn("_lengths", lengths_of(fleet, F.col("disk")))
        grams = named.select(S.DISK, F.explode(substrings(S.DISK, F.col("_lengths"))).alias("g"))
        met = grams.join(fleet, grams["g"] == fleet["disk"], "inner")
    return met.groupBy(S.DISK).agg(F.array_sort(F.collect_set("disk")).alias("disks"))


def factor_fleet_disks(df: DataFrame, match: str = "contains") -> tuple[DataFrame, DataFrame]:
    """The fleet-wide disk split (J4) without its expansion: ``(facts, members)``.

    ``facts`` are the rows of the whole fleet once each, with ``disks``, the disk keys that the row belongs to; ``members``
    is ``(client, disk)``.  Neither grows with facts times clients.  ``expand_fleet_disks`` gives the rows of
    ``split_fleet_disks``; a measure by (client, disk) needs only sums by disk, joined to ``members``.
    """
    members = materialize(client_disks(df, match), "fleet-disk-keys")
    classes = measured(materialize(disk_classes(df, match, members), "fleet-disk-classes"))
    return df.join(classes, S.DISK, "inner"), members


def expand_fleet_disks(facts: DataFrame, members: DataFrame) -> DataFrame:
    """One row for each fact and (client, disk) it belongs to, as ``split_fleet_disks`` gives them."""
    each = facts.withColumn("disk", F.explode("disks")).drop("disks")
    return each.join(measured(members), "disk", "inner")


# --- single-key predicates (F1-F4) ---------------------------------------------

def client_filter(client: str) -> Column:
    return F.col(S.SERVER).contains(client)


def host_filter(client: str, host: str) -> Column:
    return F.col(S.SERVER).contains(client) & F.col(S.SERVER).contains(host)


def disk_filter(client: str, host: str, disk: str) -> Column:
    return host_filter(client, host) & F.col(S.DISK).contains(disk)


def total_filter(client: str, processor: str = S.TOTAL_PROCESSOR) -> Column:
    return F.col(S.SERVER).contains(client) & F.col(S.PROCESSOR).contains(processor)
