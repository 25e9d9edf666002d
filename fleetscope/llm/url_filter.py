"""URL filters by a temporal list join.

A block list is a log of dated entries: on a day an entry (a host, a domain with all its
subdomains, or a page) is added or removed.  ``intervals`` turns the log into validity
intervals [from, to): each addition holds until the entry's next change.  ``judge`` is the as-of join: every capture
is evaluated against the entries that were active when it was fetched, by an
equality join on its keys (its page, its host, each parent domain) with the interval
as a further condition.

Captures are first reduced to their places, a place being a page on a day, and the as-of join takes every distinct (kind,
value, day) of them once: a domain that a third of all captures share costs it one row a day.  The
active keys are then joined back to the places, and the places' verdicts to the captures.  In both joins a key
that more than one in ``PARTS`` of the rows have is salted: at most ``PARTS`` keys can be so frequent, which
bounds the broadcast list of them and the copies of their verdicts, and no task gets a whole hot key.

Nulls and ties: a capture without a host or without a fetch day matches nothing and passes.  Blanks and control
signs around a URL are no part of it.  An IPv4 address has no parent domains.  Log rows
with null fields are ignored.  Of changes of one entry on one day a removal wins.  Repeated
log rows change nothing; rows with equal id, URL and day get the same verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetscope.llm.common import materialize

PARTS = 4096    # a key with more than one in so many of a join's rows is salted

_AUTHORITY = r"^[a-z][a-z0-9+.-]*://([^/?#]*)"
_PATH = r"^[a-z][a-z0-9+.-]*://[^/?#]*(/[^?#]*)"
_IPV4 = r"^[0-9]{1,3}([.][0-9]{1,3}){3}$"


def _trimmed(url: Column | str) -> Column:
    return F.regexp_replace(F.lower(url), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def host(url: Column | str) -> Column:
    """The URL's host in lower case, without user, port and last dot; empty if it has none."""
    h = F.regexp_extract(_trimmed(url), _AUTHORITY, 1)
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(h, "^.*@", ""), ":[0-9]*$", ""), r"\.$", "")


def page(url: Column | str) -> Column:
    """Host and path, without query, fragment and last slash."""
    return F.concat(host(url), F.regexp_replace(F.regexp_extract(_trimmed(url), _PATH, 1), "/$", ""))


def _page_keys(place: str) -> Column:
    """All (kind, value) under which an entry may match a page (as ``page`` gives it); null without a host."""
    name = F.substring_index(place, "/", 1)
    parts = F.split(name, r"\.")
    last = F.when(name.rlike(_IPV4), 1).otherwise(F.size(parts))
    domains = F.transform(F.sequence(F.lit(1), last), lambda i: F.struct(
        F.lit("domain").alias("kind"), F.array_join(F.slice(parts, i, F.size(parts)), ".").alias("value")))
    one = lambda kind, value: F.array(F.struct(F.lit(kind).alias("kind"), value.alias("value")))
    return F.when(name != "", F.concat(one("host", name), one("page", F.col(place)), domains))


def intervals(log: DataFrame) -> DataFrame:
    """(kind, value, valid_from, valid_to) of a log (kind, value, action, day); valid_to null: still active."""
    one = (log.where("kind IS NOT NULL AND value IS NOT NULL AND day IS NOT NULL AND action IN ('add', 'remove')")
           .groupBy("kind", "value", "day").agg(F.max("action").alias("action")))  # 'remove' sorts last
    w = W.partitionBy("kind", "value").orderBy("day")
    return (one.withColumn("valid_to", F.lead("day").over(w)).where("action = 'add'")
            .select("kind", "value", F.col("day").alias("valid_from"), "valid_to"))


def _places(captures: DataFrame) -> DataFrame:
    """(place, day, n): the pages that have a host, each day they were fetched, and how many captures they have."""
    at = captures.where("url IS NOT NULL AND fetched IS NOT NULL").select(page("url").alias("place"), F.col("fetched").alias("day"))
    return at.where(F.substring_index("place", "/", 1) != "").groupBy("place", "day").agg(F.count("*").alias("n"))


def _salted(rows: DataFrame, facts: DataFrame, on: list[str], n: str, total: int, spread: Column, how: str) -> DataFrame:
    """Join ``rows`` with at most one of ``facts`` for a key, ``n`` being how many of the ``total`` rows have the key.

    Keys beyond one in ``PARTS`` rows are dealt by ``spread`` to as many parts as they are times as frequent, and their
    fact goes to each part.  The list of hot keys has at most ``PARTS`` pairs of numbers.
    """
    code = F.xxhash64(*on)
    hot = (facts.where(F.col(n) * PARTS > total).groupBy(code.alias("_code"))
           .agg(F.ceil(F.sum(n) * PARTS / F.lit(total)).cast("int").alias("_parts")))
    hot = F.broadcast(hot)
    parts = F.coalesce("_parts", F.lit(1))
    dealt = rows.join(hot, code == F.col("_code"), "left").withColumn("_salt", F.pmod(spread, parts).cast("int")).drop("_code", "_parts")
    copies = (facts.drop(n).join(hot, code == F.col("_code"), "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_code", "_parts"))
    return dealt.join(copies, [*on, "_salt"], how).drop("_salt")


def judge(captures: DataFrame, log: DataFrame) -> DataFrame:
    """page_id, url, fetched, n_active, entry, blocked: one row per row of ``captures`` (page_id, url, fetched).

    n_active counts the active entries that match; entry is the first of them by kind and value.
    """
    places = materialize(_places(captures), "url-places")
    total = places.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    keyed = places.select("place", "day", F.explode(_page_keys("place")).alias("k")).select("place", "day", "k.kind", "k.value")
    spans = intervals(log).withColumnsRenamed({"kind": "l_kind", "value": "l_value"})
    named = keyed.groupBy("kind", "value", "day").agg(F.count("*").alias("n_places"))
    active = materialize(
        named.join(spans, (F.col("kind") == F.col("l_kind")) & (F.col("value") == F.col("l_value")) & (F.col("day") >= F.col("valid_from"))
                   & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to"))))
        .select("kind", "value", "day", "n_places"), "url-active")
    n_places = places.count()  # no key has more
    met = _salted(keyed, active, ["kind", "value", "day"], "n_places", n_places, F.xxhash64("place"), "inner")
    verdicts = materialize(
        met.groupBy("place", "day").agg(F.count("*").alias("n_active"), F.min(F.concat_ws(":", "kind", "value")).alias("entry"))
        .join(places.withColumnsRenamed({"place": "p_place", "day": "p_day"}),
              (F.col("place") == F.col("p_place")) & (F.col("day") == F.col("p_day"))).select("place", "day", "n_active", "entry", "n"),
        "url-verdicts")
    rows = captures.select("page_id", "url", "fetched", F.when(F.col("fetched").isNotNull(), page("url")).alias("place"),
                           F.col("fetched").alias("day"))
    # repeated rows are dealt by the partition that they are read in
    spread = F.xxhash64("page_id", "url", F.spark_partition_id())
    out = _salted(rows, verdicts, ["place", "day"], "n", total, spread, "left")
    n = F.coalesce("n_active", F.lit(0).cast("long"))
    return out.select("page_id", "url", "fetched", n.alias("n_active"), "entry", (n > 0).alias("blocked"))


# --- the query's own log and fetch days, derived from the pages ------------------------

def fetch_days(pages: DataFrame) -> DataFrame:
    """pages has no fetch time: its crawl is taken to run over 2024, a page's day following its id."""
    return pages.select("page_id", "url", F.expr("date_add(DATE'2024-01-01', cast(pmod(page_id, 366) AS int))").alias("fetched"))


def derived_log(pages: DataFrame) -> DataFrame:
    """A dated log over the domains, hosts and pages that occur, by a rule on their md5.

    An entry whose first four hex digits v leave 0 modulo 3 (pages: 7) is added on day v mod
    200 of 2024, removed 30 + v mod 60 days later if v is even, and added again 120 days
    after the first time if v leaves 0 modulo 5.  One-label names (com) are left out.  example.com, which a third of all
    captures may lie under, is on the list by this rule.
    """
    keys = _places(fetch_days(pages)).select("place").distinct().select(F.explode(_page_keys("place")).alias("k"))
    name = keys.select("k.kind", "k.value").distinct().where("kind <> 'domain' OR size(split(value, '[.]')) >= 2")
    v = name.withColumn("v", F.conv(F.substring(F.md5(F.concat("kind", F.lit(":"), "value").cast("binary")), 1, 4), 16, 10).cast("int"))
    v = v.where("v % CASE kind WHEN 'page' THEN 7 ELSE 3 END = 0")
    day = lambda plus: f"date_add(DATE'2024-01-01', v % 200 + {plus})"
    rows = (f"array(named_struct('action', 'add', 'day', {day('0')}), "
            f"IF(v % 2 = 0, named_struct('action', 'remove', 'day', {day('30 + v % 60')}), NULL), "
            f"IF(v % 5 = 0, named_struct('action', 'add', 'day', {day('120')}), NULL))")
    return v.select("kind", "value", F.inline(F.expr(f"filter({rows}, x -> x IS NOT NULL)")))
