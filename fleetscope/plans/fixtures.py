"""Metric tables derived from the driver's ``events`` table (FIXTURES.md §2).

One wide table with every source column serves the three metric families.
``user_id`` drives the server name (five client codes, four host letters),
``event_id`` the processor and disk, ``value`` and the ``k`` of ``props`` the
metrics.  The result has the source column names; ``load_metrics`` returns it
clean, with internal names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fleetscope import schema as S
from fleetscope.sources.readers import clean

# --- fixed values: the fixture mapping of FIXTURES.md §2 -------------------------
CLIENT_CODES = ["acm", "bet", "cor", "dyn", "ech"]
HOST_LETTERS = "abcd"
PROCESSORS = ["_Total", "0", "1"]     # by event_id % 3
DISK_NAMES = ["_total", "c:", "d:"]   # by event_id % 3
# --- end of fixed values ----------------------------------------------------------

# The events columns the mapping reads; an explicit schema skips footer inference.
EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def _quoted(items) -> str:
    return ", ".join(f"'{x}'" for x in items)


def metrics_from_events(events: DataFrame) -> DataFrame:
    """The wide metric table with source column names."""
    k = "cast(get_json_object(props, '$.k') AS double)"
    slot = "cast(event_id % 3 AS int) + 1"
    n_clients, n_hosts = len(CLIENT_CODES), len(HOST_LETTERS)
    server = (f"concat(element_at(array({_quoted(CLIENT_CODES)}), cast(user_id % {n_clients} AS int) + 1), "
              f"'-', substr('{HOST_LETTERS}', cast((user_id div {n_clients}) % {n_hosts} AS int) + 1, 1), "
              f"lpad(cast(user_id AS string), 3, '0'))")
    return events.selectExpr(
        f"{server} AS `{S.SRC_SERVER}`",
        f"cast(date_trunc('hour', ts) AS timestamp_ntz) AS `{S.SRC_TIME}`",
        f"element_at(array({_quoted(PROCESSORS)}), {slot}) AS `{S.SRC_PROCESSOR}`",
        f"element_at(array({_quoted(DISK_NAMES)}), {slot}) AS `{S.SRC_DISK}`",
        f"value AS `{S.SRC_CPU}`",
        f"{k} AS `{S.SRC_MEM}`",
        f"value AS `{S.SRC_WRITES_AVG}`",
        f"value + {k} AS `{S.SRC_WRITES_MAX}`",
        f"{k} AS `{S.SRC_READS_AVG}`",
        f"{k} + event_id % 10 AS `{S.SRC_READS_MAX}`",
    )


def family_table(wide: DataFrame, family: S.MetricFamily) -> DataFrame:
    """The source-named columns of one metric family."""
    return wide.selectExpr(*[f"`{c}`" for c in family.source_columns])


def load_metrics(spark: SparkSession, sf_dir: str, family: S.MetricFamily | None = None) -> DataFrame:
    """Clean metric table (internal names) for one family, or the wide table."""
    wide = metrics_from_events(read_events(spark, sf_dir))
    return clean(wide if family is None else family_table(wide, family))
