"""Small hand-written metric tables for edge-case tests."""

from pyspark.sql import types as T

from fleetscope import schema as S
from fleetscope.sources.readers import clean

WIDE_SCHEMA = T.StructType([
    T.StructField(S.SRC_SERVER, T.StringType()),
    T.StructField(S.SRC_TIME, T.StringType()),
    T.StructField(S.SRC_PROCESSOR, T.StringType()),
    T.StructField(S.SRC_DISK, T.StringType()),
    T.StructField(S.SRC_CPU, T.DoubleType()),
    T.StructField(S.SRC_MEM, T.DoubleType()),
    T.StructField(S.SRC_WRITES_AVG, T.DoubleType()),
    T.StructField(S.SRC_WRITES_MAX, T.DoubleType()),
    T.StructField(S.SRC_READS_AVG, T.DoubleType()),
    T.StructField(S.SRC_READS_MAX, T.DoubleType()),
])

# FIXTURES.md §3: (Server_Name, Disk_Name, value)
EDGE_ROWS = [
    ("acm-b001", "c:", 10.0),
    ("acm-a002", "d:", 20.0),
    ("bet", None, 30.0),
    (None, "c:", 40.0),
    ("bet-acm7", "c:", 50.0),
]

EXPECTED_HOST_MEMBERS = {
    ("acm", "a", "acm-a002"), ("acm", "a", "acm-b001"), ("acm", "a", "bet-acm7"),
    ("acm", "b", "acm-b001"), ("acm", "b", "bet-acm7"),
    ("bet", "", "bet"), ("bet", "", "bet-acm7"), ("bet", "a", "bet-acm7"),
}


def wide_rows(rows):
    """(server, time text, processor, disk, value) -> full wide rows."""
    out = []
    for server, ts, proc, disk, v in rows:
        out.append((server, ts, proc, disk, v, v, v, v, v, v))
    return out


def edge_table(spark, ts="2024-01-01 10:00:00", proc="_Total"):
    rows = [(s, ts, proc, d, v) for s, d, v in EDGE_ROWS]
    return clean(spark.createDataFrame(wide_rows(rows), WIDE_SCHEMA))


def table(spark, rows):
    return clean(spark.createDataFrame(wide_rows(rows), WIDE_SCHEMA))
