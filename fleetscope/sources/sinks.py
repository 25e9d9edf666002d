"""Chart-ready table sinks.

The reference regenerates a chart image unless it exists and regeneration is
off, chart by chart.  The table equivalent: ``force=True`` replaces the table;
``force=False`` writes only the rows of charts (``keys``) that the table does not have yet.
A folder without a finished write, such as a failed first run leaves, holds no chart.

The table is partitioned by an encoded copy of the client, so each client's report
reads only its own files, while ``client`` itself stays in the data: an empty
client, or one that looks like a number, reads back as it was.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.sources.scratch import file_system

CHART_KEYS = ("client", "host", "disk", "section")


def partition_name(column: str) -> str:
    return f"{column}_key"


def encoded(column: str) -> Column:
    """A folder-safe copy of a key column: never empty, never read as a number."""
    return F.concat(F.lit("k"), F.col(column).cast("string"))


def finished(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether a write to ``path`` has been committed."""
    found = file_system(spark, f"{path.rstrip('/')}/_SUCCESS")
    if found:
        return found[0].exists(found[1])
    try:  # no JVM access: a table that can be read
        return bool(spark.read.format(fmt).load(path).columns)
    except Exception:
        return False


def missing(df: DataFrame, written: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys (NULL equal to NULL) ``written`` does not hold."""
    there = written.select(*[F.col(k).alias(f"_w_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_w_{k}")) for k in keys])
    return df.join(there, same, "left_anti")


def write_table(df: DataFrame, path: str, force: bool = True, partition_by: Sequence[str] = ("client",),
                fmt: str = "parquet", keys: Sequence[str] | None = None) -> None:
    """Write a chart table; without ``force`` only charts that it lacks.

    ``keys`` name a chart; by default those of ``CHART_KEYS`` that ``df`` has.
    """
    spark, mode = df.sparkSession, "overwrite"
    if not force and finished(spark, path, fmt):
        keys = [k for k in CHART_KEYS if k in df.columns] if keys is None else keys
        df, mode = missing(df, read_written(spark, path, df.schema, fmt), keys), "append"
    parts = [partition_name(c) for c in partition_by]
    if parts:  # a client's rows meet in few tasks, so a client has few files
        df = df.withColumns({partition_name(c): encoded(c) for c in partition_by}).hint("rebalance", *parts)
        order = [c for c in (*parts, "host", "disk", "section", "x") if c in df.columns]
        df = df.sortWithinPartitions(*order)
    writer = df.write.mode(mode).format(fmt)
    (writer.partitionBy(*parts) if parts else writer).save(path)


def read_written(spark: SparkSession, path: str, schema: T.StructType,
                 fmt: str = "parquet") -> DataFrame:
    """Read a table back with its schema."""
    return spark.read.format(fmt).schema(schema).load(path).select(*schema.fieldNames())
