"""Ingest of landed files into the metric table.

The reference reads one spreadsheet in the driver and inserts its rows into a
document store.  Here a batch is a landing *directory* of files (any number,
read in parallel by the executors), cleaned and added to a Parquet table laid out as

    table/load=<id>/metric_date=<day>/part-*.parquet

Every load has a folder and a name of its own: a batch load a fresh one, a stream's micro-batch (see
``fleetscope.streaming``) that of its stream and number.  So batches and streams feed one table,
nothing hides anything, and reads prune by day.  A load counts once it is committed in the table's
manifest (``fleetscope.sources.manifest``); what an interrupted load leaves is never read, and a retry
replaces it.  ``compact`` puts many small loads into one.  Ingesting the same batch twice doubles its
rows, as in the reference (``read_table(..., dedupe=True)`` drops exact duplicates on read).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetscope import schema as S
from fleetscope.sources import manifest
from fleetscope.sources.readers import clean, read_metrics
from fleetscope.sources.scratch import drop

PARTITION_COLUMN = "metric_date"
LOAD_COLUMN = "load"


def with_partition_column(df: DataFrame) -> DataFrame:
    return df.withColumn(PARTITION_COLUMN, F.to_date(F.col(S.TIME)))


def write_landing(df: DataFrame, landing_dir: str, fmt: str = "csv",
                  mode: str = "errorifexists") -> None:
    """Write a batch of source-named rows as landing files (tests, examples)."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(landing_dir)


def _load_path(table_dir: str, load: str) -> str:
    return f"{table_dir.rstrip('/')}/{LOAD_COLUMN}={load}"


def write_load(rows: DataFrame, table_dir: str, load: str,
               max_records_per_file: int = 10_000_000, replaces: Sequence[str] = (),
               files: DataFrame | None = None) -> None:
    """Write clean rows as one load of the table, in place of what an unfinished try of it left, and commit it.

    Rows are rebalanced by day and server first: a day's rows meet in tasks of the
    adaptive advisory size (large days are split, small ones share a task), so the number of
    files follows the data and not tasks times days.  Each task sorts its rows by day, server and
    time: the server-name column compresses to runs, and row-group statistics on
    server and time become selective.
    """
    spark = rows.sparkSession
    manifest.open_table(spark, table_dir)
    (with_partition_column(rows)
     .hint("rebalance", PARTITION_COLUMN, S.SERVER)
     .sortWithinPartitions(PARTITION_COLUMN, S.SERVER, S.TIME)
     .write.mode("overwrite")
     .option("maxRecordsPerFile", str(max_records_per_file))
     .partitionBy(PARTITION_COLUMN).parquet(_load_path(table_dir, load)))
    if files is not None:
        manifest.note_files(files, table_dir, load)
    manifest.commit(spark, table_dir, load, replaces)


def ingest_append(spark: SparkSession, landing_dir: str, table_dir: str,
                  family: S.MetricFamily, fmt: str = "csv",
                  options: dict | None = None,
                  max_records_per_file: int = 10_000_000) -> None:
    """Read one landed batch and add it to the metric table as a new load."""
    df = read_metrics(spark, landing_dir, family, fmt=fmt, options=options)
    write_load(df, table_dir, f"batch-{uuid.uuid4().hex}", max_records_per_file)


def _in_period(df: DataFrame, since: str | None, until: str | None) -> DataFrame:
    """Rows of the days from ``since`` to before ``until`` (ISO dates); a condition on the partition column."""
    day = F.col(PARTITION_COLUMN)
    if since:
        df = df.where(day >= F.lit(since).cast("date"))
    return df.where(day < F.lit(until).cast("date")) if until else df


def _read(spark: SparkSession, table_dir: str, schema: StructType, merge: bool, loads: Sequence[str] | None = None) -> DataFrame:
    """The table's loads (or some) with the partition columns; without a manifest, the folder as it is."""
    reader = spark.read.option("mergeSchema", "true") if merge else spark.read.schema(schema)
    paths = [table_dir]
    if loads is not None or manifest.opened(spark, table_dir):
        loads = manifest.live(spark, table_dir) if loads is None else loads
        # a load without rows has no files, and so no schema to merge
        paths = [p for p in (_load_path(table_dir, x) for x in loads) if not merge or _has_data(spark, p)]
        reader = reader.option("basePath", table_dir)
    if not paths:
        return spark.createDataFrame([], schema.add(PARTITION_COLUMN, "date").add(LOAD_COLUMN, "string"))
    df = reader.parquet(*paths)
    for c, kind in ((PARTITION_COLUMN, "date"), (LOAD_COLUMN, "string")):  # neither is found where no load has rows
        df = df.withColumn(c, F.col(c).cast(kind) if c in df.columns else F.lit(None).cast(kind))
    return df


def _has_data(spark: SparkSession, path: str) -> bool:
    return bool(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
                .load(path).select("path").limit(1).count())


def read_table(spark: SparkSession, table_dir: str, family: S.MetricFamily,
               dedupe: bool = False, extras: bool = False,
               since: str | None = None, until: str | None = None) -> DataFrame:
    """Read the metric table (internal names): all finished loads.

    ``since`` and ``until`` (ISO dates, the latter exclusive) read only the folders of these days.
    ``extras`` also gives the further columns that any load has.  ``dedupe`` drops rows
    that agree in all columns, further ones included.  A folder without a manifest is read as it is.
    """
    schema = clean(spark.createDataFrame([], family.source_schema())).schema
    df = _in_period(_read(spark, table_dir, schema, extras or dedupe), since, until)
    if extras or dedupe:
        df = df.drop(LOAD_COLUMN, PARTITION_COLUMN)
        df = df.dropDuplicates() if dedupe else df
        rest = [c for c in df.columns if c not in family.columns] if extras else []
        return df.select(*family.columns, *["`" + c.replace("`", "``") + "`" for c in rest])
    return df.select(*family.columns)


def read_loads(spark: SparkSession, table_dir: str, family: S.MetricFamily, loads: Sequence[str]) -> DataFrame:
    """The rows of some loads (internal names) with the load they came in."""
    schema = clean(spark.createDataFrame([], family.source_schema())).schema
    return _read(spark, table_dir, schema, False, loads).select(*family.columns, LOAD_COLUMN)


def compact(spark: SparkSession, table_dir: str, family: S.MetricFamily, small_rows: int = 10_000_000) -> str | None:
    """Put the loads of fewer than ``small_rows`` rows into one; returns its name, None if fewer than two are small.

    The rows stay the same.  Readers see the old loads until the new one is committed; their folders stay for running
    readers until ``vacuum``.
    """
    loads = manifest.live(spark, table_dir)
    schema = clean(spark.createDataFrame([], family.source_schema())).schema
    rows = {r[LOAD_COLUMN]: r["count"] for r in _read(spark, table_dir, schema, False).groupBy(LOAD_COLUMN).count().collect()}
    small = [x for x in loads if rows.get(x, 0) < small_rows]
    if len(small) < 2:
        return None
    load = f"compact-{uuid.uuid4().hex}"
    data = _read(spark, table_dir, schema, True, small).drop(LOAD_COLUMN, PARTITION_COLUMN)
    write_load(data, table_dir, load, replaces=small)
    return load


def vacuum(spark: SparkSession, table_dir: str) -> list[str]:
    """Delete the folders of replaced loads; no reader or compaction of the former state may be running."""
    gone = sorted(manifest.committed(spark, table_dir).difference(manifest.live(spark, table_dir)))
    drop(spark, [_load_path(table_dir, x) for x in gone])
    return gone
