"""Reports from partial sums that are kept for each load of a metric table (S2 with A1-A13).

The partial sums of a rollup merge by addition, so a load's rollup never has to be made twice.  ``refresh`` scans
only the finished loads that have none yet, all in one job, and writes theirs beside the table:

    table/_rollups/<family and arithmetic>/<batch>/load=<id>/part-*.parquet
    table/_rollups/<family and arithmetic>/_done/<batch>      which loads the batch holds

``table_rollup`` refreshes and adds up the rollups of the loads that make up the table now; a report from it
reads names x buckets of each load and not the facts.  What an interrupted refresh leaves has no entry
in ``_done`` and is never read; if two refreshes make the rollup of one load, one of them is taken.
A compacted load is a new one and is scanned once.  With ``exact_scale`` results equal those of a full run
bit by bit, otherwise up to the order of additions.  A table without rows gives an empty rollup.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope import schema as S
from fleetscope.plans.reports import family_metrics, family_rollup
from fleetscope.sources import ingest as I
from fleetscope.sources import manifest

ROLLUPS, DONE = "_rollups", "_done"
_DONE_SCHEMA = "batch string, load string, n_rows long"


def _root(table_dir: str, family: S.MetricFamily, exact_scale: int | None) -> str:
    kind = "double" if exact_scale is None else f"exact{exact_scale}"
    return f"{table_dir.rstrip('/')}/{ROLLUPS}/{family.name}-{kind}"


def _made(spark: SparkSession, root: str) -> dict[str, tuple[str, int]]:
    """The batch that holds a load's rollup, and its rows there."""
    if not manifest.there(spark, f"{root}/{DONE}"):
        return {}
    rows = spark.read.schema(_DONE_SCHEMA).json(f"{root}/{DONE}/*").where("load IS NOT NULL").collect()  # a row for each load
    return {r["load"]: (r["batch"], r["n_rows"]) for r in sorted(rows, reverse=True)}


def _load_rollup(spark: SparkSession, table_dir: str, family: S.MetricFamily, exact_scale: int | None,
                 loads: list[str]) -> DataFrame:
    facts = I.read_loads(spark, table_dir, family, loads)
    return family_rollup(facts, family, exact_scale, further=(I.LOAD_COLUMN,))


def refresh(spark: SparkSession, table_dir: str, family: S.MetricFamily, exact_scale: int | None = None) -> list[str]:
    """Make the rollups of the finished loads that have none; returns these loads."""
    root = _root(table_dir, family, exact_scale)
    todo = sorted(set(manifest.live(spark, table_dir)).difference(_made(spark, root)))
    if not todo:
        return []
    batch = f"batch-{uuid.uuid4().hex}"
    rolled = _load_rollup(spark, table_dir, family, exact_scale, todo)
    rolled.write.mode("errorifexists").partitionBy(I.LOAD_COLUMN).parquet(f"{root}/{batch}")
    written = spark.read.schema(rolled.schema).parquet(f"{root}/{batch}").groupBy(I.LOAD_COLUMN).count().collect()
    size = {r[I.LOAD_COLUMN]: r["count"] for r in written}
    entries = spark.createDataFrame([(batch, x, size.get(x, 0)) for x in todo], _DONE_SCHEMA)
    entries.coalesce(1).write.mode("errorifexists").json(f"{root}/{DONE}/{batch}")
    return todo


def table_rollup(spark: SparkSession, table_dir: str, family: S.MetricFamily, exact_scale: int | None = None) -> DataFrame:
    """The rollup of the whole table, as ``family_rollup`` makes it, from those of its loads."""
    refresh(spark, table_dir, family, exact_scale)
    root = _root(table_dir, family, exact_scale)
    made = _made(spark, root)
    schema = _load_rollup(spark, table_dir, family, exact_scale, []).schema
    paths = [f"{root}/{made[x][0]}/{I.LOAD_COLUMN}={x}" for x in manifest.live(spark, table_dir) if made[x][1]]
    parts = spark.createDataFrame([], schema)
    if paths:
        parts = spark.read.schema(T.StructType([f for f in schema.fields if f.name != I.LOAD_COLUMN])).parquet(*paths)
    sums = [f"{k}{i}" for i in range(len(family_metrics(family))) for k in "sn"]
    keys = [c for c in parts.columns if c not in (*sums, I.LOAD_COLUMN)]
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
