"""Written intermediate tables in the shared scratch folder.

A small derived table (a rollup, a membership table) that several parts of a
plan read is written once below ``spark.checkpoint.dir`` and read back.  That
cuts lineage (a lost executor never re-scans the facts for it) and gives the
planner the table's real size on disk.

A DataFrame read back from such a table needs it until its last action has run, so the
caller decides when it goes: every table belongs to the innermost open
``scope`` and is deleted when that closes, also after a failure.  Tables written outside of
any scope are kept until ``release``.

    with scope(spark):
        report = client_report(...)      # writes its rollup
        report.write.parquet(out)
    # the rollup is gone
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from fleetscope.session import scratch_path

_lock = threading.Lock()
_scopes: list[list[str]] = [[]]  # the first holds what no scope does


def table_path(spark: SparkSession, name: str) -> str:
    """A fresh location that is deleted with the innermost open scope."""
    path = scratch_path(spark, name)
    with _lock:
        _scopes[-1].append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[list[str]]:
    """Delete what is written to the scratch folder in this block when the block ends, however it ends."""
    mine: list[str] = []
    with _lock:
        _scopes.append(mine)
    try:
        yield mine
    finally:
        with _lock:
            _scopes[:] = [s for s in _scopes if s is not mine]
        drop(spark, mine)


def release(spark: SparkSession) -> None:
    """Delete the tables written outside of any scope."""
    with _lock:
        paths, _scopes[0][:] = list(_scopes[0]), []
    drop(spark, paths)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back."""
    return materialize_all({name: df})[name]


def materialize_all(dfs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Write several independent DataFrames concurrently and read them back.

    The jobs share no stages, so submitting them from separate threads lets the
    scheduler run them side by side instead of one after another.  Reading back
    with the known schema skips footer inference.
    """
    if not dfs:
        return {}
    spark = next(iter(dfs.values())).sparkSession
    paths = {name: table_path(spark, name) for name in dfs}

    def write(name: str) -> None:
        dfs[name].write.mode("errorifexists").parquet(paths[name])

    if len(dfs) == 1:
        write(next(iter(dfs)))
    else:
        with ThreadPoolExecutor(max_workers=len(dfs)) as pool:
            for f in [pool.submit(write, name) for name in dfs]:
                f.result()
    return {name: spark.read.schema(dfs[name].schema).parquet(paths[name]) for name in dfs}


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path in it; None without a JVM (Spark Connect)."""
    try:
        sc = spark.sparkContext
    except Exception:
        return None
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def drop(spark: SparkSession, paths) -> None:
    """Delete written tables, on whatever storage they are.

    On a Spark Connect client (no JVM access) they are left to the scratch folder's retention.
    """
    for path in paths:
        found = file_system(spark, path)
        if found:
            found[0].delete(found[1], True)
