"""Which loads of a metric table are finished.

Beside its loads a table has two folders that readers of plain Parquet skip:

    table/_loads/<id>/    one JSON row: the load, when it was finished, which loads it replaces
    table/_files/<id>/    JSON rows: the landing files that a stream's load has taken

An entry in ``_loads`` is written after the load's data and is the commit point: without it a load
does not exist for any reader, whatever lies in its folder.  Entries are never changed, so a reader
sees a table before or after a commit, never between.

A compaction's entry names the loads it replaces.  Entries are resolved in order of time; a
compaction that replaces a load that another one has already replaced is void, and
its inputs stay.  So two compactions at the same time can neither lose nor double rows.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.sources.scratch import file_system

LOADS, FILES = "_loads", "_files"
_LOADS_SCHEMA = "load string, at bigint, replaces array<string>"
_FILES_SCHEMA = "file string"


def _path(table_dir: str, *parts: str) -> str:
    return "/".join([table_dir.rstrip("/"), *parts])


def there(spark: SparkSession, path: str) -> bool:
    found = file_system(spark, path)
    if found:
        return found[0].exists(found[1])
    try:
        return bool(spark.read.text(path).columns)
    except Exception:
        return False


def opened(spark: SparkSession, table_dir: str) -> bool:
    """Whether the table keeps a manifest."""
    return there(spark, _path(table_dir, LOADS))


def _entries(spark: SparkSession, table_dir: str) -> list:
    if not opened(spark, table_dir):
        return []
    rows = spark.read.schema(_LOADS_SCHEMA).json(_path(table_dir, LOADS, "*")).where("load IS NOT NULL").collect()
    return sorted(rows, key=lambda r: (r["at"], r["load"]))


def _append(spark: SparkSession, table_dir: str, load: str, replaces: Sequence[str], at: int) -> None:
    row = spark.createDataFrame([(load, at, list(replaces))], _LOADS_SCHEMA)
    # a retry of a commit that was interrupted leaves one entry
    row.coalesce(1).write.mode("overwrite").json(_path(table_dir, LOADS, load or "opened"))


def open_table(spark: SparkSession, table_dir: str) -> None:
    """Give a table its manifest, before any data, so that an unfinished first load is not read either."""
    if not opened(spark, table_dir):
        _append(spark, table_dir, "", [], 0)


def committed(spark: SparkSession, table_dir: str) -> set[str]:
    """All loads that were ever finished, also those replaced since."""
    return {r["load"] for r in _entries(spark, table_dir) if r["load"]}


def live(spark: SparkSession, table_dir: str) -> list[str]:
    """The loads that make up the table, in order of their names."""
    entries = [r for r in _entries(spark, table_dir) if r["load"]]
    now = {r["load"] for r in entries if not r["replaces"]}
    for r in entries:
        if r["replaces"] and now.issuperset(r["replaces"]):
            now = now.difference(r["replaces"]) | {r["load"]}
    return sorted(now)


def commit(spark: SparkSession, table_dir: str, load: str, replaces: Sequence[str] = ()) -> None:
    """Make a written load part of the table, in place of those it replaces."""
    last = max([r["at"] for r in _entries(spark, table_dir)], default=0) if replaces else 0
    _append(spark, table_dir, load, replaces, max(int(time.time() * 1000), last + 1))


def note_files(files: DataFrame, table_dir: str, load: str) -> None:
    """Write which landing files (a column ``file``) a load takes; counts once the load is committed."""
    files.select("file").distinct().write.mode("overwrite").json(_path(table_dir, FILES, load))


def taken_files(spark: SparkSession, table_dir: str, but: str) -> DataFrame | None:
    """The landing files of committed loads whose names do not begin with ``but``; None if there are none."""
    loads = [x for x in sorted(committed(spark, table_dir)) if not x.startswith(but) and x.startswith("stream-")]
    loads = [x for x in loads if there(spark, _path(table_dir, FILES, x))]
    if not loads:
        return None
    return spark.read.schema(_FILES_SCHEMA).json([_path(table_dir, FILES, x) for x in loads]).where(F.col("file").isNotNull())
