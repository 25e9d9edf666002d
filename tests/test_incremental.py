"""Reports from the kept rollups of a table's loads equal reports over its rows."""

import os
import tempfile

from fleetscope import schema as S
from fleetscope.plans import fixtures as X
from fleetscope.plans import incremental as N
from fleetscope.plans import reports as R
from fleetscope.sources import ingest as I
from fleetscope.sources import manifest
from fleetscope.sources.readers import clean
from tests.conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def load(spark, table, family, name, i, n=3):
    facts = X.load_metrics(spark, SF_SMALL, family)
    I.write_load(facts.where(f"abs(hash(*)) % {n} = {i}"), table, name)


def full(spark, table, family):
    return rows(R.client_report(I.read_table(spark, table, family), family, exact_scale=2))


def kept(spark, table, family):
    return rows(R.client_report(None, family, exact_scale=2, rolled=N.table_rollup(spark, table, family, 2)))


def test_only_new_loads_are_scanned_and_results_stay_equal(spark):
    table = os.path.join(tempfile.mkdtemp(prefix="rollups-"), "cpu")
    load(spark, table, S.CPU_FAMILY, "batch-a", 0)
    assert N.refresh(spark, table, S.CPU_FAMILY, 2) == ["batch-a"] and N.refresh(spark, table, S.CPU_FAMILY, 2) == []
    load(spark, table, S.CPU_FAMILY, "batch-b", 1)
    assert N.refresh(spark, table, S.CPU_FAMILY, 2) == ["batch-b"]
    rolled = N.table_rollup(spark, table, S.CPU_FAMILY, 2)
    assert all(N.ROLLUPS in f for f in rolled.inputFiles())  # the facts are not read
    assert kept(spark, table, S.CPU_FAMILY) == full(spark, table, S.CPU_FAMILY)
    new = I.compact(spark, table, S.CPU_FAMILY)
    assert N.refresh(spark, table, S.CPU_FAMILY, 2) == [new]
    assert kept(spark, table, S.CPU_FAMILY) == full(spark, table, S.CPU_FAMILY)
    assert I.read_table(spark, table, S.CPU_FAMILY).count() == X.load_metrics(spark, SF_SMALL, S.CPU_FAMILY).where(
        "abs(hash(*)) % 3 < 2").count()


def test_unfinished_loads_and_rollups_are_not_read(spark):
    table = os.path.join(tempfile.mkdtemp(prefix="rollups-"), "disk")
    load(spark, table, S.DISK_FAMILY, "batch-a", 0)
    root = N._root(table, S.DISK_FAMILY, 2)
    part = N._load_rollup(spark, table, S.DISK_FAMILY, 2, ["batch-a"])
    part.write.partitionBy(I.LOAD_COLUMN).parquet(f"{root}/batch-dead")  # a refresh that ended before its entry
    X.load_metrics(spark, SF_SMALL, S.DISK_FAMILY).write.parquet(f"{table}/load=half")  # a load that was never committed
    assert manifest.live(spark, table) == ["batch-a"]
    assert kept(spark, table, S.DISK_FAMILY) == full(spark, table, S.DISK_FAMILY)


def test_empty_tables_and_loads(spark):
    table = os.path.join(tempfile.mkdtemp(prefix="rollups-"), "mem")
    empty = clean(spark.createDataFrame([], S.MEM_FAMILY.source_schema()))
    I.write_load(empty, table, "batch-none")
    assert N.table_rollup(spark, table, S.MEM_FAMILY, 2).collect() == []
    load(spark, table, S.MEM_FAMILY, "batch-a", 0)
    assert N.refresh(spark, table, S.MEM_FAMILY, 2) == ["batch-a"]
    assert kept(spark, table, S.MEM_FAMILY) == full(spark, table, S.MEM_FAMILY)


def test_arithmetics_are_kept_apart(spark):
    table = os.path.join(tempfile.mkdtemp(prefix="rollups-"), "mem")
    load(spark, table, S.MEM_FAMILY, "batch-a", 0)
    assert N.refresh(spark, table, S.MEM_FAMILY) == N.refresh(spark, table, S.MEM_FAMILY, 2) == ["batch-a"]
