"""The metric table's loads: commit, interrupted loads, lost checkpoints, compaction, reads by day."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fleetscope import schema as S
from fleetscope.sources import ingest as I
from fleetscope.sources import manifest as M
from fleetscope.sources import readers as RD
from fleetscope.streaming.ingest_stream import ingest_stream
from tests.test_sources import cpu_source


def fresh(name):
    return os.path.join(tempfile.mkdtemp(prefix="loads-"), name)


def rows(spark, n, start=0):
    return spark.createDataFrame([(f"acm-a{i % 7}", f"2024-01-{1 + (start + i) % 28:02d} 05:00:00", "0", float(start + i)) for i in range(n)],
                                 f"`{S.SRC_SERVER}` string, `{S.SRC_TIME}` string, `{S.SRC_PROCESSOR}` string, `{S.SRC_CPU}` double")


def land(spark, folder, n, start=0):
    I.write_landing(rows(spark, n, start).coalesce(1), folder)


def values(spark, table, **kw):
    return sorted(r[0] for r in I.read_table(spark, table, S.CPU_FAMILY, **kw).select(S.CPU).collect())


def test_a_lost_checkpoint_loses_and_doubles_nothing(spark):
    landing, table, ckpt = fresh("landing"), fresh("table"), fresh("ckpt")
    land(spark, landing + "/a", 3)
    ingest_stream(spark, landing + "/*", table, ckpt, S.CPU_FAMILY)
    os.rename(ckpt, ckpt + "-lost")
    land(spark, landing + "/b", 2, 3)
    ingest_stream(spark, landing + "/*", table, ckpt, S.CPU_FAMILY)
    assert values(spark, table) == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_a_lost_checkpoint_with_the_old_files_gone(spark):
    landing, table, ckpt = fresh("landing"), fresh("table"), fresh("ckpt")
    land(spark, landing + "/a", 3)
    ingest_stream(spark, landing + "/*", table, ckpt, S.CPU_FAMILY)
    os.rename(ckpt, ckpt + "-lost")
    os.rename(landing, landing + "-done")
    land(spark, landing + "/b", 2, 3)
    ingest_stream(spark, landing + "/*", table, ckpt, S.CPU_FAMILY)
    assert values(spark, table) == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_two_spellings_of_one_checkpoint_are_one_stream(spark):
    landing, table, ckpt = fresh("landing"), fresh("table"), fresh("ckpt")
    land(spark, landing + "/a", 3)
    ingest_stream(spark, landing + "/*", table, ckpt, S.CPU_FAMILY)
    land(spark, landing + "/b", 2, 3)
    ingest_stream(spark, landing + "/*", table, os.path.dirname(ckpt) + "/./ckpt/", S.CPU_FAMILY)
    assert values(spark, table) == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert len({x.rsplit("-", 1)[0] for x in M.live(spark, table)}) == 1


def test_a_half_written_load_is_invisible(spark, monkeypatch):
    table = fresh("table")
    data = RD.clean(rows(spark, 4))
    with monkeypatch.context() as m:
        m.setattr(M, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            I.write_load(data, table, "first")
    assert os.path.isdir(f"{table}/load=first") and values(spark, table) == []
    assert values(spark, table, extras=True) == []
    I.write_load(data.limit(2), table, "second")
    assert len(values(spark, table)) == 2
    I.write_load(data, table, "first")  # the retry
    assert len(values(spark, table)) == 6 and M.live(spark, table) == ["first", "second"]


def test_a_retried_micro_batch_that_was_committed_writes_nothing(spark):
    landing, table, ckpt = fresh("landing"), fresh("table"), fresh("ckpt")
    land(spark, landing + "/a", 3)
    ingest_stream(spark, landing + "/*", table, ckpt, S.CPU_FAMILY)
    (commit,) = [f for f in os.listdir(f"{ckpt}/commits") if f.isdigit()]
    os.remove(f"{ckpt}/commits/{commit}")  # Spark did not learn that the batch was done
    for f in os.listdir(f"{ckpt}/commits"):
        os.remove(f"{ckpt}/commits/{f}")
    ingest_stream(spark, landing + "/*", table, ckpt, S.CPU_FAMILY)
    assert values(spark, table) == [0.0, 1.0, 2.0] and len(M.live(spark, table)) == 1


def test_a_hundred_micro_batches_compact_to_the_same_rows(spark):
    table = fresh("table")
    data = RD.clean(rows(spark, 300)).cache()
    days = data.select(F.to_date(S.TIME)).distinct().count()
    I.write_load(data.where(F.col(S.CPU) < 200), table, "batch-large")
    for i in range(100):
        M.open_table(spark, table)
        data.where(F.col(S.CPU) == 200.0 + i).withColumn(I.PARTITION_COLUMN, F.to_date(S.TIME)).coalesce(1).write.partitionBy(
            I.PARTITION_COLUMN).parquet(f"{table}/load=stream-x-{i}")
    os.makedirs(f"{table}/{M.LOADS}/many")
    with open(f"{table}/{M.LOADS}/many/part-0.json", "w") as f:  # a hundred entries as a hundred commits would leave
        f.writelines(f'{{"load": "stream-x-{i}", "at": {i + 1}, "replaces": []}}\n' for i in range(100))
    before = values(spark, table)
    assert before == [float(i) for i in range(300)]
    reader = I.read_table(spark, table, S.CPU_FAMILY)  # begun before the compaction
    load = I.compact(spark, table, S.CPU_FAMILY, small_rows=150)
    assert values(spark, table) == before and M.live(spark, table) == ["batch-large", load]
    assert reader.count() == 300
    files = [f for d, _, names in os.walk(f"{table}/load={load}") for f in names if f.endswith(".parquet")]
    assert len(files) <= days + 2
    assert len(I.vacuum(spark, table)) == 100 and values(spark, table) == before
    assert not os.path.exists(f"{table}/load=stream-x-1") and I.compact(spark, table, S.CPU_FAMILY, small_rows=150) is None
    data.unpersist()


def test_two_compactions_at_once_keep_each_row_once(spark):
    table = fresh("table")
    data = RD.clean(rows(spark, 6))
    for i in range(3):
        I.write_load(data.where(F.col(S.CPU) % 3 == i), table, f"batch-{i}")
    one = I._read(spark, table, data.schema, False, ["batch-0", "batch-1"]).select(*data.columns)
    two = I._read(spark, table, data.schema, False, ["batch-1", "batch-2"]).select(*data.columns)
    I.write_load(one, table, "compact-one", replaces=["batch-0", "batch-1"])
    I.write_load(two, table, "compact-two", replaces=["batch-1", "batch-2"])
    assert M.live(spark, table) == ["batch-2", "compact-one"] and values(spark, table) == [float(i) for i in range(6)]


def test_compaction_keeps_columns_that_only_some_loads_have(spark):
    table = fresh("table")
    data = RD.clean(rows(spark, 4))
    I.write_load(data.limit(2), table, "a")
    I.write_load(data.limit(2).withColumn("rack", F.lit("r1")), table, "b")
    I.write_load(data.limit(0), table, "empty")
    I.compact(spark, table, S.CPU_FAMILY)
    got = I.read_table(spark, table, S.CPU_FAMILY, extras=True)
    assert sorted(str(r.rack) for r in got.collect()) == ["None", "None", "r1", "r1"] and len(M.live(spark, table)) == 1


def test_reads_by_day_prune_folders(spark):
    table = fresh("table")
    I.write_load(RD.clean(rows(spark, 56)), table, "a")
    I.write_load(RD.clean(rows(spark, 1)).withColumn(S.TIME, F.lit(None).cast("timestamp_ntz")), table, "b")
    got = I.read_table(spark, table, S.CPU_FAMILY, since="2024-01-03", until="2024-01-05")
    assert sorted({r[0].day for r in got.select(S.TIME).collect()}) == [3, 4] and got.count() == 4
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "metric_date" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert I.read_table(spark, table, S.CPU_FAMILY).count() == 57
    assert I.read_table(spark, table, S.CPU_FAMILY, until="2024-01-02", extras=True).count() == 2


def test_no_loads_and_plain_folders(spark):
    table = fresh("table")
    M.open_table(spark, table)
    assert values(spark, table) == [] and values(spark, table, dedupe=True) == [] and values(spark, table, since="2024-01-01") == []
    assert I.compact(spark, table, S.CPU_FAMILY) is None and I.vacuum(spark, table) == []
    plain = fresh("plain")
    RD.clean(cpu_source(spark).limit(3)).write.parquet(plain)
    assert I.read_table(spark, plain, S.CPU_FAMILY).count() == 3
