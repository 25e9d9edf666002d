import itertools
import random
import zlib

import pytest

from fleetscope.llm import reshard
from tests.llm.helpers import AWKWARD, SCHEMA, documents, prose


def rows(n=900):
    return AWKWARD[:-4] + [(100 + i, prose(i, 3 + i % 60), "en", f"src{min(i % 9, 4)}") for i in range(n)]


def check(got, n):
    assert len(got) == n
    load = dict.fromkeys(range(8), 0)
    slots = {}
    for r in got:
        load[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    return load


@pytest.mark.parametrize("block_rows", [1000, 20])
def test_laws(spark, monkeypatch, block_rows):
    monkeypatch.setattr(reshard, "BLOCK_ROWS", block_rows)
    data = rows()
    data = [r for r in data if r[1] is None or len(r[1]) < 10_000]
    got = reshard.shard_report(documents(spark, data)).collect()
    load = check(got, len(data))
    mean = sum(load.values()) / 8
    assert max(abs(x - mean) for x in load.values()) < 0.02 * mean
    text = {r[0]: r[1] for r in data if r[0] is not None}
    for r in got:
        if r["doc_id"] is not None:
            raw = text[r["doc_id"]]
            assert r["size"] == (len(raw.encode()) if raw is not None else 0) + 1
            assert r["text_crc32"] == (zlib.crc32(raw.encode()) if raw is not None else None)
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}


def test_awkward_and_empty(spark):
    check(reshard.shard_report(documents(spark, AWKWARD)).collect(), len(AWKWARD))
    empty = spark.createDataFrame([], SCHEMA)
    assert reshard.shard_report(empty).collect() == [] and reshard.reshard(empty).collect() == []


def test_stage_keeps_columns_and_rows(spark):
    df = documents(spark, rows(50))
    out = reshard.reshard(df)
    assert set(out.columns) == set(df.columns) | {"shard", "slot"}
    assert out.count() == df.count()


@pytest.mark.parametrize("seed", range(25))
def test_flow_moves_the_fewest_bytes(seed):
    rng = random.Random(seed)
    n, m = rng.randrange(1, 4), rng.randrange(1, 4)
    supply = [rng.randrange(0, 5) for _ in range(n)]
    cap = [0] * m
    for _ in range(sum(supply) + rng.randrange(0, 3)):
        cap[rng.randrange(m)] += 1
    flow = reshard.min_cost_flow(supply, cap)
    assert [sum(v for (i, _), v in flow.items() if i == k) for k in range(n)] == supply
    assert all(sum(v for (_, j), v in flow.items() if j == k) <= cap[k] for k in range(m))
    moved = sum(v for (i, j), v in flow.items() if i != j)
    # nothing is won beyond the bytes that can stay where they are
    stay = sum(min(supply[k], cap[k]) for k in range(min(n, m)))
    best = sum(supply) - stay
    assert moved >= best
    units = [i for i, x in enumerate(supply) for _ in range(x)]
    if len(units) <= 6:
        least = min(sum(i != j for i, j in zip(units, p, strict=True)) for p in itertools.product(range(m), repeat=len(units))
                    if all(p.count(j) <= cap[j] for j in range(m)))
        assert moved == least


def test_rewrite_touches_only_affected_shards(spark, tmp_path):
    from pyspark.sql import functions as F
    data = [(i, "x" * 99, "en", "s") for i in range(60)]
    df = documents(spark, data).select("doc_id", "text")
    old = F.when(F.col("doc_id") < 20, 0).when(F.col("doc_id") < 30, 1).otherwise(2)   # 20, 10 and 30 rows
    layout = str(tmp_path / "layout")
    df.withColumn("shard", old).write.partitionBy("shard").parquet(layout)
    before = {p.name for p in (tmp_path / "layout" / "shard=0").iterdir()}
    out = reshard.assign(df, old, old_shards=3, shards=3)
    assert reshard.rewrite_affected(out, layout) == [1, 2]
    assert {p.name for p in (tmp_path / "layout" / "shard=0").iterdir()} == before
    got = spark.read.parquet(layout)
    assert got.count() == 60 and {r["shard"]: r["count"] for r in got.groupBy("shard").count().collect()} == {0: 20, 1: 20, 2: 20}


def test_an_affected_shard_is_written_by_many_tasks(spark, tmp_path):
    from pyspark.sql import functions as F
    df = documents(spark, [(i, "x" * 99, "en", "s") for i in range(600)]).select("doc_id", "text")
    out = reshard.assign(df, F.lit(0), old_shards=1, shards=2)
    layout = tmp_path / "layout"
    assert reshard.rewrite_affected(out, str(layout), file_rows=20) == [0, 1]
    assert all(len(list((layout / f"shard={k}").glob("*.parquet"))) > 3 for k in (0, 1))
    got = spark.read.parquet(str(layout))
    assert sorted(r[0] for r in got.select("doc_id").collect()) == list(range(600))
    assert got.select("shard", "slot").distinct().count() == 600
