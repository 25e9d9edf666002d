"""The registered queries against DuckDB, and the pipeline from end to end."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from fleetscope.llm.common import materialize, read_table
from fleetscope.llm.near_dup import near_duplicates
from fleetscope.llm.oracles import ORACLES
from fleetscope.llm.queries import QUERIES
from fleetscope.llm import decontaminate, toxicity
from tests.conftest import SF_SMALL
from tests.llm.helpers import AWKWARD, SCHEMA, documents


def test_registered_once_each():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(ORACLES) <= set(names)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = QUERIES[name](spark, SF_SMALL)
    cols = sorted(got.columns)
    rel = con.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.select(*cols).collect())


def test_pipeline_stage_by_stage(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontaminate", "mixing", "sharding"]
    docs, counts = read_table(spark, SF_SMALL, "documents"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, SF_SMALL), f"test-{name}")
        counts[name] = docs.count()
        if name != "sharding":
            assert docs.columns == columns
        if name == "near_dedup":
            assert near_duplicates(docs, 80, 100).where("NOT kept").count() == 0
            assert docs.join(before, columns, "left_anti").count() == 0
        if name == "decontaminate":
            assert decontaminate.leak_report(docs, read_table(spark, SF_SMALL, "benchmark")).where("contaminated").count() == 0
    assert counts["sharding"] == counts["mixing"] > 0
    assert docs.select("shard", "slot").distinct().count() == counts["sharding"]


def test_pipeline_on_awkward_rows_and_none(spark, tmp_path):
    for name in ("labels", "benchmark"):
        os.symlink(os.path.join(SF_SMALL, f"{name}.parquet"), tmp_path / f"{name}.parquet")
    for rows, n in ((AWKWARD, None), ([], 0)):
        docs = documents(spark, rows) if rows else spark.createDataFrame([], SCHEMA)
        docs = docs.drop("shard")
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, str(tmp_path)), f"test-{name}")
            assert docs.columns[:len(columns)] == columns
        if n is not None:
            assert docs.count() == n


def test_fixed_threshold():
    assert toxicity.THRESHOLD == 0.3
