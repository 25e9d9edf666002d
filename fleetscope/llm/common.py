"""Helpers shared by the operators: table reads, written intermediates, word splits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.sources.scratch import drop, materialize, scope, table_path

__all__ = ["bounded_batches", "drop", "held_out", "materialize", "mix64", "mix64_int", "read_table",
           "scope", "table_path", "tables", "unit"]

#: Rows in one Arrow batch: bounds the memory of a Python worker on long texts.
BATCH_ROWS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the session's Arrow batch to ``rows`` rows, if it is larger or unlimited."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def held_out(doc_id: Column | str) -> Column:
    """Rows no operator learns from: crc32 of the id as text leaves 2 modulo 4 (null: false)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


_M1, _M2, _G = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser over an array of uint64."""
    x = x + np.uint64(_G)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_M1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_M2)
    return x ^ (x >> np.uint64(31))


def mix64_int(x: int) -> int:
    """SplitMix64 finaliser of one integer."""
    x = (x + _G) & _MASK
    x = ((x ^ (x >> 30)) * _M1) & _MASK
    x = ((x ^ (x >> 27)) * _M2) & _MASK
    return x ^ (x >> 31)


def unit(x: np.ndarray) -> np.ndarray:
    """uint64 hashes as doubles in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53


def tables(batches: Iterator, *names: str) -> Iterator[tuple[list, ...]]:
    """Arrow batches as Python lists of the named columns."""
    for b in batches:
        yield tuple(b.column(b.schema.get_field_index(n)).to_pylist() for n in names)
