"""Reading metric tables (S1), SQL over a view (S3), cached shared input.

``read_metrics`` reads any Spark data source and hands back the *clean* table:
internal column names, NaN turned into NULL (``avg`` skips NULL but not NaN),
and time text parsed leniently, so a malformed value becomes NULL instead of
failing the job under ANSI mode.  Columns are taken by name: they may come in
any order, a missing one is an error, and further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope import schema as S


def clean_sql(name: str, dtype: T.DataType) -> str:
    """SQL expression cleaning one source column; aliased to its internal name.

    Time text is read as wall-clock time, whatever the session's time zone.
    """
    internal = S.COLUMN_MAP.get(name, name)
    c = "`" + name.replace("`", "``") + "`"
    text = isinstance(dtype, T.StringType)
    alias = "`" + internal.replace("`", "``") + "`"
    if internal == S.TIME:
        c = f"{'try_cast' if text else 'cast'}({c} AS timestamp_ntz)"
    elif internal in S.METRIC_COLUMNS:
        c = f"nanvl({'try_cast' if text else 'cast'}({c} AS double), cast(NULL AS double))"
    elif internal in S.STRING_COLUMNS and not text:
        c = f"cast({c} AS string)"
    return f"{c} AS {alias}"


def clean(df: DataFrame, dedupe: bool = False) -> DataFrame:
    """Rename source columns to internal names and normalise their types."""
    out = df.selectExpr(*[clean_sql(f.name, f.dataType) for f in df.schema.fields])
    return out.dropDuplicates() if dedupe else out


def checked(columns: list[str], family: S.MetricFamily) -> list[str]:
    """The columns, the family's first; an error if one of these is missing or a name is taken twice."""
    missing = [c for c in family.source_columns if c not in columns]
    if missing:
        raise ValueError(f"the {family.name} table lacks the columns {missing}; it has {columns}")
    rest = [c for c in columns if c not in family.source_columns]
    names = [n.lower() for n in (*family.columns, *(S.COLUMN_MAP.get(c, c) for c in rest))]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"the {family.name} table has several columns for {twice}")
    return [*family.source_columns, *rest]


def header(spark: SparkSession, path: str | list[str], options: dict | None = None) -> list[str]:
    """Column names of CSV files, from the first file's header line."""
    return spark.read.options(**{**(options or {}), "header": "true", "inferSchema": "false"}).csv(path).columns


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_metrics(spark: SparkSession, path: str | list[str], family: S.MetricFamily,
                 fmt: str = "parquet", options: dict | None = None,
                 schema: T.StructType | None = None, dedupe: bool = False) -> DataFrame:
    """Scan a metric table from any source format and return it clean.

    The family's columns come first, further columns after them.  CSV files take their columns
    from the header line; every file's header must be the first file's, or the read fails.
    (With ``header=false`` they must hold the family's columns in order.)  JSON without a
    ``schema`` is read with the family's columns only, so that nothing has to be
    inferred.  Other formats bring their schema along.  Connector formats (a
    document store, JDBC) work the same way once their jar is on the classpath: pass
    ``fmt`` and ``options`` (e.g. ``{"uri": ...}``) and ``path=[]``.
    """
    options = dict(options or {})
    if fmt == "csv":
        options.setdefault("header", "true")
        if schema is None:
            named = str(options["header"]).lower() == "true"
            schema = text_schema(header(spark, path, options) if named else list(family.source_columns))
        options.setdefault("enforceSchema", "false")
    elif fmt == "json" and schema is None:
        schema = family.source_schema(T.StringType())
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path) if path else reader.load()
    columns = checked(df.columns, family)
    return clean(df.select(*["`" + c.replace("`", "``") + "`" for c in columns]), dedupe=dedupe)


def in_period(df: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """Rows timed from ``since`` to before ``until`` (ISO dates), rows without a time left out."""
    if since:
        df = df.where(F.col(S.TIME) >= F.lit(since).cast("timestamp_ntz"))
    return df.where(F.col(S.TIME) < F.lit(until).cast("timestamp_ntz")) if until else df


def sql_view_scan(spark: SparkSession, df: DataFrame, view: str = "metrics") -> DataFrame:
    """Register ``df`` as a temporary view and scan it with SQL (S3)."""
    df.createOrReplaceTempView(view)
    return spark.sql(f"SELECT * FROM `{view}`")


def cached_scan(spark: SparkSession, df: DataFrame, view: str = "metrics_cached",
                partitions: int | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Cache the shared input under a view and read it back as a table.

    Worth it only when several outputs are computed from the same input in one
    session and the input fits the cluster's storage memory; the operators of
    this package need one scan per output and do not call it.  Partitions are
    rebalanced to the adaptive advisory size (by ``keys``, if any), or to the given number of
    ``partitions``.  The cache is lazily filled by the first action and recomputed from
    lineage if an executor is lost.  It stays until ``uncache``; ``cached`` does both.
    """
    uncache(spark, view)
    if partitions:
        df = df.repartition(partitions, *keys) if keys else df.repartition(partitions)
    else:
        df = df.hint("rebalance", *keys)
    df.createOrReplaceTempView(view)
    spark.catalog.cacheTable(view)
    return spark.table(view)


def uncache(spark: SparkSession, view: str = "metrics_cached") -> None:
    if spark.catalog.tableExists(view):
        spark.catalog.uncacheTable(view)


@contextmanager
def cached(spark: SparkSession, df: DataFrame, view: str = "metrics_cached",
           partitions: int | None = None, keys: tuple[str, ...] = ()) -> Iterator[DataFrame]:
    """``cached_scan`` for the length of a block."""
    try:
        yield cached_scan(spark, df, view, partitions, keys)
    finally:
        uncache(spark, view)
