"""Exactly-once ingest of landed files with Structured Streaming (S2, streamed).

The batch ingest adds whatever it is given, so re-running it doubles rows.
A file-source stream with a checkpoint remembers which landing files it has
committed.  Each micro-batch is written as one load, named by the id that Spark keeps *inside* the
checkpoint and by the batch's number, so names never repeat: neither another spelling of the checkpoint's path nor
a new checkpoint in its place can meet a former load.  What an interrupted try of a
micro-batch left is replaced; if its load was already committed, the retry writes nothing.

The landing files that a load takes are noted in the table's manifest.  A stream with a fresh checkpoint, as
after the loss of the former one, leaves out the files that another stream's committed loads have taken.  So every
file is added to the metric table once, however often the job runs, and beside any batch loads.

``trigger(availableNow=True)`` processes what has landed and stops, so the job can be
scheduled like a batch; on executor loss the next run resumes from the checkpoint.  The
checkpoint belongs in shared storage next to the table.  Many small micro-batches are put together by
``fleetscope.sources.ingest.compact``.
"""

from __future__ import annotations

from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope import schema as S
from fleetscope.sources import manifest
from fleetscope.sources.ingest import write_load
from fleetscope.sources.readers import checked, clean, header, text_schema


def ingest_stream(spark: SparkSession, landing_dir: str, table_dir: str, checkpoint_dir: str,
                  family: S.MetricFamily, fmt: str = "csv", options: dict | None = None,
                  max_files_per_trigger: int | None = None) -> dict | None:
    """Add every not-yet-ingested landing file to the table; returns the last progress.

    CSV columns are taken from the header, as in ``read_metrics``.
    """
    options = dict(options or {})
    if fmt == "csv":
        options.setdefault("header", "true")
        options.setdefault("enforceSchema", "false")
        schema = text_schema(header(spark, landing_dir, options))
    else:
        schema = family.source_schema(T.StringType() if fmt == "json" else T.TimestampNTZType())
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    columns = checked(schema.fieldNames(), family)
    named = ["`" + c.replace("`", "``") + "`" for c in columns]
    landed = reader.load(landing_dir)
    metadata = _free_name(columns)
    rows = landed.select(*named, F.col("_metadata.file_path").alias(metadata))
    done, name = manifest.committed(spark, table_dir), Future()  # the stream's id is known once it has started

    def write(batch: DataFrame, number: int) -> None:
        mine = f"stream-{name.result()}-"
        if f"{mine}{number}" in done:
            return
        files = batch.select(F.col(metadata).alias("file"))
        taken = manifest.taken_files(batch.sparkSession, table_dir, mine)
        if taken is not None:
            taken = taken.select(F.col("file").alias(metadata)).distinct()
            batch = batch.join(taken, metadata, "left_anti")
        write_load(clean(batch.select(*named)), table_dir, f"{mine}{number}", files=files)

    query = (rows.writeStream.foreachBatch(write)
             .option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True)
             .start())
    name.set_result(query.id)
    query.awaitTermination()
    return query.lastProgress


def _free_name(columns: list[str]) -> str:
    """A column name that the rows do not have."""
    name = "landed_file"
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name
