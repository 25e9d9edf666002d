"""The corpus pipeline: five filtering and layout stages over ``documents``, one after another.

Every stage's result is written as Parquet in the shared scratch folder and read again
as the next one's input, so a lost executor never repeats an earlier stage; it is deleted
once the next stage is written.

toxicity      rows that score 0.3 or more go
near_dedup    one row of each class of near copies stays (five words, similarity 0.8)
decontaminate the spans that repeat benchmark windows go; a row with no word left goes
mixing        a row is taken as often as its source's target asks: not at all, once or twice
sharding      rows get their shard and their place in it

Null texts pass the first three stages as they are; an empty table passes all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetscope.llm import decontaminate, mixing, near_dup, reshard, toxicity
from fleetscope.llm.common import drop, read_table, scope, table_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.drop_near_duplicates(docs, 80, 100)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return reshard.reshard(docs)


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("decontaminate", remove_leaks),
          ("mixing", mix_sources), ("sharding", shard)]

#: SQL can't express the learned lexicon, the register sketch or the random rounding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, former = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = table_path(spark, f"stage-{name}")
        with scope(spark):  # a stage's own intermediates go with it
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if former:
            drop(spark, [former])
        former = path
    return docs
