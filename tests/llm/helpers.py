"""Small tables with awkward rows, and the laws that the operators' results obey."""

from __future__ import annotations

import random
import zlib

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # extra columns whose names clash with the operators' own
    T.StructField("score", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("n_words", T.StringType()),
    T.StructField("th", T.StringType()), T.StructField("size", T.StringType()), T.StructField("component_id", T.StringType())])


def prose(seed: int, n: int, vocabulary: int = 4000) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}" for k in (rng.randrange(vocabulary) for _ in range(n)))


def documents(spark, rows):
    """rows: (doc_id, text[, lang[, source]])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s0",
             None if r[1] is None else len(r[1]), "x", None, "y", "z", None, "c") for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


#: Null and empty texts and ids, blanks only, repeated rows, one very long text.
AWKWARD = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "de", "a"), (4, "one", "en", "b"), (None, "lost and found", "en", "b"),
    (5, prose(5, 40), "en", "b"), (5, prose(5, 40), "en", "b"), (6, prose(6, 60_000), "en", None), (7, "Ω ≈ ß ﬁ 𒀀\x00é", "fr", "c"),
    (8, None, "en", "c"), (None, None, None, None)]


def held(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2
