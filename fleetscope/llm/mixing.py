"""Mixing sources to target weights by pivotal dependent rounding.

Sources, in code point order with null last, weigh ``WEIGHTS``, repeating, and share
``SHARE`` of all words; a source's target stops at ``MOST`` times its words, and what is
above goes to the others by weight until none is above.  A document of a source with the target t
and s words is wanted t / s times: its whole copies are taken at once, and the fraction
is rounded against other documents of its source.  Two documents meet, mass is
transferred between them at random, in words, until one of them is integral, and the other goes
on.  So every document's expectation is kept, and a source's taken words differ from its
target by less than one document, a short one, as the long ones meet first.

The tree: documents are dealt to buckets by the hash of their id; a bucket leaves at
most one fractional document of each source; ``FAN`` buckets' residuals meet in a group of the
next level, and so on up to one residual of each source, which is drawn by its fraction.  A
source with a third of all rows is spread over all buckets.  Random numbers are hashes of ids
and levels: reruns agree.

Nulls and ties: a null text has 0 words and is taken 0 times.  Rows with equal id, text
and source are one unit that is worth its number of rows; its copies are spread
evenly over the rows.  A null doc_id is an id like any other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetscope.llm.common import materialize, mix64_int

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
BUCKET = 50_000      # documents of a bucket, on average
FAN = 64             # buckets whose residuals meet in a group of the next level
_UNIT = "u_id long, th long, source string, size long, m long, want double, base long, f double, node long, residual boolean"


def words_in(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) of a table (source, source_size) with one row a source.

    Sources sorted by how early they reach their cap: a source is capped if its cap is at
    most what the ones not capped before it would get for its weight.
    """
    d = lambda c: F.col(c).cast("double")
    s = sizes.withColumn("i", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("i") % len(weights) + 1))
    s = s.withColumn("cap", most * d("source_size")).withColumn("at", F.col("cap") / F.col("w"))
    every = W.partitionBy()
    upto = W.orderBy("at", "i").rowsBetween(W.unboundedPreceding, W.currentRow)
    s = (s.withColumn("pos", F.row_number().over(W.orderBy("at", "i")))
         .withColumn("left", share * F.sum(d("source_size")).over(every) - (F.sum("cap").over(upto) - F.col("cap")))
         .withColumn("ws", F.sum("w").over(every) - (F.sum("w").over(upto) - F.col("w")))
         .withColumn("level", F.col("left") / F.col("ws")).withColumn("capped", F.col("at") <= F.col("level")))
    s = s.withColumn("first", F.min(F.when(~F.col("capped"), F.struct("pos", "level"))).over(every))
    is_capped = F.col("first").isNull() | (F.col("pos") < F.col("first.pos"))
    return s.select("source", "source_size", F.when(is_capped, F.col("cap"))
                    .otherwise(F.col("first.level") * F.col("w")).alias("target"))


def _draw(key: int) -> float:
    return (mix64_int(key) >> 11) * 2.0 ** -53


def _pivot(level: int, last: bool):
    """Rounds the documents of a group source by source; at most one of each source stays fractional."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # large documents first: what stays fractional at the end, and is drawn at the root, is small
        pdf = (pdf.assign(w=(pdf["size"] * pdf["m"]).astype(float))
               .sort_values(["source", "w", "u_id", "th"], ascending=[True, False, True, True], na_position="last")
               .reset_index(drop=True))
        f, size = pdf["f"].to_numpy(copy=True), pdf.pop("w").to_numpy()
        seed = [mix64_int(((int(t) * 31) ^ (level + 1)) & (2**64 - 1)) for t in pdf["th"]]
        source = pdf["source"].where(pdf["source"].notna(), None).tolist()
        a = None
        for b in range(len(f)):
            if a is not None and source[b] != source[a]:
                a = None
            if not 0.0 < f[b] < 1.0:
                continue
            if a is None:
                a = b
                continue
            k = size[a] / size[b]
            up, down = min(1.0 - f[a], f[b] / k), min(f[a], (1.0 - f[b]) / k)
            if _draw(seed[a] ^ seed[b] ^ (b + 1)) * (up + down) < down:
                fa, fb, full = f[a] + up, f[b] - up * k, up == 1.0 - f[a]
                f[a], f[b] = (1.0, max(fb, 0.0)) if full else (fa, 0.0)
            else:
                fa, fb, none = f[a] - down, f[b] + down * k, down == f[a]
                f[a], f[b] = (0.0, min(fb, 1.0)) if none else (fa, 1.0)
            if not 0.0 < f[a] < 1.0:
                a = b if 0.0 < f[b] < 1.0 else None
        open_ = (f > 0) & (f < 1)
        if last:
            for i in np.flatnonzero(open_):
                f[i] = float(_draw(seed[i] ^ 0x5DEECE66D) < f[i])
            open_[:] = False
        return pdf.assign(f=f, node=pdf["node"] // FAN, residual=open_)
    return run


def plan(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(u_id, th, source, size, m, copies, source_size, target): a row for each unit.

    A unit is the m rows with one id, text hash and source; copies is what all of them
    are taken, at most ``most`` times m rounded up.
    """
    unit = (docs.select(F.col("doc_id").cast("long").alias("u_id"), F.xxhash64("text").alias("th"),
                        F.col("source").cast("string").alias("source"), words_in("text").alias("size"))
            .groupBy("u_id", "th", "source").agg(F.first("size").alias("size"), F.count("*").alias("m")))
    unit = materialize(unit, "mix-units")
    sizes = unit.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))
    target = materialize(targets(sizes, weights, share, most), "mix-targets")
    buckets = max(1, -(-unit.count() // BUCKET))
    want = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0) * F.col("m")
    t = target.withColumnRenamed("source", "t_source")
    now = (unit.join(t, F.col("source").eqNullSafe(F.col("t_source"))).withColumn("want", want)
           .withColumn("base", F.when(F.col("size") > 0, F.floor(F.col("want") + 1e-9)).otherwise(0))
           .withColumn("f", F.when(F.col("size") > 0, F.greatest(F.col("want") - F.col("base"), F.lit(0.0))).otherwise(0.0))
           .select("u_id", "th", "source", "size", "m", "want", F.col("base").cast("long"), "f",
                   F.pmod(F.xxhash64("u_id", "th"), F.lit(buckets)).cast("long").alias("node"), F.lit(True).alias("residual")))
    done, level, keys = None, 0, ["node"]
    while True:
        last = level > 0 and buckets == 1
        now = materialize(now.groupBy(*keys).applyInPandas(_pivot(level, last), _UNIT), f"mix-level{level}")
        part = now.where("NOT residual")
        done = part if done is None else done.union(part)
        if last:
            break
        now, level, keys, buckets = now.where("residual"), level + 1, ["source", "node"], -(-buckets // FAN)
    return (done.join(t, F.col("source").eqNullSafe(F.col("t_source")))
            .select("u_id", "th", "source", "size", "m", (F.col("base") + F.round("f").cast("long")).alias("copies"), "source_size", "target"))


def _per_row(copies: Column, m: Column, i: Column) -> Column:
    """Copies of a unit's i-th row, from 1."""
    return F.floor(copies / m).cast("long") + F.when(i <= copies % m, 1).otherwise(0).cast("long")


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per row of ``docs``."""
    p = plan(docs).withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    return p.select(F.col("u_id").alias("doc_id"), "size", "source_size", "target",
                    (F.col("size") * _per_row(F.col("copies"), F.col("m"), F.col("i"))).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """``docs`` with each row as often as the mix takes it (not at all, once or twice)."""
    names = {"u_id": "_mix_id", "th": "_mix_uh", "source": "_mix_source", "m": "_mix_m", "copies": "_mix_copies"}
    p = materialize(plan(docs).select(*names).withColumnsRenamed(names), "mix-plan")
    full = docs.withColumn("_mix_th", F.xxhash64("text"))
    same = (F.col("doc_id").cast("long").eqNullSafe(F.col("_mix_id")) & (F.col("_mix_th") == F.col("_mix_uh"))
            & F.col("source").cast("string").eqNullSafe(F.col("_mix_source")))
    copies, m = F.col("_mix_copies"), F.col("_mix_m")

    def taken(rows: DataFrame, n: Column) -> DataFrame:
        return (rows.withColumn("_mix_n", n.cast("int")).where("_mix_n > 0")
                .withColumn("_mix_k", F.explode(F.sequence(F.lit(1), F.col("_mix_n")))).select(*docs.columns))

    out = taken(full.join(p.where((m == 1) & (copies > 0)), same), copies)
    if p.where(m > 1).limit(1).count():
        w = W.partitionBy("doc_id", "_mix_th", "source").orderBy(*[c for c in docs.columns if c != "text"])
        many = full.join(p.where(m > 1), same).withColumn("_mix_i", F.row_number().over(w))
        out = out.union(taken(many, _per_row(copies, m, F.col("_mix_i"))))
    return out
