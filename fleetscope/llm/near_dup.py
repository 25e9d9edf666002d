"""Near-duplicate classes by SetSketch registers.

A document is the set of its distinct five-word shingles.  Its SetSketch has
``M`` registers: each shingle's hash seeds a Poisson process of exponentially
spaced points dealt over the registers, a register keeps its minimum h and stores
``clip(floor(1 - log_b(h)), 0, q + 1)``.  Registers of a union are the maxima of the
parts' registers (mergeable), and equal registers are as frequent as the sets are
alike (locality-sensitive).

1. Documents with the same shingle set form a class (a hash aggregate combined
   before the shuffle), so thousands of exact copies cost one row from here on.
2. Bands of six registers give buckets.  Each bucket links its members to one
   pivot, another pivot in every bucket, never to each other.
3. A pair's similarity is estimated by the joint likelihood of its registers (how
   many are greater, equal, less) and its set sizes; pairs five standard errors
   below the threshold go.  The rest is confirmed on full shingle sets.
4. Confirmed links are contracted to components.  A bucket that still spans several
   components compares every pair across them, in blocks of registers: members
   outside the bucket's largest component against all members.  Members with a pair
   that passes the estimate get their full sets, once for each block, and the block
   confirms its pairs; a component that a member has met is not met again.

A link is lost only if no band of either set agrees, which at the threshold 0.85
has a probability below 3e-9, or if the estimate is off by five standard errors.

Nulls and ties: a null or wordless text has the empty set and links with nothing.
Rows with a null doc_id take part by their text; a class's id is its smallest
non-null doc_id.  Repeated rows are copies of each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetscope.llm.common import bounded_batches, materialize, mix64, scope, table_path, tables, unit
from fleetscope.llm.components import components

M = 256                 # registers
BASE = 1.001            # ratio of two register values
Q = (1 << 16) - 2       # largest finite register value
RATE = 20.0             # rate of the first points, so that registers of one-shingle sets stay above 0
BAND = 6                # registers a band holds
BANDS = M // BAND
TEXT_BYTES = 1 << 21    # bytes of text that are split into words together
SKETCH_SHINGLES, SKETCH_ROWS = 300_000, 2048  # shingles, rows that are sketched together
PROBE, BUILD = 256, 1024  # block sizes of the comparison across components
ERRORS = 5.0            # standard errors an estimate may lie below the threshold


# --- shingles and registers ---------------------------------------------------

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words [^\x20\x09-\x0D]+ of a text with A-Z lower-cased, and where they begin.

    A word's hash is the sum of its bytes times a random number of their place, mixed.
    """
    data = np.frombuffer(raw.lower(), np.uint8)  # lower() of bytes changes A-Z only
    edge = np.diff(np.concatenate(([True], _BLANK[data], [True])).astype(np.int8))
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(first):
        return np.empty(0, np.uint64), first
    size = last - first
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    random = mix64(np.arange(int(size.max()), dtype=np.uint64)) | np.uint64(1)
    part = (data[~_BLANK[data]].astype(np.uint64) + np.uint64(1)) * random[place]
    return mix64(np.add.reduceat(part, np.cumsum(size) - size) ^ size.astype(np.uint64)), first


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A very long text in parts that end at a blank."""
    at = 0
    while at < len(raw):
        end = at + TEXT_BYTES
        if end < len(raw):
            cut = max(raw.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut <= at:  # no blank in this part: the next one, wherever it is
                cut = min((k for k in (raw.find(c, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if k >= 0), default=len(raw))
            end = cut
        yield raw[at:end]
        at = end


def _windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words: their hashes times odd random numbers, so that order counts."""
    salt = mix64(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    n = len(h) - width + 1
    acc = np.full(max(n, 0), np.uint64(width))
    for i in range(width):
        acc = acc + h[i:i + n] * salt[i] if n > 0 else acc
    return mix64(acc)


def shingle_sets(texts: list[str | None], width: int = 5) -> list[np.ndarray]:
    """Of each text the sorted hashes of its distinct shingles; fewer words are one shingle, none are none."""
    raws = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    out: list[np.ndarray] = [np.empty(0, np.uint64)] * len(raws)

    def put(k: int, own: np.ndarray, runs: np.ndarray) -> None:
        if len(own):
            out[k] = np.unique(runs if len(own) >= width else _windows(own, len(own)))

    lo = 0
    while lo < len(raws):
        if len(raws[lo]) > TEXT_BYTES:
            own = np.concatenate([word_hashes(p)[0] for p in _pieces(raws[lo])])
            put(lo, own, _windows(own, width))
            lo += 1
            continue
        hi, size = lo, 0
        while hi < len(raws) and len(raws[hi]) <= TEXT_BYTES and (hi == lo or size + len(raws[hi]) <= TEXT_BYTES):
            size += len(raws[hi]) + 1
            hi += 1
        h, first = word_hashes(b" ".join(raws[lo:hi]))
        starts = np.cumsum([0] + [len(r) + 1 for r in raws[lo:hi]])
        ends = np.searchsorted(first, starts)
        runs = _windows(h, width)
        for k in range(lo, hi):
            a, b = ends[k - lo], ends[k - lo + 1]
            put(k, h[a:b], runs[a:max(a, b - width + 1)])
        lo = hi
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers (uint16, one row of M per set) of non-empty sets."""
    d = len(sets)
    low = np.full(d * M, np.inf)
    seg = np.repeat(np.arange(d), [len(s) for s in sets])
    state = np.concatenate(sets) if d else np.empty(0, np.uint64)
    x, drawn = np.zeros(len(state)), 0
    live = np.arange(d)
    while len(state):
        # a few points at once where few shingles are left, as in short documents
        many = max(1, min(64, 8192 // len(state)))
        step = np.arange(drawn + 1, drawn + many + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = mix64(state[:, None] + step)
        points = x[:, None] + np.cumsum(-np.log(unit(z)) / M, axis=1)
        np.minimum.at(low, (seg[:, None] * M + (z & np.uint64(M - 1)).astype(np.int64)).ravel(), points.ravel())
        x, drawn = points[:, -1], drawn + many
        top = np.full(d, -1.0)
        top[live] = low.reshape(d, M)[live].max(axis=1)
        on = x < top[seg]
        state, x, seg = state[on], x[on], seg[on]
        live = np.unique(seg)
    k = np.floor(1.0 - np.log(low / RATE) / np.log(BASE))
    return np.clip(k, 0, Q + 1).astype(np.uint16).reshape(d, M)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, hashes, sets, size = [], [], [], 0

    def out() -> pa.RecordBatch:
        full = [i for i, s in enumerate(sets) if len(s)]
        ck, regs = [None] * len(sets), [None] * len(sets)
        for i, r in zip(full, registers([sets[i] for i in full]), strict=True):
            ck[i], regs[i] = xxhash.xxh3_128_digest(sets[i].tobytes()), r.tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()),
             pa.array([len(s) for s in sets], pa.int64()), pa.array(ck, pa.binary()), pa.array(regs, pa.binary())],
            ["doc_id", "th", "n", "ck", "regs"])

    for batch_ids, texts, batch_hashes in tables(batches, "doc_id", "text", "th"):
        for i, x, h in zip(batch_ids, shingle_sets(texts), batch_hashes, strict=True):
            ids.append(i)
            hashes.append(h)
            sets.append(x)
            size += len(x)
            if size >= SKETCH_SHINGLES or len(sets) >= SKETCH_ROWS:
                yield out()
                ids, hashes, sets, size = [], [], [], 0
    yield out()


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, th, n, ck, regs) per row: text hash, set size, set hash, registers."""
    bounded_batches(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("th"))
            .mapInArrow(_sketch, "doc_id long, th long, n long, ck binary, regs binary"))


# --- joint likelihood -----------------------------------------------------------

def _log_likelihood(j, u, v, more, less, same):
    lead = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    p, q = lead(u - v * j), lead(v - u * j)
    log = lambda x: np.log(np.clip(x, 1e-12, 1))
    return more * log(p) + less * log(q) + same * log(1 - p - q)


def plausible(more: np.ndarray, less: np.ndarray, na: np.ndarray, nb: np.ndarray, least: float) -> np.ndarray:
    """Whether a similarity of ``least`` can't be excluded by ERRORS standard errors.

    more, less: registers of the first set above and below the second's; na, nb: set sizes.
    The similarity's likelihood is unimodal, so a golden-section search finds the joint estimate.
    """
    na, nb = na.astype(float), nb.astype(float)
    u, v, same = na / (na + nb), nb / (na + nb), M - more - less
    lo, hi = np.zeros(len(u)), np.minimum(na / nb, nb / na)
    fit = hi >= least - 1e-12
    top, g = hi.copy(), (np.sqrt(5) - 1) / 2
    for _ in range(30):
        c, d = hi - g * (hi - lo), lo + g * (hi - lo)
        left = _log_likelihood(c, u, v, more, less, same) > _log_likelihood(d, u, v, more, less, same)
        lo, hi = np.where(left, lo, c), np.where(left, d, hi)
    j = (lo + hi) / 2
    at = np.minimum(least, top)
    drop = 2 * (_log_likelihood(j, u, v, more, less, same) - _log_likelihood(at, u, v, more, less, same))
    return fit & ((j >= least) | (drop <= ERRORS ** 2))


def _estimate(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ca, cb, na, nb = (b.column(i) for i in range(4))
            ra, rb = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(-1, M) for i in (4, 5))
            ok = plausible((ra > rb).sum(1), (ra < rb).sum(1), na.to_numpy(), nb.to_numpy(), least)
            yield pa.RecordBatch.from_arrays([ca, cb], ["a", "b"]).filter(pa.array(ok))
    return run


_GROUP = ["band", "key", "pb", "bb"]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole groups of rows with equal _GROUP, which stand together: one table for each batch."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([*held, b])
        ends = _starts(t)
        if len(ends) > 1:  # the last group may go on
            yield t.slice(0, int(ends[-1])).combine_chunks()
            t = t.slice(int(ends[-1]))
        held = t.combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _starts(t: pa.Table) -> np.ndarray:
    keys = np.stack([t.column(c).to_numpy() for c in _GROUP])
    return np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(0))))


def _across(least: float):
    """Of each group: members with partners in other components that may be links.

    A pair counts in the first band it shares only.  Probes carry the list of their
    partners' places among the group's members.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            regs = np.frombuffer(b"".join(t.column("regs").to_pylist()), np.uint16).reshape(-1, M)
            ck, root = np.array(t.column("ck").to_pylist(), object), np.array(t.column("root").to_pylist(), object)
            _, ck_no = np.unique(ck, return_inverse=True)
            _, root_no = np.unique(root, return_inverse=True)
            n, probe, outer = (t.column(c).to_numpy() for c in ("n", "probe", "outer"))
            band = t.column("band").to_numpy()
            ends = np.append(_starts(t), t.num_rows)
            pending, size, hits = [], 0, []

            def evaluate():
                i, j = (np.concatenate(x) for x in zip(*pending, strict=True))
                for lo in range(0, len(i), 8192):
                    a, b = i[lo:lo + 8192], j[lo:lo + 8192]
                    same = (regs[a] == regs[b])[:, :BANDS * BAND].reshape(len(a), BANDS, BAND).all(2)
                    first = same.argmax(1) == band[a]
                    a, b = a[first], b[first]
                    if len(a):
                        ra, rb = regs[a], regs[b]
                        ok = plausible((ra > rb).sum(1), (ra < rb).sum(1), n[a], n[b], least)
                        hits.append((a[ok], b[ok]))

            for lo, hi in zip(ends[:-1], ends[1:], strict=True):
                p, b = lo + np.flatnonzero(probe[lo:hi]), lo + np.flatnonzero(~probe[lo:hi])
                if not len(p) or not len(b):
                    continue
                i, j = np.repeat(p, len(b)), np.tile(b, len(p))
                on = (root_no[i] != root_no[j]) & (~outer[j] | (ck_no[j] > ck_no[i]))
                if on.any():
                    pending.append((i[on], j[on]))
                    size += int(on.sum())
                if size >= 65_536:
                    evaluate()
                    pending, size = [], 0
            if pending:
                evaluate()
            if not hits:
                continue
            i, j = (np.concatenate(x) for x in zip(*hits, strict=True))
            rows = np.unique(np.concatenate((i, j)))
            mates: dict[int, list[bytes]] = {}
            for a, b in zip(i.tolist(), j.tolist(), strict=True):
                mates.setdefault(a, []).append(ck[b])
            yield pa.RecordBatch.from_arrays(
                [*(t.column(c).take(rows).combine_chunks() for c in (*_GROUP, "ck", "root")),
                 pa.array([mates.get(r, []) for r in rows.tolist()], pa.list_(pa.binary()))],
                [*_GROUP, "ck", "root", "mates"])
    return run


def _links(num: int, den: int):
    """Of each group: pairs of roots whose components link, confirmed on full sets; none is met twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            ck, root, mates = (t.column(c).to_pylist() for c in ("ck", "root", "mates"))
            shingles, out = t.column("shingles"), []
            ends = np.append(_starts(t), t.num_rows)
            for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                at = {ck[r]: r for r in range(lo, hi)}
                sets: dict[int, np.ndarray] = {}
                up: dict[bytes, bytes] = {}

                def find(x):
                    while up.get(x, x) != x:
                        x = up[x]
                    return x

                def full(r):
                    if r not in sets:
                        sets[r] = shingles[r].values.to_numpy()
                    return sets[r]

                for r in range(lo, hi):
                    for mate in mates[r]:
                        a, b = find(root[r]), find(root[at[mate]])
                        if a == b:
                            continue
                        x, y = full(r), full(at[mate])
                        both = len(np.intersect1d(x, y, assume_unique=True))
                        if den * both >= num * (len(x) + len(y) - both):
                            up[a] = b
                            out.append((root[r], root[at[mate]]))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.binary())], ["a", "b"])
    return run


# --- candidates and links ---------------------------------------------------------

def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ck, texts in tables(batches, "ck", "text"):
        sets = [x.view(np.int64) for x in shingle_sets(texts)]
        yield pa.RecordBatch.from_arrays([pa.array(ck, pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
                                         ["ck", "shingles"])


def _confirm(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    one = lambda c: sets.select(F.col("ck").alias(c), F.col("shingles").alias(f"s{c}"))
    both = pairs.join(one("b"), "b").join(one("a"), "a")
    inter = F.size(F.array_intersect("sa", "sb"))
    return (both.withColumn("i", inter)
            .where(F.lit(den) * F.col("i") >= F.lit(num) * (F.size("sa") + F.size("sb") - F.col("i")))
            .select("a", "b"))


def classes(docs: DataFrame, num: int = 85, den: int = 100) -> DataFrame:
    """(doc_id, th, n, ck, component_id) per row of ``docs``.

    th is xxhash64 of the text, n its number of distinct shingles and ck the hash of
    its shingle set (null: empty).  Rows link when den * |A & B| >= num * |A | B|;
    component_id is the smallest doc_id reachable by links.
    """
    spark = docs.sparkSession
    t = materialize(sketch(docs), "sketches")
    path = table_path(spark, "near-labels")
    with scope(spark):  # what leads to the labels goes once they are written
        label = _labels(docs, t, num, den)
        label.write.parquet(path)
    label = spark.read.schema(label.schema).parquet(path)
    body = t.select("doc_id", "th", "n", "ck")
    empty = body.where("n = 0").withColumn("component_id", F.col("doc_id"))
    return body.where("n > 0").join(label, "ck").select("doc_id", "th", "n", "ck", "component_id").union(
        empty.select("doc_id", "th", "n", "ck", "component_id"))


def _labels(docs: DataFrame, t: DataFrame, num: int, den: int) -> DataFrame:
    """(ck, component_id) of every class in the sketches ``t`` of ``docs``."""
    least = num / den
    reps = materialize(t.where("n > 0").groupBy("ck").agg(
        F.min("doc_id").alias("low"), F.min(F.struct("doc_id", "th")).alias("rep"),
        F.first("n").alias("n"), F.first("regs").alias("regs")), "classes")

    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.struct(
        i.alias("band"), F.xxhash64(i, F.expr("regs").substr(i * F.lit(2 * BAND) + F.lit(1), F.lit(2 * BAND))).alias("key")))
    member = reps.select("ck", F.inline(bands))
    order = F.struct(F.xxhash64("ck", "key").alias("o"), "ck")
    bucket = (member.groupBy("band", "key").agg(F.count("*").alias("size"), F.min(order).alias("p"))
              .where("size > 1").select("band", "key", F.col("p.ck").alias("pivot")))
    member = materialize(member.join(bucket, ["band", "key"]), "buckets")

    # full shingle sets, only of classes that share a bucket
    need = reps.join(member.select("ck").distinct(), "ck").select("ck", "rep.doc_id", "rep.th")
    text = docs.select(F.col("doc_id").cast("long").alias("d"), "text", F.xxhash64("text").alias("h"))
    rows = text.join(need, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("th")))
    sets = materialize(rows.select("ck", "text").mapInArrow(_sets, "ck binary, shingles array<long>")
                       .groupBy("ck").agg(F.first("shingles").alias("shingles"))
                       if _repeated(t) else rows.select("ck", "text").mapInArrow(_sets, "ck binary, shingles array<long>"), "shingles")

    # pivots
    r = reps.select("ck", "n", "regs")
    side = lambda c: r.toDF(c, f"n{c}", f"r{c}")
    star = (member.where(F.col("ck") != F.col("pivot"))
            .select(F.greatest("ck", "pivot").alias("a"), F.least("ck", "pivot").alias("b")).distinct())
    likely = (star.join(side("a"), "a").join(side("b"), "b")
              .select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_estimate(least), "a binary, b binary"))
    links = materialize(_confirm(likely, sets, num, den), "links")

    # pairs across the components that share a bucket
    root = materialize(components(links), "roots")
    m = (member.select("band", "key", "ck").join(root.withColumnRenamed("node", "ck"), "ck", "left")
         .withColumn("root", F.coalesce("root", "ck")))
    per = m.groupBy("band", "key", "root").agg(F.count("*").alias("c"))
    open_ = (per.groupBy("band", "key").agg(F.count("*").alias("k"), F.sum("c").alias("size"),
                                           F.max(F.struct("c", "root")).alias("top"))
             .where("k > 1").select("band", "key", "size", (F.col("size") - F.col("top.c")).alias("outs"),
                                    F.col("top.root").alias("top")))
    m = (m.join(open_, ["band", "key"]).join(r, "ck")
         .withColumn("outer", F.col("root") != F.col("top"))
         .withColumn("pbs", F.ceil(F.col("outs") / PROBE).cast("int"))
         .withColumn("bbs", F.ceil(F.col("size") / BUILD).cast("int")))
    slot = lambda n: F.pmod(F.xxhash64("ck"), F.col(n)).cast("int")
    span = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cols = ["band", "key", "ck", "root", "n", "regs", "outer"]
    gather = lambda df: df.repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    probes = (m.where("outer").withColumn("pb", slot("pbs")).withColumn("bb", F.explode(span("bbs")))
              .select(*cols, "pb", "bb", F.lit(True).alias("probe")))
    builds = (m.withColumn("bb", slot("bbs")).withColumn("pb", F.explode(span("pbs")))
              .select(*cols, "pb", "bb", F.lit(False).alias("probe")))
    slim = "band int, key long, pb int, bb int, ck binary, root binary"
    near = (gather(probes.union(builds)).mapInArrow(_across(least), f"{slim}, mates array<binary>")
            .groupBy(*_GROUP, "ck", "root").agg(F.flatten(F.collect_list("mates")).alias("mates")))
    late = gather(near.join(sets, "ck")).mapInArrow(_links(num, den), "a binary, b binary")
    over = components(late).toDF("root", "last")  # components of components

    c = (reps.select("ck", "low").join(root.withColumnRenamed("node", "ck"), "ck", "left")
         .withColumn("root", F.coalesce("root", "ck")))
    c = c.join(over, "root", "left").withColumn("root", F.coalesce("last", "root"))
    low = c.groupBy("root").agg(F.min("low").alias("component_id"))
    return c.join(low, "root").select("ck", "component_id")


def _repeated(t: DataFrame) -> bool:
    """Whether two rows share doc_id and text (each row would then give its set again)."""
    return bool(t.groupBy("doc_id", "th").count().where("count > 1").limit(1).count())


def near_duplicates(docs: DataFrame, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``."""
    c = classes(docs, num, den)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return c.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id.

    Rows without words all stay.  Of repeated rows with the same id and text one stays,
    the smallest by its other columns.
    """
    c = materialize(classes(docs, num, den), "near-classes")
    key = ["doc_id", "th"]
    keep = (c.where("n > 0").groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), *key)).alias("k"))
            .select("k.doc_id", "k.th")
            .union(c.where("n = 0").select(*key))).distinct().toDF("_near_id", "_near_th")
    text = docs.withColumn("_near_h", F.xxhash64("text"))
    out = text.join(keep, F.col("doc_id").cast("long").eqNullSafe(F.col("_near_id"))
                    & (F.col("_near_h") == F.col("_near_th")), "left_semi").drop("_near_h")
    if _repeated(c.where("n > 0")):
        others = [x for x in docs.columns if x not in ("doc_id", "text")]
        w = W.partitionBy("doc_id", F.xxhash64("text")).orderBy(*others or ["doc_id"])
        out = (out.withColumn("_near_r", F.row_number().over(w))
               .where((F.col("_near_r") == 1) | ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
               .drop("_near_r"))
    return out
