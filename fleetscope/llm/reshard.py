"""Resharding by minimum-cost flow.

Old shards have sizes, new shards have equal capacities in bytes; a flow from old to new
shards at the cost of one per byte that leaves its shard (shard k stays shard k) gives
the transfers that move the fewest bytes.  Rows are grouped in hash blocks within their old
shard; the flow takes whole blocks, and the few blocks in which a transfer ends are divided row by row,
largest rows first, each to the transfer that has the most room left.  Rows of
unaffected shards need no rewriting (``rewrite_affected``).

The driver holds one size and count for each block (at most ``MOST_BLOCKS`` of each old
shard) and the row sizes of the divided blocks, of which there are fewer than old plus new shards.

Nulls and ties: a null text has size 1, as an empty one, and its text_crc32 is null.
Null ids and repeated rows are rows like others; equal rows may swap places.
"""

from __future__ import annotations

from collections import defaultdict, deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

SHARDS = 8
OLD_SHARDS = 6
BLOCK_ROWS = 1000       # rows of a block, on average
MOST_BLOCKS = 16_384    # blocks of an old shard
FILE_ROWS = 100_000     # slots of a shard that one task rewrites


def min_cost_flow(supply: list[int], capacity: list[int]) -> dict[tuple[int, int], int]:
    """Transfers {(old, new): bytes} of all supply within the capacities that move the fewest bytes.

    Successive shortest augmenting paths over source, old shards, new shards, sink.
    """
    n, m = len(supply), len(capacity)
    s, t = n + m, n + m + 1
    cap, cost, to = defaultdict(int), {}, defaultdict(set)

    def edge(a, b, c, w):
        cap[a, b] += c
        cost[a, b], cost[b, a] = w, -w
        to[a].add(b)
        to[b].add(a)

    total = sum(supply)
    for i, x in enumerate(supply):
        edge(s, i, x, 0)
        for j in range(m):
            edge(i, n + j, total, 0 if i == j else 1)
    for j, x in enumerate(capacity):
        edge(n + j, t, x, 0)
    while True:
        dist, prev, queue = {s: 0}, {}, deque([s])
        while queue:
            a = queue.popleft()
            for b in sorted(to[a]):
                if cap[a, b] > 0 and dist[a] + cost[a, b] < dist.get(b, 1 << 60):
                    dist[b], prev[b] = dist[a] + cost[a, b], a
                    queue.append(b)
        if t not in dist:
            break
        path, b = [], t
        while b != s:
            path.append((prev[b], b))
            b = prev[b]
        push = min(cap[e] for e in path)
        for a, b in path:
            cap[a, b] -= push
            cap[b, a] += push
    return {(i, j): cap[n + j, i] for i in range(n) for j in range(m) if cap[n + j, i] > 0}


def size_of(text: Column | str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def by_source(n: int = OLD_SHARDS) -> Column:
    """The old layout of the queries: shards by source, so that a hot source makes a large shard."""
    return F.pmod(F.crc32(F.coalesce(F.col("source").cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


def _blocks(docs: DataFrame, old: Column, blocks: int, carry: dict[str, Column]) -> DataFrame:
    """The carried columns with _rs_old, _rs_size, _rs_block and _rs_pos, the place in the block from 0."""
    key = F.xxhash64(F.col("doc_id"), F.col("text"))
    out = docs.select(*[c.alias(n) for n, c in carry.items()], F.col("doc_id").alias("_rs_id"), old.alias("_rs_old"),
                      size_of().alias("_rs_size"), key.alias("_rs_key"),
                      F.pmod(key, F.lit(blocks)).cast("int").alias("_rs_block"))
    w = W.partitionBy("_rs_old", "_rs_block").orderBy("_rs_id", "_rs_key")
    return out.withColumn("_rs_pos", F.row_number().over(w) - 1).drop("_rs_key", "_rs_id")


def _divide(sizes: list[int], room: dict[int, float]) -> list[int]:
    """A shard for each row: largest first, each to the transfer with the most room left."""
    out, left = [0] * len(sizes), dict(room)
    for i in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        out[i] = max(left, key=lambda j: (left[j], -j))
        left[out[i]] -= sizes[i]
    return out


_MAP = T.StructType([T.StructField("m_old", T.IntegerType()), T.StructField("m_block", T.IntegerType()),
                     T.StructField("m_shard", T.IntegerType()), T.StructField("m_at", T.LongType()),
                     T.StructField("m_shards", T.ArrayType(T.IntegerType())), T.StructField("m_slots", T.ArrayType(T.LongType()))])


def assign(docs: DataFrame, old: Column | None = None, old_shards: int = OLD_SHARDS, shards: int = SHARDS,
           carry: dict[str, Column] | None = None) -> DataFrame:
    """``docs``, or the ``carry`` expressions on it, with _rs_old, _rs_size, shard and slot (gapless in its shard from 0).

    Only what is carried is shuffled, once, by block.
    """
    carry = {c: F.col(c) for c in docs.columns} if carry is None else carry
    old = by_source(old_shards) if old is None else old
    n = docs.count()
    blocks = max(1, min(MOST_BLOCKS, n // (BLOCK_ROWS * old_shards)))
    place, slim = _blocks(docs, old, blocks, carry), _blocks(docs, old, blocks, {})
    stats = {(r[0], r[1]): (r[2], r[3]) for r in slim.groupBy("_rs_old", "_rs_block")
             .agg(F.sum("_rs_size"), F.count("*")).collect()}  # at most old_shards * MOST_BLOCKS rows
    supply = [sum(v[0] for k, v in stats.items() if k[0] == o) for o in range(old_shards)]
    total = sum(supply)
    capacity = [total // shards + (j < total % shards) for j in range(shards)]
    flow = min_cost_flow(supply, capacity)

    whole, cut = {}, {}
    for o in range(old_shards):
        due = deque([j, flow[o, j]] for j in sorted(range(shards), key=lambda j: (j != o, j)) if (o, j) in flow)
        for b in sorted(k[1] for k in stats if k[0] == o):
            size, room = stats[o, b][0], {}
            while due and size >= due[0][1] > 0 and size > 0:
                j, x = due.popleft()
                room[j] = room.get(j, 0) + x
                size -= x
            if size > 0 and due:
                room[due[0][0]] = room.get(due[0][0], 0) + size
                due[0][1] -= size
            if len(room) == 1:
                whole[o, b] = next(iter(room))
            else:
                cut[o, b] = room
    split = {}
    if cut:
        hit = F.concat_ws("/", "_rs_old", "_rs_block").isin([f"{o}/{b}" for o, b in cut])
        rows = defaultdict(list)
        for r in slim.where(hit).select("_rs_old", "_rs_block", "_rs_pos", "_rs_size").toLocalIterator():
            rows[r[0], r[1]].append((r[2], r[3]))
        # what rounding to rows leaves in one block is made good in the next
        over = defaultdict(float)
        for k in sorted(cut):
            sizes = [s for _, s in sorted(rows[k])]
            room = {j: x - over[j] for j, x in cut[k].items()}
            split[k] = _divide(sizes, room)
            for j in room:
                over[j] += sum(s for s, g in zip(sizes, split[k], strict=True) if g == j) - cut[k][j]
    at, table = [0] * shards, []
    for k in sorted(stats):
        if k in whole:
            table.append((*k, whole[k], at[whole[k]], None, None))
            at[whole[k]] += stats[k][1]
        else:
            slots = []
            for g in split[k]:
                slots.append(at[g])
                at[g] += 1
            table.append((*k, None, None, split[k], slots))
    moves = F.broadcast(docs.sparkSession.createDataFrame(table, _MAP))  # bounded as stats
    out = place.join(moves, (F.col("_rs_old") == F.col("m_old")) & (F.col("_rs_block") == F.col("m_block")))
    pos = F.col("_rs_pos")
    return (out.withColumn("shard", F.coalesce("m_shard", F.get("m_shards", pos)))
            .withColumn("slot", F.coalesce(F.col("m_at") + pos, F.get("m_slots", pos)).cast("long"))
            .drop("m_old", "m_block", "m_shard", "m_at", "m_shards", "m_slots", "_rs_block", "_rs_pos"))


def shard_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, old_shard: one row per row of ``docs``."""
    carry = {"doc_id": F.col("doc_id"), "text_crc32": F.crc32(F.col("text").cast("binary"))}
    return assign(docs, carry=carry).select(
        "doc_id", F.col("_rs_size").alias("size"), "text_crc32",
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("_rs_old").alias("old_shard"))


def reshard(docs: DataFrame) -> DataFrame:
    """``docs`` with shard and slot; columns of these names are replaced."""
    kept = {c: F.col(c) for c in docs.columns if c not in ("shard", "slot")}
    return assign(docs, carry=kept).select(*kept, "shard", "slot")


def rewrite_affected(assigned: DataFrame, layout: str, file_rows: int = FILE_ROWS) -> list[int]:
    """Write the shards of ``assigned`` that gain or lose rows under ``layout``/shard=K, and only these.

    ``assigned`` is what ``assign`` gives, read from elsewhere than ``layout``.  Other
    shards' files stay as they are; an old shard that is left empty keeps no file.  A shard's rows are
    dealt by ranges of ``file_rows`` slots, so many tasks write it.
    Returns the affected shards.
    """
    spark = assigned.sparkSession
    moved = assigned.where(F.col("shard") != F.col("_rs_old"))
    affected = sorted({x for r in moved.select("_rs_old", "shard").distinct().collect() for x in r})
    if affected:
        body = assigned.where(F.col("shard").isin(affected)).drop("_rs_old", "_rs_size")
        filled = {r[0]: r[1] for r in assigned.groupBy("shard").count().collect()}
        ranges = sum(-(-filled.get(k, 0) // file_rows) for k in affected)
        (body.repartition(max(1, ranges), "shard", F.floor(F.col("slot") / file_rows))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(layout))
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for k in set(affected) - filled.keys():
            path = jvm.org.apache.hadoop.fs.Path(f"{layout}/shard={k}")
            path.getFileSystem(conf).delete(path, True)
    return affected
