"""Benchmark decontamination by an FM-index per training shard.

Every task gathers the documents it reads into shards of bounded size.  A shard's
text is the sequence of its documents' words over the alphabet of the test
phrases: words that occur in no phrase are one separator symbol, as no match runs
across them, and so is the end of a document.  Over it stand the suffix array (by prefix doubling), the
Burrows-Wheeler transform, a wavelet matrix for rank queries, and suffix positions sampled at every ``SAMPLE``-th
place.  All phrases are searched backwards at once; each match's positions are
located by walking back to a sample, and overlapping matches merge to removal spans.

A phrase is a window of ``width`` consecutive words of a benchmark item; an item
with fewer words, but not none, is one phrase.  Items are dealt to blocks of about ``ITEM_BLOCK`` rows and
``BLOCK_BYTES`` bytes.  One block is searched while the documents are read, without any exchange.  More blocks are
written to the scratch folder and searched one after another: a pass reads the documents' texts, holds one
block in the driver and its tasks, and writes its hits only; in the end these are merged by the documents' row numbers.

Nulls and ties: a null text has no words.  An item is a distinct item_id: rows that share one are one
item with all their windows; rows without an id are one item that counts, but is left out of the list of ids.
Documents with equal doc_id are handled row by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.llm.common import bounded_batches, materialize

WIDTH = 10
ITEM_BLOCK = 20_000       # items of one pass: bounds what each task receives
BLOCK_BYTES = 16_000_000  # bytes of their texts
SHARD_WORDS = 2_000_000   # symbols a shard gathers before it is indexed
SAMPLE = 8                # one suffix position in so many is kept

#: Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing; all others divide.
_KEEP = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().translate(_KEEP).split() if text else []


def spans_of(text: str) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The text's bytes and the first and last + 1 byte of each word."""
    raw = text.encode("utf-8", "surrogatepass")
    on = np.frombuffer(raw.lower().translate(_KEEP), np.uint8) != 0x20
    edge = np.diff(np.concatenate(([0], on.astype(np.int8), [0])))
    return raw, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


class Phrases:
    """The windows of a block of items (id, text): distinct, with the numbers of the ids that hold each."""

    def __init__(self, items: list[tuple], width: int = WIDTH):
        self.ids = {}
        self.owners: list[set[int]] = []
        self.names = list(dict.fromkeys(i for i, _ in items))
        number, at = {i: k for k, i in enumerate(self.names)}, {}
        for i, text in items:
            k = number[i]
            ws = [self.ids.setdefault(w, len(self.ids) + 1) for w in words(text)]
            n = min(width, len(ws))
            for j in range(len(ws) - n + 1 if ws else 0):
                w = tuple(ws[j:j + n])
                if w not in at:
                    at[w] = len(at)
                    self.owners.append(set())
                self.owners[at[w]].add(k)
        self.lens = np.array([len(w) for w in at], np.int64)
        self.codes = np.zeros((len(at), width), np.int64)  # right-aligned
        for i, w in enumerate(at):
            self.codes[i, width - len(w):] = w
        self.least = int(self.lens.min()) if len(at) else 0


class WaveletMatrix:
    """rank(c, i): how often symbol c stands before place i; vectorised over c and i."""

    def __init__(self, s: np.ndarray, top: int):
        self.bits = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        for k in reversed(range(self.bits)):
            b = ((s >> k) & 1).astype(bool)
            self.ones.append(np.concatenate(([0], np.cumsum(b, dtype=np.int32))))
            self.zeros.append(len(s) - int(self.ones[-1][-1]))
            s = np.concatenate((s[~b], s[b]))

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        lo, hi = np.zeros_like(i), i
        for level, k in enumerate(reversed(range(self.bits))):
            b = ((c >> k) & 1).astype(bool)
            ones, z = self.ones[level], self.zeros[level]
            lo = np.where(b, z + ones[lo], lo - ones[lo])
            hi = np.where(b, z + ones[hi], hi - ones[hi])
        return hi - lo


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order, by prefix doubling; only suffixes still tied are sorted again."""
    n = len(s)
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    sa = np.argsort(rank, kind="stable")
    head = np.concatenate(([True], rank[sa][1:] != rank[sa][:-1]))
    k = 1
    while True:
        group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        rank[sa] = group
        tied = np.flatnonzero(~(head & np.append(head[1:], True)))
        if not len(tied) or k >= n:
            return sa
        part = sa[tied]
        ahead = np.where(part + k < n, rank[np.minimum(part + k, n - 1)], -1)
        order = np.lexsort((ahead, group[tied]))
        part, ahead, own = part[order], ahead[order], group[tied]
        sa[tied] = part
        head[tied[1:]] |= (ahead[1:] != ahead[:-1]) & (own[1:] == own[:-1])
        k *= 2


class FMIndex:
    """Backward search and sampled positions over a text of symbols 0..top; 0 separates."""

    def __init__(self, s: np.ndarray, top: int):
        s = np.concatenate((s, [0]))
        sa = suffix_array(s)
        self.bwt = s[sa - 1]  # the place before 0 is the last, a separator
        self.first = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=top + 1))))
        self.tree = WaveletMatrix(self.bwt, top)
        kept = (sa % SAMPLE == 0) | (self.bwt == 0)  # a walk never crosses a separator
        self.mark = np.concatenate(([0], np.cumsum(kept, dtype=np.int32)))
        self.kept, self.places = kept, sa[kept]

    def search(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of right-aligned phrases; 0 on their left fills up."""
        lo = np.zeros(len(codes), np.int64)
        hi = np.full(len(codes), len(self.bwt), np.int64)
        for col in range(codes.shape[1] - 1, -1, -1):
            c = codes[:, col]
            on = np.flatnonzero((c > 0) & (lo < hi))
            if not len(on):
                continue
            both = self.tree.rank(np.tile(c[on], 2), np.concatenate((lo[on], hi[on])))
            lo[on], hi[on] = self.first[c[on]] + both[:len(on)], self.first[c[on]] + both[len(on):]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffixes, walking back until a sampled one."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        while len(on := np.flatnonzero(~self.kept[rows])):
            r = rows[on]
            c = self.bwt[r]
            rows[on] = self.first[c] + self.tree.rank(c, r)
            steps[on] += 1
        return self.places[self.mark[rows]] + steps


def _shard(docs: list[list[bytes]], phrases: Phrases) -> tuple[list, list]:
    """Of each document: its words' hits (bool array or None), and the numbers of its items."""
    get = phrases.ids.get
    hit, items = [None] * len(docs), [set() for _ in docs]
    parts, owner, offset = [], [], []
    for d, ws in enumerate(docs):
        code = np.fromiter((get(w, 0) for w in ws), np.int64, len(ws))
        # runs of phrase words long enough for the shortest phrase; the rest separates
        edge = np.diff(np.concatenate(([0], (code > 0).astype(np.int8), [0])))
        for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
            if b - a >= phrases.least:
                parts += [code[a:b], [0]]
                owner += [d]
                offset += [a]
    if not parts:
        return hit, items
    s = np.concatenate(parts).astype(np.int64)
    begin = np.cumsum([0] + [len(p) + 1 for p in parts[::2]])[:-1]
    index = FMIndex(s, len(phrases.ids))
    lo, hi = index.search(phrases.codes)
    found = np.flatnonzero(lo < hi)
    owner, offset = np.array(owner), np.array(offset)
    for a in range(0, len(found), 4096):  # bounds the places that are held at once
        f = found[a:a + 4096]
        n = hi[f] - lo[f]
        phrase = np.repeat(f, n)
        rows = np.repeat(lo[f], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = index.locate(rows)
        run = np.searchsorted(begin, at, side="right") - 1
        for d, w, p in zip(owner[run].tolist(), (at - begin[run] + offset[run]).tolist(), phrase.tolist(), strict=True):
            if hit[d] is None:
                hit[d] = np.zeros(len(docs[d]), bool)
            hit[d][w:w + phrases.lens[p]] = True
            items[d] |= phrases.owners[p]
    return hit, items


_FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())), T.StructField("nameless", T.BooleanType())])


def _search(phrases: Phrases, others: int, all_rows: bool):
    """Adds n_words, spans, items and nameless to batches whose column ``text`` stands after ``others`` others.

    Without ``all_rows`` only rows with hits are given, and their texts are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, size = [], [], 0

        def flush():
            hits, items = _shard(docs, phrases)
            at = 0
            for b in held:
                n = b.num_rows
                some = [i for i in range(n) if all_rows or hits[at + i] is not None]
                names = [[phrases.names[k] for k in items[at + i]] for i in some]
                out = [*b.columns] if all_rows else [c.take(pa.array(some, pa.int64())) for c in b.columns[:others]]
                yield pa.RecordBatch.from_arrays(
                    [*out, pa.array([len(docs[at + i]) for i in some], pa.int64()),
                     pa.array([_merged(hits[at + i]) for i in some], pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                     pa.array([sorted(x for x in own if x is not None) for own in names], pa.list_(pa.string())),
                     pa.array([None in own for own in names], pa.bool_())],
                    [*b.schema.names[:len(out)], *_FOUND.names])
                at += n

        for b in batches:
            new = [words(t) for t in b.column(others).to_pylist()]
            held.append(b)
            docs += new
            size += sum(map(len, new))
            if size >= SHARD_WORDS:
                yield from flush()
                held, docs, size = [], [], 0
        if held:
            yield from flush()
    return run


def _merged(hit: np.ndarray | None) -> list[dict]:
    """Overlapping and adjoining hits as spans of words, first to last."""
    if hit is None:
        return []
    edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]


def _item_blocks(benchmark: DataFrame) -> list[DataFrame]:
    """The distinct items (i, text), dealt to blocks by a hash; each block is small enough to be collected."""
    items = benchmark.select(F.col("item_id").cast("string").alias("i"), "text").where("text IS NOT NULL").distinct()
    n, size = items.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    blocks = max(1, -(-n // ITEM_BLOCK), -(-(size or 0) // BLOCK_BYTES))
    if blocks == 1:
        return [items]
    dealt = materialize(items.withColumn("block", F.pmod(F.xxhash64("i", "text"), F.lit(blocks))), "leak-items")
    return [dealt.where(F.col("block") == k).select("i", "text") for k in range(blocks)]


def _phrases(block: DataFrame) -> Phrases:
    return Phrases([(r["i"], r["text"]) for r in block.collect()])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the bytes of their spans (first word's first to last word's last byte)."""
    for b in batches:
        texts, spans = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("text", "spans"))
        out = []
        for text, cut in zip(texts, spans, strict=True):
            if cut:
                raw, first, last = spans_of(text)
                keep, at = [], 0
                for s in cut:
                    keep.append(raw[at:first[s["first"]]])
                    at = last[s["last"]]
                text = b"".join([*keep, raw[at:]]).decode("utf-8", "surrogatepass")
            out.append(text)
        yield b.set_column(b.schema.get_field_index("text"), "text", pa.array(out, pa.string()))


def _found(docs: DataFrame, benchmark: DataFrame, cols: list[str]) -> DataFrame:
    """The columns as c0, c1, ... (no name can clash), with text, n_words, spans, items, n_items."""
    bounded_batches(docs.sparkSession)
    named = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)], "text")
    blocks = _item_blocks(benchmark)
    if len(blocks) == 1:
        out = named.mapInArrow(_search(_phrases(blocks[0]), len(cols), True), T.StructType([*named.schema.fields, *_FOUND.fields]))
    else:
        out = _by_blocks(named, blocks)
    n_items = F.size("items") + F.col("nameless").cast("int")
    return out.select(*named.columns, "n_words", "spans", "items", n_items.cast("long").alias("n_items"))


def _by_blocks(named: DataFrame, blocks: list[DataFrame]) -> DataFrame:
    """The documents with what the passes over all blocks find, each pass a job of its own."""
    rows = materialize(named.withColumn("row", F.monotonically_increasing_id()), "leak-rows")
    texts = rows.select("row", "text")
    none = T.StructType([texts.schema["row"], *_FOUND.fields])
    hits = [materialize(texts.mapInArrow(_search(_phrases(b), 1, False), none), "leak-hits") for b in blocks]
    one = reduce(DataFrame.union, hits).groupBy("row").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.max("nameless").alias("nameless"))
    empty = F.expr("cast(array() AS array<struct<first:bigint,last:bigint>>)")
    last = lambda acc: F.element_at(acc, -1)
    merged = F.aggregate("spans", empty, lambda acc, x: F.when(
        (F.size(acc) > 0) & (last(acc)["last"] >= x["first"] - 1),
        F.concat(F.slice(acc, 1, F.size(acc) - 1),
                 F.array(F.struct(last(acc)["first"].alias("first"), F.greatest(last(acc)["last"], x["last"]).alias("last")))))
        .otherwise(F.concat(acc, F.array(x))))
    one = one.select(F.col("row").alias("hit_row"), merged.alias("spans"), "items", "nameless")
    n_words = F.size(F.regexp_extract_all(F.col("text"), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0)))
    return rows.join(one, F.col("row") == F.col("hit_row"), "left").select(
        *named.columns, F.when(F.col("text").isNull(), 0).otherwise(n_words).cast("long").alias("n_words"),
        F.coalesce("spans", empty).alias("spans"), F.coalesce("items", F.expr("cast(array() AS array<string>)")).alias("items"),
        F.coalesce("nameless", F.lit(False)).alias("nameless"))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, spans, items, n_items: one row per row of ``docs``.

    spans: merged runs of hit words, first and last word's number, from 0; items: ids
    with occurring windows as strings, sorted; n_items counts them, and all items without an id as one.
    """
    return _found(docs, benchmark, ["doc_id"]).select(F.col("c0").alias("doc_id"), "n_words", "spans", "items", "n_items")


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row per row of ``docs``."""
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1)
    return find_leaks(docs, benchmark).select(
        "doc_id", "n_words", hits.alias("n_hit"), "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` whose texts lack the spans that repeat benchmark windows.

    Other rows stay as they are; a contaminated row whose text has no word left goes.
    n_chars, if there, follows the new text.
    """
    rest = [c for c in docs.columns if c != "text"]
    at = {c: F.col(f"c{i}") for i, c in enumerate(rest)}
    found = _found(docs, benchmark, rest)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1)
    kept = (found.where((F.size("spans") == 0) | (F.col("n_words") > hit))
            .select(*[f"c{i}" for i in range(len(rest))], "text", "spans"))
    cut = kept.mapInArrow(_cut, kept.schema)
    if "n_chars" in at:
        kind = docs.schema["n_chars"].dataType
        at["n_chars"] = F.when(F.size("spans") > 0, F.char_length("text").cast(kind)).otherwise(at["n_chars"])
    return cut.select(*[at[c].alias(c) if c in at else F.col("text") for c in docs.columns])
