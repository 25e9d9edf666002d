"""Periodic runs of words, found in the grammar that Re-Pair makes of them.

A run is a stretch of words with smallest period q, at least ``exponent * q`` and ``least`` words long, that
no neighbouring word extends.  Each task works on its documents' word ids, a few hundred thousand words at a time:

* **Re-Pair in rounds.**  Repeating pairs of neighbours become nonterminals.  A round replaces every
  pair that is more frequent (by powers of two, then by a hash) than the pairs it overlaps, so that all documents
  of a batch shrink together; within repeats of one symbol every other pair is taken.  The grammar
  is shared by the batch: what copies share is derived by the same nonterminals.  Once hardly any pair
  repeats, each document's rest is paired up to one balanced tree.
* **Boundaries.**  A run lies across the boundary of the lowest tree node that covers it.  So each nonterminal is
  looked at once, at one of its places: of the periods q with equal words q apart on both sides of its boundary those
  are kept whose extension to the left and right, by hashed longest common extensions within
  the nonterminal, is long enough.  One side of the boundary must hold two periods; this bounds q by half of a side.
* **Derivation.**  A nonterminal's runs are moved to all places that it derives.
* **Merge.**  An interval within another of the same period was cut off by its nonterminal and
  goes; of intervals with equal ends the smallest period stays (a stretch of four periods of q that also has a smaller
  period has a divisor of q as period).

Hashes (two 31-bit primes) only propose: every run is compared word by word before it counts, and a batch is hashed
anew with another base if one differs.  Memory is bounded by ``WORDS`` words, or by the longest text.

Words are runs of characters other than U+0020 and U+0009 to U+000D.  Null texts have no words and stay null;
empty and blank texts become empty.  Each row is a document, also if ids are null or repeat; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.llm.common import bounded_batches, mix64

LEAST, EXPONENT = 6, 4
WORDS = 400_000        # words that are worked on at a time
CANDIDATES = 1 << 20   # (boundary, period) pairs that are looked at at a time
REST = 256             # the rounds end when one replaces less than this part of the sequence
_PRIMES = (2147483647, 2147483629)


class _Hashes:
    """Equality of stretches of ``w`` by prefix hashes."""

    def __init__(self, w: np.ndarray, base: int):
        self.sums = []
        for k, p in enumerate(_PRIMES):
            b, n = (0x2545F491 + 7919 * (2 * base + k)) % p, len(w)
            power, step = np.ones(1, np.int64), b
            while len(power) <= n:
                power, step = np.concatenate([power, power * step % p]), step * step % p
            value = (mix64(w.astype(np.uint64) + np.uint64(k << 40)) % np.uint64(p)).astype(np.int64)
            total = np.concatenate([[0], np.cumsum(value * power[:n] % p)])
            self.sums.append((p, power, total))

    def equal(self, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the n words from x are those from y; x <= y."""
        same = np.ones(len(x), bool)
        for p, power, total in self.sums:
            same &= (total[x + n] - total[x]) % p * power[y - x] % p == (total[y + n] - total[y]) % p
        return same

    def common(self, x: np.ndarray, y: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """Length, up to ``most``, of what agrees from x and y on (x < y), or before them."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = self.equal(x - mid, y - mid, mid) if back else self.equal(x, y, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low


def _grammar(w: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """(rule, start, boundary, end) of every inner node of the documents' derivation trees."""
    sym, pos, d, rules = w.astype(np.int64), np.arange(len(w)), doc, int(w.max(initial=0)) + 1
    nodes: list[tuple[np.ndarray, ...]] = []

    def replace(at: np.ndarray, rule: np.ndarray) -> None:
        nonlocal sym, pos, d
        end = np.append(pos, len(w))
        nodes.append((rule, pos[at], pos[at + 1], end[at + 2]))
        sym[at] = rule
        left = np.ones(len(sym), bool)
        left[at + 1] = False
        sym, pos, d = sym[left], pos[left], d[left]

    while len(sym) > 1:
        key = (sym[:-1].astype(np.uint64) << np.uint64(32)) | sym[1:].astype(np.uint64)
        h = mix64(key)
        slot = (h >> np.uint64(64 - max(10, len(sym).bit_length() + 3))).astype(np.int64)
        whole = d[:-1] == d[1:]
        often = np.bincount(slot[whole], minlength=1)
        often = np.where(whole, often[np.minimum(slot, len(often) - 1)], 0)
        rank = np.where(often > 1, (np.frexp(often.astype(np.float64))[1].astype(np.uint64) << np.uint64(58)) | (h >> np.uint64(6)),
                        np.uint64(0))
        first = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))  # stretches of one rank
        top = rank[first]
        best = (top > 0) & (top > np.append(np.uint64(0), top[:-1])) & (top > np.append(top[1:], np.uint64(0)))
        size = np.diff(np.append(first, len(rank)))
        at = np.flatnonzero(np.repeat(best, size))
        at = at[(at - np.repeat(first, size)[at]) % 2 == 0]
        _, rule, uses = np.unique(key[at], return_inverse=True, return_counts=True)
        again = uses[rule] > 1
        if again.sum() * REST <= len(sym):
            break
        replace(at[again], rules + rule[again])
        rules += len(uses)
    while True:  # what is left: neighbours, from each document's first symbol on
        first = np.flatnonzero(np.append(True, d[1:] != d[:-1])) if len(d) else np.zeros(0, np.int64)
        nth = np.arange(len(d)) - np.repeat(first, np.diff(np.append(first, len(d))))
        at = np.flatnonzero((nth[:-1] % 2 == 0) & (d[:-1] == d[1:])) if len(d) else nth
        if not len(at):
            break
        replace(at, rules + np.arange(len(at)))
        rules += len(at)
    return tuple(np.concatenate(x) if nodes else np.zeros(0, np.int64) for x in (zip(*nodes) if nodes else ((),) * 4))


def _counted(most: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, period from 1 to most[row]) pairs, some at a time."""
    have = np.flatnonzero(most > 0)
    ends = np.cumsum(most[have])
    i = 0
    while i < len(have):
        done = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, done + CANDIDATES, "right")))
        n = most[have[i:j]]
        before = ends[i:j] - n - done
        yield np.repeat(have[i:j], n), np.arange(n.sum()) - np.repeat(before, n) + 1
        i = j


def _crossing(w: np.ndarray, hashes: _Hashes, s: np.ndarray, b: np.ndarray, e: np.ndarray, least: int,
              exponent: int) -> tuple[np.ndarray, ...]:
    """(window, start, end, period) of the runs across the boundaries b of the windows [s, e), within these."""
    out, whole = [], (e - s) // exponent
    for left, most in ((True, np.minimum((b - s) // 2, whole)), (False, np.minimum((e - b) // 2, whole))):
        for k, q in _counted(most):
            at = b[k]
            x, y = (at - q, at) if left else (at, at + q)
            near = np.flatnonzero((w[x] == w[y]) & (w[x - 1] == w[y - 1]))
            k, q, x, y = k[near], q[near], x[near], y[near]
            back = hashes.common(x, y, x - s[k], True)
            on = hashes.common(x, y, e[k] - y, False)
            start, end = x - back, y + on
            full = np.flatnonzero(end - start >= np.maximum(least, exponent * q))
            out.append((k[full], start[full], end[full], q[full]))
    k, start, end, q = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 4
    order = np.lexsort((q, end, start, k))
    k, start, end, q = k[order], start[order], end[order], q[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return k[new], start[new], end[new], q[new]


def _true(w: np.ndarray, start: np.ndarray, end: np.ndarray, q: np.ndarray) -> bool:
    """Whether all stretches have their periods, word by word."""
    for k, i in _counted(end - start - q):
        x = start[k] + i - 1
        if (w[x] != w[x + q[k]]).any():
            return False
    return True


def find_runs(w: np.ndarray, doc: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> tuple[np.ndarray, ...]:
    """(start, end, period) of all runs in the word ids ``w`` of consecutive documents, by start, then period."""
    if exponent < 4:  # one side of a boundary must hold two periods
        raise ValueError("runs of fewer than four periods are not looked for")
    rule, s, b, e = _grammar(w, doc)
    one = np.unique(rule, return_index=True)[1]
    one = one[e[one] - s[one] >= max(least, exponent)]
    base = 0
    while True:
        k, start, end, q = _crossing(w, _Hashes(w, base), s[one], b[one], e[one], least, exponent)
        if _true(w, start, end, q):
            break
        base += 1
    # to all places of a rule
    order = np.argsort(rule, kind="stable")
    sorted_ = rule[order]
    low, high = (np.searchsorted(sorted_, rule[one[k]], side) for side in ("left", "right"))
    n = high - low
    place = order[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    move = s[place] - np.repeat(s[one[k]], n)
    start, end, q = np.repeat(start, n) + move, np.repeat(end, n) + move, np.repeat(q, n)
    # cut-off parts go
    order = np.lexsort((-end, start, q))
    start, end, q = start[order], end[order], q[order]
    group = np.cumsum(np.append(False, q[1:] != q[:-1])) * (len(w) + 1) if len(q) else q
    reach = np.maximum.accumulate(end + group)
    stay = np.append(True, (end + group)[1:] > reach[:-1])[:len(q)]
    start, end, q = start[stay], end[stay], q[stay]
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    stay = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))[:len(q)]
    start, end, q = start[stay], end[stay], q[stay]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def _words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words, and where each row's begin and end."""
    rows = pc.ascii_split_whitespace(pc.fill_null(text, ""))
    flat = rows.flatten()
    full = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    bounds = np.append(0, np.cumsum(full))[rows.offsets.to_numpy() - rows.offsets[0].as_py()]
    return flat.filter(pa.array(full)), bounds


RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _collapse(text: pa.Array, least: int, exponent: int) -> tuple[pa.Array, pa.Array]:
    words, bounds = _words(text)
    ids = words.dictionary_encode().indices.to_numpy()
    doc = np.repeat(np.arange(len(text)), np.diff(bounds))
    start, end, q = find_runs(ids, doc, least, exponent)
    of = doc[start]
    runs = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(of, np.arange(len(text) + 1)), pa.int32()),
        pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start - bounds[of], end - start, q)], fields=list(_RUN)))
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, start + q, 1)
    np.add.at(cover, end, -1)
    kept = np.cumsum(cover[:-1]) == 0
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(kept))[bounds], pa.int32()), words.filter(pa.array(kept)))
    left = pc.binary_join(lists, " ")
    return runs, pc.if_else(pc.is_valid(text), left, pa.scalar(None, left.type))


def collapse_runs(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """doc_id, runs (start, length, period by start, then period), text: the words that no run repeats, joined by a space.

    A word stays unless a run contains it after that run's first period.
    """
    bounded_batches(docs.sparkSession)
    schema = docs.select("doc_id").schema.add("runs", RUNS).add("text", T.StringType())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, i = batch.column(1).cast(pa.string()), 0
            size = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy()) // 5  # words, about
            while i < len(text):
                j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + WORDS, "right")))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *_collapse(text.slice(i, j - i), least, exponent)],
                                                 names=["doc_id", "runs", "text"])
                i = j

    return docs.select("doc_id", "text").mapInArrow(work, schema)


def repeated_words(doc_id: str, text: str) -> Column:
    """The texts of every tenth document (by checksum of the id) with their later words in periods, as test data.

    With h the checksum of the id as text, g = h // 10 and h % 10 = 0, the words from a = g % n on
    become repeats of the next 1 + (n - a) // (3 + g % 8).  Null ids and texts without words change nothing.
    """
    words = f"filter(split({text}, '[ \\\\t\\\\n\\\\x0B\\\\f\\\\r]+'), x -> x <> '')"
    # transform over one element binds a value, so that it is computed once
    full = f"""transform(array({words}), w -> transform(array(named_struct('g', crc32(encode(cast({doc_id} AS string), 'UTF-8')) div 10, 'n', size(w))), v ->
      transform(array(named_struct('a', v.g % v.n, 'p', 1 + (v.n - v.g % v.n) div (3 + v.g % 8))), u ->
        array_join(transform(w, (x, i) -> if(i >= u.a, get(w, cast(u.a + (i - u.a) % u.p AS int)), x)), ' '))[0])[0])[0]"""
    some = f"crc32(encode(cast({doc_id} AS string), 'UTF-8')) % 10 = 0 AND {text} RLIKE '[^ \\\\t\\\\n\\\\x0B\\\\f\\\\r]'"
    return F.expr(f"CASE WHEN coalesce({some}, false) THEN {full} ELSE {text} END")
