"""Toxicity by a weighted lexicon.

Texts are folded: compatibility forms, case, homoglyphs of other scripts, digit and
sign substitutions, accents of single letters stay.  One Aho-Corasick automaton finds
all entries, whole words and word beginnings, and all exception phrases; a hit inside
an exception phrase does not count.  The weights of a document's hits, also as weight per
thousand words, give its score through a logistic curve.

``learn`` builds the lexicon from a bounded sample of labelled rows (``TRAIN_ROWS``; rows of equal id, text and
label count once, and of one id and label at most ``ID_TEXTS`` texts):
Spark counts, for every word and word beginning, the toxic and other documents that hold it;
a gram enters if it is ``LEAST_RATIO`` times as frequent in toxic documents and its
log-likelihood ratio against the labels is at least ``LEAST_LLR`` beyond what the entries nested
with it explain.  Its weight is its log odds.  Copies of one toxic document (a word Jaccard of ``COPY`` or
more with one that counts) count as one there, else every word of theirs would look like an entry.

Exception phrases are mined from the same rows (``mine``), beside the fixed ones: a word with an entry and the
word before or after it, if documents that are not toxic hold the two in ``EXCEPTION_USES`` or more different
surroundings (so that copies count once), and toxic ones hold them no more often by their share.

Nulls and ties: null or empty text has no hit and the lowest score.  Labels that are null
or belong to no document are not learned from; a document labelled twice counts once for each
label.  Without labels of both kinds the model has no learned entry and a fixed curve.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from fleetscope.llm.common import bounded_batches, held_out, materialize, tables

TRAIN_ROWS = 12_000     # labelled rows a model is fitted on, those of the smallest id hashes
ID_TEXTS = 16           # texts of one id and label among them, those of the smallest hashes
MAX_ENTRIES = 5_000     # entries of a lexicon: bounds what each task receives
LEAST_LLR = 30.0
LEAST_RATIO = 12.0      # how much more often an entry stands in toxic documents
STEMS = range(4, 9)     # letters of word beginnings that may become entries
EXCEPTION_USES = 5      # different surroundings in documents not toxic that make a phrase an exception
COPY = 0.8              # word Jaccard from which a toxic document is a copy of another
THRESHOLD = 0.3

# Look-alike letters of other scripts, with the Latin letter they imitate.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k",
    "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "х": "x", "α": "a", "β": "b",
    "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ɑ": "a", "ɡ": "g", "ı": "i", "ʟ": "l", "ո": "n", "օ": "o", "ս": "u",
}
# Digits and signs written for letters; i, l and 1 are one letter.
SUBSTITUTIONS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
                 "l": "i", "|": "i"}
# Phrases in which an entry is harmless.
EXCEPTIONS = ("trash can", "trash cans", "trash bin", "trash bins", "trash bag", "clown fish", "clown car",
              "scum of pond", "pond scum", "loser bracket", "losers bracket", "pathetic fallacy")

_INVISIBLE = "­​‌‍⁠﻿"
_TABLE = {ord(a): b for a, b in {**HOMOGLYPHS, **SUBSTITUTIONS}.items()}
_TABLE |= dict.fromkeys(map(ord, _INVISIBLE), None)
_TABLE |= {c: " " for c in range(128) if not chr(c).isalnum() and chr(c) not in SUBSTITUTIONS}
_TABLE |= {ord(c): " " for c in "«»“”‘’„…–—¡¿·•   "}


def fold(text: str) -> str:
    """The text's folded words between single spaces, with one at either end."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return f" {' '.join(text.lower().translate(_TABLE).split())} "


@dataclass
class Lexicon:
    """entries: folded pattern to weight; ' word ' is a whole word, ' stem' a beginning."""
    entries: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (-4.0, 1.5, 0.5)

    def automaton(self):
        import ahocorasick
        a = ahocorasick.Automaton()
        for p, w in self.entries.items():
            a.add_word(p, (len(p), w))
        for p in {fold(x) for x in self.exceptions}:
            a.add_word(p, (len(p), None))  # a phrase that is an entry too is an exception
        if len(a):
            a.make_automaton()
        return a

    def measure(self, folded: str, automaton) -> tuple[float, int, int]:
        """Weight and number of the hits outside exception phrases; number of words."""
        n = max(0, folded.count(" ") - 1)
        if not len(automaton):
            return 0.0, 0, n
        hits = [(end - size + 1, end, w) for end, (size, w) in automaton.iter(folded)]
        hits.sort(key=lambda h: (h[0], h[2] is not None))
        at, reach = {}, -1  # of the entries that begin at one word the heaviest counts
        for a, b, w in hits:  # by where they begin, phrases first: reach is the furthest end of a phrase begun so far
            if w is None:
                reach = max(reach, b)
            elif b > reach:
                at[a] = max(at.get(a, w), w)
        return sum(at.values()), len(at), n

    def features(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        a = self.automaton()
        got = np.array([self.measure(fold(t), a) if t else (0.0, 0, 0) for t in texts], float).reshape(-1, 3)
        return np.column_stack((np.ones(len(got)), np.log1p(got[:, 0]), np.log1p(1000 * got[:, 0] / np.maximum(got[:, 2], 1)))), got

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.curve), -30, 30)))


def _grams(text: str) -> set[str]:
    ws = set(fold(text).split())
    return {f" {w} " for w in ws} | {f" {w[:k]}" for w in ws for k in STEMS if len(w) > k}


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold a gram, by label, summed over the task in parts of bounded size."""
    pos, neg = Counter(), Counter()

    def part():
        keys = list(pos.keys() | neg.keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([pos[k] for k in keys], pa.int64()), pa.array([neg[k] for k in keys], pa.int64())],
            ["gram", "pos", "neg"])

    for texts, toxic in tables(batches, "text", "toxic"):
        for t, y in zip(texts, toxic, strict=True):
            (pos if y else neg).update(_grams(t or ""))
            if len(pos) + len(neg) > 400_000:
                yield part()
                pos, neg = Counter(), Counter()
    yield part()


def _llr(pos, neg, n_pos, n_neg):
    """Log-likelihood ratio of a gram's counts against the labels' shares; 0 if it speaks for the other."""
    xlogy = lambda x, y: x * np.log(np.maximum(y, 1e-300))
    n, k = n_pos + n_neg, pos + neg
    p, a, b = n_pos / n, pos / np.maximum(k, 1), (n_pos - pos) / np.maximum(n - k, 1)
    of = lambda q, x, m: xlogy(x, q) + xlogy(m - x, 1 - q)
    return np.where(a > p, 2 * (of(a, pos, k) + of(b, n_pos - pos, n - k) - of(p, n_pos, n)), 0.0)


def _words(text: str) -> bytes:
    """Sorted hashes of the text's folded words."""
    return np.unique(np.array([xxhash.xxh3_64_intdigest(w) for w in set(fold(text).split())], np.uint64)).tobytes()


def _apart(docs: list[tuple[bytes, list[str]]], copy: float = COPY) -> list[list[str]]:
    """The grams of documents whose word Jaccard with every earlier one of them is below ``copy``.

    Two sets as alike as that share one of the first words of either, rare words first, as many as may be
    missing and one more: only documents that share such a word are compared, on all their words.
    """
    sets = [np.frombuffer(words, np.uint64) for words, _ in docs]
    _, at, n = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_inverse=True, return_counts=True)
    rank = np.empty(len(n), np.int64)
    rank[np.argsort(n, kind="stable")] = np.arange(len(n))
    ranks = [np.sort(x) for x in np.split(rank[at], np.cumsum([len(x) for x in sets])[:-1])] if sets else []
    holders, out, empty = {}, [], False
    for d, r in enumerate(ranks):
        first = r[:len(r) - math.ceil(copy * len(r) - 1e-9) + 1].tolist()
        near = {e for w in first for e in holders.get(w, ()) if copy * len(r) <= len(ranks[e]) <= len(r) / copy}
        if any((both := len(np.intersect1d(r, ranks[e], assume_unique=True))) >= copy * (len(r) + len(ranks[e]) - both) for e in near):
            continue
        if not len(r):
            if empty:
                continue
            empty = True
        out.append(docs[d][1])
        for w in first:
            holders.setdefault(w, []).append(d)
    return out


def _select(grams: dict[str, tuple[int, int]], docs: list[list[str]], n_neg: int) -> list[str]:
    """Entries, strongest first.

    A gram must be strong on the documents (copies apart) that no entry nested with it
    covers: of a word, its beginnings and longer words with the same beginning, the strongest
    stands for all, and others enter only by what they add.
    """
    holders = {g: set() for g in grams}
    for d, gs in enumerate(docs):
        for g in gs:
            holders[g].add(d)
    names = list(grams)
    neg = np.array([grams[g][1] for g in names], float)
    value = _llr(np.array([len(holders[g]) for g in names], float), neg, len(docs), n_neg)
    chosen, inner, by_core = [], {}, {}
    for i in sorted(np.flatnonzero(value >= LEAST_LLR), key=lambda k: (-value[k], -len(names[k]), names[k])):
        core = names[i].strip()
        starts = [core[:k] for k in range(1, len(core) + 1)]
        # entries this gram extends, and entries that extend it
        nested = {e for c in starts for e in by_core.get(c, ()) if e[-1] != " " or c == core} | inner.get(core, set())
        left = holders[names[i]].difference(*(holders[e] for e in nested))
        if nested and _llr(np.array([float(len(left))]), neg[i:i + 1], len(docs), n_neg)[0] < LEAST_LLR:
            continue
        chosen.append(names[i])
        by_core.setdefault(core, set()).add(names[i])
        for c in starts:
            inner.setdefault(c, set()).add(names[i])
        if len(chosen) == MAX_ENTRIES:
            break
    return chosen


def _uses(folded: str, lexicon: Lexicon, automaton) -> set[tuple[str, str]]:
    """(phrase, surroundings) of the words with an entry: each with its neighbour on either side."""
    out = set()
    for end, (size, weight) in automaton.iter(folded):
        if weight is None:
            continue
        a = end - size + 2                                  # where the word begins
        b = folded.index(" ", a)
        before = folded[max(0, a - 200):a - 1].rsplit(" ", 2)[1:] if a > 1 else []
        after = folded[b + 1:b + 200].split(" ", 2)[:2]
        word, left, right = folded[a:b], before[-1] if before else "", after[0] if after else ""
        if left:
            out.add((f"{left} {word}", f"{before[0] if len(before) > 1 else ''} {right}"))
        if right:
            out.add((f"{word} {right}", f"{left} {after[1] if len(after) > 1 else ''}"))
    return out


def mine(train: DataFrame, lexicon: Lexicon, n_pos: int, n_neg: int) -> tuple[str, ...]:
    """Phrases of two folded words in which an entry is harmless, from labelled rows (text, toxic)."""
    def run(batches):
        a = lexicon.automaton()
        for texts, toxic in tables(batches, "text", "toxic"):
            got = [(p, xxhash.xxh3_64_intdigest(c) >> 1, y) for t, y in zip(texts, toxic, strict=True) if t and len(a)
                   for p, c in sorted(_uses(fold(t), lexicon, a))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.int64()),
                 pa.array([g[2] for g in got], pa.int32())], ["phrase", "around", "toxic"])

    met = train.mapInArrow(run, "phrase string, around long, toxic int").distinct()
    count = met.groupBy("phrase").agg(F.sum(F.col("toxic").cast("long")).alias("pos"), F.sum(1 - F.col("toxic").cast("long")).alias("neg"))
    found = count.where((F.col("neg") >= EXCEPTION_USES) & (F.col("pos") * n_neg <= F.col("neg") * n_pos)).select("phrase")
    return tuple(sorted(r[0] for r in found.collect()))  # bounded by the sample


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, ...]:
    """Logistic regression by Newton steps; neither slope may fall below zero."""
    w, free = np.zeros(x.shape[1]), list(range(x.shape[1]))
    for _ in range(60):
        z = x[:, free]
        p = 1 / (1 + np.exp(-np.clip(z @ w[free], -30, 30)))
        reg = ridge * (np.array(free) > 0)
        h = (z * (p * (1 - p))[:, None]).T @ z + np.diag(reg + 1e-6)
        step = np.linalg.solve(h, z.T @ (y - p) - reg * w[free])
        w[free] += np.clip(step, -2, 2)
        if (bad := [k for k in free if k and w[k] < 0]) and np.abs(step).max() < 1e-3:
            w[bad] = 0
            free = [k for k in free if k not in bad]
        elif np.abs(step).max() < 1e-6:
            break
    return tuple(np.maximum(w, [-np.inf] + [0] * (len(w) - 1)).tolist())


def _sample(docs: DataFrame, known: DataFrame, rows: int) -> DataFrame:
    """(text, toxic) of at most ``rows`` rows of the ids in ``known`` (l_id, toxic), each id, text and label once.

    Rows are chosen by the hashes of their texts, so that repeats and an id that very many rows have
    are reduced before any text is shuffled.
    """
    met = (docs.select("doc_id", "text").where("text IS NOT NULL")
           .join(F.broadcast(known), F.col("doc_id") == F.col("l_id")).select("l_id", "toxic", F.xxhash64("text").alias("th"), "text"))
    w = W.partitionBy("l_id", "toxic").orderBy("th")
    pick = (met.select("l_id", "toxic", "th").distinct().withColumn("r", F.row_number().over(w)).where(F.col("r") <= ID_TEXTS)
            .orderBy(F.xxhash64("l_id"), "l_id", "toxic", "th").limit(rows).select("l_id", "toxic", "th"))
    pick = docs.sparkSession.createDataFrame(pick.collect(), pick.schema)  # bounded by rows
    return (met.join(F.broadcast(pick), ["l_id", "toxic", "th"]).groupBy("l_id", "toxic", "th").agg(F.first("text").alias("text"))
            .select("text", "toxic"))


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS,
          exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Fit a lexicon on at most ``rows`` labelled rows outside the held-out fold."""
    bounded_batches(docs.sparkSession)
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
             .select(F.col("doc_id").alias("l_id"), (F.col("toxic") > 0).cast("int").alias("toxic"))
             .orderBy(F.xxhash64("l_id"), "l_id", "toxic").limit(rows))
    known = docs.sparkSession.createDataFrame(known.collect(), known.schema)  # bounded by rows
    train = materialize(_sample(docs, known, rows), "toxicity-sample")
    size = dict(train.groupBy("toxic").count().collect())
    n_pos, n_neg = size.get(1, 0), size.get(0, 0)
    lexicon = Lexicon(exceptions=exceptions)
    if not n_pos or not n_neg:
        return lexicon
    least = max(2, math.ceil(LEAST_LLR / (2 * math.log((n_pos + n_neg) / n_pos)))) if n_pos < n_pos + n_neg else 2
    counts = (train.mapInArrow(_count, "gram string, pos long, neg long")
              .groupBy("gram").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
              .where((F.col("pos") >= least) & (F.col("pos") * n_neg > F.col("neg") * n_pos * LEAST_RATIO)))
    rows_ = [r for r in counts.toLocalIterator() if _llr(float(r["pos"]), float(r["neg"]), n_pos, n_neg) >= LEAST_LLR]
    grams = {r["gram"]: (r["pos"], r["neg"]) for r in rows_}

    def held(batches):
        for (texts,) in tables(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [pa.array([_words(t) for t in texts], pa.binary()),
                 pa.array([sorted(_grams(t) & grams.keys()) for t in texts], pa.list_(pa.string()))], ["words", "grams"])

    toxic = train.where("toxic = 1").select("text").mapInArrow(held, "words binary, grams array<string>").collect()
    for g in _select(grams, _apart(sorted((bytes(r["words"]), list(r["grams"])) for r in toxic)), n_neg):
        pos, neg = grams[g]
        lexicon.entries[g] = math.log((pos + 0.5) / (n_pos + 1)) - math.log((neg + 0.5) / (n_neg + 1))

    lexicon.exceptions += mine(train, lexicon, n_pos, n_neg)

    def measure(batches):
        for texts, y in tables(batches, "text", "toxic"):
            x, _ = lexicon.features(texts)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 1]), pa.array(x[:, 2]), pa.array(y, pa.int32())], ["x1", "x2", "y"])

    seen = sorted(tuple(r) for r in train.mapInArrow(measure, "x1 double, x2 double, y int").collect())
    a = np.array(seen, float)
    lexicon.curve = _fit(np.column_stack((np.ones(len(a)), a[:, :2])), a[:, 2])
    return lexicon


def _scored(docs: DataFrame, lexicon: Lexicon, columns: list[str]) -> DataFrame:
    """The columns as c0, c1, ... (no name can clash) with score, n_hits and hit_weight."""
    bounded_batches(docs.sparkSession)
    base = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], "text")
    schema = T.StructType([*base.schema.fields[:-1], T.StructField("score", T.DoubleType()),
                           T.StructField("n_hits", T.LongType()), T.StructField("hit_weight", T.DoubleType())])

    def run(batches):
        for b in batches:
            x, got = lexicon.features(b.column(b.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(lexicon.score(x)), pa.array(got[:, 1].astype(np.int64)), pa.array(got[:, 0])],
                [f.name for f in schema.fields])

    return base.mapInArrow(run, schema)


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, score, n_hits, hit_weight: one row per row of ``docs``."""
    return _scored(docs, lexicon, ["doc_id"]).withColumnRenamed("c0", "doc_id")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score is ``threshold`` or more."""
    out = _scored(docs, learn(docs, labels), docs.columns).where(F.col("score") < threshold)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
