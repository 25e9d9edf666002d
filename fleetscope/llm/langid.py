"""Language identification by a linear-chain conditional random field.

A text is a row of words; every word gets the features of its whole form, its
beginnings and endings of up to four letters, its letter n-grams, and a lexicon (the
language in which the word, or else its ending, is most at home among the training
rows).  Transitions between the languages of neighbouring words are learned with the
feature weights, so code-switched text is labelled word by word, by forward-backward; a text's
language is the one with the largest sum of its words' marginals.

The field is fitted on a bounded sample of labelled rows: ``TRAIN_ROWS`` rows of each
language, those of the smallest id hashes.  Their words are dealt in short runs of one language
each, so that a training sequence switches between languages as mixed text does.
Long texts are labelled in sequences of ``SPAN`` words, all of them.

Nulls and ties: a null text, or one without a letter, is ``und`` with score 0.  Ties
go to the language that sorts first.  Without any labelled row everything is ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetscope.llm.common import bounded_batches, held_out, mix64

TRAIN_ROWS = 250     # labelled rows of each language that the field is fitted on
PARTS = 16              # of a language, each of which names its first rows
SPAN = 256           # words of one sequence
LETTERS = 32         # letters of a word; a longer one is cut into such pieces
BUCKETS = 1 << 16    # hashed features
KEPT_WORDS = 300_000  # words whose scores a worker keeps

_WORD = re.compile(r"[^\W\d_]{1,%d}" % LETTERS)


def words(text: str | None) -> list[str]:
    """The text's words in lower case; none if it holds no letter."""
    ws = _WORD.findall(text.lower()) if text else []
    return ws if any(map(str.isalpha, ws)) or any(c.isalpha() for w in ws for c in w) else []


def features(ws: list[str]) -> np.ndarray:
    """Feature buckets (one row a word; 0 fills up) of affixes, n-grams and whole words."""
    c = np.array(ws, dtype=f"<U{LETTERS}").view(np.uint32).reshape(len(ws), LETTERS).astype(np.uint64)
    n = (c > 0).sum(1)
    rows, out = np.arange(len(ws)), []

    def add(kind: int, h: np.ndarray, on: np.ndarray) -> None:
        h = mix64(h ^ np.uint64(kind << 56))
        out.append(np.where(on, 1 + (h % np.uint64(BUCKETS - 1)).astype(np.int64), 0).astype(np.int32))

    shift = np.uint64(21)
    gram = c.copy()
    for k in range(1, 5):  # gram[:, i]: k letters from place i on
        if k > 1:
            gram = np.pad((gram << shift) ^ mix64(gram >> np.uint64(40)), ((0, 0), (0, 1)))[:, :LETTERS]
            gram[:, :LETTERS - k + 1] ^= c[:, k - 1:]
        add(k, gram[:, 0], n >= k)
        add(8 + k, gram[rows, np.maximum(n - k, 0)], n >= k)
        if k in (2, 3):
            for i in range(int(n.max(initial=0)) - k + 1):
                add(16 + k, gram[:, i], n >= i + k)
    whole = np.zeros(len(ws), np.uint64)
    for i in range(int(n.max(initial=0))):
        whole = np.where(c[:, i] > 0, mix64(whole ^ c[:, i]), whole)
    add(32, whole, n > 0)
    return np.stack(out, 1) if len(ws) else np.zeros((0, 1), np.int32)


def _buckets(idx: np.ndarray, lex: np.ndarray) -> np.ndarray:
    """Feature rows with the lexicon's: the language of the whole word, or else of its three-letter ending."""
    return idx if not len(lex) else np.column_stack((idx, lex[idx[:, -1]]))


@dataclass
class Field:
    """langs, weights (bucket x language), the lexicon's feature of each bucket, and transitions."""
    langs: list[str]
    weight: np.ndarray
    lex: np.ndarray
    trans: np.ndarray
    start: np.ndarray

    def emissions(self, ws: list[str]) -> np.ndarray:
        out = np.zeros((len(ws), len(self.langs)), np.float32)
        for lo in range(0, len(ws), 8192):
            idx = _buckets(features(ws[lo:lo + 8192]), self.lex)
            for col in range(idx.shape[1]):
                out[lo:lo + 8192] += self.weight[idx[:, col]]
        return out

    def marginals(self, e: np.ndarray, on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward over sequences e (b x t x languages); on (b x t): places in use.

        Gives the places' marginals and the expected transitions."""
        b, t, m = e.shape
        p = np.exp(e - e.max(2, keepdims=True))
        p[~on] = 1.0
        move = np.exp(self.trans)
        f, g, scale = np.empty((t, b, m)), np.empty((t, b, m)), np.empty((t, b))
        f[0] = p[:, 0] * np.exp(self.start)
        scale[0] = f[0].sum(1)
        f[0] /= scale[0][:, None]
        for i in range(1, t):
            f[i] = (f[i - 1] @ move) * p[:, i]
            scale[i] = f[i].sum(1)
            f[i] /= scale[i][:, None]
        g[-1] = 1.0
        for i in range(t - 2, -1, -1):  # unused places lie at the end, where they must not weigh
            g[i] = (p[:, i + 1] * g[i + 1]) @ move.T / scale[i + 1][:, None]
            g[i][~on[:, i + 1]] = 1.0
        q = f * g
        q /= q.sum(2, keepdims=True)
        pairs = np.zeros((m, m))
        for i in range(1, t):
            x = p[:, i] * g[i] / scale[i][:, None]
            pairs += ((f[i - 1] * on[:, i, None]).T @ x) * move
        return q.transpose(1, 0, 2), pairs


def train(rows: list[tuple[str, str]], epochs: int = 3, rate: float = 0.15, seed: int = 7) -> Field:
    """Maximise the sequences' likelihood by AdaGrad steps, with decaying weights."""
    langs = sorted({lang for _, lang in rows})
    code = {x: i for i, x in enumerate(langs)}
    m, rng = len(langs), np.random.default_rng(seed)
    runs = []
    for text, lang in rows:
        ws, at = words(text), 0
        while at < len(ws):
            k = int(rng.integers(8, 65))
            runs.append((ws[at:at + k], code[lang]))
            at += k
    vocab: dict[str, int] = {}
    word = [np.array([vocab.setdefault(w, len(vocab)) for w in ws], np.int64) for ws, _ in runs]
    # the lexicon: of each whole-word and ending bucket, the language most at home there
    idx = features(list(vocab))
    seen = np.zeros((BUCKETS, m))
    for w, (_, y) in zip(word, runs, strict=True):
        np.add.at(seen[:, y], idx[w, -1], 1.0)
    share = seen / np.maximum(seen.sum(0), 1)
    sure = (seen.sum(1) >= 3) & (share.max(1) >= 0.8 * share.sum(1))
    sure[0] = False
    lex = np.where(sure, 1 + (mix64(share.argmax(1).astype(np.uint64) + np.uint64(991)) % np.uint64(BUCKETS - 1)).astype(np.int64), 0).astype(np.int32)
    idx = _buckets(idx, lex)
    field = Field(langs, np.zeros((BUCKETS, m), np.float32), lex, np.zeros((m, m)), np.zeros(m))
    sq, sq_t, sq_s = np.full((BUCKETS, m), 1e-2), np.full((m, m), 1.0), np.full(m, 1.0)
    for _ in range(epochs):
        order, seqs, now = rng.permutation(len(runs)), [], []
        size = 0
        for r in order:
            now.append(r)
            size += len(word[r])
            if size >= SPAN:
                seqs.append(now)
                now, size = [], 0
        seqs += [now] if now else []
        for lo in range(0, len(seqs), 16):
            part = seqs[lo:lo + 16]
            w = [np.concatenate([word[r] for r in s])[:SPAN] for s in part]
            y = [np.concatenate([np.full(len(word[r]), runs[r][1]) for r in s])[:SPAN] for s in part]
            t = max(map(len, w))
            on = np.array([[i < len(x) for i in range(t)] for x in w])
            gold = np.zeros((len(part), t), np.int64)
            ids = np.zeros((len(part), t), np.int64)
            for i, (a, b) in enumerate(zip(w, y, strict=True)):
                ids[i, :len(a)], gold[i, :len(b)] = a, b
            uniq, back = np.unique(ids, return_inverse=True)
            back = back.reshape(ids.shape)
            feats = idx[uniq]
            e = field.weight[feats].sum(1)[back].astype(float)
            q, pairs = field.marginals(e, on)
            diff = np.eye(m)[gold] - q
            diff[~on] = 0
            per = np.zeros((len(uniq), m))
            np.add.at(per, back.ravel(), diff.reshape(-1, m))
            grad = np.zeros((BUCKETS, m))
            np.add.at(grad, feats.ravel(), np.repeat(per, feats.shape[1], 0))
            hit = np.unique(feats)
            hit = hit[hit > 0]
            gr = grad[hit] - 1e-3 * field.weight[hit]
            sq[hit] += gr * gr
            field.weight[hit] += (rate * gr / np.sqrt(sq[hit])).astype(np.float32)
            true = np.zeros((m, m))
            np.add.at(true, (gold[:, :-1][on[:, 1:]], gold[:, 1:][on[:, 1:]]), 1.0)
            for par, g, s in ((field.trans, true - pairs - 1e-2 * field.trans, sq_t),
                              (field.start, diff[:, 0].sum(0) - 1e-2 * field.start, sq_s)):
                s += g * g
                par += rate * g / np.sqrt(s)
    return field


class Labeller:
    """Labels texts; keeps the scores of the words it has seen, up to KEPT_WORDS."""

    def __init__(self, field: Field):
        self.field, self.at, self.score = field, {}, np.zeros((0, len(field.langs)), np.float32)

    def codes(self, all_words: list[list[str]]) -> list[np.ndarray]:
        if len(self.at) > KEPT_WORDS:
            self.at, self.score = {}, self.score[:0]
        new = list({w for ws in all_words for w in ws} - self.at.keys())
        for w in new:
            self.at[w] = len(self.at)
        self.score = np.concatenate((self.score, self.field.emissions(new)))
        get = self.at.__getitem__
        return [np.fromiter(map(get, ws), np.int64, len(ws)) for ws in all_words]

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        """Sums of the words' marginals by language, of each text."""
        m = len(self.field.langs)
        code = self.codes([words(t) for t in texts])
        sums = np.zeros((len(texts), m))
        seqs = [(d, c[i:i + SPAN]) for d, c in enumerate(code) for i in range(0, len(c), SPAN)]
        seqs.sort(key=lambda x: len(x[1]))
        for lo in range(0, len(seqs), 256):
            part = seqs[lo:lo + 256]
            t = len(part[-1][1])
            ids, on = np.zeros((len(part), t), np.int64), np.zeros((len(part), t), bool)
            for i, (_, c) in enumerate(part):
                ids[i, :len(c)], on[i, :len(c)] = c, True
            q = self.marginals(self.score[ids].astype(float), on)
            np.add.at(sums, [d for d, _ in part], (q * on[:, :, None]).sum(1))
        return sums

    def marginals(self, e: np.ndarray, on: np.ndarray) -> np.ndarray:
        return self.field.marginals(e, on)[0]


def sample(docs: DataFrame, rows: int = TRAIN_ROWS) -> list[tuple[str, str]]:
    """At most ``rows`` (text, lang) of each language outside the held-out fold."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id"))
    pick = known.select("lang", F.xxhash64("doc_id").alias("o"), F.xxhash64("text").alias("h")).distinct()
    for part in (["lang", F.pmod(F.xxhash64("o", "h"), F.lit(PARTS))], ["lang"]):  # a language's rows are not gathered
        w = W.partitionBy(*part).orderBy("o", "h")
        pick = pick.withColumn("r", F.row_number().over(w)).where(F.col("r") <= rows).select("lang", "o", "h")
    text = known.select("text", F.col("lang").alias("l"), F.xxhash64("doc_id").alias("o2"), F.xxhash64("text").alias("h2"))
    got = text.join(F.broadcast(pick), (F.col("l") == F.col("lang")) & (F.col("o") == F.col("o2")) & (F.col("h") == F.col("h2")))
    got = got.groupBy("lang", "o", "h").agg(F.first("text").alias("text"))  # repeats go before they reach the driver
    return sorted((r["o"], r["text"], r["lang"]) for r in got.select("o", "text", "lang").collect())


def learn(docs: DataFrame, rows: int = TRAIN_ROWS) -> Field | None:
    got = [(t, lang) for _, t, lang in sample(docs, rows)]
    return train(got) if any(words(t) for t, _ in got) else None


def predict(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per row of ``docs``."""
    bounded_batches(docs.sparkSession)
    base = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    kind = base.schema["doc_id"].dataType.simpleString()
    if field is None:
        return base.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, langs = Labeller(shared.value), shared.value.langs
        for b in batches:
            sums = label(b.column(2).to_pylist())
            total = sums.sum(1)
            best = sums.argmax(1)
            lang = [langs[k] if n > 0 else "und" for k, n in zip(best, total, strict=True)]
            share = np.where(total > 0, sums.max(1) / np.maximum(total, 1e-12), 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(np.clip(share, 0, 1))],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    return base.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def label_words(text: str, field: Field) -> list[tuple[str, str, float]]:
    """(word, language, marginal) of each word, for code-switched text."""
    ws, out = words(text), []
    label = Labeller(field)
    for i in range(0, len(ws), SPAN):
        part = ws[i:i + SPAN]
        code = label.codes([part])[0]
        q = label.marginals(label.score[code][None].astype(float), np.ones((1, len(part)), bool))[0]
        out += [(w, field.langs[int(k)], float(p[k])) for w, p, k in zip(part, q, q.argmax(1), strict=True)]
    return out
