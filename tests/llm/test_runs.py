import random
import re
import zlib

import numpy as np
import pytest

from fleetscope.llm import runs
from tests.llm.helpers import AWKWARD, SCHEMA, documents, prose


def naive(w, least=6, exponent=4):
    """(start, end, period) by trying every period."""
    out = set()
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q) and not any(
                    all(w[x] == w[x + p] for x in range(i, j + q - p)) for p in range(1, q)):
                out.add((i, j + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(docs):
    flat = np.array([x for d in docs for x in d], np.int32)
    return list(zip(*(x.tolist() for x in runs.find_runs(flat, np.repeat(np.arange(len(docs)), [len(d) for d in docs])))))


def test_all_runs_as_by_trying_every_period():
    rng = random.Random(1)
    for _ in range(400):
        docs, want, off = [], [], 0
        for _ in range(rng.randrange(1, 5)):
            k = rng.choice([1, 2, 2, 3, 5, 50])
            w = [rng.randrange(k) for _ in range(rng.choice([0, 1, 5, 6, 20, 60, 150]))]
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(w) + 1)
                w[at:at] = [rng.randrange(k) for _ in range(rng.randrange(1, 9))] * rng.randrange(3, 9)
            docs.append(w)
            want += [(a + off, b + off, q) for a, b, q in naive(w)]
            off += len(w)
        assert found(docs) == want


def test_long_regular_sequences():
    n = 30_000
    thue = [bin(i).count("1") % 2 for i in range(n)]
    assert found([[0] * n]) == [(0, n, 1)]
    assert found([[0, 1] * (n // 2)]) == [(0, n, 2)]
    assert found([thue]) == [] and found([list(range(n))]) == []
    assert found([list(range(500)) * 40 + [1, 2], list(range(500)) * 4]) == [(0, 20_000, 500), (20_002, 22_002, 500)]
    fib = [0]
    nxt = [0, 1]
    while len(nxt) < 2000:
        fib, nxt = nxt, nxt + fib
    assert found([nxt]) == []  # Fibonacci words hold no fourth power


def test_a_false_hash_is_noticed(monkeypatch):
    real = runs._Hashes.equal
    tries = []

    class Weak(runs._Hashes):
        def __init__(self, w, base):
            super().__init__(w, base)
            tries.append(base)
            self.weak = base == 0

        def equal(self, x, y, n):
            return np.ones(len(x), bool) if self.weak else real(self, x, y, n)

    monkeypatch.setattr(runs, "_Hashes", Weak)
    w = [1, 2, 3] * 5 + [9] + [4] * 7
    assert found([w]) == naive(w) and tries == [0, 1]


def test_many_boundaries_in_small_portions(monkeypatch):
    monkeypatch.setattr(runs, "CANDIDATES", 7)
    w = [1, 2] * 9 + [3, 1, 2, 2] * 6 + [5] * 8
    assert found([w, w[3:]]) == [*naive(w), *[(a + len(w), b + len(w), q) for a, b, q in naive(w[3:])]]


def test_three_periods_are_refused():
    with pytest.raises(ValueError):
        runs.find_runs(np.zeros(9, np.int32), np.zeros(9, np.int64), exponent=3)


def test_collapsed_texts(spark, monkeypatch):
    monkeypatch.setattr(runs, "WORDS", 50)
    data = [(1, "a b a b a b a b"), (2, "x  no\tno no no\nno no end"), (3, "one two"), (4, prose(4, 300) + " la" * 70)]
    got = {r["doc_id"]: r for r in runs.collapse_runs(documents(spark, data)).collect()}
    assert got[1]["text"] == "a b" and [tuple(x) for x in got[1]["runs"]] == [(0, 8, 2)]
    assert got[2]["text"] == "x no end" and [tuple(x) for x in got[2]["runs"]] == [(1, 6, 1)]
    assert got[3]["text"] == "one two" and got[3]["runs"] == []
    assert got[4]["text"] == prose(4, 300) + " la"


def test_awkward_and_empty(spark):
    got = runs.collapse_runs(documents(spark, AWKWARD)).collect()
    words = lambda t: None if t is None else " ".join(re.findall(r"[^\x20\x09-\x0D]+", t))
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(((r[0], words(r[1])) for r in AWKWARD), key=str)
    assert runs.collapse_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def test_repeated_words_as_test_data(spark):
    data = [(i, prose(i, 1 + i % 40)) for i in range(120)] + [(None, "a b"), (500, None), (501, " \n")]
    got = documents(spark, data).select("doc_id", runs.repeated_words("doc_id", "text").alias("t")).collect()
    want, made = {}, 0
    for i, text in data:
        h = zlib.crc32(str(i).encode())
        g, w = h // 10, (text or "").split()
        if i is not None and h % 10 == 0 and w:
            n = len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text, made = " ".join(w[k] if k < a else w[a + (k - a) % p] for k in range(n)), made + 1
        want[i] = text
    assert {r["doc_id"]: r["t"] for r in got} == want and made > 3
