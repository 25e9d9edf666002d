import random
import re
import zlib
from collections import Counter

import pytest

from fleetscope.llm import variants
from tests.llm.helpers import AWKWARD, SCHEMA, documents


def near(a, b):
    """Edit distance one, by trying every edit."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def naive(words, factor=5):
    out = {}
    for w, n in words.items():
        around = [x for x in words if near(w, x)]
        top = min(around, key=lambda x: (-words[x], x), default=None)
        out[w] = (n, top if top and words[top] >= factor * n else None, len(around))

    def root(w):
        return w if out[w][1] is None else root(out[w][1])

    return {(w, n, f, None if f is None else words[f], root(w), k) for w, (n, f, k) in out.items()}


@pytest.mark.parametrize("group", [3, 1000])
def test_equals_all_pairs(spark, group):
    rng, words = random.Random(2), {}
    for _ in range(60):
        w = "".join(rng.choice("abé") for _ in range(rng.randrange(6, 10)))
        for _ in range(5):
            words[w] = rng.choice([1, 2, 5, 10, 25, 60, 300])
            i, kind = rng.randrange(len(w)), rng.randrange(3)
            w = w[:i] + ("" if kind == 0 and len(w) > 6 else rng.choice("abñ")) + w[i + (kind == 1):]
    got = variants.variants(spark.createDataFrame(list(words.items()), "word string, n long"), group=group)
    assert {tuple(r) for r in got.collect()} == naive(words)
    assert got.count() == len(words)


def test_pairs_come_once_and_chains_end(spark):
    words = {"abcdef": 3, "abcdeg": 15, "abcdegh": 75, "abcdegg": 75, "zzzzzz": 5, "zzzzz0z": 25}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    pairs = [frozenset(r[:2]) for r in variants.near_pairs(df).collect()]
    assert len(pairs) == len(set(pairs)) == sum(near(a, b) for a in words for b in words) // 2
    got = {r["word"]: r for r in variants.variants(df).collect()}
    assert got["abcdef"]["form"] == "abcdeg" and got["abcdef"]["root"] == "abcdegg" and got["abcdegg"]["form"] is None


def test_one_chunk_shared_by_very_many_words(spark):
    words = {f"common{chr(97 + i // 676)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}": 1 + i % 7 for i in range(2000)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = variants.near_pairs(df, group=100)
    assert got.count() == replaced(words)


def replaced(words):
    """Pairs of equally long words that differ in one place."""
    stars = Counter(w[:i] + "*" + w[i + 1:] for w in words for i in range(len(w)))
    return sum(n * (n - 1) // 2 for n in stars.values())


def test_vocabulary_of_whole_texts(spark):
    data = [(i, "Straße STRASSE naïveté!! Größen-maß donaudampf " * 3 + "x" * i) for i in range(40)] + [(None, "donaudampf lonely"), (7, None)]
    got = {r["word"]: r["n"] for r in variants.vocabulary(documents(spark, data), min_count=5, thin=7).collect()}
    want = Counter()
    for i, text in data:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{i}:{w}".encode())
            if i is not None and h % 7 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            want[w] += 1
    assert got == {w: n for w, n in want.items() if len(w) >= 6 and n >= 5}
    assert len(got) > 5


def test_awkward_and_empty(spark):
    assert variants.variants(variants.vocabulary(documents(spark, AWKWARD), min_length=4, min_count=1)).count() > 3
    assert variants.variants(variants.vocabulary(spark.createDataFrame([], SCHEMA))).collect() == []
    df = spark.createDataFrame([(None, 3), ("nocount", None), ("repeat", 2), ("repeat", 3)], "word string, n long")
    assert [tuple(r) for r in variants.variants(df).collect()] == [("repeat", 5, None, None, "repeat", 0)]


def test_no_python_in_the_plan(spark):
    plan = variants.vocabulary(documents(spark, [(1, "abcdef")]).select("doc_id", "text"), thin=199)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
