import hashlib
import random
import re

import numpy as np
import pytest

from fleetscope.llm import decontaminate as D
from tests.llm.helpers import AWKWARD, SCHEMA, documents, prose


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows, items, width=10):
    out = []
    for r in rows:
        w = words(r[1])
        hit, ids = set(), set()
        for i, t in items:
            iw = words(t)
            n = min(width, len(iw))
            phrases = {tuple(iw[k:k + n]) for k in range(len(iw) - n + 1)} if iw else set()
            for k in range(len(w) - n + 1 if phrases else 0):
                if tuple(w[k:k + n]) in phrases:
                    hit |= set(range(k, k + n))
                    ids.add(i)
        sha = hashlib.sha256(",".join(sorted(str(i) for i in ids if i is not None)).encode()).hexdigest()
        out.append((r[0], len(w), len(hit), len(ids), sha, bool(hit)))
    return sorted(out, key=str)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


ITEMS = [(1, prose(70, 30)), (2, "Short-phrase, here!"), (10, prose(71, 10)), (11, prose(71, 10).upper()), (12, None), (13, "…"), (14, "")]


def planted():
    a, b = ITEMS[0][1].split(), ITEMS[2][1]
    return AWKWARD + [
        (30, prose(1, 50) + " " + " ".join(a[3:14]) + ". " + prose(2, 9)), (31, " ".join(a[:9])), (32, b + " " + b),
        (33, "x short\nphrase   HERE y"), (34, " ".join(a)), (35, " ".join(a[:10] + ["zzz"] + a[10:25]))]


def test_matches_brute_force(spark):
    rows = planted()
    got = D.leak_report(documents(spark, rows), bench(spark, ITEMS))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, ITEMS)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rows = planted()
    monkeypatch.setattr(D, "ITEM_BLOCK", 2)
    got = D.leak_report(documents(spark, rows), bench(spark, ITEMS))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, ITEMS)


def test_rows_of_one_id_and_rows_without_id(spark):
    items = [(1, "a b c"), (1, "a b c"), (1, "x y z"), (None, "m n o"), (None, "q r s"), (None, "m n o")]
    rows = [(1, "zero a b c one x y z"), (2, "m n o and q r s"), (3, "a b c m n o"), (4, "nothing"), (4, "x y z")]
    got = sorted((tuple(r) for r in D.leak_report(documents(spark, rows), bench(spark, items)).collect()), key=str)
    assert got == brute(rows, items) and [r[3] for r in got] == [1, 1, 2, 0, 1]


def test_many_blocks_are_searched_one_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(D, "ITEM_BLOCK", 1)
    items = [(i // 2, prose(900 + i, 12)) for i in range(24)] + [(None, prose(960, 11))]
    rows = [(i, prose(i, 20) + " " + prose(900 + i, 12) + " " + " ".join(prose(901 + i, 12).split()[:10 + i % 3])) for i in range(26)] + AWKWARD
    held, real = [], D.Phrases.__init__

    def count(self, block, width=D.WIDTH):
        held.append(len(block))
        real(self, block, width)

    monkeypatch.setattr(D.Phrases, "__init__", count)
    out = D.leak_report(documents(spark, rows), bench(spark, items))
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows, items)
    assert sum(held) == len(items) and len(held) > 10 and "MapInArrow" not in out._jdf.queryExecution().toString()
    cut = D.remove_leaks(documents(spark, rows), bench(spark, items))
    assert D.leak_report(cut, bench(spark, items)).where("contaminated").count() == 0


def test_blocks_are_bounded_by_bytes_too(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_BYTES", 200)
    blocks = D._item_blocks(bench(spark, ITEMS))
    assert len(blocks) > 1 and sum(b.count() for b in blocks) == len({i for i in ITEMS if i[1] is not None})


def test_empty_tables(spark):
    docs = documents(spark, planted())
    assert D.leak_report(docs, bench(spark, [])).where("contaminated").count() == 0
    assert D.leak_report(spark.createDataFrame([], SCHEMA), bench(spark, ITEMS)).collect() == []


def test_removal_cuts_the_spans_and_nothing_else(spark):
    rows = planted()
    df = documents(spark, rows)
    out = {r["doc_id"]: r for r in D.remove_leaks(df, bench(spark, ITEMS)).collect()}
    assert list(next(iter(out.values())).asDict()) == df.columns
    assert 32 not in out and 34 not in out          # nothing was left of them
    assert out[30]["text"] == prose(1, 50) + " " + ". " + prose(2, 9)
    assert out[30]["n_chars"] == len(out[30]["text"])
    assert out[33]["text"] == "x  y"
    assert out[35]["text"] == " zzz "
    for i in (1, 2, 3, 4, 5, 6, 7, 8, 31):
        assert out[i]["text"] == dict((r[0], r[1]) for r in rows)[i]
    again = D.leak_report(D.remove_leaks(df, bench(spark, ITEMS)), bench(spark, ITEMS))
    assert again.where("contaminated").count() == 0


@pytest.mark.parametrize("seed", range(40))
def test_index_finds_every_phrase(seed):
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choice("abcd") for _ in range(rng.choice([0, 1, 2, 3, 5, 12])))) for i in range(5)]
    p = D.Phrases(items, 4)
    docs = [[rng.choice([b"a", b"b", b"c", b"d", b"e"]) for _ in range(rng.randrange(60))] for _ in range(6)]
    docs.append(docs[0] * 3)
    hit, got = D._shard(docs, p)
    for d, ws in enumerate(docs):
        (_, _, n, k, _, _), = brute([(0, b" ".join(ws).decode())], items, 4)
        assert (0 if hit[d] is None else int(hit[d].sum())) == n and len(got[d]) == k


def test_suffix_array_and_ranks():
    rng = np.random.default_rng(3)
    s = rng.integers(0, 4, 500)
    s = np.concatenate((s, s[:200], [0]))
    assert D.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    tree = D.WaveletMatrix(s, 3)
    c, i = rng.integers(0, 4, 100), rng.integers(0, len(s) + 1, 100)
    assert tree.rank(c, i).tolist() == [int((s[:b] == a).sum()) for a, b in zip(c, i, strict=True)]
