import itertools
import random
import re

import numpy as np
import pytest

from fleetscope.llm import near_dup
from fleetscope.llm.components import components
from tests.llm.helpers import AWKWARD, SCHEMA, documents, prose


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, num=85, den=100):
    """{row number: (n, component)} by comparing every pair."""
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in itertools.combinations(range(len(rows)), 2):
        i = len(sets[a] & sets[b])
        if sets[a] and sets[b] and den * i >= num * (len(sets[a]) + len(sets[b]) - i):
            root[find(a)] = find(b)
    low = {}
    for k, r in enumerate(rows):
        low.setdefault(find(k), []).append(r[0])
    out = []
    for k, r in enumerate(rows):
        ids = [x for x in low[find(k)] if x is not None]
        c = (min(ids) if ids else None) if sets[k] else r[0]
        out.append((r[0], len(sets[k]), c, c is None or r[0] == c))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def edited(text, seed, n):
    rng, w = random.Random(seed), text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def test_matches_all_pairs_on_edited_copies(spark):
    rows, k = [], 0
    for g in range(12):
        base = prose(g, random.Random(g).randrange(20, 250))
        for c in range(random.Random(g + 50).randrange(1, 12)):
            rows.append((k, edited(base, 100 * g + c, c // 2 * max(1, len(base) // 900))))
            k += 1
    rows += [(k + i, prose(1000 + i, 80)) for i in range(30)]
    assert found(near_dup.near_duplicates(documents(spark, rows))) == brute(rows)


def test_one_large_group_of_near_copies(spark):
    """Members link to some of the others only, so one pivot does not settle the bucket."""
    base = prose(3, 150)
    rows = [(i, edited(base, i, 1 + i % 5)) for i in range(150)] + [(500 + i, base.upper()) for i in range(40)]
    assert found(near_dup.near_duplicates(documents(spark, rows))) == brute(rows)


def test_awkward_rows(spark):
    got = found(near_dup.near_duplicates(documents(spark, AWKWARD)))
    assert got == brute(AWKWARD)


def test_empty_table(spark):
    assert near_dup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    assert near_dup.drop_near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_small_sets_at_the_threshold(spark):
    w = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(w[:24])), (2, " ".join(w[:23])), (3, " ".join(w[:30])), (4, "a b c d"), (5, "A b c D"), (6, "a b c")]
    assert found(near_dup.near_duplicates(documents(spark, rows))) == brute(rows)


def test_stage_keeps_one_row_of_each_class(spark):
    base = prose(9, 100)
    rows = AWKWARD + [(20, base), (21, base), (21, base), (22, edited(base, 1, 1)), (23, prose(10, 90))]
    df = documents(spark, rows)
    out = near_dup.drop_near_duplicates(df)
    assert out.columns == df.columns
    ids = sorted(str(r["doc_id"]) for r in out.select("doc_id").collect())
    assert ids == sorted(map(str, [1, 2, 3, 4, None, 5, 6, 7, 8, None, 20, 23]))


def test_registers_estimate_the_similarity_and_merge():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    for share in (0.3, 0.6, 0.85, 0.95):
        n = 1000
        both = int(round(2 * n * share / (1 + share)))
        a, b = pool[:n], pool[n - both:2 * n - both]
        ra, rb, ru = near_dup.registers([a, b, np.unique(np.concatenate((a, b)))])
        assert (np.maximum(ra, rb) == ru).all()
        assert abs((ra == rb).mean() - share) < 0.12
        ok = near_dup.plausible(np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]), np.array([n]), np.array([n]), 0.85)[0]
        assert ok == (share >= 0.85)


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{i: 100 for i in range(100, 130)}, **{i: 200 for i in range(200, 203)}}
    assert components(df.where("a < 0")).collect() == []


TEXTS = ["", "a", "AÉ b", "x\x0by\x1cz", " lead and trail \n", "a b c d e", "a b c d e f a b c d e", "É" * 50, "one two\tthree"]


def test_words_are_runs_between_ascii_blanks():
    seen = {}
    for t in [*TEXTS, prose(1, 300)]:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t)
        want = re.findall(r"[^\x20\x09-\x0D]+", low)
        got = near_dup.word_hashes(t.encode())[0].tolist()
        assert len(got) == len(want)
        for h, w in zip(got, want, strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("piece", [1 << 21, 64, 7])
def test_shingle_sets_do_not_depend_on_the_batch(monkeypatch, piece):
    texts = [*TEXTS, None, prose(1, 300), prose(2, 4), "w" * 300]
    alone = [near_dup.shingle_sets([t])[0].tolist() for t in texts]
    assert [len(x) for x in alone] == [len(shingles(t)) for t in texts]
    monkeypatch.setattr(near_dup, "TEXT_BYTES", piece)
    assert [x.tolist() for x in near_dup.shingle_sets(texts)] == alone
