import numpy as np
import pytest

from fleetscope.llm import ann


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, label int")


def brute(rows, queries, k=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for i, v in queries:
        s = x @ np.array(v, np.float32).astype(float)
        s[ids == i] = -np.inf
        order = np.lexsort((ids, -s))[:min(k, len(ids) - int((ids == i).sum()))]
        out[i] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("scale", [None, 3.0])
def test_recall_and_scores(spark, monkeypatch, scale):
    monkeypatch.setattr(ann, "CELL_ROWS", 300)
    monkeypatch.setattr(ann, "PART_ROWS", 200)
    monkeypatch.setattr(ann, "QUERY_ROWS", 30)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if scale:  # unequal lengths: inner product is not the angle
        x *= rng.uniform(0.5, scale, (1500, 1))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    t = table(spark, rows)
    got = found(ann.nearest(t, t.where("vec_id % 20 = 0")))
    want = brute(rows, rows[::20])
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    for q, near in got.items():
        true = x[q].astype(np.float32).astype(float)
        for i, s in near:
            assert s == pytest.approx(float(true @ x[i].astype(np.float32).astype(float)), abs=1e-12)
        assert near == sorted(near, key=lambda y: (-y[1], y[0]))


def test_many_copies_of_one_vector(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL_ROWS", 50)
    rng = np.random.default_rng(6)
    rows = [(i, [1.0, 0.0, 0.0, 0.5]) for i in range(300)] + [(1000 + i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(100, 4)) * 0.1)]
    t = table(spark, rows)
    got = found(ann.nearest(t, t.where("vec_id % 20 = 0")))
    want = brute(rows, [r for r in rows if r[0] % 20 == 0])
    for q in want:
        if q < 1000:
            assert [i for i, _ in got[q]] == [i for i, _ in want[q]]


def test_awkward_rows(spark):
    ok = [(20 * i, [float(i), 1.0, -2.0]) for i in range(1, 6)]
    bad = [(None, [1.0, 2.0, 3.0]), (40, [1.0]), (200, None), (220, []), (240, [0.0, 0.0, 0.0]), (260, [1.0, None, 0.0]),
           (280, [float("nan"), 0.0, 1.0]), (300, [float("inf"), 0.0, 1.0]), ok[0]]
    t = table(spark, ok + bad)
    got = found(ann.nearest(t, t.where("vec_id % 20 = 0")))
    assert got == {q: [(i, pytest.approx(s)) for i, s in near] for q, near in brute(ok, ok).items()}
    none = table(spark, [(1, None)])
    assert ann.nearest(none, none).collect() == []
    assert ann.nearest(table(spark, []), table(spark, [])).collect() == []


def test_chi_square():
    assert ann.chi2_cdf(ann.chi2_quantile(0.95, 12), 12) == pytest.approx(0.95)
    assert ann.chi2_quantile(0.95, 2) == pytest.approx(5.991464547)
    assert ann.chi2_quantile(0.95, 12) == pytest.approx(21.02607, abs=1e-4)
