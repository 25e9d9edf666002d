import pytest

from fleetscope.llm import mixing
from tests.llm.helpers import AWKWARD, SCHEMA, documents, prose


def shares(sizes, share=1.5, most=2.0):
    """Targets by handing the excess out again until none is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= most * sizes[s]}
        if not over:
            out |= {s: level * weight[s] for s in free}
            break
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        free -= over
    return out


def rows():
    out = list(AWKWARD)
    for s in range(5):
        out += [(1000 * s + i, prose(1000 * s + i, 5 + i % 40), "en", f"src{s}") for i in range(200 if s else 700)]
    return out


@pytest.fixture(params=[50_000, 40])
def bucket(request, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", request.param)
    monkeypatch.setattr(mixing, "FAN", 4)


def test_laws(spark, bucket):
    data = rows()
    got = mixing.mix_report(documents(spark, data)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in data)
    sizes, texts = {}, {(r[0], len((r[1] or "").split())): r[3] for r in data}
    for r in data:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    want, taken, most = shares(sizes), {}, {}
    for r in got:
        s = texts[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s] = taken.get(s, 0) + r["taken"]
        most[s] = max(most.get(s, 0), r["size"])
    for s, t in taken.items():
        assert abs(t - want[s]) <= 2 * most[s] + 1e-6
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= sum(2 * m for m in most.values())


def test_reruns_agree_over_other_partitions(spark, bucket):
    data = rows()
    one = mixing.mix_report(documents(spark, data)).collect()
    two = mixing.mix_report(documents(spark, data[::-1]).repartition(7)).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_fractions_are_kept_in_expectation():
    import numpy as np
    import pandas as pd
    hits = np.zeros(6)
    for k in range(3000):
        pdf = pd.DataFrame({"u_id": range(6), "th": [k * 6 + i for i in range(6)], "source": "s", "size": [3, 5, 2, 8, 4, 6], "m": 1,
                            "want": 0.0, "base": 0, "f": 0.3, "node": 0, "residual": True})
        out = mixing._pivot(0, True)(pdf)
        assert set(out["f"]) <= {0.0, 1.0}
        hits += out.sort_values("u_id")["f"].to_numpy()
    assert np.abs(hits / 3000 - 0.3).max() < 0.04


def test_mix_repeats_rows_as_the_report_says(spark):
    data = rows()
    df = documents(spark, data)
    out = mixing.mix(df)
    assert out.columns == df.columns
    taken = {}
    for r in mixing.mix_report(df).collect():
        taken[r["doc_id"], r["size"]] = taken.get((r["doc_id"], r["size"]), 0) + r["taken"]
    got = {}
    for r in out.collect():
        k = (r["doc_id"], len((r["text"] or "").split()))
        got[k] = got.get(k, 0) + k[1]
    assert got == {k: v for k, v in taken.items() if v}


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_report(empty).collect() == [] and mixing.mix(empty).collect() == []
