import random

import numpy as np

from fleetscope.llm import langid as L
from tests.llm.helpers import AWKWARD, SCHEMA, documents, held

SOUNDS = {"xa": ["tha", "ing", "oth", "er", "wh"], "xb": ["sch", "ung", "ein", "ä", "ich"], "xc": ["eau", "é", "oi", "que", "aux"]}


def text(lang, seed, n):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def rows(n=240):
    langs = sorted(SOUNDS)
    return [(i, text(langs[i % 3], i, 10 + i % 50), langs[i % 3]) for i in range(n)]


def test_held_out_accuracy(spark):
    data = rows()
    docs = documents(spark, data)
    got = {r["doc_id"]: r for r in L.predict(docs, L.learn(docs)).collect()}
    assert len(got) == len(data)
    right = [got[i]["lang_pred"] == lang for i, _, lang in data if held(i)]
    assert np.mean(right) > 0.97 and all(0 <= r["score"] <= 1 for r in got.values())
    assert all(r["held_out"] == held(i) for i, r in got.items())


def test_words_of_code_switched_text(spark):
    field = L.train([(t, lang) for _, t, lang in rows()])
    mixed = text("xa", 901, 30) + " " + text("xb", 902, 30)
    labels = [lang for _, lang, _ in L.label_words(mixed, field)]
    assert np.mean([x == "xa" for x in labels[:30]]) > 0.9 and np.mean([x == "xb" for x in labels[30:]]) > 0.9
    assert np.diag(field.trans).min() > (field.trans - np.diag(np.full(3, np.inf))).max()


def test_forward_backward_matches_enumeration():
    import itertools
    rng = np.random.default_rng(1)
    field = L.Field(["a", "b"], np.zeros((1, 2)), np.zeros(1, np.int32), rng.normal(size=(2, 2)), rng.normal(size=2))
    e, on = rng.normal(size=(2, 4, 2)), np.array([[1, 1, 1, 1], [1, 1, 0, 0]], bool)
    q, pairs = field.marginals(e, on)
    want_pairs = np.zeros((2, 2))
    for s, n in ((0, 4), (1, 2)):
        marg, z, pr = np.zeros((n, 2)), 0.0, np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(field.start[y[0]] + sum(e[s, i, y[i]] for i in range(n)) + sum(field.trans[a, b] for a, b in itertools.pairwise(y)))
            z += w
            for i in range(n):
                marg[i, y[i]] += w
            for a, b in itertools.pairwise(y):
                pr[a, b] += w
        assert np.allclose(q[s, :n], marg / z)
        want_pairs += pr / z
    assert np.allclose(pairs, want_pairs)


def test_features_do_not_depend_on_the_batch():
    one = L.features(["straße", "a", "x" * 32])
    for i, w in enumerate(["straße", "a", "x" * 32]):
        alone = L.features([w])[0]
        assert set(alone[alone > 0]) == set(one[i][one[i] > 0])


def test_awkward_and_empty(spark):
    data = AWKWARD + [(50, "123 456 --", "de"), (51, "² ½ _", "de")]
    docs = documents(spark, data)
    got = L.predict(docs, L.learn(docs)).collect()
    assert len(got) == len(data)
    for r in got:
        t = dict((x[0], x[1]) for x in data).get(r["doc_id"])
        if r["doc_id"] is not None:
            assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in t or ""))
    empty = spark.createDataFrame([], SCHEMA)
    assert L.predict(empty, L.learn(empty)).collect() == []
    assert L.predict(docs, None).where("lang_pred <> 'und' OR score <> 0").count() == 0


def test_repeats_do_not_fill_the_sample(spark):
    data = rows(120)
    first = L.sample(documents(spark, data), 1)[0][1]
    many = data + [x for x in data if x[1] == first] * 200
    assert L.sample(documents(spark, many), 20) == L.sample(documents(spark, data), 20)
