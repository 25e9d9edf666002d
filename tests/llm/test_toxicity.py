import random
import time
from collections import Counter

import numpy as np

from fleetscope.llm import toxicity as X
from tests.llm.helpers import AWKWARD, SCHEMA, documents, held, prose


def corpus(n=900):
    rng, rows, labels = random.Random(4), [], []
    for i in range(n):
        words, toxic = prose(i, rng.randrange(20, 120)).split(), i % 9 == 0
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["grolk", "snaffel" + rng.choice(["en", "ung", "s"])]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learns_words_and_stems_and_scores_held_out_rows(spark):
    rows, labels = corpus()
    docs = documents(spark, rows)
    lexicon = X.learn(docs, table(spark, labels))
    assert any("groik" in e for e in lexicon.entries) and any("snaffe" in e for e in lexicon.entries)
    got = {r["doc_id"]: r["score"] for r in X.score(docs, lexicon).collect()}
    assert all(0 <= s <= 1 for s in got.values())
    for i, _, toxic in labels:
        if held(i):
            assert (got[i] >= 0.3) == bool(toxic)


def test_disguises_fold_to_the_same_words():
    for t in ("grolk", "GROLK", "gr0lk", "gro1k", "grоlk", "ｇｒｏｌｋ", "gr​olk", "grolk!!", "«grolk»"):
        assert X.fold(t) == " groik ", t
    assert X.fold("") == "  " or X.fold("").strip() == ""


def test_exceptions_and_length():
    folded = X.Lexicon({X.fold("trash"): 5.0, " scum": 4.0}, X.EXCEPTIONS, (-3.0, 1.0, 1.0))
    a = folded.automaton()
    assert folded.measure(X.fold("a trash can, pond scum"), a)[:2] == (0, 0)
    assert folded.measure(X.fold("trash can of trash"), a)[:2] == (5.0, 1)
    short, long_ = (folded.score(folded.features([t])[0])[0] for t in ("trash", "trash " + "word " * 500))
    assert short > long_


def test_labels_are_never_learned_from_the_held_out_fold(spark):
    rows, labels = corpus()
    only_held = [x for x in labels if held(x[0])]
    assert X.learn(documents(spark, rows), table(spark, only_held)).entries == {}


def test_awkward_and_empty(spark):
    docs, labels = documents(spark, AWKWARD), table(spark, [(5, 1, None), (None, 1, 1), (999, 0, 1), (5, 1, 1), (5, 1, 0)])
    out = X.score(docs, X.learn(docs, labels)).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in out)
    kept = X.drop_toxic(docs, table(spark, []))
    assert kept.columns == docs.columns and kept.count() == len(AWKWARD)
    empty = spark.createDataFrame([], SCHEMA)
    assert X.drop_toxic(empty, labels).collect() == []


def test_curve_rises_with_weight():
    x = np.column_stack((np.ones(200), np.repeat([0.0, 2.0], 100), np.repeat([0.0, 3.0], 100)))
    w = X._fit(x, np.repeat([0.0, 1.0], 100))
    assert w[1] >= 0 and w[2] >= 0 and w[1] + w[2] > 0


def test_only_true_copies_count_as_one():
    common = [f"c{i}" for i in range(30)]
    unlike = [common + [f"d{d}w{i}" for i in range(40)] for d in range(60)]            # word Jaccard 0.27
    copies = [unlike[0][:-1] + [f"x{k}"] for k in range(25)]                           # 0.97
    docs = [(X._words(" ".join(w)), [str(k)]) for k, w in enumerate(unlike + copies)]
    assert len(X._apart(docs)) == 60 and X._apart([]) == []
    rng = random.Random(3)
    some = [{f"w{rng.randrange(40)}" for _ in range(rng.randrange(0, 30))} for _ in range(150)]
    some += [set(rng.sample(sorted(s), len(s) - 1)) | {"new"} if s else s for s in some]
    want = []
    for s in some:
        if all(len(s & k) < X.COPY * len(s | k) if s | k else False for k in want):
            want.append(s)
    got = X._apart([(X._words(" ".join(s)), sorted(s)) for s in some])
    assert got == [sorted(s) for s in want]


def test_repeated_rows_of_one_labelled_id_are_one(spark):
    known = table(spark, [(1, 1, 1), (2, 1, 0)]).select("doc_id", "toxic").toDF("l_id", "toxic")
    many = [(1, prose(1, 9))] * 300 + [(2, prose(100 + i, 9)) for i in range(200)] + [(3, prose(3, 9))]
    got = [tuple(r) for r in X._sample(documents(spark, many), known, X.TRAIN_ROWS).collect()]
    assert got.count((prose(1, 9), 1)) == 1 and len(got) == len(set(got)) == 1 + X.ID_TEXTS
    assert X._sample(documents(spark, many), known, 5).count() == 5


def naive(lexicon, folded):
    """Weight and number of hits, by looking at every place and every pair of a hit and a phrase."""
    spans = [(i, i + len(p)) for p in {X.fold(e) for e in lexicon.exceptions} for i in range(len(folded)) if folded.startswith(p, i)]
    at = {}
    for e, w in lexicon.entries.items():
        for i in range(len(folded)):
            if folded.startswith(e, i) and not any(a <= i and i + len(e) <= b for a, b in spans):
                at[i] = max(at.get(i, w), w)
    return sum(at.values()), len(at)


def test_the_automaton_equals_a_naive_matcher():
    rng = random.Random(8)
    for _ in range(300):
        word = lambda: "".join(rng.choice("ab") for _ in range(rng.randrange(1, 4)))  # noqa: E731,B023
        entries = {f" {word()}" + rng.choice([" ", ""]): float(rng.randrange(1, 9)) for _ in range(rng.randrange(0, 5))}
        lexicon = X.Lexicon(entries, tuple(" ".join(word() for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(0, 4))))
        folded = X.fold(" ".join(word() for _ in range(rng.randrange(0, 30))))
        assert lexicon.measure(folded, lexicon.automaton())[:2] == naive(lexicon, folded), (entries, lexicon.exceptions, folded)


def test_counts_equal_a_naive_count(spark):
    rows, labels = corpus(60)
    pairs = [(t, y) for (_, t), (_, _, y) in zip(rows, labels, strict=True)]
    got = (spark.createDataFrame(pairs, "text string, toxic int").mapInArrow(X._count, "gram string, pos long, neg long")
           .groupBy("gram").agg({"pos": "sum", "neg": "sum"}).select("gram", "sum(pos)", "sum(neg)").collect())
    want = {y: Counter(g for t, z in pairs if z == y for g in X._grams(t)) for y in (0, 1)}
    assert {r[0]: (r[1], r[2]) for r in got} == {g: (want[1][g], want[0][g]) for g in want[0] | want[1]}


def test_a_text_of_hits_and_phrases_takes_linear_time():
    lexicon = X.Lexicon({X.fold("trash"): 5.0, X.fold("idiot"): 5.0})
    folded, a = X.fold("trash can idiot " * 65_000), lexicon.automaton()
    began = time.perf_counter()
    assert lexicon.measure(folded, a)[:2] == (5.0 * 65_000, 65_000)
    assert time.perf_counter() - began < 3


def test_harmless_phrases_are_mined_but_not_from_copies(spark):
    lexicon = X.Lexicon({X.fold("grolk"): 5.0})
    calm = [(f"{prose(i, 9)} grolk museum {prose(i + 500, 9)}", 0) for i in range(6)]
    toxic = [(f"{prose(i, 9)} grolk {prose(i + 700, 9)}", 1) for i in range(30)]
    copies = [(f"aa grolk palace bb {i}", 0) for i in range(30)]
    train = spark.createDataFrame(calm + toxic + copies, "text string, toxic int")
    assert X.mine(train, lexicon, 30, 36) == (X.fold("grolk museum").strip(),)
    assert X._uses(X.fold("grolk"), lexicon, lexicon.automaton()) == set()
    assert X.mine(train.limit(0), lexicon, 1, 1) == ()
