import random

import pytest

from fleetscope.llm import token_counts as K
from tests.llm.helpers import AWKWARD, SCHEMA, documents


def test_matches_the_library(spark):
    sp, _ = K.load(K.model_path())
    got = sorted((tuple(r) for r in K.token_counts(documents(spark, AWKWARD)).collect()), key=str)
    want = [(r[0], len((r[1] or "").encode()), len(sp.encode(r[1] or "")), len(sp.encode(r[1] or "")) > 4096) for r in AWKWARD]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("seed", range(5))
def test_chunks_splice_exactly(seed):
    sp, stable = K.load(K.model_path())
    assert stable
    rng = random.Random(seed)
    for _ in range(200):
        t = "".join(rng.choice("ab  \n▁é中<s>\U00012000") for _ in range(rng.randrange(1, 400)))
        assert K.count(t, sp, stable, chunk=20, overlap=3) == len(sp.encode(t))


def test_overlap_widens_when_no_place_is_stable():
    sp, stable = K.load(K.model_path())
    for t in ("a" * 5000 + " b c d", " " * 4000 + "x", "é中" * 2000, "ab cd " * 900):
        assert K.count(t, sp, stable, chunk=100, overlap=4) == len(sp.encode(t))
        assert K.count(t, sp, False, chunk=100, overlap=4) == len(sp.encode(t))


def test_empty_table(spark):
    assert K.token_counts(spark.createDataFrame([], SCHEMA)).collect() == []
