import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from classmap.llm import hard_negatives
from tests.llm.tables import CLASHING

SCHEMA = "vec_id bigint, embedding array<double>, label int"


@given(st.integers(1, 600), st.integers(1, 1 << 22), st.randoms(use_true_random=False))
def test_scores_are_exact(width, most, rng):
    make = lambda n: np.array([[rng.randint(-most, most) for _ in range(width)] for _ in range(n)], np.int64)
    a, b = make(3), make(4)
    want = a.astype(object) @ b.T.astype(object)
    primes = hard_negatives.moduli(width, width * most * most)
    found = hard_negatives.products(hard_negatives.Residues(a, primes), hard_negatives.Residues(b, primes))
    assert found.tolist() == want.tolist()


def brute(rows, anchor):
    """All scores, sorted."""
    good = [
        (i, [int(np.floor(256 * float(x))) for x in v], label)
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    score = lambda v, w: sum(a * b for a, b in zip(v, w, strict=False))
    out = []
    for at, (i, v, label) in enumerate(good):
        if not anchor(i):
            continue
        scored = sorted((-score(v, w), j, n, same) for n, (j, w, same) in enumerate(good) if n != at)
        for s, j, _, same in [x for x in scored if x[3] == label][:5]:
            inside = [(m, -t) for t, m, _, other in scored if other != label and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(i, j, rank, m, -s, t) for rank, (m, t) in enumerate(inside[:3], 1)]
    return out


def random_rows(seed, n=300, width=7):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.5, rng.uniform(-1, 1)]) for _ in range(width)], rng.choice([1, 1, 1, 2, 3, -4])) for i in range(n)]
    rows += [(n + i, rows[i][1], rows[i][2]) for i in range(40)]  # copies: ties
    rows += [(1000, None, 1), (1001, [None] * width, 1), (1002, [float("nan")] * width, 2), (1003, [float("inf")] * width, 2)]
    rows += [(1004, [1.0] * width, None), (None, [1.0] * width, 1), (1005, [0.5] * 3, 2), (1006, [], 2), (1007, [0.0] * width, 1)]
    return rows


@pytest.mark.parametrize("limits", [{}, {"anchor_rows": 7, "split": (20, 50)}])
def test_against_brute_force(spark, limits):
    rows = random_rows(3)
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in CLASHING if c != "label"])
    df = df.select("*", F.lit(1).alias("codes"), F.lit(1).alias("_split"), F.lit(1).alias("_block")).repartition(3)
    found = hard_negatives.hard_negatives(df, anchor=F.col("vec_id") % 9 == 0, **limits).collect()
    assert sorted(map(tuple, found)) == sorted(brute(rows, lambda i: i % 9 == 0))
    assert len(found) > 100


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (5, [0.75, 0.0], 2)]
    found = hard_negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), anchor=F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in found] == [(0, 0, 1, 5, 65536, 49152)] * 2


def test_scores_that_need_many_primes(spark):
    rows = [(i, [float(1 << 20) + i, -3.0], i % 2) for i in range(12)]
    found = hard_negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), anchor=F.lit(True), scale=256.0)
    assert sorted(map(tuple, found.collect())) == sorted(brute(rows, lambda i: True))
    with pytest.raises(ValueError, match="2\\^61"):
        hard_negatives.hard_negatives(spark.createDataFrame([(1, [1e30], 1)], SCHEMA), anchor=F.lit(True))


def test_empty_table_and_no_anchors(spark):
    assert hard_negatives.hard_negatives(spark.createDataFrame([], SCHEMA), anchor=F.lit(True)).count() == 0
    df = spark.createDataFrame([(1, [1.0], 1)], SCHEMA)
    assert hard_negatives.hard_negatives(df, anchor=F.lit(False)).count() == 0
    assert hard_negatives.hard_negatives(df, anchor=F.lit(True)).count() == 0
