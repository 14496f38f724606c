import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from classmap.functions import fuzzy
from classmap.operators import matching
from tests import brute

LETTERS = "abcdé #\t"
NAMES = st.lists(st.text(LETTERS, max_size=90), min_size=1, max_size=6, unique=True)


@settings(max_examples=60, deadline=None)
@given(NAMES, NAMES)
def test_ratios_equal_definition(left, right):
    ia, ib = (x.ravel() for x in np.meshgrid(range(len(left)), range(len(right)), indexing="ij"))
    partial = fuzzy.partial_ratios(*fuzzy.encode(left, right), ia, ib)
    tokens = fuzzy.token_set_ratios(fuzzy.NameBlock(left), fuzzy.NameBlock(right), ia, ib)
    assert partial.tolist() == [brute.partial_ratio(left[i], right[j]) for i, j in zip(ia, ib)]
    assert tokens.tolist() == [brute.token_set_ratio(left[i], right[j]) for i, j in zip(ia, ib)]


@settings(max_examples=60, deadline=None)
@given(NAMES, NAMES, st.sampled_from([0.0, 0.3, 0.6, 0.85, 1.0]))
def test_matching_loses_nothing(left, right, threshold):
    i, j, score = fuzzy.match_names(left, fuzzy.NameBlock(right), threshold)
    got = {(a, b): s for a, b, s in zip(i.tolist(), j.tolist(), score.tolist())}
    want = {}
    for a, x in enumerate(left):
        for b, y in enumerate(right):
            s = max(brute.partial_ratio(x, y), brute.token_set_ratio(x, y))
            if s >= threshold:
                want[a, b] = s
    assert got == want


def test_many_tokens_and_repeated_rests():
    rng = random.Random(5)
    words = [f"t{i}" for i in range(140)]
    left = [" ".join(rng.sample(words, n)) for n in (1, 3, 70, 130, 130)]
    right = [" ".join(rng.sample(words, n)) for n in (2, 64, 65, 129)] + left[:2]
    ia, ib = (x.ravel() for x in np.meshgrid(range(len(left)), range(len(right)), indexing="ij"))
    got = fuzzy.token_set_ratios(fuzzy.NameBlock(left), fuzzy.NameBlock(right), ia, ib)
    assert got.tolist() == [brute.token_set_ratio(left[i], right[j]) for i, j in zip(ia, ib)]


def test_few_pairs_are_touched():
    """Groups of names that differ in letters or length are ruled out as a whole."""
    rng = random.Random(9)
    alphabets = ["abc", "def", "ghi", "jkl", "mno", "pqr", "stu", "vwx"]
    word = lambda a, n: "".join(rng.choice(a) for _ in range(n))
    make = lambda k: [f"{word(a, rng.randint(5, 8))} {word(a, rng.randint(3, 30))}" for a in alphabets for _ in range(k)]
    names, block = make(6), fuzzy.NameBlock(make(60))
    i, j, _ = fuzzy.match_names(names, block, 0.85)
    want = {
        (a, b) for a, x in enumerate(names) for b, y in enumerate(block.names)
        if set(x) & set(y) - {" "} and max(brute.partial_ratio(x, y), brute.token_set_ratio(x, y)) >= 0.85
    }
    assert set(zip(i.tolist(), j.tolist())) == want and want
    assert block.touched < 0.25 * len(names) * len(block.names)


def test_score_is_symmetric_and_bounded():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcxyz ") for _ in range(rng.randint(0, 30))) for _ in range(40)]
    ia, ib = (x.ravel() for x in np.meshgrid(range(40), range(40), indexing="ij"))
    block = fuzzy.NameBlock(words)
    e1, e2 = fuzzy.encode(words, words)
    s = np.maximum(fuzzy.partial_ratios(e1, e2, ia, ib), fuzzy.token_set_ratios(block, block, ia, ib))
    s = s.reshape(40, 40)
    assert (s == s.T).all() and (s >= 0).all() and (s <= 1).all()


def test_column_functions(spark):
    rows = [("Red Bolt", "bolt red"), ("", ""), ("x", None), ("Hex Nut M10", "hexagon nut")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", fuzzy.fuzzy_score(F.col("a"), F.col("b")).alias("s")).collect()
    for a, b, s in got:
        assert s == (None if b is None else brute.score(a, b))


ITEMS = [(1, "Red Bolt"), (2, "BOLTS, red"), (3, None), (4, "zzz"), (5, "red bolt"), (6, "hex nut m10")]
CLASSES = [
    (10, "Bolts", 1, None, False), (11, "red bolts", 2, 10, True), (12, "Nuts", 1, None, False),
    (13, "hex nut", 2, 12, True), (14, None, 2, 12, True), (15, "RED BOLTS", 2, 12, True),
]


@pytest.fixture()
def tables(spark):
    items = spark.createDataFrame(ITEMS, "id long, name string")
    classes = spark.createDataFrame(
        CLASSES, "id long, name string, level int, parent_id long, lowest_level_class boolean"
    )
    return items, classes


@pytest.mark.parametrize("tasks", [1, 7])
@pytest.mark.parametrize("block_names", [1 << 20, 2])
def test_join_equals_brute_force(tables, tasks, block_names):
    """Also with class names cut into several blocks, and for any number of tasks."""
    items, classes = tables
    joined = matching.fuzzy_join(
        items, classes, item_id="id", item_name="name", threshold=0.6, splits=tasks, block_names=block_names
    )
    got = {(r[0], r[1]): r[2] for r in joined.collect()}
    want = {
        (i, c[0]): brute.score(n, c[1])
        for i, n in ITEMS for c in CLASSES
        if n is not None and c[1] is not None and brute.score(n, c[1]) >= 0.6
    }
    assert got == want


@pytest.mark.parametrize("block_names", [1 << 20, 7])
def test_hit_names_are_cut_after_twenty(spark, block_names):
    classes = spark.createDataFrame(
        [(i, "bolt %d" % i, 1, None, True) for i in range(1, 26)],
        "id long, name string, level int, parent_id long, lowest_level_class boolean",
    )
    side = matching.class_table(classes)
    items = spark.createDataFrame([(1, "bolt"), (2, None)], "id long, name string")
    hits = matching.fuzzy_hits(
        items, side, item_id="id", item_name="name", threshold=0.6, block_names=block_names
    )
    got = dict(hits.select("id", matching.hit_names()).collect())
    listed = "; ".join(f"bolt {i} (L1)" for i in range(1, 21))
    assert got == {1: listed + "; ...(+5 more)", 2: "No fuzzy match"}
