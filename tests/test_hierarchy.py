import random

import pytest

from classmap.operators import hierarchy
from tests import brute


def walk(table):
    """Node table of level rows, cell by cell."""
    index, nodes, filled = {}, [], [None, None, None]
    for row in table:
        filled = [v if v is not None else f for v, f in zip(row, filled)]
        parent = None
        for level, value in enumerate(filled, start=1):
            name = (value or "").strip()
            if not name:
                continue
            key = (level, name)
            if key not in index:
                index[key] = len(index) + 1
                nodes.append((index[key], name, level, index.get(parent)))
            parent = key
    parents = {n[3] for n in nodes}
    return [(*n, n[0] not in parents) for n in nodes]


@pytest.mark.parametrize("width", [5, 1000])
def test_tree_equals_cell_by_cell_walk(spark, width):
    rng = random.Random(7)
    cell = lambda names: rng.choice([None, None, "  ", *names, f" {names[0]} "])
    table = [(cell("AB"), cell("pqr"), cell("xyzw")) for _ in range(60)]
    sheet = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(table)], "row_pos long, `Level 1` string, `Level 2` string, `Level 3` string"
    ).repartition(3)
    got = hierarchy.build_hierarchy(sheet, ranges=width).collect()
    rows = [(r["id"], r["name"], r["level"], r["parent_id"], r["lowest_level_class"]) for r in got]
    assert sorted(rows) == walk(table)
    assert {r["level_label"] for r in got} <= {"Level 1", "Level 2", "Level 3"}


SCHEMA = "id long, parent_id long, lowest_level_class boolean"


def test_closure_equals_naive_walk(spark):
    rng = random.Random(2)
    classes = [(i, rng.randrange(i) if i and rng.random() < 0.9 else None) for i in range(60)]
    parents = {p for _, p in classes}
    # Some inner nodes are flagged too: descent stops there. Some childless ones are not.
    flagged = [(i, p, (i not in parents) if rng.random() < 0.85 else rng.random() < 0.5) for i, p in classes]
    got = {tuple(r) for r in hierarchy.hierarchy_closure(spark.createDataFrame(flagged, SCHEMA)).collect()}
    assert got == {(c[0], leaf) for c in flagged for leaf in brute.leaves_below(flagged, c[0])}


@pytest.mark.parametrize("loop", [[(1, 1, False)], [(1, 3, False), (2, 1, False), (3, 2, False), (4, None, True)]])
def test_cycles_raise(spark, loop):
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.hierarchy_closure(spark.createDataFrame(loop, SCHEMA))


def test_closure_without_flag(spark):
    df = spark.createDataFrame([(1, None), (2, 1)], "id long, parent_id long")
    assert sorted(map(tuple, hierarchy.hierarchy_closure(df).collect())) == [(1, 1), (2, 2)]
