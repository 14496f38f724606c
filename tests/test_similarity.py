import numpy as np
import pytest
from pyspark.sql import functions as F

from classmap.functions.vector import cosine_similarity
from classmap.operators import hierarchy, matching, similarity
from classmap.plans import assign
from tests import brute

KEYS = {"item_id": "item_id", "item_name": "item_name"}


def vectors(spark, rows, dim=4, seed=0):
    rng = np.random.default_rng(seed)
    data = [(i, [float(x) for x in rng.normal(size=dim)]) for i in rows]
    return data, spark.createDataFrame(data, "id long, embedding array<double>")


@pytest.fixture()
def tree(spark):
    # 1 > (2 > 4*, 5*), 3 > 6*; 7 is a lonely non-leaf, 8* has no vector
    rows = [
        (1, "fastener", 1, None, False), (2, "bolt", 2, 1, False), (3, "nut", 2, 1, False),
        (4, "hex bolt", 3, 2, True), (5, "eye bolt", 3, 2, True), (6, "wing nut", 3, 3, True),
        (7, "gasket", 1, None, False), (8, "rubber seal", 2, 7, True),
    ]
    schema = "id long, name string, level int, parent_id long, lowest_level_class boolean"
    return rows, spark.createDataFrame(rows, schema)


ITEMS = [
    (1, "Hex Bolt M8", "a"), (2, "wingnut", "b"), (3, "qqq", "c"), (4, "gasket", "d"),
    (5, None, "e"), (6, "rubber seal", "f"), (7, "no vector", "g"),
]


def expected(tree_rows, item_vecs, class_vecs, threshold, policy, n=3):
    """The assignment worked out row by row."""
    flat = [(c[0], c[3], c[4]) for c in tree_rows]
    vecs = dict(class_vecs)
    leaves = [c[0] for c in tree_rows if c[4] and c[0] in vecs]
    out = {}
    for iid, name, _ in ITEMS:
        if iid not in dict(item_vecs):
            continue
        hits = [c for c in tree_rows if name is not None and brute.score(name, c[1]) >= threshold]
        cand = set()
        for c in hits:
            cand |= brute.leaves_below(flat, c[0]) & set(leaves)
        pool = sorted(cand)
        if not hits or (not cand and policy == "all"):
            pool = leaves
        sims = sorted(
            ((-brute.cosine(dict(item_vecs)[iid], vecs[c]), c) for c in pool),
        )[:n]
        shown = "; ".join(f"{c[1]} (L{c[2]})" for c in hits) or "No fuzzy match"
        out[iid] = ([(c, round(-s, 4)) for s, c in sims], len(cand), shown)
    return out


@pytest.mark.parametrize("policy", ["none", "all"])
@pytest.mark.parametrize("threshold", [0.6, 0.85])
def test_assignment_equals_row_by_row(spark, tree, policy, threshold):
    rows, classes = tree
    item_vecs, item_emb = vectors(spark, [1, 2, 3, 4, 5, 6, 99], seed=1)
    class_vecs, class_emb = vectors(spark, [1, 4, 5, 6], seed=2)
    items = spark.createDataFrame(ITEMS, "item_id long, item_name string, note string")
    out = assign.assign_classes(
        items, classes, item_emb, class_emb, threshold=threshold, on_no_candidates=policy, **KEYS
    )
    got = {}
    for r in out.collect():
        tops = [(r[f"top_{i}_class_id"], r[f"top_{i}_similarity"]) for i in (1, 2, 3)]
        got[r["item_id"]] = (
            [t for t in tops if t[0] is not None], r["fuzzy_candidates_count"], r["fuzzy_candidate_names"],
        )
    assert got == expected(rows, item_vecs, class_vecs, threshold, policy)


@pytest.mark.parametrize("size", [1, 2, 1 << 20])
def test_class_blocks_change_nothing(spark, tree, size):
    """Partial rankings of several class blocks merge to the ranking of one; a name's
    ranges meet its items in every split of a hot name."""
    _, classes = tree
    side = matching.class_table(classes)
    _, class_emb = vectors(spark, [4, 5, 6], seed=2)
    leaves, ranges = hierarchy.nested_leaves(side, similarity.class_embedding_join(side, class_emb))
    found = {(r["class_pos"], r["hi"] - r["lo"]) for r in ranges.collect()}
    assert found == {(0, 3), (1, 2), (2, 1), (3, 1), (4, 1), (5, 1)}
    _, item_emb = vectors(spark, range(20), seed=5)
    # Name 7 is below class 2, name 8 has no leaf, all others are compared with all leaves.
    items = item_emb.withColumn("name_no", F.when(F.col("id") % 4 == 0, 7).when(F.col("id") % 4 == 1, 8))
    own = ranges.where("class_pos = 1").select(F.lit(7).cast("bigint").alias("name_no"), "lo", "hi")
    best = similarity.cosine_top_k(items, leaves, k=2, id="id", ranges=own, block_leaves=size, split=(3, 3))
    by_id = {r["id"]: r for r in best.collect()}
    plain = {r["id"]: r for r in similarity.cosine_top_k(item_emb, leaves, k=2, id="id").collect()}
    assert len(by_id) == 20
    for i, r in by_id.items():
        ids = [c["class_id"] for c in r["topk"]]
        assert r["candidates_count"] == (2 if i % 4 == 0 else 0)
        assert set(ids) == {4, 5} if i % 4 == 0 else ids == [] if i % 4 == 1 else ids == [c["class_id"] for c in plain[i]["topk"]]


def test_one_block_and_fifty(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (i * 7) % 200, i, f"c{i}", [float(x) for x in rng.integers(-2, 3, 3)]) for i in range(200)]
    leaves = spark.createDataFrame(rows, "leaf_no bigint, class_pos bigint, class_id bigint, class_name string, embedding array<double>")
    items = spark.createDataFrame([(i, [float(x) for x in rng.integers(-2, 3, 3)], i % 5) for i in range(60)], "id bigint, embedding array<double>, name_no bigint")
    own = spark.createDataFrame([(n, 31 * n, 31 * n + 40) for n in range(4)] + [(0, 120, 160)], "name_no bigint, lo bigint, hi bigint")
    runs = [
        sorted(str(r) for r in similarity.cosine_top_k(items, leaves, k=5, id="id", ranges=own, block_leaves=size, split=(10, 20)).collect())
        for size in (200, 4)
    ]
    assert runs[0] == runs[1] and len(runs[0]) == 60


def test_ranges_are_merged(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 2, 3), (1, 5, 7), (1, 9, 10), (2, 4, 6), (2, 4, 6)], "name_no bigint, lo bigint, hi bigint")
    got = sorted(tuple(r) for r in similarity.merge_ranges(df, "name_no").collect())
    assert got == [(1, 0, 7), (1, 9, 10), (2, 4, 6)]


def test_given_candidates_are_scored_in_blocks(spark):
    leaves = spark.createDataFrame([(i, i, i, f"c{i}", [float(i), 1.0]) for i in range(9)], "leaf_pos bigint, class_pos bigint, class_id bigint, class_name string, embedding array<double>")
    items = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(7)], "item bigint, embedding array<double>")
    asked = [(i, c) for i in range(7) for c in range(9) if (i + c) % 3 == 0] + [(99, 1), (1, 99)]
    pairs = spark.createDataFrame(asked, "item bigint, class_id bigint")
    got = similarity.cosine_candidates(pairs, items, leaves, item_id="item", block_leaves=2, split=(2, 2)).collect()
    assert sorted(map(tuple, got)) == [(i, c, pytest.approx(brute.cosine([1.0, float(i)], [float(c), 1.0]))) for i, c in sorted(asked) if i < 9 and c < 9]


@pytest.mark.parametrize("parts", [1, 7])
def test_ties_keep_class_order(spark, parts):
    leaves = spark.createDataFrame(
        [(0, 0, 30, "c", [1.0, 0.0]), (1, 1, 20, "b", [2.0, 0.0]), (2, 2, 10, "a", [0.0, 0.0])],
        "leaf_pos long, class_pos long, class_id long, class_name string, embedding array<double>",
    )
    items = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(14)], "id long, embedding array<double>")
    best = similarity.cosine_top_k(items.repartition(parts), leaves, k=3, id="id").collect()
    for r in best:
        assert [c["class_id"] for c in r["topk"]] == [30, 20, 10]
        assert r["topk"][2]["sim"] == 0.0


def test_column_cosine(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(cosine_similarity("a", "b")).collect()]
    assert got == [pytest.approx(0.8), 0.0]


def test_without_leaf_flag_every_class_is_a_leaf(spark, tree):
    _, classes = tree
    _, class_emb = vectors(spark, [1, 2, 3], seed=2)
    _, item_emb = vectors(spark, [1], seed=1)
    items = spark.createDataFrame(ITEMS, "item_id long, item_name string, note string")
    out = assign.assign_classes(
        items, classes.drop("lowest_level_class"), item_emb, class_emb, threshold=0.6, **KEYS
    ).first()
    assert out["fuzzy_candidates_count"] == 1 and out["top_1_class_id"] == 2


def test_repeated_ids_raise(spark, tree):
    _, classes = tree
    _, class_emb = vectors(spark, [4], seed=2)
    _, item_emb = vectors(spark, [1], seed=1)
    items = spark.createDataFrame([(1, "a"), (1, "b")], "item_id long, item_name string")
    with pytest.raises(ValueError, match="occurs 2 times"):
        assign.assign_classes(items, classes, item_emb, class_emb, **KEYS)


def test_attach_keeps_both_names(spark, tree):
    _, classes = tree
    _, class_emb = vectors(spark, [4, 5, 6], seed=2)
    _, item_emb = vectors(spark, [1, 2], seed=1)
    items = spark.createDataFrame(ITEMS, "item_id long, item_name string, note string")
    out = assign.assign_and_attach(items, classes, item_emb, class_emb, threshold=0.6, **KEYS)
    row = out.where("item_id = 1").first()
    assert row["item_item_name"] == "Hex Bolt M8" and row["note"] == "a"
    assert row["class_id"] == row["top_1_class_id"] and row["class_name"] == row["top_1_class_name"]
