"""Results that must not depend on size, order of rows, or the value of an argument."""

import pytest
from pyspark.sql import functions as F

from classmap.functions import replies
from classmap.operators import abbreviations, hierarchy, joins, matching, models, ordering, rows, similarity, validation
from classmap.plans import settle
from classmap.plans.assign import assign_classes
from classmap.sources import tables
from classmap.streaming import incremental


def test_deep_tree_closes(spark):
    tree = spark.createDataFrame([(i, i - 1 if i else None, i == 120) for i in range(121)], "id bigint, parent_id bigint, lowest_level_class boolean")
    tree.write.mode("overwrite").parquet(path := settle.new_path(spark, "tree"))
    got = hierarchy.hierarchy_closure(spark.read.parquet(path))
    assert sorted(map(tuple, got.collect())) == [(i, 120) for i in range(121)]


def test_a_chain_of_a_thousand_takes_few_jobs(spark):
    chain = spark.createDataFrame([(i, i - 1 if i else None, i == 1000) for i in range(1001)], "id bigint, parent_id bigint, lowest_level_class boolean")
    chain = settle.settle(chain, "chain")
    before, written = settle.settle, []
    hierarchy.settle = lambda df, name: written.append(name) or before(df, name)
    try:
        got = hierarchy.hierarchy_closure(chain).collect()
    finally:
        hierarchy.settle = before
    assert sorted(map(tuple, got)) == [(i, 1000) for i in range(1001)]
    assert written.count("climb") <= 11


def test_leaves_below_a_class_are_one_range(spark):
    import random

    rng = random.Random(4)
    rows = [(i, i, f"c{i}", rng.randrange(i) if i and rng.random() < 0.9 else None) for i in range(80)]
    parents = {r[3] for r in rows}
    side = spark.createDataFrame([(p, c, n, u, p not in parents or rng.random() < 0.1) for p, c, n, u in rows], "class_pos bigint, class_id bigint, class_name string, parent_id bigint, leaf boolean")
    leaves = side.where("leaf and class_id % 5 != 0")
    numbered, ranges = hierarchy.nested_leaves(side, leaves)
    number = {r["class_id"]: r["leaf_no"] for r in numbered.collect()}
    assert sorted(number.values()) == list(range(len(number)))
    below = {}
    for r in hierarchy.hierarchy_closure(side, class_id="class_id", leaf="leaf").collect():
        if r["leaf_id"] in number:
            below.setdefault(r["anc_id"], set()).add(number[r["leaf_id"]])
    assert {r["class_pos"]: set(range(r["lo"], r["hi"])) for r in ranges.collect()} == below


def test_cycle_raises(spark):
    ring = spark.createDataFrame([(0, None, False), (1, 3, False), (2, 1, False), (3, 2, False)], "id bigint, parent_id bigint, lowest_level_class boolean")
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.hierarchy_closure(ring)


def test_header_row_zero_is_given(spark):
    grid = spark.createDataFrame([(0, "A", None), (1, "x", "y"), (2, "z", "w")], "row_pos bigint, c1 string, c2 string")
    got = tables.promote_header(grid, 0)
    assert got.columns == ["row_pos", "A", "c2"] and got.count() == 2


@pytest.mark.parametrize("make", [lambda d: ordering.number_rows(d), lambda d: ordering.forward_fill(d, ["v"])])
def test_null_position_raises(spark, make):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "row_pos bigint, v string")
    with pytest.raises(Exception, match="a row has no row_pos"):
        make(df).collect()


@pytest.mark.parametrize("factor", [1, 10**9])
def test_sparse_positions(spark, factor):
    df = spark.createDataFrame([(i * factor, "a" if i % 4 == 0 else None) for i in range(200)], "row_pos bigint, v string").repartition(6)
    got = {r["row_pos"]: r["Unique_ID"] for r in ordering.number_rows(df, ranges=7).collect()}
    assert got == {i * factor: i + 1 for i in range(200)}
    assert {r["v"] for r in ordering.forward_fill(df, ["v"], ranges=7).collect()} == {"a"}


def test_repeated_ids_in_one_block_and_in_many(spark):
    leaves = spark.createDataFrame([(i, i, i, f"c{i}", [1.0, float(i)]) for i in range(6)], "leaf_pos bigint, class_pos bigint, class_id bigint, class_name string, embedding array<double>")
    items = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "id bigint, embedding array<double>")
    got = [
        sorted(str(r) for r in similarity.cosine_top_k(items, leaves, k=3, id="id", block_leaves=size).collect())
        for size in (2, 1 << 20)
    ]
    assert got[0] == got[1] and len(got[0]) == 3


def test_lookup_columns_do_not_depend_on_size(spark, monkeypatch):
    items = spark.createDataFrame([("x", "s", 1)], "a string, sheet string, row_pos bigint")
    pairs = spark.createDataFrame([("s", [("k", "d")])], "sheet string, pairs array<struct<code:string,descr:string>>")
    small = abbreviations.sheet_pairs(items, pairs, sheet="sheet", spread_by="row_pos")
    monkeypatch.setattr(abbreviations, "PAIR_BYTES", -1)
    large = abbreviations.sheet_pairs(items, pairs, sheet="sheet", spread_by="row_pos")
    assert small.columns == large.columns == ["a", "sheet", "row_pos", "pairs"]
    assert small.collect() == large.collect()


CLASSES = "id string, name string, parent_id string, lowest_level_class boolean"
VECTORS = "id string, embedding array<double>"


def test_text_class_ids(spark):
    classes = spark.createDataFrame([("C-1", "pump", None, False), ("C-2", "water pump", "C-1", True), ("C-3", "oil pump", "C-1", True)], CLASSES)
    vectors = spark.createDataFrame([("C-2", [1.0, 0.0]), ("C-3", [0.0, 1.0])], VECTORS)
    items = spark.createDataFrame([("i1", "pump"), ("i2", "zzz")], "item_id string, item_name string")
    own = spark.createDataFrame([("i1", [0.2, 1.0]), ("i2", [1.0, 0.1])], VECTORS)
    got = assign_classes(items, classes, own, vectors, item_id="item_id", item_name="item_name")
    assert {r["item_id"]: r["top_1_class_id"] for r in got.collect()} == {"i1": "C-3", "i2": "C-2"}
    for bad_classes, bad_vectors in ((classes.union(classes), vectors), (classes, vectors.union(vectors))):
        with pytest.raises(ValueError, match="class"):
            assign_classes(items, bad_classes, own, bad_vectors, item_id="item_id", item_name="item_name").collect()


def test_absent_vectors(spark):
    nan, inf = float("nan"), float("inf")
    side = matching.class_table(spark.createDataFrame([(str(i), f"c{i}", None, True) for i in range(5)], CLASSES))
    vectors = spark.createDataFrame([("0", [1.0, 0.0]), ("1", [nan, 1.0]), ("2", None), ("3", [inf, 0.0]), ("4", [None, 1.0])], VECTORS)
    leaves = similarity.class_embedding_join(side, vectors)
    assert [r["class_id"] for r in leaves.collect()] == ["0"]
    items = spark.createDataFrame([("0",), ("1",), ("2",)], "item string")
    assert [r["item"] for r in joins.item_embedding_join(items, vectors, id="item").collect()] == ["0"]


def test_nan_cells_are_missing(spark, tmp_path):
    spark.createDataFrame([(1.5, "a"), (float("nan"), "b")], "x double, y string").write.parquet(str(tmp_path / "t"))
    got = {r["y"]: r["x"] for r in tables.scan_table(spark, str(tmp_path / "t")).collect()}
    assert got == {"a": 1.5, "b": None}


def test_sheets_of_a_folder_have_positions(spark, tmp_path):
    df = spark.createDataFrame([("s1", i, None) for i in range(4)] + [("s0", i, None) for i in range(3)], "sheet string, v bigint, w string")
    df.repartition(3).write.partitionBy("sheet").parquet(str(tmp_path / "book"))
    got = tables.scan_sheets(spark, str(tmp_path / "book"))
    assert got.columns[:3] == ["sheet", "sheet_pos", "row_pos"]
    found = got.collect()
    assert {(r["sheet"], r["sheet_pos"]) for r in found} == {("s0", 0), ("s1", 1)}
    assert sorted((r["sheet"], r["row_pos"]) for r in found) == [("s0", i) for i in range(3)] + [("s1", i) for i in range(4)]


def test_numeric_mapping_against_names(spark):
    df = spark.createDataFrame([("a", "b", "c", 7), ("7", "b", "c", 7), ("a", "b", "c", 0)], "top_1_class_name string, top_2_class_name string, top_3_class_name string, m bigint")
    got = [r["match_bucket"] for r in validation.match_bucket(df, mapping="m").collect()]
    assert got == ["mismatch", "top1", "no_mapping"]


def test_extraction_keeps_the_first_entry(spark):
    text = '[{"values":["1"],"units":["mm"]}, "x"]'
    (row,) = spark.createDataFrame([(text,)], "raw string").select(replies.parse_extraction("raw").alias("p")).collect()
    assert row["p"]["values"] == ["1"] and row["p"]["units"] == ["mm"]


def test_only_a_missing_path_means_no_replies(spark, tmp_path):
    assert incremental.read_responses(spark, str(tmp_path / "none")).count() == 0


def test_requests_are_grouped_by_hash(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "request string")
    got = {r["request"]: r["n"] for r in models.distinct_requests(df).collect()}
    assert got == {"a": 2, "b": 1}


def test_a_hanging_call_fails(spark):
    def make():
        import time

        return lambda batch: [time.sleep(30 if r == "hang" else 0) or r.upper() for r in batch]

    asked = models.distinct_requests(spark.createDataFrame([("hang",), ("b",)], "request string"))
    with settle.scratch(spark):
        stored = settle.settle(asked, "asked")
        got = {r["raw"] for r in models.invoke_model(stored, make, retries=1, delay=0, timeout=0.5).collect()}
    assert got == {"B", "ERROR: no reply within 0.5 s"}


def test_hanging_calls_are_bounded(monkeypatch):
    import threading
    import time

    monkeypatch.setattr(models, "MOST_HUNG", 2)
    before, call = threading.active_count(), models._within(lambda batch: time.sleep(5), 0.05)
    for said in ("no reply", "no reply", "2 calls hang", "2 calls hang"):
        with pytest.raises(TimeoutError, match=said):
            call(["x"])
    assert threading.active_count() == before + 2


def test_duplicate_rows(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "b", 1)], "row_pos bigint, x string, y bigint")
    assert sorted(r["row_pos"] for r in rows.duplicate_report(df).collect()) == [1, 2]


def test_scratch_leaves_nothing(spark):
    with settle.scratch(spark):
        kept = settle.settle(spark.range(5), "t")
        files = kept.inputFiles()
        assert files and kept.count() == 5
        with settle.lasting():
            lasting = settle.settle(spark.range(3), "t")
    with pytest.raises(Exception):
        spark.read.parquet(files[0]).count()
    assert lasting.select(F.count("id")).first()[0] == 3


def test_vectors_meet_items_without_the_driver(spark):
    items = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "d")], "item_id bigint, item_name string")
    given = spark.createDataFrame([(1, [1.0]), (2, [2.0]), (None, [3.0]), (3, [float("nan")])], "id bigint, embedding array<double>")
    for path, df in {"items": items, "given": given}.items():
        df.write.mode("overwrite").parquet(f"{settle.shared_dir(spark)}/{path}-stored")
    items, given = (spark.read.parquet(f"{settle.shared_dir(spark)}/{p}-stored") for p in ("items", "given"))
    joined = joins.item_embedding_join(items, given, id="item_id")
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, joined.collect())) == [(1, "a", [1.0]), (2, "b", [2.0]), (2, "d", [2.0])]


def test_rows_of_hot_names_fill_splits_evenly(spark, monkeypatch):
    """Few names with many rows each: no task holds many more rows than a split should."""
    before = similarity.pair_blocks
    seen = []

    def watched(left, *args, **more):
        seen.extend(r["count"] for r in left.groupBy("_split").count().collect())
        return before(left, *args, **more)

    monkeypatch.setattr(similarity, "pair_blocks", watched)
    items = spark.range(6400).select("id", (F.col("id") % 16).alias("name_no"), F.array(F.lit(1.0), F.col("id") * 0.5).alias("embedding"))
    leaves = spark.createDataFrame([(i, i, f"c{i}", [float(i), 1.0]) for i in range(4)], "leaf_no bigint, class_id bigint, class_name string, embedding array<double>")
    leaves = leaves.withColumn("class_pos", F.col("leaf_no"))
    ranges = spark.range(16).select(F.col("id").alias("name_no"), F.lit(0).cast("bigint").alias("lo"), F.lit(4).cast("bigint").alias("hi"))
    got = similarity.cosine_top_k(items, leaves, k=2, id="id", ranges=ranges, rows=6400, split=(400, 400))
    assert got.where("candidates_count = 4 and size(topk) = 2").count() == 6400
    assert sum(seen) == 6400 and max(seen) < 2 * 400
