import random

import pytest
from pyspark.sql import functions as F

from classmap.operators import enrich, joins, ordering, rows
from classmap.sources import sinks, tables


# --- joins that split hot keys


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_spread_join_equals_plain_join(spark, how, null_safe):
    rng = random.Random(5)
    data = [(i, rng.choice(["hot", "hot", "warm", "cold", None, "none.such"])) for i in range(500)]
    left = spark.createDataFrame(data, "`row.id` long, `the.key` string")
    right = spark.createDataFrame(
        [("hot", 1), ("warm", 2), (None, 3), ("other", 4)], "`the.key` string, v int"
    )
    got = joins.spread_join(
        left, right, "the.key", how, spread_by="row.id", null_safe=null_safe, rows_per_split=20
    )
    on = left["`the.key`"].eqNullSafe(right["`the.key`"]) if null_safe else left["`the.key`"] == right["`the.key`"]
    want = left.join(right.select("`the.key`", "v"), on, how)
    keep = ["`row.id`"] + (["v"] if how in ("inner", "left") else [])
    assert sorted(got.select(*keep).collect()) == sorted(want.select(*keep).collect())


def test_spread_join_splits_the_hot_key(spark):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("k"))
    right = left.select("k").distinct().withColumn("v", F.col("k") * 2)
    joined = joins.spread_join(left, right, "k", "left", spread_by="id", rows_per_split=100)
    assert joined.where("v <=> k * 2").count() == 3000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_split" in plan


def test_filter_by_mapping_matches_null_with_null(spark):
    items = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b")], "n long, `No.` string")
    mapping = spark.createDataFrame([("a",), ("a",), (None,)], "`no.` string")
    got = joins.filter_by_mapping(items, mapping, left="No.", right="no.", spread_by="n")
    assert sorted(r["n"] for r in got.collect()) == [1, 2, 3]


def test_required_columns_are_named(spark):
    with pytest.raises(ValueError, match="absent"):
        joins.require_columns(spark.range(1), "id", "absent")


# --- order


@pytest.mark.parametrize("width", [1, 7, 1000])
@pytest.mark.parametrize("parts", [1, 5])
def test_numbering_follows_row_order(spark, width, parts):
    places = sorted(random.Random(1).sample(range(5000), 200))
    df = spark.createDataFrame([(p, f"x{p}") for p in places], "row_pos long, v string").repartition(parts)
    got = ordering.number_rows(df, ranges=width).collect()
    assert sorted((r["Unique_ID"], r["row_pos"]) for r in got) == list(enumerate(places, start=1))


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_forward_fill_never_resets(spark, width):
    values = [None, "a", None, None, "b", None, None, None, None, "c", None]
    df = spark.createDataFrame(list(enumerate(values)), "row_pos long, `Level.1` string").repartition(3)
    got = ordering.forward_fill(df, ["Level.1"], ranges=width).collect()
    want, last = [], None
    for v in values:
        last = v or last
        want.append(last)
    assert [r[1] for r in sorted(got)] == want


def test_sampling_contract(spark):
    items = spark.createDataFrame([(i, str(i)) for i in range(20)], "id long, v string")
    emb = spark.range(10).select("id", F.array(F.lit(1.0)).alias("embedding"))
    draw = lambda n, seed=42: sorted(
        r["id"] for r in ordering.sample_items(items, emb, n, id="id", seed=seed).collect()
    )
    assert len(draw(4)) == 4 and set(draw(4)) <= set(range(10)) and draw(4) == draw(4)
    assert draw(4) != draw(4, seed=7) and draw(50) == list(range(10))
    with pytest.raises(ValueError):
        draw(0)
    with pytest.raises(ValueError):
        ordering.sample_items(items, emb.where("id < 0"), 3, id="id")


# --- rows


def test_dedupe_and_report(spark):
    data = [(0, "a", None), (1, "a", None), (2, "b", "x"), (3, "a", "x"), (4, "b", "x")]
    df = spark.createDataFrame(data, "row_pos long, `A.b` string, c string")
    assert sorted(r["row_pos"] for r in rows.dedupe_rows(df).collect()) == [0, 2, 3]
    assert sorted(r["row_pos"] for r in rows.duplicate_report(df).collect()) == [0, 1, 2, 4]


def test_unique_rows_are_distinct_before_projection(spark):
    df = spark.createDataFrame([(0, "a", 1), (1, "a", 2), (2, "a", 1)], "row_pos long, x string, y int")
    got = enrich.extract_unique_rows(df, columns=["x"]).orderBy("Unique_ID").collect()
    assert [tuple(r) for r in got] == [(1, 0, "a"), (2, 1, "a")]
    assert enrich.extract_unique_rows(df, columns=["x"], add_id=False).count() == 2


def test_context_map(spark):
    df = spark.createDataFrame(
        [(1, "n", " v ", None, "  ", 7948.0)], "`Item.ID` long, Name string, A string, B string, C string, D double"
    )
    got = df.select(rows.context_map(df, exclude=["item.id", "NAME"]).alias("m")).first()["m"]
    assert got == {"A": "v", "D": "7948"}
    got = df.select(rows.context_map(df, exclude=["name"], include=[" d "]).alias("m")).first()["m"]
    assert got == {"D": "7948"}
    exact = rows.context_map(df, exclude=["NAME", "Item.ID"], ignore_case=False)
    assert df.select(exact.alias("m")).first()["m"] == {"Name": "n", "A": "v", "D": "7948"}
    assert df.select(rows.context_map(df, exclude=df.columns).alias("m")).first()["m"] == {}


def test_level_columns():
    names = ["Level 1", "id", "Sub Level", "level 2"]
    assert rows.select_level_columns(names) == ["Level 1", "Sub Level"]
    assert rows.select_level_columns(names, names=["id"]) == ["id"]
    assert rows.select_level_columns(names, keywords=["level", "id"]) == ["id", "level 2"]


def test_union_needs_a_usable_sheet(spark):
    with pytest.raises(ValueError):
        rows.union_sheets({"A": spark.range(1)}, key="no")


def test_default_ids(spark):
    df = spark.createDataFrame([("s", 0, "k", "v")], "sheet string, row_pos long, code string, text string")
    assert rows.first_column_id(df) == "code" and rows.first_column_id(df, "text") == "text"
    assert rows.first_column_id(df, "absent") == "code"
    assert df.select(rows.fallback_id(df, "absent").alias("i")).first()["i"] == 0


# --- enrichment

TRANSFERRED = ["Kind Code", "Kind Text", "Coating", "Finish"]


def test_enrichment_rules(spark):
    a = spark.createDataFrame([(0, 1.0, "", "first"), (1, 1.0, "late", "second")], "row_pos long, Id double, `Coating` string, `Kind Code` string")
    b = spark.createDataFrame([(0, 1.0, "b"), (1, None, "lost")], "row_pos long, Id double, `Coating` string")
    lookup = enrich.enrichment_lookup(rows.union_sheets({"A": a, "B": b}, key="Id"), id="Id", columns=TRANSFERRED)
    assert lookup.select("lookup_key", "Coating", "`Kind Code`", "`Kind Text`").collect() == [
        ("1", "late", "first", None)
    ]
    target = spark.createDataFrame([(0, 1, ""), (1, 1, None), (2, 5, None)], "row_pos long, `No.` int, Coating string")
    fill = enrich.enrich_items(target, lookup, key="No.", columns=TRANSFERRED).orderBy("row_pos").collect()
    assert [r["Coating"] for r in fill] == ["", "late", None]
    assert [r["Kind Code"] for r in fill] == ["first", "first", None]
    over = enrich.enrich_items(target, lookup, key="No.", columns=TRANSFERRED, overwrite=True).orderBy("row_pos").collect()
    assert [r["Coating"] for r in over] == ["late", "late", None]
    assert enrich.enrich_items(target, lookup, key="absent", columns=TRANSFERRED) is target


# --- sources and sinks


def test_rows_are_numbered_across_files(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(100).repartition(4).write.parquet(path)
    got = tables.scan_table(spark, path).collect()
    assert sorted(r["row_pos"] for r in got) == list(range(100))
    assert sorted(r["id"] for r in got) == list(range(100))


def test_csv_and_sheets_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("A", 0, "x"), ("A", 1, "y"), ("B", 0, "z")], "sheet string, row_pos long, v string")
    path = sinks.sink_sheets(df, str(tmp_path / "book"), files_per_sheet=2)
    assert sorted(tables.scan_sheets(spark, path).select("sheet", "row_pos", "v").collect()) == sorted(df.collect())
    flat = sinks.sink_table(df, str(tmp_path / "flat"), fmt="csv")
    assert tables.scan_table(spark, flat, fmt="csv", columns=["v"]).count() == 3


def test_empty_embeddings_are_not_written(spark, tmp_path):
    empty = spark.createDataFrame([], "id long, embedding array<double>")
    assert sinks.sink_embeddings(empty, str(tmp_path / "none")) is False
    assert not (tmp_path / "none").exists()


def test_header_is_guessed_and_promoted(spark):
    grid = spark.createDataFrame(
        [(0, "t", None, None), (1, "Name", "Size", None), (2, "a", "1", "z")],
        "row_pos long, _c0 string, _c1 string, _c2 string",
    )
    assert tables.guess_header_row(grid).first()[0] == 1
    named = tables.promote_header(grid)
    assert named.columns == ["row_pos", "Name", "Size", "_c2"] and named.count() == 1
    assert tables.promote_header(grid, 2).count() == 0


def test_text_files_are_numbered_in_path_order(spark, tmp_path):
    """Files of unequal size, the largest last and cut into several splits."""
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("v\n" + "".join(f"a{i}\n" for i in range(3)))
    (folder / "b.csv").write_text("v\n" + "".join(f"b{i}\n" for i in range(20_000)))
    (folder / "c.csv").write_text("v\n" + "".join(f"c{i}\n" for i in range(700)))
    (folder / "d.csv").write_text("v\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = tables.scan_table(spark, str(folder), fmt="csv")
        got = [r["v"] for r in sorted(df.collect(), key=lambda r: r["row_pos"])]
        assert [r[0] for r in df.select("row_pos").orderBy("row_pos").collect()] == list(range(20_703))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [f"a{i}" for i in range(3)] + [f"b{i}" for i in range(20_000)] + [f"c{i}" for i in range(700)]


def test_sheet_names_stay_texts(spark, tmp_path):
    rows = [("01", 1), ("1", 2), ("1e3", 3), (None, 4), ("1", 5)]
    spark.createDataFrame(rows, "sheet string, v int").write.partitionBy("sheet").parquet(str(tmp_path / "book"))
    got = tables.scan_sheets(spark, str(tmp_path / "book")).collect()
    assert {(r["sheet"], r["sheet_pos"]) for r in got} == {(None, 0), ("01", 1), ("1", 2), ("1e3", 3)}
    assert sorted(r["v"] for r in got if r["sheet"] == "1") == [2, 5]
