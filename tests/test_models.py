import pytest
from pyspark.sql import functions as F

from classmap.operators import models
from classmap.plans import cleanup, rerank
from classmap.streaming import incremental

QUICK = {"delay": 0.0}


def upper():
    return lambda texts: [t.upper() for t in texts]


def counting(path):
    """A model that notes every text it is asked about in a file of its own."""

    def make():
        import uuid

        def call(texts):
            (path / uuid.uuid4().hex).write_text("\n".join(texts))
            return ["ok " + t for t in texts]

        return call

    return make


def asked(path):
    return sorted(line for f in path.iterdir() for line in f.read_text().split("\n"))


def test_equal_requests_are_asked_once(spark, tmp_path):
    df = spark.createDataFrame([(i, "abc"[i % 3]) for i in range(30)] + [(30, None)], "id long, q string")
    out = models.answer(df, counting(tmp_path), request="q", spread_by="id", **QUICK)
    got = {r["id"]: r["raw"] for r in out.collect()}
    out.count()
    assert got == {**{i: "ok " + "abc"[i % 3] for i in range(30)}, 30: None}
    assert asked(tmp_path) == ["a", "b", "c"]


def test_failures_become_error_texts(spark):
    def make():
        def call(texts):
            if "bad" in texts:
                raise RuntimeError("no luck")
            return texts

        return call

    df = spark.createDataFrame([(1, "bad"), (2, "good")], "id long, q string")
    out = models.answer(df, make, request="q", spread_by="id", tasks=1, **QUICK)
    assert {r["id"]: r["raw"] for r in out.collect()} == {1: "ERROR: no luck", 2: "good"}


def test_retries_recover(spark):
    def make():
        tries = []

        def call(texts):
            tries.append(1)
            if len(tries) < 3:
                raise RuntimeError("later")
            return texts

        return call

    df = spark.createDataFrame([(1, "q")], "id long, q string")
    assert models.answer(df, make, request="q", spread_by="id", **QUICK).first()["raw"] == "q"


def test_each_request_of_a_failed_batch_gets_its_tries(spark):
    def make():
        tries = {}

        def call(texts):
            if len(texts) > 1:
                raise RuntimeError("one at a time")
            tries[texts[0]] = tries.get(texts[0], 0) + 1
            if tries[texts[0]] < 3:
                raise RuntimeError("later")
            return texts

        return call

    df = spark.createDataFrame([(i, f"q{i}") for i in range(5)], "id long, q string")
    out = models.answer(df, make, request="q", spread_by="id", tasks=1, **QUICK)
    assert all(r["raw"] == r["q"] for r in out.collect())


def test_wrong_number_of_replies_is_a_failure(spark):
    df = spark.createDataFrame([(1, "a")], "id long, q string")
    out = models.answer(df, lambda: (lambda texts: []), request="q", spread_by="id", **QUICK)
    assert out.first()["raw"] == "ERROR: 0 replies to 1 requests"


def test_embedding_skips_blank_and_failed(spark):
    def make():
        def call(texts):
            if any("fail" in t for t in texts):
                raise RuntimeError("refused")
            return [[float(len(t))] for t in texts]

        return call

    rows = [(0, 10, "ab"), (1, 11, "  "), (2, 12, None), (3, 13, "fail"), (4, 14, "ab"), (5, 15, "abc")]
    df = spark.createDataFrame(rows, "row_pos long, id long, t string")
    out = models.embed_text(df, make, text="t", id="id", retries=2, **QUICK)
    assert {r["id"]: list(r["embedding"]) for r in out.collect()} == {10: [2.0], 14: [2.0], 15: [3.0]}
    by_pos = models.embed_text(df, make, text="t", retries=1, **QUICK)
    assert sorted(r["id"] for r in by_pos.collect()) == [0, 4, 5]
    with pytest.raises(ValueError, match="occurs"):
        models.embed_text(df.withColumn("id", F.lit(1)), make, text="t", id="id", **QUICK)
    with pytest.raises(ValueError):
        models.embed_text(df, make, text="absent")


def test_expansion(spark):
    def make():
        import json

        fixed = {"GAL BOLT": "`Galvanised bolt`", "M8 NUT": "Metric nut", "x": "ERROR: y", "keep 5": "keeps 5 \n more"}
        return lambda reqs: [fixed[json.loads(r)["description"]] for r in reqs]

    rows = [
        ("A", 0, "1", " GAL BOLT ", "ctx"), ("A", 1, "1", "M8 NUT", None), ("A", 2, "2", "x", " "),
        ("A", 3, "3", "  ", None), ("A", 4, "3", None, None), ("A", 5, "3", "keep 5", None), ("B", 0, "9", " ", None),
    ]
    df = spark.createDataFrame(rows, "sheet string, row_pos long, `No.` string, Description string, Note string")
    out = cleanup.expand_abbreviations(df, make, **QUICK)
    got = {(r["sheet"], r["row_pos"]): r["Description_Expanded"] for r in out.collect()}
    assert got == {
        ("A", 0): "Galvanised bolt", ("A", 1): "M8 NUT", ("A", 2): "x", ("A", 3): "  ", ("A", 4): None,
        ("A", 5): "keeps 5", ("B", 0): "",
    }
    request = df.select(cleanup.expansion_requests(df, text="Description").alias("r")).first()["r"]
    assert request == '{"sheet_name":"A","item_id":"1","description":"GAL BOLT","context":{"Note":"ctx"}}'
    assert cleanup.expand_abbreviations(df, make, text="absent") is df


def test_main_names(spark):
    def make():
        import json

        fixed = {"Hex bolt M8": '"Hex Bolt"', "HOSE; PVC; 50MM": "Hose 50", "Nut": "ERROR: x"}
        return lambda reqs: [fixed[json.loads(r)["description"]] for r in reqs]

    rows = [("A", 0, "Hex bolt M8", "z"), ("A", 1, " ", "HOSE; PVC; 50MM"), ("A", 2, None, "Nut"), ("A", 3, None, " ")]
    df = spark.createDataFrame(rows, "sheet string, row_pos long, Description_Expanded string, Description string")
    got = {r["row_pos"]: r["Item_Name"] for r in cleanup.extract_main_names(df, make, **QUICK).collect()}
    assert got == {0: "Hex Bolt", 1: "HOSE PVC", 2: "Nut", 3: ""}


def test_value_extraction_sends_blank_text_and_limits(spark):
    def make():
        return lambda texts: ['{"values": ["%d"], "units": ["mm"]}' % len(t) for t in texts]

    df = spark.createDataFrame([(0, "abc"), (1, None), (2, "x")], "row_pos long, t string")
    out = cleanup.extract_values(df, make, text="t", limit=2, **QUICK)
    assert {r["row_pos"]: (r["extracted_values"], r["extracted_units"]) for r in out.collect()} == {
        0: ("3", "mm"), 1: ("0", "mm")
    }


# --- rerank


@pytest.fixture()
def assigned(spark):
    top = "array<struct<class_pos:bigint,class_id:bigint,class_name:string,sim:double>>"
    rows = [
        (1, "bolt", [(0, 10, "Bolts", 0.9), (1, 11, "Nuts", 0.5)]),
        (2, "nut", [(1, 11, "Nuts", 0.81), (0, 10, "Bolts", 0.8)]),
        (3, "pin", [(0, 10, "Bolts", 0.7)]),
        (4, "cap", [(0, 10, "Bolts", 0.7), (1, 11, "Nuts", 0.69)]),
    ]
    items = [(1, "bolt", "Bolt M8", "steel"), (2, "nut", "Nut M8", None), (3, "pin", "Pin", " "), (4, "cap", "Cap", "x")]
    return (
        spark.createDataFrame(rows, f"item_id long, item_name string, topk {top}"),
        spark.createDataFrame(items, "item_id long, item_name string, Description string, Coating string"),
        spark.createDataFrame([(10, "Bolts", 1, "for wood"), (11, "Nuts", 2, None)], "id long, name string, level int, note string"),
    )


KEYS = {"item_id": "item_id", "item_name": "item_name"}


def test_request_payload(spark, assigned):
    rows, items, classes = assigned
    plain = rerank.rerank_requests(rows, items, name_col="Description", **KEYS)
    got = {r["item_id"]: r["request"] for r in plain.collect()}
    assert got[1] == (
        '{"item":{"item_name":"Bolt M8","item_context":{"Coating":"steel"}},"candidates":['
        '{"class_id":"10","class_name":"Bolts","cosine_similarity":0.9},'
        '{"class_id":"11","class_name":"Nuts","cosine_similarity":0.5}]}'
    )
    rich = rerank.rerank_requests(rows, items, classes=classes, class_context=["NOTE"], context=["absent"], **KEYS)
    got = {r["item_id"]: r["request"] for r in rich.collect()}
    assert got[2] == (
        '{"item":{"item_name":"nut","item_context":{}},"candidates":['
        '{"class_id":"11","class_name":"Nuts","cosine_similarity":0.81,"class_context":{}},'
        '{"class_id":"10","class_name":"Bolts","cosine_similarity":0.8,"class_context":{"note":"for wood"}}]}'
    )


def test_margin_gate_sends_close_and_single(spark, assigned):
    rows, items, _ = assigned
    sent = rerank.rerank_requests(rows, items, margin_below=0.05, **KEYS)
    assert sorted(r["item_id"] for r in sent.collect()) == [2, 3, 4]


def picker(replies, log=None):
    def make():
        import json
        import uuid

        def call(reqs):
            names = [json.loads(r)["item"]["item_name"] for r in reqs]
            if log:
                (log / uuid.uuid4().hex).write_text("\n".join(names))
            return [replies[n] for n in names]

        return call

    return make


GOOD = '{"choice_id": "10", "reasoning": "fits"}'


def test_rerank_fills_only_what_was_asked(spark, assigned):
    rows, items, _ = assigned
    model = picker({"nut": GOOD, "pin": "ERROR: x", "cap": '{"choice_id": "99"}'})
    out = rerank.rerank_classes(rows, items, model, margin_below=0.05, calls=QUICK, **KEYS)
    got = {r["item_id"]: (r["llm_class_id"], r["llm_class_name"], r["llm_reasoning"]) for r in out.collect()}
    assert got == {
        1: (None, None, ""), 2: ("10", "Bolts", "fits"), 3: (None, None, "ERROR: x"),
        4: (None, None, "Invalid choice_id: 99"),
    }


def test_second_run_asks_only_for_what_failed(spark, assigned, tmp_path):
    rows, items, _ = assigned
    path, first, second = str(tmp_path / "replies"), tmp_path / "one", tmp_path / "two"
    first.mkdir(), second.mkdir()
    run = lambda model: incremental.incremental_rerank(
        rows, items, model, responses_path=path, autosave_every=1, calls=QUICK, **KEYS
    )
    run(picker({"bolt": GOOD, "nut": "ERROR: x", "pin": "zzz", "cap": GOOD}, first))
    out = run(picker({"bolt": "no", "nut": GOOD, "pin": GOOD, "cap": "no"}, second))
    assert asked(first) == ["bolt", "cap", "nut", "pin"] and asked(second) == ["nut", "pin"]
    assert {r["item_id"]: r["llm_class_id"] for r in out.collect()} == {1: "10", 2: "10", 3: "10", 4: "10"}


def test_done_items_stay_done_when_the_question_changes(spark, assigned, tmp_path):
    rows, items, _ = assigned
    path, first, second = str(tmp_path / "replies"), tmp_path / "one", tmp_path / "two"
    first.mkdir(), second.mkdir()
    run = lambda model, **options: incremental.incremental_rerank(
        rows, items, model, responses_path=path, calls=QUICK, **KEYS, **options
    )
    run(picker({"bolt": GOOD, "nut": "ERROR: x", "pin": GOOD, "cap": "zzz"}, first))
    # Another context makes all requests new, another margin lets no item through but those
    # with one candidate; the items done keep their choice.
    out = run(picker({"bolt": "no", "nut": GOOD, "pin": "no", "cap": GOOD}, second), context=[])
    assert asked(second) == ["cap", "nut"]
    choices = {r["item_id"]: r["llm_class_id"] for r in out.collect()}
    assert choices == {1: "10", 2: "10", 3: "10", 4: "10"}
    third = tmp_path / "three"
    third.mkdir()
    out = run(picker({}, third), margin_below=-1.0)
    assert asked(third) == [] and {r["item_id"]: r["llm_class_id"] for r in out.collect()} == choices


def test_a_killed_run_keeps_the_replies_of_its_ended_tasks(spark, assigned, tmp_path):
    rows, items, _ = assigned
    path, second = str(tmp_path / "replies"), tmp_path / "two"
    second.mkdir()
    good = GOOD

    def dying():
        import json
        import os
        import time

        def call(texts):
            if any(json.loads(t)["item"]["item_name"] == "cap" for t in texts):
                time.sleep(8)
                os._exit(1)
            return [good] * len(texts)

        return call

    run = lambda model: incremental.incremental_rerank(
        rows, items, model, responses_path=path, autosave_every=1, calls=QUICK, **KEYS
    )
    with pytest.raises(Exception):
        run(dying)
    out = run(picker({"cap": GOOD}, second))
    assert asked(second) == ["cap"]
    assert {r["item_id"]: r["llm_class_id"] for r in out.collect()} == {1: "10", 2: "10", 3: "10", 4: "10"}
