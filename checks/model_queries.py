"""Model operators, driven by deterministic local functions in place of a model."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.match_queries import assign_base
from checks.registry import check
from checks.text_queries import EXPECTED_UNITS, EXPECTED_VALUES, fallback_sql, sheet_items
from classmap.operators import models
from classmap.plans import cleanup, rerank
from classmap.plans.settle import new_path, settle
from classmap.streaming import incremental

QUICK = {"delay": 0.0}

# --- local stand-ins


def vector_model():
    """Text to (length, count of e, count of a, count of spaces)."""

    def embed(texts):
        return [[float(len(t)), float(t.count("e")), float(t.count("a")), float(t.count(" "))] for t in texts]

    return embed


def rerank_model(broken: bool = False):
    """A reply whose shape depends on the length of the item name."""

    def make():
        def one(request: str) -> str:
            asked = json.loads(request)
            ids = [c["class_id"] for c in asked["candidates"]]
            shape = len(asked["item"]["item_name"]) % 6
            if broken and shape % 2 == 0:
                return "ERROR: quota"
            return [
                json.dumps({"choice_id": ids[-1], "reasoning": " last one "}),
                'Sure: {"choice_id": %s, "reasoning": "first one"} done' % ids[0],
                '{"choice_id": "none such"}',
                "[1, 2]",
                "ERROR: quota",
                "",
            ][shape]

        return lambda requests: [one(r) for r in requests]

    return make


def expand_model():
    def one(request: str) -> str:
        text = json.loads(request)["description"]
        without = "".join(c for c in text if not c.isdigit())
        return ["`" + text + " EXPANDED\nmore`", "ERROR: quota", without, ""][len(text) % 4]

    return lambda requests: [one(r) for r in requests]


def name_model():
    def one(request: str) -> str:
        text = json.loads(request)["description"]
        return ['"' + text.split(" ")[0] + '"', "ERROR: quota", text + " 12", ""][len(text) % 4]

    return lambda requests: [one(r) for r in requests]


def value_model():
    def one(text: str) -> str:
        n = int(text) if text else 2
        return [
            '{"values": ["%d", "2.1"], "units": ["mm", "m"]}' % n,
            '[{"values": [%d], "units": ["mm"]}, {"values": ["9"]}]' % n,
            "no json at all", '{"values": "abc", "units": ["m"]}', "[]", '{"values": []} trailing',
        ][n % 6]

    return lambda texts: [one(t) for t in texts]


def failing_model():
    """Fails on a whole batch that holds an odd text, so each text is tried alone."""

    def call(texts):
        if any(len(t) % 2 for t in texts):
            raise RuntimeError("odd length")
        return [t.upper() for t in texts]

    return call


# --- calls


@check(
    "embed_text",
    """select doc_id id, length(text)::double n, (length(text) - length(replace(text, 'e', '')))::double e,
        (length(text) - length(replace(text, 'a', '')))::double a,
        (length(text) - length(replace(text, ' ', '')))::double spaces from documents where trim(text) <> ''""",
)
def embed_text(spark, sf):
    docs = fx.table(spark, sf, "documents")
    out = models.embed_text(docs, vector_model, text="text", id="doc_id")
    return out.select(
        "id", *[F.get("embedding", F.lit(i)).alias(c) for i, c in enumerate(("n", "e", "a", "spaces"))]
    )


def name_requests(spark, sf):
    return fx.items(spark, sf).select("item_id", F.col("item_name").alias("request"))


@check("distinct_requests", f"with {fx.ITEMS_SQL} select sha256(item_name) request_hash, item_name request, count(*) n from items group by item_name")
def distinct_requests(spark, sf):
    return models.distinct_requests(name_requests(spark, sf))


@check(
    "invoke_model",
    f"""with {fx.ITEMS_SQL} select distinct sha256(item_name) request_hash,
        case when length(item_name) % 2 = 1 then 'ERROR: odd length' else upper(item_name) end raw from items""",
)
def invoke_model(spark, sf):
    return models.invoke_model(models.distinct_requests(name_requests(spark, sf)), failing_model, **QUICK)


@check(
    "write_back",
    f"""with {fx.ITEMS_SQL} select item_id, case when length(item_name) % 2 = 1 then 'ERROR: odd length'
        else upper(item_name) end raw from items""",
)
def write_back(spark, sf):
    replied = models.answer(
        name_requests(spark, sf), failing_model, request="request", spread_by="item_id", **QUICK
    )
    return replied.select("item_id", "raw")


def described(spark, sf):
    """Sheets of parts with a description; suppliers have none at all."""
    items = sheet_items(spark, sf).withColumnRenamed("text", "Description")
    text = F.when(F.col("sheet") == "SUPPLIERS", " ").otherwise(
        F.when(F.col("row_pos") % 7 == 0, "  ").otherwise(F.col("Description"))
    )
    return items.withColumn("Description", text)


DESCRIBED_SQL = """described as (select p_type sheet, p_partkey row_pos, case when p_partkey % 7 = 0 then '  '
    else p_brand || ' ' || p_name || ' x' || p_brand || ' A BAD' || p_size end d from part
  union all select 'SUPPLIERS', s_suppkey, ' ' from supplier)"""


@check(
    "expand_abbreviations",
    f"""with {DESCRIBED_SQL} select sheet, row_pos, case when sheet = 'SUPPLIERS' then ''
        when length(d) % 4 = 0 and trim(d) <> '' then d || ' EXPANDED' else d end "Description_Expanded" from described""",
)
def expand_abbreviations(spark, sf):
    out = cleanup.expand_abbreviations(described(spark, sf), expand_model, **QUICK)
    return out.select("sheet", "row_pos", "Description_Expanded")


@check(
    "extract_main_names",
    f"""with {fx.ITEMS_SQL} select item_id, case when length(t) % 4 = 0 and not regexp_matches(split_part(t, ' ', 1), '\\d')
          then split_part(t, ' ', 1) else {fallback_sql('t')} end "Item_Name"
        from (select item_id, coalesce(nullif(trim("Type"), ''), item_name) t from items)""",
)
def extract_main_names(spark, sf):
    described = fx.items(spark, sf).select("item_id", "Type", F.col("item_name").alias("Description"))
    out = cleanup.extract_main_names(
        described, name_model, primary="Type", spread_by="item_id", **QUICK
    )
    return out.select("item_id", "Item_Name")


@check("extract_values", f"with {fx.ITEMS_SQL} select item_id, {EXPECTED_VALUES} extracted_values, {EXPECTED_UNITS} extracted_units from items")
def extract_values(spark, sf):
    numbered = fx.items(spark, sf).select("item_id", F.col("item_id").cast("string").alias("text"))
    out = cleanup.extract_values(numbered, value_model, text="text", position="item_id", **QUICK)
    return out.select("item_id", "extracted_values", "extracted_units")


# --- rerank

RERANK = assign_base(0.85, "all") + """,
top5 as (select item_id, list({'id': class_id, 'name': class_name, 'sim': sim} order by rk) c from ranked where rk <= 5 group by 1),
asked as (select p.item_id, p.item_name, i."Brand", i."Type", i."Size", c, length(p.item_name) % 6 shape,
    c[1].sim - c[2].sim as gap from top5 join per_item p using (item_id) join items i using (item_id)),
verdict as (select item_id, gap, case shape when 0 then c[-1].id::varchar when 1 then c[1].id::varchar end llm_class_id,
  case shape when 0 then c[-1].name when 1 then c[1].name end llm_class_name,
  case shape when 0 then 'last one' when 1 then 'first one' when 2 then 'Invalid choice_id: none such'
    when 3 then 'Unparseable LLM output: [1, 2]' when 4 then 'ERROR: quota' else 'Unparseable LLM output: ' end llm_reasoning from asked)"""
VERDICT_SQL = f"{RERANK} select item_id, llm_class_id, llm_class_name, llm_reasoning from verdict"


def requests(spark, sf):
    return fx.once(
        spark, sf, "rerank_requests",
        lambda: rerank.rerank_requests(fx.assigned(spark, sf), fx.items(spark, sf), **fx.NAMES),
    )


@check(
    "request_json",
    f"""{RERANK} select item_id, item_name, coalesce("Brand", '-') brand, coalesce("Size"::varchar, '-') size,
        nullif(trim("Type"), '') "type", len(c)::int offered, c[1].id::varchar first_id, c[1].name first_name,
        round(c[1].sim, 4) first_sim, c[-1].id::varchar last_id from asked""",
)
def request_json(spark, sf):
    shape = (
        "item struct<item_name:string,item_context:map<string,string>>, "
        "candidates array<struct<class_id:string,class_name:string,cosine_similarity:double>>"
    )
    r = requests(spark, sf).select("item_id", F.from_json("request", shape).alias("r"))
    context, offered = F.col("r.item.item_context"), F.col("r.candidates")
    first, last = F.get(offered, F.lit(0)), F.element_at(offered, -1)
    return r.select(
        "item_id", F.col("r.item.item_name").alias("item_name"),
        F.coalesce(F.element_at(context, "Brand"), F.lit("-")).alias("brand"),
        F.coalesce(F.element_at(context, "Size"), F.lit("-")).alias("size"),
        F.element_at(context, "Type").alias("type"), F.size(offered).alias("offered"),
        first["class_id"].alias("first_id"), first["class_name"].alias("first_name"),
        first["cosine_similarity"].alias("first_sim"), last["class_id"].alias("last_id"),
    )


@check(
    "class_context_lookup",
    f"""{RERANK}, offers as (select item_id, unnest(c) u, unnest(range(len(c))) "at" from asked)
        select item_id, "at"::int "at", u.id::varchar class_id, n.level::varchar "level" from offers join nodes n on n.id = u.id""",
)
def class_context_lookup(spark, sf):
    asked = rerank.rerank_requests(
        fx.assigned(spark, sf), fx.items(spark, sf), classes=fx.classes(spark, sf),
        class_context=["level"], **fx.NAMES,
    )
    shape = "candidates array<struct<class_id:string,class_context:map<string,string>>>"
    seen = asked.select("item_id", F.posexplode(F.from_json("request", shape)["candidates"]).alias("at", "c"))
    return seen.select(
        "item_id", "at", "c.class_id", F.element_at("c.class_context", "level").alias("level")
    )


@check("rerank_classes", VERDICT_SQL)
def rerank_classes(spark, sf):
    out = rerank.rerank_classes(
        fx.assigned(spark, sf), fx.items(spark, sf), rerank_model(), calls=QUICK, **fx.NAMES
    )
    return out.select("item_id", "llm_class_id", "llm_class_name", "llm_reasoning")


@check(
    "rerank_close_calls",
    f"""{RERANK} select item_id, case when coalesce(gap < 0.05, true) then llm_class_id end llm_class_id,
        case when coalesce(gap < 0.05, true) then llm_reasoning else '' end llm_reasoning from verdict""",
)
def rerank_close_calls(spark, sf):
    out = rerank.rerank_classes(
        fx.assigned(spark, sf), fx.items(spark, sf), rerank_model(), margin_below=0.05, calls=QUICK, **fx.NAMES
    )
    return out.select("item_id", "llm_class_id", "llm_reasoning")


# --- resumable rerank: a first run in which every second kind of request fails


def first_run(spark, sf):
    """Folder with the replies of the broken first run."""
    path = new_path(spark, "responses")
    asked = models.distinct_requests(requests(spark, sf))
    incremental.checkpoint_responses(models.invoke_model(asked, rerank_model(True), **QUICK), path)
    return path


def resumed(spark, sf):
    path = first_run(spark, sf)
    return settle(
        incremental.resume_responses(
            requests(spark, sf), incremental.read_responses(spark, path), item_id="item_id"
        ),
        "resumed",
    )


@check(
    "checkpoint_responses",
    f"{RERANK} select shape % 2 = 0 failed, count(distinct (item_name, c, \"Brand\", \"Type\", \"Size\")) replies from asked group by 1",
)
def checkpoint_responses(spark, sf):
    stored = incremental.read_responses(spark, first_run(spark, sf))
    return stored.groupBy(F.startswith("raw", F.lit("ERROR:")).alias("failed")).agg(F.count("*").alias("replies"))


@check("resume_responses", f"{RERANK} select item_id, shape = 1 done from asked")
def resume_responses(spark, sf):
    return resumed(spark, sf).select("item_id", "done")


@check("resume_anti", f"{RERANK} select item_id from asked where shape <> 1")
def resume_anti(spark, sf):
    return incremental.resume_anti(requests(spark, sf), resumed(spark, sf), item_id="item_id").select("item_id")


@check(
    "carry_forward",
    f"""{RERANK} select v.item_id, case when shape = 1 then llm_class_id end llm_class_id,
        case when shape = 1 then llm_class_name end llm_class_name,
        case when shape = 1 then llm_reasoning else '' end llm_reasoning from verdict v join asked using (item_id)""",
)
def carry_forward(spark, sf):
    out = incremental.carry_forward(fx.assigned(spark, sf), resumed(spark, sf), item_id="item_id")
    return out.select("item_id", "llm_class_id", "llm_class_name", "llm_reasoning")


@check(
    "resume_by_item",
    f"{RERANK} select item_id, llm_class_id, llm_class_name, llm_reasoning from verdict join asked using (item_id) where shape = 1",
)
def resume_by_item(spark, sf):
    """Choices of the items that an earlier run has done, whatever is asked now."""
    path = first_run(spark, sf)
    incremental.log_items(requests(spark, sf), path, item_id="item_id")
    return incremental.resume_items(spark, path, like=fx.assigned(spark, sf), item_id="item_id")


@check("incremental_rerank", VERDICT_SQL)
def incremental_rerank(spark, sf):
    out = incremental.incremental_rerank(
        fx.assigned(spark, sf), fx.items(spark, sf), rerank_model(),
        responses_path=first_run(spark, sf), autosave_every=100, calls=QUICK, **fx.NAMES,
    )
    return out.select("item_id", "llm_class_id", "llm_class_name", "llm_reasoning")
