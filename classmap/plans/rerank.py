"""Reranking the best candidates of each item with a model."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classmap.functions.names import col, cols
from classmap.functions.replies import resolve_choice, validate_choice
from classmap.operators.joins import require_columns, spread_join
from classmap.operators.models import answer
from classmap.operators.rows import context_map
from classmap.operators.similarity import margin_gate
from classmap.plans.settle import settle


def pick_model_name(items: DataFrame, name_col: str | None, item_name: str) -> str:
    """The item-name column shown to the model; the matching name when absent."""
    return name_col if name_col and name_col in items.columns else item_name


def class_contexts(
    classes: DataFrame, *, class_id: str, class_name: str, include: Sequence[str]
) -> DataFrame:
    """Context map per class id; of repeated ids one with the latest position counts."""
    context = context_map(classes, exclude=[class_id, class_name], include=include)
    rows = classes.select(col(class_id).alias("class_id"), context.alias("class_context"))
    if "row_pos" not in classes.columns:
        return rows.dropDuplicates(["class_id"])
    place = classes.select(
        col(class_id).alias("class_id"), F.struct("row_pos", context.alias("m")).alias("s"), "row_pos"
    )
    return place.groupBy("class_id").agg(F.max_by("s", "row_pos").getField("m").alias("class_context"))


def class_context_lookup(candidates: DataFrame, contexts: DataFrame, *, spread_by: str) -> DataFrame:
    """Candidate rows with the context of their class; popular classes are split."""
    return spread_join(candidates, contexts, "class_id", "left", spread_by=spread_by)


def request_json(name: Column, context: Column, candidates: Column) -> Column:
    """The request payload: the item, then the offered classes in rank order."""
    item = F.struct(name.alias("item_name"), context.alias("item_context"))
    return F.to_json(F.struct(item.alias("item"), candidates.alias("candidates")))


def _offered(topk: str) -> Column:
    """Candidates as they appear in a request."""
    return F.transform(
        col(topk),
        lambda c: F.struct(
            c["class_id"].cast("string").alias("class_id"),
            c["class_name"].alias("class_name"),
            F.round(c["sim"], 4).alias("cosine_similarity"),
        ),
    )


def rerank_requests(
    assigned: DataFrame,
    items: DataFrame,
    *,
    item_id: str,
    item_name: str,
    name_col: str | None = None,
    context: Sequence[str] | None = None,
    classes: DataFrame | None = None,
    class_id: str = "id",
    class_name: str = "name",
    class_context: Sequence[str] | None = None,
    margin_below: float | None = None,
) -> DataFrame:
    """``item_id, topk, request`` for the items that go to the model.

    ``assigned`` carries ``topk``. With ``class_context`` each candidate also shows
    those columns of its class.
    """
    require_columns(assigned, item_id, "topk")
    shown = pick_model_name(items, name_col, item_name)
    facts = context_map(items, exclude=[item_id, item_name, shown], include=context)
    described = items.select(
        col(item_id), col(shown).cast("string").alias("_name"), facts.alias("_context")
    )
    chosen = assigned.where(margin_gate("topk", margin_below)).select(col(item_id), "topk")
    offered = chosen.withColumn("_offered", _offered("topk"))
    if class_context is not None:
        if classes is None:
            raise ValueError("class_context needs the class table")
        contexts = class_contexts(
            classes, class_id=class_id, class_name=class_name, include=class_context
        ).withColumn("class_id", F.col("class_id").cast("string"))
        rows = offered.select(col(item_id), "topk", F.posexplode("_offered").alias("at", "o"))
        rows = rows.withColumn("class_id", F.col("o.class_id"))
        looked = class_context_lookup(rows, contexts, spread_by=item_id)
        entry = F.struct("at", F.struct("o.*", "class_context").alias("o"))
        # At most top-k rows per item come back together.
        by_rank = lambda a, b: a["at"] - b["at"]
        back = looked.groupBy(col(item_id)).agg(
            F.array_sort(F.collect_list(entry), by_rank).alias("e")
        )
        offered = chosen.join(back, item_id, "left").select(
            col(item_id), "topk", F.col("e.o").alias("_offered")
        )
    joined = offered.join(described, item_id)
    request = request_json(F.col("_name"), F.col("_context"), F.col("_offered"))
    return joined.select(col(item_id), "topk", request.alias("request"))


def apply_rerank(replied: DataFrame) -> DataFrame:
    """Add ``llm_class_id, llm_class_name, llm_reasoning`` from ``raw`` and ``topk``."""
    judged = replied.withColumn("_choice", validate_choice("raw", "topk"))
    return judged.select(
        *cols(replied.columns),
        F.col("_choice.choice_id").alias("llm_class_id"),
        resolve_choice(F.col("_choice.choice_id"), "topk").alias("llm_class_name"),
        F.col("_choice.reasoning").alias("llm_reasoning"),
    )


def with_rerank_columns(assigned: DataFrame, judged: DataFrame, *, item_id: str) -> DataFrame:
    """All assigned rows; items without a call have empty rerank columns."""
    added = judged.select(col(item_id), "llm_class_id", "llm_class_name", "llm_reasoning")
    joined = assigned.join(added, item_id, "left")
    return joined.withColumn("llm_reasoning", F.coalesce("llm_reasoning", F.lit("")))


def rerank_classes(
    assigned: DataFrame,
    items: DataFrame,
    make_fn: Callable,
    *,
    item_id: str,
    item_name: str,
    calls: dict | None = None,
    **requests,
) -> DataFrame:
    """Ask the model about each item's candidates and add its accepted choice."""
    asked = settle(
        rerank_requests(assigned, items, item_id=item_id, item_name=item_name, **requests),
        "requests",
    )
    replied = answer(asked, make_fn, request="request", spread_by=item_id, **(calls or {}))
    return with_rerank_columns(assigned, apply_rerank(replied), item_id=item_id)
