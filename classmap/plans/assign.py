"""Assigning items to leaf classes, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classmap.functions.names import col, cols
from classmap.operators.hierarchy import nested_leaves
from classmap.operators.joins import (
    item_embedding_join,
    require_columns,
    require_unique,
    spread_join,
)
from classmap.operators.matching import (
    NO_MATCH,
    class_pairs,
    class_table,
    distinct_names,
    hit_names,
    name_pairs,
    name_summary,
    with_match_name,
)
from classmap.operators.rows import prefix_columns
from classmap.operators.similarity import class_embedding_join, cosine_top_k, merge_ranges, pivot_top_n
from classmap.plans.settle import settle, together


def rank_classes(
    items: DataFrame,
    classes: DataFrame,
    item_emb: DataFrame,
    class_emb: DataFrame,
    *,
    item_id: str,
    item_name: str,
    class_id: str = "id",
    class_name: str = "name",
    leaf: str = "lowest_level_class",
    order: str | None = None,
    threshold: float = 0.6,
    k: int = 3,
    on_no_candidates: str = "none",
    check_ids: bool = True,
) -> DataFrame:
    """Per item with a vector: ``topk``, candidate count and the matched class names.

    Only id, name and vector travel through the matching stages, so the width of the
    item table does not matter. Leaves are numbered depth first, so the candidates of a
    name are a few ranges, worked out once per distinct name; items carry the name's
    number.
    """
    if on_no_candidates not in ("all", "none"):
        raise ValueError("on_no_candidates must be 'all' or 'none'")
    require_columns(items, item_id, item_name)
    require_columns(classes, class_id, class_name, "parent_id")
    thin = items.select(col(item_id), col(item_name).cast("string").alias(item_name))

    def check() -> None:
        if check_ids:
            require_unique({
                "item": (items, item_id), "embedding": (item_emb, "id"),
                "class": (classes, class_id), "class embedding": (class_emb, "id"),
            })

    def read_classes() -> tuple[DataFrame, DataFrame, DataFrame]:
        side = class_table(classes, class_id=class_id, class_name=class_name, leaf=leaf, order=order)
        return side, *nested_leaves(side, class_embedding_join(side, class_emb))

    _, rows, names, (side, leaves, below) = together(
        check, thin.count, lambda: distinct_names(thin, item_name=item_name), read_classes
    )
    pairs = settle(name_pairs(names, side, threshold=threshold), "pairs")
    hits = class_pairs(pairs, side)
    ranges = settle(merge_ranges(hits.join(below, "class_pos").select("name_no", "lo", "hi"), "name_no"), "ranges")
    known = ranges.select("name_no").distinct().withColumn("_known", F.lit(True))
    summary = name_summary(hits).join(known, "name_no", "left")
    told = settle(
        names.join(summary, "name_no").select(
            "match_name", "n", "name_no", hit_names().alias("fuzzy_candidate_names"), F.coalesce("_known", F.lit(False)).alias("_known")
        ),
        "named",
    )
    # Items carry a name's number and their vector only. A name without hits has no number,
    # and one without embedded leaves has none where such items are compared with all leaves.
    numbered = told if on_no_candidates == "none" else told.where("_known")
    matched = spread_join(
        with_match_name(thin, item_name), numbered.select("match_name", "name_no"), "match_name", "left",
        spread_by=item_id, counts=names,
    )
    probe = item_embedding_join(matched, item_emb, id=item_id)
    best = cosine_top_k(
        probe, leaves, k=k, id=item_id, ranges=ranges, keep=(item_name, "match_name"), rows=rows,
    )
    shown = told.select("match_name", F.col("fuzzy_candidate_names").alias("_shown"))
    named = spread_join(best, shown, "match_name", "left", spread_by=item_id, counts=names)
    return named.select(
        *cols([item_id, item_name]), F.col("candidates_count").alias("fuzzy_candidates_count"),
        F.coalesce("_shown", F.lit(NO_MATCH)).alias("fuzzy_candidate_names"), "topk",
    )


def assign_classes(
    items: DataFrame,
    classes: DataFrame,
    item_emb: DataFrame,
    class_emb: DataFrame,
    *,
    item_id: str,
    item_name: str,
    top_n: int = 3,
    keep_top_k: int | None = None,
    **options,
) -> DataFrame:
    """One row per item with a vector: id, name, ``top_i_*`` columns and the fuzzy columns.

    ``on_no_candidates`` is "none" (items whose matches have no embedded leaf get null
    ranks) or "all" (they are compared with every leaf). ``keep_top_k`` also keeps that
    many ranked candidates in ``topk``, for a rerank.
    """
    ranked = rank_classes(
        items, classes, item_emb, class_emb,
        item_id=item_id, item_name=item_name, k=max(top_n, keep_top_k or 0), **options,
    )
    tail = ["fuzzy_candidates_count", "fuzzy_candidate_names"]
    if keep_top_k:
        ranked = ranked.withColumn("_all", F.col("topk")).withColumn(
            "topk", F.slice("topk", 1, keep_top_k)
        )
        return pivot_top_n(ranked, top_n, topk="_all", keep=[item_id, item_name, *tail, "topk"])
    return pivot_top_n(ranked, top_n, keep=[item_id, item_name, *tail])


def assign_classes_fallback(*args, **options) -> DataFrame:
    return assign_classes(*args, on_no_candidates="all", **options)


def attach_items(result: DataFrame, items: DataFrame, *, item_id: str, item_name: str) -> DataFrame:
    """Add the item columns; the item table's own name column becomes ``item_<name>``."""
    columns = [
        col(c).alias(f"item_{c}") if c == item_name else col(c)
        for c in items.columns
        if c != item_id
    ]
    return result.join(items.select(col(item_id), *columns), item_id, "left")


def attach_top1_class(result: DataFrame, classes: DataFrame, *, class_id: str = "id") -> DataFrame:
    """Add the ``class_*`` columns of the best class.

    A class can be the best one of most items, so its key is split when it is hot.
    """
    side = prefix_columns(classes).withColumn("top_1_class_id", F.col(f"class_{class_id}"))
    return spread_join(result, side, "top_1_class_id", "left", spread_by=result.columns[0])


def assign_and_attach(
    items: DataFrame,
    classes: DataFrame,
    item_emb: DataFrame,
    class_emb: DataFrame,
    *,
    item_id: str,
    item_name: str,
    class_id: str = "id",
    **options,
) -> DataFrame:
    result = assign_classes(
        items, classes, item_emb, class_emb,
        item_id=item_id, item_name=item_name, class_id=class_id, **options,
    )
    # Written once: both joins and their hot-key counts read it.
    result = settle(result, "assigned")
    attached = attach_top1_class(result, classes, class_id=class_id)
    return attach_items(attached, items, item_id=item_id, item_name=item_name)
