"""Class trees: from ragged level columns to a node table and its leaf closure."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classmap.functions.names import col, cols
from classmap.functions.text import strip
from classmap.operators.ordering import forward_fill, number_rows
from classmap.operators.rows import drop_all_null_rows, select_level_columns
from classmap.plans.settle import release, settle


def level_path(levels: Sequence[str]) -> Column:
    """Non-blank levels of one row as ``array<struct(level, level_label, name)>``."""
    cells = [
        F.struct(
            F.lit(i).alias("level"), F.lit(c).alias("level_label"),
            F.coalesce(strip(col(c).cast("string")), F.lit("")).alias("name"),
        )
        for i, c in enumerate(levels, start=1)
    ]
    return F.filter(F.array(*cells), lambda x: x["name"] != "")


def previous_level_key(sheet: DataFrame, levels: Sequence[str], *, position: str = "row_pos") -> DataFrame:
    """One row per non-blank cell with the key of the previous non-blank level."""
    path = sheet.select(position, level_path(levels).alias("path"))
    cells = path.select(position, "path", F.posexplode("path").alias("at", "cell"))
    parent = F.get(F.col("path"), F.col("at") - 1)
    return cells.select(
        position,
        F.col("cell.level").alias("level"),
        F.col("cell.level_label").alias("level_label"),
        F.col("cell.name").alias("name"),
        parent["level"].alias("parent_level"),
        parent["name"].alias("parent_name"),
    )


def assign_node_ids(
    cells: DataFrame, *, position: str = "row_pos", ranges: int | None = None
) -> DataFrame:
    """Distinct ``(level, name)`` keys, numbered in first-seen order (row, then level).

    A key keeps the parent of its first sighting.
    """
    first = F.struct(
        col(position).alias("first_pos"), "level_label", "parent_level", "parent_name"
    )
    nodes = cells.groupBy("level", "name").agg(F.min(first).alias("first")).select(
        "level", "name", "first.*"
    )
    return number_rows(
        nodes, position="first_pos", then=["level"], out="id", ranges=ranges
    )


def link_parents(nodes: DataFrame) -> DataFrame:
    keys = nodes.select(
        F.col("level").alias("parent_level"), F.col("name").alias("parent_name"),
        F.col("id").alias("parent_id"),
    )
    linked = nodes.join(keys, ["parent_level", "parent_name"], "left")
    return linked.select("id", "name", "level", "level_label", "parent_id")


def mark_leaf_nodes(nodes: DataFrame) -> DataFrame:
    """Flag the nodes that no other node names as its parent."""
    parents = nodes.where(F.col("parent_id").isNotNull()).select(
        F.col("parent_id").alias("id"), F.lit(False).alias("_leaf")
    ).distinct()
    flagged = nodes.join(parents, "id", "left")
    return flagged.select(
        *cols(nodes.columns), F.coalesce("_leaf", F.lit(True)).alias("lowest_level_class")
    )


def build_hierarchy(
    sheet: DataFrame,
    *,
    levels: Sequence[str] | None = None,
    keywords: Sequence[str] = ("Level",),
    position: str = "row_pos",
    ranges: int | None = None,
) -> DataFrame:
    """Node table ``id, name, level, level_label, parent_id, lowest_level_class``."""
    levels = select_level_columns(sheet.columns, names=levels, keywords=keywords)
    filled = forward_fill(
        sheet.select(position, *levels), levels, position=position, ranges=ranges
    )
    cells = previous_level_key(drop_all_null_rows(filled, levels), levels, position=position)
    nodes = settle(assign_node_ids(cells, position=position, ranges=ranges), "nodes")
    return mark_leaf_nodes(link_parents(nodes))


def _climb(tree: DataFrame, leaves: DataFrame) -> DataFrame:
    """``leaf_id, anc_id, distance`` from every leaf to itself and the inner nodes above it.

    ``tree`` is ``id, parent_id, leaf``; the way up ends below a node flagged as a leaf.
    A round joins ways with ways: it knows all ancestors up to twice as far as the one
    before, so a tree of depth d takes log2(d) rounds. Each is written, and the jumps of a
    round take the place of those of the one before.
    """
    inner = tree.where("not leaf").select(F.col("id").alias("parent_id"))
    jumps = tree.select("id", "parent_id").join(inner, "parent_id", "left_semi")
    jumps = settle(jumps.select("id", F.col("parent_id").alias("up"), F.lit(1).cast("bigint").alias("far")).distinct(), "jumps")
    nodes, open_ = tree.count(), not jumps.isEmpty()
    parts = [settle(leaves.select(F.col("id").alias("leaf_id"), F.col("id").alias("anc_id"), F.lit(0).cast("bigint").alias("distance")), "climb")]
    far = 1
    while open_:
        if far > nodes:
            raise ValueError("parent_id has a cycle")
        reached = reduce(DataFrame.unionByName, parts)
        step = reached.join(jumps.withColumnRenamed("id", "anc_id"), "anc_id")
        parts.append(settle(step.select("leaf_id", F.col("up").alias("anc_id"), (F.col("distance") + F.col("far")).alias("distance")).distinct(), "climb"))
        after = jumps.select(F.col("id").alias("up"), F.col("up").alias("_up"))
        last, jumps = jumps, settle(
            jumps.join(after, "up").select("id", F.col("_up").alias("up"), (F.col("far") * 2).alias("far")).distinct(), "jumps"
        )
        release(last)
        far, open_ = far * 2, not jumps.isEmpty()
    return reduce(DataFrame.unionByName, parts)


def _tree(classes: DataFrame, class_id: str, parent_id: str, leaf: str) -> DataFrame:
    return classes.select(
        col(class_id).alias("id"), col(parent_id).alias("parent_id"),
        F.coalesce(col(leaf), F.lit(False)).alias("leaf"),
    )


def hierarchy_closure(
    classes: DataFrame,
    *,
    class_id: str = "id",
    parent_id: str = "parent_id",
    leaf: str = "lowest_level_class",
) -> DataFrame:
    """``(anc_id, leaf_id)``: every leaf below each class; a leaf is below itself only.

    Descent stops at a flagged leaf, and without a flag column every class is its own
    leaf. Trees may be of any depth: paths are joined with paths, so their length doubles
    from round to round. A class that reaches itself raises.
    """
    if leaf not in classes.columns:
        return classes.select(col(class_id).alias("anc_id"), col(class_id).alias("leaf_id"))
    tree = _tree(classes, class_id, parent_id, leaf)
    return _climb(tree, tree.where("leaf")).select("anc_id", "leaf_id").distinct()


def nested_leaves(side: DataFrame, leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves numbered depth first, so that those below a class are one range.

    ``side`` is a class table (``class_pos, class_id, parent_id, leaf``), ``leaves`` the
    leaves to number. Gives the leaves with ``leaf_no`` (from 0) and ``class_pos, lo, hi``
    of the classes that have any: their leaves are ``lo`` to ``hi - 1``.
    """
    tree = side.select(F.col("class_id").alias("id"), "parent_id", "leaf")
    ways = _climb(tree, leaves.select(F.col("class_id").alias("id")))
    places = side.select(F.col("class_id").alias("anc_id"), F.col("class_pos").alias("anc_pos"))
    ways = ways.join(places, "anc_id")
    # The way from the top down sorts the leaves depth first.
    down = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("distance")).alias("d"), "anc_pos"))), lambda x: x["anc_pos"])
    order = ways.groupBy("leaf_id").agg(down.alias("way"))
    numbered = number_rows(order, position="way", out="_n").select("leaf_id", (F.col("_n") - 1).alias("leaf_no"))
    numbered = settle(numbered, "leaf-numbers")
    number = F.col("leaf_no")
    ranges = ways.join(numbered, "leaf_id").groupBy(F.col("anc_pos").alias("class_pos")).agg(
        F.min(number).alias("lo"), (F.max(number) + 1).alias("hi")
    )
    placed = leaves.join(numbered.withColumnRenamed("leaf_id", "class_id"), "class_id")
    return settle(placed, "leaves"), settle(ranges, "class-ranges")
