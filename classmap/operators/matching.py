"""Fuzzy join: every (name, class) pair whose fuzzy score reaches a threshold.

The comparison is not an equality, so it cannot be hashed into place. Its cost is kept
down by comparing distinct lower-cased names only, by lossless letter-count filters on
groups of names and then on pairs, and by token postings. Names and class names are dealt
into splits and blocks that meet in tasks; hits are rows, and no array grows with them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from classmap.functions.names import col, cols
from classmap.functions import fuzzy
from classmap.functions.text import level_label
from classmap.operators.joins import require_columns, spread_join
from classmap.operators.ordering import number_rows
from classmap.plans.blocks import BLOCK, SPLIT, block_count, pair_blocks
from classmap.plans.settle import settle, task_count

# How many hits are listed by name, and the text for none.
LISTED_HITS = 20
NO_MATCH = "No fuzzy match"
# Class names of a block.
BLOCK_NAMES = 8192
# Fewest and most pairs a task should compare (about 0.1 s and 20 s of work).
PAIRS_PER_TASK = (100_000, 20_000_000)
# Cells of the name x class matrix a task holds at a time.
CELLS = 1 << 20
PAIR_HEADS = ["name_no", "match_name", "score"]


def class_table(
    classes: DataFrame,
    *,
    class_id: str = "id",
    class_name: str = "name",
    leaf: str = "lowest_level_class",
    order: str | None = None,
) -> DataFrame:
    """The class side, written once: ``class_pos`` (0-based table order), id, name,
    lower-cased name, display label, parent and leaf flag."""
    require_columns(classes, class_id, class_name)
    order = order or ("row_pos" if "row_pos" in classes.columns else class_id)
    level = F.col("level") if "level" in classes.columns else None
    parent = F.col("parent_id") if "parent_id" in classes.columns else F.lit(None)
    flag = F.coalesce(col(leaf), F.lit(False)) if leaf in classes.columns else F.lit(True)
    name = col(class_name).cast("string")
    rows = classes.select(
        col(order).alias("row_pos"),
        col(class_id).alias("class_id"),
        name.alias("class_name"),
        F.lower(name).alias("match_name"),
        level_label(name, level).alias("label"),
        parent.cast(classes.schema[class_id].dataType).alias("parent_id"),
        flag.alias("leaf"),
    )
    numbered = number_rows(rows, out="_n")
    return settle(
        numbered.select((F.col("_n") - 1).alias("class_pos"), *[c for c in rows.columns if c != "row_pos"]),
        "classes",
    )


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ranges start..start+count."""
    offset = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) - np.repeat(offset - starts, counts)


def name_pairs(
    names: DataFrame,
    classes: DataFrame,
    *,
    threshold: float = 0.6,
    count: int | None = None,
    block_names: int = BLOCK_NAMES,
    splits: int | None = None,
) -> DataFrame:
    """``name_no, match_name, score`` for each class name that a name is near to.

    ``names`` is a stored table of distinct ``match_name`` with ``name_no``; ``classes``
    comes from :func:`class_table`. Class names are compared once each, whatever the number
    of classes that bear them. They are dealt into blocks by length and letters, so that
    like names are in one block and whole groups of them can be ruled out at once.
    """
    spark = names.sparkSession
    each = classes.where(F.col("match_name").isNotNull()).select("match_name").distinct()
    total, n = each.count(), names.count() if count is None else count
    blocks = block_count(total, block_names)
    each = each.select(F.col("match_name").alias("class_name"), F.pmod(F.xxhash64("match_name"), F.lit(blocks)).cast("int").alias(BLOCK))
    parts = splits or task_count(spark, n * total, *PAIRS_PER_TASK)
    dealt = names.select("name_no", "match_name", F.pmod(F.xxhash64("match_name"), F.lit(parts)).cast("int").alias(SPLIT))

    def match(a: pa.Table, b: pa.Table) -> pa.Table:
        texts, others = a["match_name"].to_pylist(), b["class_name"].to_pylist()
        out = []
        if others:
            prepared = fuzzy.NameBlock(others)
            step = max(1, CELLS // len(others))
            number, theirs = a["name_no"].combine_chunks(), b["class_name"].combine_chunks()
            for at in range(0, len(texts), step):
                i, j, score = fuzzy.match_names(texts[at : at + step], prepared, threshold)
                out.append(pa.table([number.take(pa.array(i + at)), theirs.take(pa.array(j)), pa.array(score)], PAIR_HEADS))
        return pa.concat_tables(out) if out else pa.table([pa.array([], t) for t in (pa.int64(), pa.string(), pa.float64())], PAIR_HEADS)

    return pair_blocks(dealt, each, parts, blocks, match, "name_no bigint, match_name string, score double")


def class_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of names with every class that bears the matched name."""
    side = classes.where(F.col("match_name").isNotNull()).select("match_name", "class_pos", "class_id", "label")
    return pairs.join(side, "match_name").select("name_no", "class_pos", "class_id", "label", "score")


def name_summary(pairs: DataFrame) -> DataFrame:
    """``name_no, n_hits, labels`` of :func:`class_pairs`: the first labels in class order."""
    order = Window.partitionBy("name_no").orderBy("class_pos")
    first = pairs.withColumn("_at", F.row_number().over(order))
    shown = F.when(F.col("_at") <= LISTED_HITS, F.struct("_at", "label"))
    listed = first.groupBy("name_no").agg(F.count(F.lit(1)).cast("int").alias("n_hits"), F.array_sort(F.collect_list(shown)).alias("_shown"))
    return listed.select("name_no", "n_hits", F.col("_shown.label").alias("labels"))


def distinct_names(items: DataFrame, *, item_name: str) -> DataFrame:
    """Distinct lower-cased item names with their number of rows ``n``, written once and
    numbered by ``name_no`` (without an order).

    A missing name never matches anything.
    """
    names = items.select(F.lower(col(item_name).cast("string")).alias("match_name"))
    counted = names.where(F.col("match_name").isNotNull()).groupBy("match_name").agg(
        F.count(F.lit(1)).alias("n")
    )
    return settle(counted.withColumn("name_no", F.monotonically_increasing_id()), "names")


def with_match_name(items: DataFrame, item_name: str) -> DataFrame:
    return items.withColumn("match_name", F.lower(col(item_name).cast("string")))


def fuzzy_hits(
    items: DataFrame,
    classes: DataFrame,
    *,
    item_id: str,
    item_name: str,
    threshold: float = 0.6,
    **limits,
) -> DataFrame:
    """Items with the number of classes their name matches, ``n_hits``, and the first
    ``labels`` (null without a hit).

    Names are counted once: the counts feed the comparison and tell which names are too
    frequent for one task of the join back to the items.
    """
    names = distinct_names(items, item_name=item_name)
    pairs = settle(name_pairs(names, classes, threshold=threshold, **limits), "pairs")
    told = names.join(name_summary(class_pairs(pairs, classes)), "name_no").select("match_name", "n_hits", "labels")
    return spread_join(
        with_match_name(items, item_name), told, "match_name", "left",
        spread_by=item_id, counts=names,
    ).drop("match_name")


def fuzzy_join(
    items: DataFrame,
    classes: DataFrame,
    *,
    item_id: str,
    item_name: str,
    class_id: str = "id",
    class_name: str = "name",
    threshold: float = 0.6,
    order: str | None = None,
    **limits,
) -> DataFrame:
    """``(item id, class_id, score)`` for every pair at or above the threshold.

    Pairs stay rows throughout: names meet class names, matched names their classes, and
    the rows of hot item names are spread over tasks.
    """
    side = class_table(classes, class_id=class_id, class_name=class_name, order=order)
    thin = items.select(*cols([item_id, item_name]))
    names = distinct_names(thin, item_name=item_name)
    pairs = settle(name_pairs(names, side, threshold=threshold, **limits), "pairs")
    told = names.join(class_pairs(pairs, side), "name_no").select("match_name", F.col("class_id").alias("_class"), F.col("score").alias("_score"))
    found = spread_join(with_match_name(thin, item_name), told, "match_name", "inner", spread_by=item_id, counts=names)
    return found.select(col(item_id), F.col("_class").alias("class_id"), F.col("_score").alias("score"))


def hit_names(n_hits="n_hits", labels="labels") -> Column:
    """First hits in class order by label, the number left out, or a no-match text."""
    n = F.coalesce(col(n_hits), F.lit(0))
    more = F.when(
        n > LISTED_HITS,
        F.array(F.concat(F.lit("...(+"), (n - LISTED_HITS).cast("string"), F.lit(" more)"))),
    ).otherwise(F.array().cast("array<string>"))
    listed = F.array_join(F.concat(col(labels), more), "; ")
    return F.when(n > 0, listed).otherwise(F.lit(NO_MATCH))


def expand_candidates(pairs: DataFrame, closure: DataFrame, leaves: DataFrame, *, item_id: str) -> DataFrame:
    """Distinct ``(item id, class_id)`` of the embedded leaves below each hit class.

    ``pairs`` is ``(item id, class_id)``, ``closure`` is ``(anc_id, leaf_id)``, and
    ``leaves`` holds the ids of the embedded leaves as ``class_id``.
    """
    usable = closure.join(leaves.select(F.col("class_id").alias("leaf_id")), "leaf_id", "left_semi")
    below = pairs.select(col(item_id), F.col("class_id").alias("anc_id")).join(usable, "anc_id")
    return below.select(col(item_id), F.col("leaf_id").alias("class_id")).distinct()


def distinct_candidates(candidates: DataFrame, *, item_id: str | None = None) -> DataFrame:
    """The different candidate classes of each item, or of all items without ``item_id``."""
    return candidates.select(*([col(item_id)] if item_id else []), "class_id").distinct()


def candidate_count(candidates: DataFrame, *, item_id: str) -> DataFrame:
    return candidates.groupBy(col(item_id)).agg(F.count(F.lit(1)).alias("fuzzy_candidates_count"))
