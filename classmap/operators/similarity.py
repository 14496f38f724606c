"""Cosine top-k of item vectors against class vectors, as blocked matrix products.

Class vectors are rows dealt into blocks, items are dealt into splits, and a task compares
one split with one block. Each block yields a partial top-k per item, and with several
blocks the partial results are merged per item. Nothing of either side passes the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from classmap.functions.names import col, cols
from classmap.functions.vector import usable_vector
from classmap.operators.matching import _ragged
from classmap.operators.ordering import number_rows
from classmap.plans.blocks import BLOCK, SPLIT, block_count, pair_blocks, split_rows
from classmap.plans.settle import settle

# Cells of the item x class similarity matrix a task holds at a time.
CELLS = 1 << 22
# Leaves of a block, and the fewest and most items of a split.
BLOCK_LEAVES = 8192
SPLIT_ROWS = (2048, 65536)
# A hot name's rows are dealt out in so many parts of a split's size: few large parts would
# land unevenly, and a task holds its whole split.
PARTS = 8
# Similarities closer than this are ties (matrix products vary in the last bits).
TIE_DIGITS = 12


def class_embedding_join(classes: DataFrame, embeddings: DataFrame, *, emb_id: str = "id") -> DataFrame:
    """Embedded leaves in class order, with a dense ``leaf_pos``; others cannot be assigned.
    A null or non-finite vector counts as none."""
    vectors = embeddings.where(usable_vector("embedding")).select(col(emb_id).alias("class_id"), "embedding")
    leaves = classes.where("leaf").select("class_pos", "class_id", "class_name").join(vectors, "class_id")
    numbered = number_rows(leaves, position="class_pos", out="_n")
    return settle(
        numbered.select((F.col("_n") - 1).alias("leaf_pos"), *cols(leaves.columns)), "leaves"
    )


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1.0, norms)


def _matrix(lists) -> np.ndarray:
    """List column of equally long vectors as rows of doubles."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if not len(lists):
        return np.zeros((0, 0))
    rows = flat.reshape(len(lists), -1) if len(flat) % len(lists) == 0 else None
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    if rows is None or (sizes != rows.shape[1]).any():
        raise ValueError("embeddings differ in length")
    return rows


def _best(sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Column and value of the k best per row; equal values keep column order."""
    rows = np.arange(len(sims))
    cols, vals = [], []
    for _ in range(min(k, sims.shape[1])):
        c = sims.argmax(axis=1)
        cols.append(c)
        vals.append(sims[rows, c])
        sims[rows, c] = -np.inf
    if not cols:
        return np.zeros((len(sims), 0), np.int64), np.zeros((len(sims), 0))
    return np.stack(cols, axis=1), np.stack(vals, axis=1)


def _struct_lists(cols, vals, table: pa.Table) -> pa.ListArray:
    """Ranked (class_pos, class_id, class_name, sim) lists, dropping masked cells."""
    keep = np.isfinite(vals)
    ends = np.concatenate([[0], np.cumsum(keep.sum(axis=1))]).astype(np.int32)
    rows = pa.array(cols[keep])
    fields = [table[c].combine_chunks().take(rows) for c in ("class_pos", "class_id", "class_name")]
    structs = pa.StructArray.from_arrays(
        [*fields, pa.array(vals[keep])], names=["class_pos", "class_id", "class_name", "sim"]
    )
    return pa.ListArray.from_arrays(pa.array(ends), structs)


def merge_ranges(ranges: DataFrame, by: str) -> DataFrame:
    """Overlapping and touching ``lo, hi`` of each ``by`` made one."""
    order = Window.partitionBy(by).orderBy("lo", "hi")
    before = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = ranges.select(by, "lo", "hi", F.coalesce(F.col("lo") > before, F.lit(True)).cast("int").alias("_new"))
    placed = opened.withColumn("_at", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return placed.groupBy(by, "_at").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_at")


def _inside(names: np.ndarray, ranges: pa.Table, first: int, width: int) -> np.ndarray:
    """Which of ``width`` leaf numbers from ``first`` on lie in the ranges of each name."""
    order = np.argsort(ranges["name_no"].to_numpy(), kind="stable")
    of = ranges["name_no"].to_numpy()[order]
    lo, hi = (np.clip(ranges[c].to_numpy()[order] - first, 0, width) for c in ("lo", "hi"))
    a, b = np.searchsorted(of, names), np.searchsorted(of, names, "right")
    row, at = np.repeat(np.arange(len(names)), b - a), _ragged(a, b - a)
    edges = np.zeros((len(names), width + 1), np.int32)
    np.add.at(edges, (row, lo[at]), 1)
    np.add.at(edges, (row, hi[at]), -1)
    return np.cumsum(edges[:, :-1], axis=1, dtype=np.int32) > 0


def cosine_top_k(
    items: DataFrame,
    leaves: DataFrame,
    *,
    k: int,
    id: str,
    ranges: DataFrame | None = None,
    keep: Sequence[str] = (),
    rows: int | None = None,
    block_leaves: int = BLOCK_LEAVES,
    split: tuple[int, int] = SPLIT_ROWS,
) -> DataFrame:
    """``id, <keep>, candidates_count, topk array<struct(class_pos, class_id, class_name, sim)>``.

    ``items`` holds ``id`` and ``embedding``; ``leaves`` a dense number ``leaf_no`` or
    ``leaf_pos``. With ``ranges`` (``name_no, lo, hi``, none of a name overlapping) items
    also hold ``name_no`` and are compared with the leaves in their name's ranges; a null
    ``name_no`` means all leaves, which are not counted as candidates.

    Item splits meet leaf blocks in tasks (``plans.blocks``). Items of one name go to one
    split, hot names to several, so that a name's ranges are sent once or a few times.
    With several blocks the partial results are merged per item. ``rows`` is the number of
    items, or a bound of it; without it they are counted.
    """
    spark = items.sparkSession
    kind = leaves.schema["class_id"].dataType.simpleString()
    number = "leaf_no" if "leaf_no" in leaves.columns else "leaf_pos"
    carried = [id, *keep]
    best = f"array<struct<class_pos:bigint,class_id:{kind},class_name:string,sim:double>>"
    heads = ", ".join(f"`{c}` {items.schema[c].dataType.simpleString()}" for c in carried)
    schema = f"{heads}, n int, topk {best}"
    name = F.col("name_no") if ranges is not None else F.lit(None)
    probe = items.select(
        *cols(carried), F.col("embedding").alias("_vector"), name.cast("bigint").alias("_name"),
        F.monotonically_increasing_id().alias("_row"),
    )
    last = leaves.agg(F.coalesce(F.max(number) + 1, F.lit(0))).first()[0]
    blocks = block_count(last, block_leaves)
    if blocks > 1:
        # Partial results are merged by row: ids may repeat.
        probe = settle(probe, "vectors")
        carried, schema = [*carried, "_row"], schema.replace(", n int,", ", _row bigint, n int,")
    total = items.count() if rows is None else rows
    size = split_rows(total, spark.sparkContext.defaultParallelism, *split)
    splits = block_count(total, size)
    parts, shared = F.lit(1), None
    if ranges is not None:
        ranges = ranges.select(F.col("name_no").cast("bigint").alias("_name"), "lo", "hi")
        # At most PARTS * rows / split size names are hot.
        part_rows = max(1, size // PARTS)
        hot = probe.groupBy("_name").agg(F.count(F.lit(1)).alias("_n")).where("_name is not null").where(F.col("_n") > part_rows)
        hot = settle(hot.select("_name", F.ceil(F.col("_n") / part_rows).cast("int").alias("_parts")), "hot-names")
        probe = probe.join(F.broadcast(hot), "_name", "left")
        parts = F.coalesce("_parts", F.lit(1))
        spread = ranges.join(F.broadcast(hot), "_name", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
        shared = spread.select(
            F.pmod(F.xxhash64("_name", "_part"), F.lit(splits)).cast("int").alias(SPLIT),
            F.col("_name").alias("name_no"), "lo", "hi",
        ).distinct()
        shared = shared.withColumn(
            BLOCK, F.explode(F.sequence(*[F.floor(c / block_leaves).cast("int") for c in (F.col("lo"), F.col("hi") - 1)]))
        )
    part = F.pmod(F.xxhash64("_row"), parts.cast("bigint")).cast("int")
    place = F.when(F.col("_name").isNull(), F.xxhash64("_row")).otherwise(F.xxhash64("_name", part))
    dealt = probe.withColumn(SPLIT, F.pmod(place, F.lit(splits)).cast("int")).drop("_parts")
    sides = leaves.select(
        F.floor(F.col(number) / block_leaves).cast("int").alias(BLOCK), F.col(number).cast("bigint").alias("leaf_no"),
        F.col("class_pos").cast("bigint").alias("class_pos"), "class_id", "class_name", "embedding",
    )

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        table = b.filter(pc.is_valid(b["class_pos"])).sort_by("class_pos").combine_chunks()
        inside = b.filter(pc.is_valid(b["lo"])) if "lo" in b.column_names else None
        classes = _unit(_matrix(table["embedding"]))
        leaf = table["leaf_no"].to_numpy()
        first, width = (int(leaf.min()), int(leaf.max() - leaf.min()) + 1) if len(leaf) else (0, 0)
        names = a["_name"].combine_chunks().fill_null(-1).to_numpy(zero_copy_only=False)
        step, out = max(1, CELLS // max(1, len(leaf))), []
        for at in range(0, a.num_rows, step):
            some, own = a.slice(at, step), names[at : at + step]
            vectors = _unit(_matrix(some["_vector"]))
            board = vectors @ classes.T if len(leaf) else np.zeros((len(own), 0))
            np.round(board, TIE_DIGITS, out=board)
            n = np.zeros(len(own), np.int32)
            if inside is not None and (own >= 0).any():
                different, which = np.unique(own, return_inverse=True)
                good = _inside(different, inside, first, width)[:, leaf - first][which] if width else np.zeros(board.shape, bool)
                masked = own >= 0
                n[masked] = good[masked].sum(axis=1)
                board[masked[:, None] & ~good] = -np.inf
            columns = [some[c] for c in carried] + [pa.array(n), _struct_lists(*_best(board, k), table)]
            out.append(pa.table(columns, [*carried, "n", "topk"]))
            del board  # not beside the next one
        return pa.concat_tables(out)

    if shared is None:
        found = pair_blocks(dealt, sides, splits, blocks, compare, schema)
    else:
        found = pair_blocks(dealt, sides, splits, blocks, compare, schema, also=shared)
    if blocks == 1:
        return found.select(*cols(carried), F.col("n").alias("candidates_count"), "topk")
    merged = found.groupBy("_row").agg(
        *[F.first(col(c)).alias(c) for c in [id, *keep]],
        F.sum("n").cast("int").alias("candidates_count"),
        _ranked(F.flatten(F.collect_list("topk")), k).alias("topk"),
    )
    return merged.select(*cols([id, *keep]), "candidates_count", "topk")


def _ranked(entries: Column, k: int) -> Column:
    """Best k of an array of candidates: similarity down, class order up."""

    def order(a, b):
        return (
            F.when(a["sim"] > b["sim"], -1)
            .when(a["sim"] < b["sim"], 1)
            .when(a["class_pos"] < b["class_pos"], -1)
            .when(a["class_pos"] > b["class_pos"], 1)
            .otherwise(0)
        )

    return F.slice(F.array_sort(entries, order), 1, k)


def top_n_classes(assigned: DataFrame, n: int, *, id: str, topk: str = "topk") -> DataFrame:
    """One row per item and rank."""
    rows = assigned.select(col(id), F.posexplode(F.slice(col(topk), 1, n)).alias("at", "c"))
    return rows.select(
        col(id),
        (F.col("at") + 1).alias("rank"),
        F.col("c.class_id").alias("class_id"),
        F.col("c.class_name").alias("class_name"),
        F.round("c.sim", 4).alias("similarity"),
    )


def pivot_top_n(assigned: DataFrame, n: int, *, topk: str = "topk", keep: Sequence[str] = ()) -> DataFrame:
    """``top_i_class_id/_class_name/_similarity`` columns; missing ranks are null."""
    cells: list[Column] = []
    for i in range(1, n + 1):
        c = F.get(col(topk), F.lit(i - 1))
        cells += [
            c["class_id"].alias(f"top_{i}_class_id"),
            c["class_name"].alias(f"top_{i}_class_name"),
            F.round(c["sim"], 4).alias(f"top_{i}_similarity"),
        ]
    return assigned.select(*cols(keep), *cells)


def margin(topk="topk") -> Column:
    """Unrounded distance between the two best; null with fewer than two."""
    t = col(topk) if isinstance(topk, str) else topk
    return F.get(t, F.lit(0))["sim"] - F.get(t, F.lit(1))["sim"]


def margin_gate(topk="topk", below: float | None = None) -> Column:
    """Whether an item goes to the model: always without a limit or with one candidate."""
    if below is None:
        return F.lit(True)
    return F.coalesce(margin(topk) < below, F.lit(True))


def cosine_candidates(
    candidates: DataFrame, items: DataFrame, leaves: DataFrame, *, item_id: str, rows: int | None = None,
    block_leaves: int = BLOCK_LEAVES, split: tuple[int, int] = SPLIT_ROWS,
) -> DataFrame:
    """``(item id, class_id, similarity)`` of a given set of candidates.

    Vectors are not copied onto pairs: a task holds the vectors of a split of items and of
    a block of leaves and works out the pairs between them.
    """
    spark = items.sparkSession
    total = items.count() if rows is None else rows
    splits = block_count(total, split_rows(total, spark.sparkContext.defaultParallelism, *split))
    blocks = block_count(leaves.count(), block_leaves)
    split_of = F.pmod(F.xxhash64("_item"), F.lit(splits)).cast("int").alias(SPLIT)
    block_of = F.pmod(F.xxhash64("class_id"), F.lit(blocks)).cast("int").alias(BLOCK)
    probe = items.select(col(item_id).alias("_item"), F.col("embedding").alias("_vector")).select("*", split_of)
    side = leaves.select("class_id", "embedding", block_of)
    asked = candidates.select(col(item_id).alias("_item"), "class_id").select("_item", F.col("class_id").alias("_class"), split_of, block_of)
    heads = ["_item", "class_id", "similarity"]
    kinds = [items.schema[item_id].dataType.simpleString(), leaves.schema["class_id"].dataType.simpleString(), "double"]

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        pairs, table = b.filter(pc.is_valid(b["_item"])), b.filter(pc.is_valid(b["class_id"]))
        i = pc.index_in(pairs["_item"], a["_item"].combine_chunks())
        j = pc.index_in(pairs["_class"], table["class_id"].combine_chunks())
        good = pc.and_(pc.is_valid(i), pc.is_valid(j))
        pairs, i, j = pairs.filter(good), i.filter(good).to_numpy(), j.filter(good).to_numpy()
        sims = np.zeros(len(i))
        if len(i):
            left, right = _unit(_matrix(a["_vector"])), _unit(_matrix(table["embedding"]))
            for at in range(0, len(i), CELLS // 64):
                cut = slice(at, at + CELLS // 64)
                sims[cut] = np.einsum("ij,ij->i", left[i[cut]], right[j[cut]])
        return pa.table([pairs["_item"], pairs["_class"], pa.array(sims)], heads)

    schema = ", ".join(f"{h} {k}" for h, k in zip(heads, kinds, strict=True))
    found = pair_blocks(probe, side, splits, blocks, compare, schema, also=asked)
    return found.select(F.col("_item").alias(item_id), "class_id", "similarity")
