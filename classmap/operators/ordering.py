"""Operators that depend on row order, without putting all rows in one task.

Rows are dealt out by ranges of their position and written. Each range is handled by its
own task; what passes between ranges (a count, or the last value seen) is one small row
per range, so sparse positions cost no more than dense ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from classmap.functions.names import col, cols, quoted
from classmap.operators.joins import intersect_ids
from classmap.plans.settle import settle

def _earlier() -> WindowSpec:
    """Over the ranges before one; it holds one row per range, all in one task."""
    return Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)


def in_ranges(df: DataFrame, order: Sequence[str], *, ranges: int | None = None) -> DataFrame:
    """A written copy with a ``_range`` number that rises with ``order``.

    A row without a first order value has no place in the order, so that raises.
    """
    first = quoted(order[0])
    placed = F.when(
        col(order[0]).isNull(), F.raise_error(F.lit(f"a row has no {order[0]}"))
    ).otherwise(F.lit(0))
    checked = df.where(placed == 0)
    by = [first, *map(quoted, order[1:])]
    dealt = checked.repartitionByRange(ranges, *by) if ranges else checked.repartitionByRange(*by)
    return settle(dealt.withColumn("_range", F.spark_partition_id()), "ranges")


def number_rows(
    df: DataFrame,
    *,
    position: str = "row_pos",
    then: Sequence[str] = (),
    out: str = "Unique_ID",
    ranges: int | None = None,
) -> DataFrame:
    """Add 1..n in order of ``position`` (ties broken by ``then``). A null position raises."""
    cut = in_ranges(df, [position, *then], ranges=ranges)
    counts = cut.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(_earlier()), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(*cols([position, *then]))
    ranked = cut.withColumn("_rank", F.row_number().over(inside))
    numbered = ranked.join(offsets, "_range")
    number = (F.col("_offset") + F.col("_rank")).cast("bigint").alias(out)
    return numbered.select(number, *cols(df.columns))


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    *,
    position: str = "row_pos",
    ranges: int | None = None,
) -> DataFrame:
    """Replace nulls by the last non-null value above, over the whole table. A null
    position raises."""
    cut = in_ranges(df, [position], ranges=ranges)
    upto = Window.partitionBy("_range").orderBy(col(position)).rowsBetween(Window.unboundedPreceding, 0)
    lasts = cut.groupBy("_range").agg(
        *[
            F.max(F.when(col(c).isNotNull(), F.struct(col(position), col(c).alias("v"))))
            .getField("v")
            .alias(f"_last_{c}")
            for c in columns
        ]
    )
    carried = lasts.select(
        "_range",
        *[F.last(col(f"_last_{c}"), ignorenulls=True).over(_earlier()).alias(f"_carry_{c}") for c in columns],
    )
    filled = cut.select(
        "_range",
        *cols(c for c in df.columns if c not in columns),
        *[F.last(col(c), ignorenulls=True).over(upto).alias(c) for c in columns],
    ).join(carried, "_range")
    return filled.select(
        *[
            F.coalesce(col(c), col(f"_carry_{c}")).alias(c) if c in columns else col(c)
            for c in df.columns
        ]
    )


def head_limit(df: DataFrame, n: int, *, position: str = "row_pos") -> DataFrame:
    return df.orderBy(position).limit(n)


def stable_item_order(df: DataFrame, *, position: str = "row_pos") -> DataFrame:
    """Sort a result into item-table order, for the sink only."""
    return df.orderBy(position)


def sample_items(
    items: DataFrame, embeddings: DataFrame, n: int, *, id: str, emb_id: str = "id", seed: int = 42
) -> DataFrame:
    """``n`` items drawn among those with an embedding, the same ones for the same seed."""
    if n <= 0:
        raise ValueError("the sample size must be a positive number")
    usable = intersect_ids(items, embeddings, id=id, emb_id=emb_id)
    if usable.isEmpty():
        raise ValueError("no item id occurs among the embedding ids")
    draw = F.md5(F.concat(F.lit(f"{seed}:"), col(id).cast("string")))
    return usable.orderBy(draw, id).limit(n)
