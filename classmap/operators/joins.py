"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classmap.functions.names import col, cols, quoted
from classmap.functions.vector import usable_vector

ROWS_PER_SPLIT = 1_000_000
NULL_SPLITS = 1024


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    *,
    spread_by: str | Sequence[str],
    null_safe: bool = False,
    counts: DataFrame | None = None,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Join ``left`` to ``right``, which holds at most one row per key.

    Keys with more than ``rows_per_split`` left rows are cut into numbered splits:
    the left rows are dealt out by a hash of ``spread_by`` and the matching right row
    is repeated once per split. The list of hot keys has at most
    ``rows(left) / rows_per_split`` entries, which is what makes broadcasting it safe.
    ``counts`` (the keys with ``n``, at least their number of left rows) saves counting
    them here. ``how`` is inner, left, left_semi or left_anti.
    """
    keys = [on] if isinstance(on, str) else list(on)
    by = [spread_by] if isinstance(spread_by, str) else list(spread_by)
    if counts is None:
        counts = left.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("n"))
    hot = counts.where(F.col("n") > rows_per_split).select(
        *cols(keys), F.ceil(F.col("n") / rows_per_split).cast("int").alias("_splits")
    )

    def same(pairs):
        return reduce(and_, [x.eqNullSafe(y) if null_safe else x == y for x, y in pairs])

    def with_splits(df: DataFrame) -> DataFrame:
        hot_side = F.broadcast(hot.select(*[col(k).alias(f"_hot_{k}") for k in keys], "_splits"))
        match = same([(df[quoted(k)], hot_side[quoted(f"_hot_{k}")]) for k in keys])
        return df.join(hot_side, match, "left").drop(*[f"_hot_{k}" for k in keys])

    splits = F.coalesce(F.col("_splits"), F.lit(1))
    if not null_safe:
        # A null key matches nothing, so such rows may go anywhere.
        missing = reduce(lambda a, b: a | b, [col(k).isNull() for k in keys])
        splits = F.when(missing, F.lit(NULL_SPLITS)).otherwise(splits)
    deal = F.pmod(F.xxhash64(*cols(by)), splits.cast("bigint")).cast("int")
    dealt = with_splits(left).withColumn("_split", deal).drop("_splits")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_splits"), F.lit(1)) - 1))
    copied = with_splits(right).withColumn("_split", copies).drop("_splits")
    renamed = copied.select(
        *[col(k).alias(f"_right_{k}") for k in keys],
        F.col("_split").alias("_right_split"),
        *cols(c for c in right.columns if c not in keys),
    )
    match = same([(dealt[quoted(k)], renamed[quoted(f"_right_{k}")]) for k in keys])
    out = dealt.join(renamed, match & (dealt["_split"] == renamed["_right_split"]), how)
    return out.drop("_split", "_right_split", *[f"_right_{k}" for k in keys])


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; have {df.columns}")
    return df


def require_unique(tables: dict[str, tuple[DataFrame, str]]) -> None:
    """Raise when a key occurs twice in a table; reads the key columns only."""
    repeated = [
        df.groupBy(col(key).cast("string").alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.lit(what).alias("what"), "key", "n")
        for what, (df, key) in tables.items()
    ]
    row = reduce(DataFrame.unionByName, repeated).limit(1).first()
    if row is not None:
        raise ValueError(f"{row['what']} id {row['key']!r} occurs {row['n']} times")


def intersect_ids(items: DataFrame, embeddings: DataFrame, *, id: str, emb_id: str = "id") -> DataFrame:
    """Items that have an embedding."""
    return items.join(embeddings.select(col(emb_id).alias(id)), id, "left_semi")


def item_embedding_join(items: DataFrame, embeddings: DataFrame, *, id: str, emb_id: str = "id") -> DataFrame:
    """Items with their vectors; either side alone is dropped, and a null or non-finite
    vector counts as none. Both sides grow with the items: neither passes the driver, even
    where a well packed table looks small enough to be broadcast."""
    vectors = embeddings.where(usable_vector("embedding")).select(col(emb_id).alias(id), "embedding")
    return items.join(vectors.hint("merge"), id, "inner")


def filter_by_mapping(
    items: DataFrame, mapping: DataFrame, *, left: str, right: str,
    spread_by: str | Sequence[str] = (), counts: DataFrame | None = None,
) -> DataFrame:
    """Items whose id is listed; duplicates stay and a listed null matches null ids.

    Without ``counts`` (the ids with ``n``) a skewed id is left to adaptive execution.
    """
    listed = mapping.select(col(right).alias("_listed"))
    if counts is None:
        return items.join(listed, items[quoted(left)].eqNullSafe(listed["_listed"]), "left_semi")
    return spread_join(
        items, listed.distinct().withColumnRenamed("_listed", left), left, "left_semi",
        spread_by=spread_by, null_safe=True, counts=counts,
    )
