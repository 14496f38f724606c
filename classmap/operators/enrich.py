"""Filling columns of a target table from other tables by id."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classmap.functions.names import col, cols
from classmap.functions.text import join_key
from classmap.operators.joins import spread_join
from classmap.operators.ordering import number_rows
from classmap.operators.rows import add_missing_columns, dedupe_rows


def first_non_empty(
    rows: DataFrame, key: str, columns: Sequence[str], *, order: Sequence[str] = ("sheet_pos", "row_pos")
) -> DataFrame:
    """Per key and column the first value, in order, that is neither null nor empty."""
    place = F.struct(*order)

    def first(c: str) -> Column:
        held = F.when(col(c).isNotNull() & (col(c).cast("string") != ""), col(c))
        return F.min_by(held, F.when(held.isNotNull(), place)).alias(c)

    return rows.groupBy(col(key)).agg(*[first(c) for c in columns])


def enrichment_lookup(
    sheets: DataFrame,
    *,
    id: str,
    columns: Sequence[str],
    order: Sequence[str] = ("sheet_pos", "row_pos"),
) -> DataFrame:
    """One row per id text with its first non-empty value of each column."""
    kinds = dict(sheets.dtypes)
    full = add_missing_columns(sheets, columns)
    keyed = full.withColumn("lookup_key", join_key(col(id), kinds[id]))
    usable = keyed.where(F.col("lookup_key").isNotNull() & (F.col("lookup_key") != ""))
    return first_non_empty(usable, "lookup_key", columns, order=order)


def enrich_items(
    target: DataFrame,
    lookup: DataFrame,
    *,
    key: str,
    columns: Sequence[str],
    overwrite: bool = False,
    spread_by: str = "row_pos",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Fill null target cells from the lookup, or with ``overwrite`` let it win.

    ``counts`` (``lookup_key, n``) splits hot keys ahead of the join. An empty text
    counts as present in the target. A target without the key column is returned unchanged.
    """
    if key not in target.columns:
        return target
    kinds = dict(target.dtypes)
    full = add_missing_columns(target, columns)
    source = lookup.select("lookup_key", *[col(c).alias(f"_src_{c}") for c in columns])
    keyed = full.withColumn("lookup_key", join_key(col(key), kinds[key]))
    if counts is None:  # adaptive execution splits a skewed key
        joined = keyed.join(source, "lookup_key", "left")
    else:
        joined = spread_join(keyed, source, "lookup_key", "left", spread_by=spread_by, counts=counts)

    def merged(c: str) -> Column:
        mine, theirs = col(c), F.col(f"`_src_{c}`")
        if c not in columns:
            return mine
        return F.coalesce(*((theirs, mine) if overwrite else (mine, theirs))).alias(c)

    return joined.select(*[merged(c) for c in full.columns])


def enrich_sheets(
    targets: Mapping[str, DataFrame], lookup: DataFrame, *, key: str, columns: Sequence[str], **options
) -> dict[str, DataFrame]:
    """Every target sheet enriched from one lookup; sheets without the key column are
    returned as they are."""
    return {name: enrich_items(df, lookup, key=key, columns=columns, **options) for name, df in targets.items()}


def extract_unique_rows(
    df: DataFrame,
    *,
    columns: Sequence[str],
    add_id: bool = True,
    position: str = "row_pos",
    ranges: int | None = None,
) -> DataFrame:
    """Chosen columns of the distinct rows, optionally numbered first.

    Rows are distinct over all columns, so the chosen ones may still repeat.
    """
    unique = dedupe_rows(df, position=position).select(*cols([position, *columns]))
    if not add_id:
        return unique
    numbered = number_rows(unique, position=position, ranges=ranges)
    return numbered.select(*cols(["Unique_ID", position, *columns]))
