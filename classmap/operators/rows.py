"""Whole-row operators: duplicates, column shaping, context maps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classmap.functions.names import col, cols, quoted
from classmap.functions.text import nonblank, strip, text_of


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def normalize_columns_nbsp(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().replace("\u00a0", " ") for c in df.columns])


def prefix_columns(df: DataFrame, prefix: str = "class_") -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


def add_missing_columns(df: DataFrame, names: Sequence[str], dtype: str = "string") -> DataFrame:
    absent = {n: F.lit(None).cast(dtype) for n in names if n not in df.columns}
    return df.withColumns(absent) if absent else df


def select_level_columns(
    columns: Sequence[str], *, names: Sequence[str] | None = None, keywords: Sequence[str] = ("Level",)
) -> list[str]:
    """Explicit names, else every column whose name contains one of the keywords."""
    if names:
        return list(names)
    return [c for c in columns if any(k in c for k in keywords)]


def drop_all_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(reduce(or_, [col(c).isNotNull() for c in columns]))


def filter_nonblank(df: DataFrame, column: str) -> DataFrame:
    return df.where(nonblank(col(column).cast("string")))


def filter_leaf_classes(classes: DataFrame, *, leaf: str = "lowest_level_class") -> DataFrame:
    """Classes flagged as leaves; all of them when there is no flag column."""
    if leaf not in classes.columns:
        return classes
    return classes.where(F.coalesce(col(leaf), F.lit(False)))


def fallback_id(df: DataFrame, id: str | None = None, *, otherwise: str = "row_pos") -> Column:
    """The id column when it is given and present, else the row position."""
    return col(id) if id and id in df.columns else col(otherwise)


def first_column_id(df: DataFrame, id: str | None = None, *, skip: Sequence[str] = ("sheet", "row_pos")) -> str:
    """Name of the id column, by default the first data column."""
    return id if id and id in df.columns else [c for c in df.columns if c not in skip][0]


def context_map(
    df: DataFrame,
    *,
    exclude: Sequence[str],
    include: Sequence[str] | None = None,
    ignore_case: bool = True,
) -> Column:
    """Map of the other columns' non-blank values, stripped, keyed by header.

    Excluded and included names compare in lower case unless ``ignore_case`` is off.
    """
    fold = (lambda s: s.strip().lower()) if ignore_case else (lambda s: s)
    out = {fold(c) for c in exclude}
    only = None if include is None else {fold(c) for c in include}
    kinds = dict(df.dtypes)
    chosen = [
        c for c in df.columns if fold(c) not in out and (only is None or fold(c) in only)
    ]
    if not chosen:
        return F.create_map().cast("map<string,string>")
    entries: list[Column] = []
    for c in chosen:
        entries += [F.lit(c), strip(text_of(c, kinds[c]))]
    return F.map_filter(F.create_map(*entries), lambda k, v: v.isNotNull() & (v != ""))


def dedupe_rows(df: DataFrame, *, position: str = "row_pos") -> DataFrame:
    """One row per distinct content, keeping the first position."""
    data = [c for c in df.columns if c != position]
    return df.groupBy(*cols(data)).agg(F.min(position).alias(position)).select(*cols(df.columns))


def duplicate_report(df: DataFrame, *, position: str = "row_pos") -> DataFrame:
    """Every row whose content occurs more than once."""
    data = [c for c in df.columns if c != position]
    counted = df.groupBy(*cols(data)).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    repeated = counted.select(*[col(c).alias(f"_rep_{c}") for c in data])
    same = [df[quoted(c)].eqNullSafe(repeated[quoted(f"_rep_{c}")]) for c in data]
    return df.join(repeated, reduce(and_, same), "left_semi")  # adaptive execution splits skew


def union_sheets(sheets: dict[str, DataFrame], *, key: str | None = None) -> DataFrame:
    """Sheets stacked under one schema, tagged with name and order; absent columns null.

    With ``key``, only sheets that have that column count, and having none is an error.
    """
    usable = {n: d for n, d in sheets.items() if key is None or key in d.columns}
    if not usable:
        raise ValueError(f"no sheet has a column {key!r}")
    order = {n: i for i, n in enumerate(sheets)}
    tagged = [
        d.select(F.lit(n).alias("sheet"), F.lit(order[n]).alias("sheet_pos"), *cols(d.columns))
        for n, d in usable.items()
    ]
    out = tagged[0]
    for d in tagged[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
