"""Text clean-up with a model: build requests, call, check the replies, fall back."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classmap.functions.names import col, cols, quoted
from classmap.functions.replies import join_extraction, parse_extraction
from classmap.functions.text import (
    accept_expansion,
    accept_main_name,
    dimension_units,
    dimension_values,
    nonblank,
    pick_first_nonblank,
    replace_missing_text,
    strip,
    text_of,
)
from classmap.operators.joins import require_columns
from classmap.operators.models import answer
from classmap.operators.ordering import head_limit
from classmap.operators.rows import context_map, first_column_id
from classmap.plans.settle import settle

# Fixed value: rows per call of the value extraction model.
EXTRACT_BATCH = 8
# Most sheets without text that are sent to all tasks.
BROADCAST_SHEETS = 100_000


def expansion_requests(
    df: DataFrame, *, text: str, id: str | None = None, sheet: str = "sheet", position: str = "row_pos"
) -> Column:
    """JSON request of a row: sheet, id, description and the other columns as context."""
    id = first_column_id(df, id, skip=(sheet, position))
    kinds = dict(df.dtypes)
    context = context_map(df, exclude=[text, id, sheet, position], ignore_case=False)
    payload = F.struct(
        col(sheet).alias("sheet_name"),
        strip(text_of(id, kinds[id])).alias("item_id"),
        strip(text).alias("description"),
        context.alias("context"),
    )
    return F.when(nonblank(text), F.to_json(payload))


def expand_abbreviations(
    df: DataFrame,
    make_fn: Callable,
    *,
    text: str = "Description",
    id: str | None = None,
    sheet: str = "sheet",
    position: str = "row_pos",
    out: str = "Description_Expanded",
    **calls,
) -> DataFrame:
    """Add the expanded text. A failed reply, or one that lost a number, keeps the original.

    Blank rows keep what they have, except that in a sheet without any text they get "".
    """
    if text not in df.columns:
        return df
    # The input is read once. Requests travel alone, by row number, and meet the wide rows
    # in one join.
    rows = settle(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    request = expansion_requests(df, text=text, id=id, sheet=sheet, position=position)
    thin = rows.select("_row", request.alias("_request")).where(F.col("_request").isNotNull())
    replied = answer(thin, make_fn, request="_request", spread_by="_row", **calls).select("_row", "raw")
    blank = rows.groupBy(col(sheet).alias("_sheet")).agg(F.max(nonblank(text)).alias("_has")).where("not _has")
    blank = settle(blank.select("_sheet", F.lit(True).alias("_blank")), "blank-sheets")
    few = blank.count() <= BROADCAST_SHEETS
    joined = rows.join(replied, "_row", "left")
    marked = joined.join(F.broadcast(blank) if few else blank, joined[quoted(sheet)].eqNullSafe(blank["_sheet"]), "left")
    expanded = (
        F.when(nonblank(text), accept_expansion(strip(text), "raw"))
        .when(F.col("_blank"), F.lit(""))
        .otherwise(col(text))
    )
    return marked.select(*cols(c for c in df.columns if c != out), expanded.alias(out))


def extract_main_names(
    df: DataFrame,
    make_fn: Callable,
    *,
    primary: str = "Description_Expanded",
    fallback: str = "Description",
    out: str = "Item_Name",
    spread_by: str | Sequence[str] = ("sheet", "row_pos"),
    **calls,
) -> DataFrame:
    """Add the main item name, "" where there is no text; bad replies use the rule."""
    sources = [c for c in (primary, fallback) if c in df.columns]
    if not sources:
        return df
    described = df.withColumn("_text", pick_first_nonblank(*sources))
    request = F.when(F.col("_text") != "", F.to_json(F.struct(F.col("_text").alias("description"))))
    asked = described.withColumn("_request", request)
    replied = answer(asked, make_fn, request="_request", spread_by=spread_by, **calls)
    name = F.when(F.col("_text") != "", accept_main_name("_text", "raw")).otherwise(F.lit(""))
    return replied.select(*cols(c for c in df.columns if c != out), name.alias(out))


def extract_values(
    df: DataFrame,
    make_fn: Callable,
    *,
    text: str,
    limit: int | None = None,
    position: str = "row_pos",
    batch: int = EXTRACT_BATCH,
    **calls,
) -> DataFrame:
    """Add ``extracted_values`` and ``extracted_units`` read from the model's JSON.

    Missing text is sent as an empty text, as any other.
    """
    require_columns(df, text)
    rows = df if limit is None else settle(head_limit(df, limit, position=position), "head")
    asked = rows.withColumn("_request", replace_missing_text(text))
    replied = answer(
        asked, make_fn, request="_request", spread_by=position, batch=batch, **calls
    )
    got = replied.withColumn("_got", parse_extraction("raw"))
    return got.select(
        *cols(rows.columns),
        join_extraction(F.col("_got.values")).alias("extracted_values"),
        join_extraction(F.col("_got.units")).alias("extracted_units"),
    )


def extract_dimensions(df: DataFrame, *, text: str) -> DataFrame:
    """The same columns by rule: numbers with a length unit, units in lower case."""
    require_columns(df, text)
    return df.select(
        "*",
        join_extraction(dimension_values(text)).alias("extracted_values"),
        join_extraction(dimension_units(text)).alias("extracted_units"),
    )
