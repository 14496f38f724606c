"""Table sources: single tables, groups of sheets, raw grids, embeddings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from classmap.functions.names import col, cols
from classmap.operators.rows import union_sheets

# Fixed value: rows looked at when guessing the header row.
HEADER_PREVIEW_ROWS = 10
# Most files whose first row numbers are sent to all tasks.
BROADCAST_FILES = 100_000


def _no_nan(df: DataFrame) -> DataFrame:
    """Not-a-number cells are missing cells."""
    kinds = dict(df.dtypes)
    return df.select(
        *[F.when(~F.isnan(col(c)), col(c)).alias(c) if kinds[c] in ("float", "double") else col(c) for c in df.columns]
    )


def scan_table(
    spark: SparkSession,
    path: str,
    *,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    columns: Sequence[str] | None = None,
    row_pos: str | None = None,
    **options,
) -> DataFrame:
    """One table with a ``row_pos`` column.

    ``row_pos`` may name an existing order column. Otherwise rows are numbered from 0 in
    file order, files in path order: Parquet rows by their place in the file, rows of
    other formats by their place in the split that reads them, of which each begins at
    the number of rows before it. NaN cells become null.
    """
    reader = spark.read.format(fmt).options(**({"header": True} if fmt == "csv" else {}))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.options(**options).load(path)
    wanted = list(columns) if columns else [c for c in df.columns if c != "row_pos"]
    if row_pos is not None:
        return _no_nan(df.select(col(row_pos).cast("bigint").alias("row_pos"), *cols(wanted)))
    files = df.inputFiles()
    if fmt == "parquet":
        place = F.col("_metadata.row_index")
        if len(files) == 1:
            return _no_nan(df.select(place.alias("row_pos"), *cols(wanted)))
        return _no_nan(_numbered_by(df, [F.col("_metadata.file_path")], place, wanted, len(files) <= BROADCAST_FILES))
    # A task reads the rows of a split one after the other, so their numbers in the task
    # differ from those in the split by that of the split's first row.
    split = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start")]
    return _no_nan(_numbered_by(df, split, F.monotonically_increasing_id(), wanted, len(files) <= BROADCAST_FILES))


def _numbered_by(df: DataFrame, split: Sequence[Column], place: Column, wanted: Sequence[str], few: bool) -> DataFrame:
    """``row_pos`` and the wanted columns: splits in order, rows by their place in a split."""
    keys = [f"_split_{i}" for i in range(len(split))]
    located = df.select(*[c.alias(k) for c, k in zip(split, keys)], place.alias("_place"), *cols(wanted))
    sizes = located.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    starts = sizes.select(*keys, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_start"))
    joined = located.join(F.broadcast(starts) if few else starts, keys)
    return joined.select((F.col("_start") + F.col("_place")).alias("row_pos"), *cols(wanted))


def scan_sheets(
    spark: SparkSession,
    paths: Mapping[str, str] | str,
    *,
    fmt: str = "parquet",
    row_pos: str | None = None,
    **options,
) -> DataFrame:
    """Every sheet of a workbook under one schema, tagged by name.

    ``paths`` maps sheet names to tables, or is one folder partitioned by ``sheet=``, whose
    sheets come in order of their names, as texts. Its rows keep the ``row_pos`` they were written
    with, if any.
    """
    if isinstance(paths, str):
        header = {"header": True} if fmt == "csv" else {}
        found = spark.read.format(fmt).options(**header, **options).load(paths).schema
        # Names of sheets stay as they are written: 01 and 1 are two sheets.
        schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "sheet" else f for f in found])
        if row_pos is None and "row_pos" in found.names:
            row_pos = "row_pos"
        whole = scan_table(spark, paths, fmt=fmt, schema=schema, row_pos=row_pos, **options)
        names = whole.groupBy(F.col("sheet").alias("_sheet")).agg(F.min("row_pos").alias("_first"))
        order = (F.row_number().over(Window.orderBy("_sheet")) - 1).alias("sheet_pos")
        places = names.select("_sheet", "_first", order)  # as many rows as the folder has parts
        tagged = whole.join(F.broadcast(places), whole["sheet"].eqNullSafe(places["_sheet"]), "left")
        place = F.col("row_pos") - (F.col("_first") if row_pos is None else 0)
        data = [c for c in whole.columns if c not in ("sheet", "row_pos")]
        return tagged.select("sheet", "sheet_pos", place.alias("row_pos"), *cols(data))
    return union_sheets(
        {n: scan_table(spark, p, fmt=fmt, row_pos=row_pos, **options) for n, p in paths.items()}
    )


def scan_embeddings(
    spark: SparkSession, path: str, *, id: str = "id", embedding: str = "embedding"
) -> DataFrame:
    return spark.read.parquet(path).select(col(id).alias("id"), col(embedding).alias("embedding"))


def guess_header_row(grid: DataFrame, *, position: str = "row_pos") -> DataFrame:
    """Position of the first preview row that is at least half filled (null if none)."""
    data = [c for c in grid.columns if c != position]
    filled = sum((col(c).isNotNull().cast("int") for c in data), F.lit(0))
    return (
        grid.where(col(position) < HEADER_PREVIEW_ROWS)
        .where(filled >= len(data) / 2)
        .agg(F.min(position).alias("header_row_index"))
    )


def promote_header(
    grid: DataFrame, header_row_index: int | None = None, *, position: str = "row_pos"
) -> DataFrame:
    """Use one row of a raw grid as the header; data starts below it.

    Without an index the header row is guessed.
    """
    if header_row_index is None:
        guessed = guess_header_row(grid, position=position).first()[0]
        header_row_index = int(guessed or 0)
    data = [c for c in grid.columns if c != position]
    head = grid.where(col(position) == header_row_index).select(*cols(data)).first()
    if head is None:
        raise ValueError(f"the grid has no row {header_row_index}")
    names = [str(h) if h is not None else c for h, c in zip(head, data)]
    return grid.where(col(position) > header_row_index).select(*cols([position, *data])).toDF(position, *names)
