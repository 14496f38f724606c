"""Table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classmap.functions.names import col


def sink_table(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "errorifexists") -> str:
    options = {"header": True} if fmt == "csv" else {}
    df.write.format(fmt).options(**options).mode(mode).save(path)
    return path


def sink_sheets(
    df: DataFrame, path: str, *, sheet: str = "sheet", fmt: str = "parquet",
    files_per_sheet: int | None = None, spread_by: str = "row_pos",
) -> str:
    """One folder per sheet, with full sheet names (a cut name could collide).

    With ``files_per_sheet`` rows are dealt over that many files of each sheet, so a
    sheet holding most rows is still written by many tasks.
    """
    if files_per_sheet:
        df = df.repartition(sheet, F.pmod(F.xxhash64(spread_by), F.lit(files_per_sheet)))
    df.write.format(fmt).partitionBy(sheet).save(path)
    return path


def sink_embeddings(df: DataFrame, path: str, *, id: str = "id") -> bool:
    """Write ``(id, embedding)``; nothing is written when there are none."""
    vectors = df.select(col(id).alias("id"), "embedding").where(F.col("embedding").isNotNull())
    if vectors.isEmpty():
        return False
    vectors.write.parquet(path)
    return True


def embeddings_to_json(df: DataFrame, *, id: str = "id") -> DataFrame:
    """One JSON object per vector."""
    return df.select(
        col(id).alias("id"), F.to_json(F.struct(col(id).alias("id"), "embedding")).alias("json")
    )
