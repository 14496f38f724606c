"""Scoring an assignment against known mappings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classmap.functions.names import col
from classmap.functions.text import format_percent, text_of
from classmap.operators.joins import require_columns

# Bucket names with their fill colours (none for an unmapped row).
COLOURS = {
    "top1": "C6EFCE",
    "top2": "FFEB9C",
    "top3": "F8CBAD",
    "mismatch": "FFC7CE",
    "no_mapping": None,
}
# Labels of the summary rows.
LABELS = (
    "Total Items",
    "Total with Mapping",
    "Top-1 Match %",
    "Top-2 Match %",
    "Top-3 Match %",
    "Total Match % (Top1-3)",
    "False Match / No Match %",
)
LABELS_WITHOUT_MAPPING = {
    "Total Match % (Top1-3)": "Total Match %",
    "False Match / No Match %": "False Match %",
}
NOT_AVAILABLE = "N/A"


def match_bucket(
    df: DataFrame,
    *,
    top: tuple[str, str, str] = ("top_1_class_name", "top_2_class_name", "top_3_class_name"),
    mapping: str,
) -> DataFrame:
    """Add ``match_bucket`` and ``match_colour``. Null, empty and 0 mean no mapping.

    Values are compared as text, so that a number can be told from a name.
    """
    require_columns(df, *top, mapping)
    known = col(mapping)
    absent = known.isNull() | (known.cast("string") == "")
    kinds = dict(df.dtypes)
    if kinds[mapping] != "string":
        absent = absent | (known.cast("double") == 0)
    bucket = F.when(absent, F.lit("no_mapping"))
    for i, c in enumerate(top, start=1):
        bucket = bucket.when(text_of(c, kinds[c]) == text_of(mapping, kinds[mapping]), F.lit(f"top{i}"))
    bucket = bucket.otherwise(F.lit("mismatch"))
    colour = F.lit(None).cast("string")
    for name, code in COLOURS.items():
        if code:
            colour = F.when(F.col("match_bucket") == name, F.lit(code)).otherwise(colour)
    return df.withColumn("match_bucket", bucket).withColumn("match_colour", colour)


def validation_counts(bucketed: DataFrame) -> DataFrame:
    """One row: total, mapped, and the hits per rank with their shares of the mapped."""
    b = F.col("match_bucket")
    counts = bucketed.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(b != "no_mapping").alias("mapped"),
        *[F.count_if(b == f"top{i}").alias(f"top{i}") for i in (1, 2, 3)],
    )
    mapped = F.col("mapped")
    share = lambda n: F.when(mapped > 0, n / mapped)
    return counts.select(
        "*",
        *[share(F.col(f"top{i}")).alias(f"top{i}_share") for i in (1, 2, 3)],
        share(F.col("top1") + F.col("top2") + F.col("top3")).alias("match_share"),
    ).withColumn("false_share", 1 - F.col("match_share"))


def validation_summary(bucketed: DataFrame) -> DataFrame:
    """The report as ``(line, metric, value)`` rows."""
    counts = validation_counts(bucketed)
    shares = ("top1_share", "top2_share", "top3_share", "match_share", "false_share")
    values = [F.col("total").cast("string"), F.col("mapped").cast("string")]
    values += [F.coalesce(format_percent(s), F.lit(NOT_AVAILABLE)) for s in shares]
    lines = [
        F.struct(
            F.lit(i).alias("line"),
            F.when(F.col("mapped") > 0, F.lit(label))
            .otherwise(F.lit(LABELS_WITHOUT_MAPPING.get(label, label)))
            .alias("metric"),
            value.alias("value"),
        )
        for i, (label, value) in enumerate(zip(LABELS, values), start=1)
    ]
    return counts.select(F.explode(F.array(*lines)).alias("r")).select("r.*")


def validate_assignments(df: DataFrame, *, mapping: str, **options) -> tuple[DataFrame, DataFrame]:
    """The rows with their buckets, and the summary."""
    bucketed = match_bucket(df, mapping=mapping, **options)
    return bucketed, validation_summary(bucketed)
