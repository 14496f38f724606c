"""Figures about embeddings and about an assignment run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def embedding_profile(embeddings: DataFrame) -> DataFrame:
    """Item count and the range of vector lengths."""
    size = F.size("embedding")
    return embeddings.agg(
        F.count(F.lit(1)).alias("items"), F.min(size).alias("min_dim"), F.max(size).alias("max_dim")
    )


def embedding_preview(embeddings: DataFrame, n: int = 3, *, id: str = "id") -> DataFrame:
    """Ids and vector lengths of the first ``n`` items."""
    return embeddings.select(id, F.size("embedding").alias("dim")).orderBy(id).limit(n)


def group_counts(hits: DataFrame, *, n_hits: str = "n_hits") -> DataFrame:
    """How many items matched some class by name and how many matched none."""
    branch = F.when(F.coalesce(F.col(n_hits), F.lit(0)) > 0, "fuzzy").otherwise("no fuzzy match")
    return hits.groupBy(branch.alias("branch")).agg(F.count(F.lit(1)).alias("items"))
