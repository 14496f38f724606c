"""Vector similarity as a Column expression, for pairs that are already joined."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def usable_vector(c) -> Column:
    """Whether a vector is there and all of its numbers are finite."""
    c = F.col(c) if isinstance(c, str) else c
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return c.isNotNull() & F.coalesce(F.forall(c, lambda x: finite(x.cast("double"))), F.lit(False))


def cosine_similarity(a, b) -> Column:
    """Dot product of the normalised vectors; a zero vector gives 0."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    norms = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    return F.when(norms == 0, F.lit(0.0)).otherwise(_dot(a, b) / norms)
