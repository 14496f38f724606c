"""Exact deduplication by skew-safe combining.

Copies meet three times, and each time the whole normalised text is compared: inside the
task that reads them, in one of a few salted groups of their digest, and once more when
the winners of the salts meet. A group of any size sends at most one row per task to the
second meeting and one row per salt to the third, so no task ever receives a large group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classmap.functions.names import col
from classmap.llm.common import ascii_lower, sha256_hex, text_or_empty
from classmap.plans.settle import settle

SALTS = 16


def _texts(docs: DataFrame, doc_id: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    body = docs.select(
        col(doc_id).alias("doc_id"), ascii_lower(text_or_empty(col(text))).alias("body")
    )
    return body.withColumn("digest", digest(F.col("body")))


def combine_copies(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256_hex,
) -> DataFrame:
    """One row per distinct normalised text: ``digest, body, keep_id, group_size``."""
    salted = _texts(docs, doc_id, text, digest).withColumn(
        "salt", F.pmod(F.spark_partition_id(), F.lit(salts))
    )
    # Partial aggregation inside the reading task is the local step.
    winners = salted.groupBy("salt", "digest", "body").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")
    )
    return winners.groupBy("digest", "body").agg(
        F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size")
    )


def exact_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256_hex,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; the largest id of equal texts
    is kept. Null text counts as empty, so null and empty texts are copies of each other.
    Rows that repeat both id and text are all marked kept. A null id never wins unless
    the group has no other; then ``keep_id`` is null and those rows are kept. Other
    columns are ignored. An empty table gives an empty result.

    ``digest`` only deals texts out. Should two texts share one, their rows are told apart
    by the whole text.
    """
    found = settle(
        combine_copies(docs, doc_id=doc_id, text=text, salts=salts, digest=digest)
        .groupBy("digest")
        .agg(
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
            F.count(F.lit(1)).alias("texts"),
        ),
        "copies",
    )
    rows = _texts(docs, doc_id, text, digest).withColumn("text_sha256", sha256_hex(F.col("body")))
    plain = found.where("texts = 1").drop("texts")
    out = rows.drop("body").join(plain, "digest")
    shared = found.where("texts > 1").select("digest")
    if not shared.isEmpty():
        whole = combine_copies(
            docs, doc_id=doc_id, text=text, salts=salts, digest=digest
        ).join(shared, "digest", "left_semi")
        out = out.unionByName(rows.join(whole, ["digest", "body"]).drop("body"))
    return out.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one for each distinct text, with all their columns."""
    kept = exact_duplicates(docs, doc_id=doc_id, text=text).where("kept")
    return keep_rows(docs, kept, "text_sha256", sha256_hex(ascii_lower(text_or_empty(col(text)))), doc_id, text)


def keep_rows(
    docs: DataFrame, kept: DataFrame, mark: str, of_row: Column, doc_id: str, text: str
) -> DataFrame:
    """Rows of ``docs`` whose id is in ``kept`` with the same mark (a digest or
    fingerprint of the text), once each: rows repeating id and mark count as one.

    Id and mark are one key, in which a null id equals itself, so that the text is
    shuffled once for both steps.
    """
    key = "_classmap_key"
    marks = kept.select(F.struct(F.col("doc_id").alias("i"), F.col(mark).alias("m")).alias(key)).distinct()
    marked = docs.withColumn(key, F.struct(col(doc_id).alias("i"), of_row.alias("m")))
    return marked.join(marks, key, "left_semi").dropDuplicates([key]).drop(key)
