"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The white space of every word and line rule here: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def give_back() -> None:
    """Hand a task's free memory back to the system: its Python worker lives on and shares
    the executor's memory with the stages that follow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_batches(
    df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]
) -> DataFrame:
    """``mapInArrow`` with set-up once per task: ``make()`` returns the batch function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield step(batch)
        give_back()

    return df.mapInArrow(run, schema)


def byte_texts(column: pa.Array) -> Iterable[bytes]:
    """UTF-8 bytes of a text column one by one; null counts as empty."""
    column = column.cast(pa.large_binary())
    for value in column:
        yield value.as_py() or b""
