"""Two tables compared block by block: every split of one meets every block of the other.

Both sides stay rows of Spark tables; a task gets one split and one block as Arrow tables
of bounded size. What must be compared with what is decided by the caller's function, and
its results are merged by the caller with an ordinary aggregation.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from classmap.functions.names import col

SPLIT, BLOCK = "_split", "_block"


def block_count(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def split_rows(rows: int, cores: int, smallest: int, largest: int) -> int:
    """Rows of a split: enough splits for all cores, within the limits."""
    return max(smallest, min(largest, -(-rows // (2 * cores))))


def numbered(row: Column, count: int, name: str) -> Column:
    """Split or block of a row, from a number that differs between the rows of a stored table."""
    return F.pmod(row, F.lit(count)).cast("int").alias(name)


def pair_blocks(
    left: DataFrame,
    right: DataFrame,
    splits: int,
    blocks: int,
    compare: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
    *,
    also: DataFrame | None = None,
) -> DataFrame:
    """``compare(left rows, right rows)`` for each split of ``left`` (by its column
    ``_split``) and each block of ``right`` (by ``_block``), put together. Pairs without
    rows on the left are not compared. Rows of ``also`` carry both numbers and join the
    right rows of just that pair; columns that either lacks are null."""
    every = left.withColumn(BLOCK, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    # Both sides may come from one table; the right one gets columns of its own.
    other = right.select(*[col(c).alias(c) for c in right.columns]).withColumn(SPLIT, F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))
    if also is not None:
        other = other.unionByName(also, allowMissingColumns=True)
    keys = [SPLIT, BLOCK]
    kinds = {f.name: to_arrow_type(f.dataType) for f in DataType.fromDDL(schema)}

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows:
            return pa.table({n: pa.array([], t) for n, t in kinds.items()})
        # What earlier groups left free goes back: the worker lives on beside others.
        pa.default_memory_pool().release_unused()
        return compare(a.combine_chunks(), b.combine_chunks())

    return every.groupBy(*keys).cogroup(other.groupBy(*keys)).applyInArrow(run, schema)
