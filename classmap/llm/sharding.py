"""Sharding by minimax contiguous partition, in DataFrame operations only.

Rows with equal text form an atomic group; groups are ordered by their first id. Of all
ways to cut that order into so many shards, the one whose largest shard is smallest is
found by binary search over the capacity, filling shards greedily for each try.

The greedy check only asks how far a shard of a given capacity reaches, that is, for the
last group end at or below a byte position. The driver answers it from a bounded number
of known group ends, once optimistically and once pessimistically; where the two differ,
one Spark job fetches finer ends for just the places in doubt. Each round narrows them by
a factor of hundreds, so a handful of jobs settles any size of table exactly.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from classmap.functions.names import col
from classmap.llm.common import text_or_empty
from classmap.plans.settle import settle

SHARDS = 16
# Pieces that a round looks at, and the most spans it puts them in.
MARKS, MOST_SPANS = 1 << 16, 32


def running(df: DataFrame, order: list[str], value: Column, out: str, within: Column | None = None) -> DataFrame:
    """Add the sum of ``value`` over the rows up to each one in ``order``, which must
    have no ties. ``within`` starts a new sum for each of its few values.

    Rows are dealt out by range and written. Each range is summed by its own task, and
    only one total per range (and value of ``within``) passes between them.
    """
    group = F.lit(0) if within is None else within
    dealt = df.withColumns({"_value": value, "_group": group}).repartitionByRange("_group", *order)
    stored = settle(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    totals = stored.groupBy("_group", "_range").agg(F.sum("_value").alias("_total"))
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_group", "_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range", "_group").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = stored.withColumn("_sum", F.sum("_value").over(inside)).join(offsets, ["_group", "_range"])
    return summed.select(*df.columns, (F.col("_before") + F.col("_sum")).cast("bigint").alias(out))


class Ends:
    """What is known about the sorted group ends: some of them, and the intervals strictly
    inside which others lie."""

    def __init__(self, total: int):
        self.at, self.open, self.total = [0, total], [(0, total)], total

    def reach(self, start: int, capacity: int, hopeful: bool) -> int:
        """The furthest end within ``capacity`` of ``start``, as far as it is known."""
        target = start + capacity
        if target >= self.total:
            return self.total
        known = self.at[bisect_right(self.at, target) - 1]
        i = bisect_left(self.open, (target,)) - 1
        if hopeful and i >= 0 and (best := min(target, self.open[i][1] - 1)) > self.open[i][0]:
            return max(known, best)
        return known

    def cuts(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        out = [0]
        for _ in range(shards):
            out.append(self.reach(out[-1], capacity, hopeful))
        return out

    def smallest(self, low: int, high: int, shards: int, hopeful: bool) -> int:
        """Binary search for the smallest capacity with which greedy filling gets through."""
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, hopeful)[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def doubtful(self, early: list[int], late: list[int]) -> list[tuple[int, int]]:
        """Open intervals that may hold one of the cuts, of which bounds are given; few
        spans that cover them."""
        found: set[tuple[int, int]] = set()
        for a, b in zip(early, late, strict=True):
            first = max(0, bisect_left(self.open, (a,)) - 1)
            found.update(x for x in self.open[first : bisect_left(self.open, (b,))] if x[1] > a < b)
        spans = sorted(found)
        while len(spans) > MOST_SPANS:
            gaps = [b[0] - a[1] for a, b in zip(spans, spans[1:], strict=False)]
            i = gaps.index(min(gaps))
            spans[i : i + 2] = [(spans[i][0], spans[i + 1][1])]
        return spans

    def learn(self, found: list[tuple[int, int, int]], spans: list[tuple[int, int]]) -> None:
        """``found``: of each piece of a span that has ends, where it starts, its last end
        and the number of its ends. A piece with more ends than are known stays open."""
        begins = [a for a, _ in spans]

        def covered(x: tuple[int, int]) -> bool:
            i = bisect_right(begins, x[0]) - 1
            return i >= 0 and x[1] <= spans[i][1]

        self.at = sorted({*self.at, *(last for _, last, _ in found)})
        left = [x for x in self.open if not covered(x)]
        for start, last, n in found:
            if n > bisect_right(self.at, last) - bisect_right(self.at, start):
                left.append((start, last))
        self.open = sorted(left)


def _finer(groups: DataFrame, spans: list[tuple[int, int]], width: int) -> list[tuple[int, int, int]]:
    """Start, last end and number of ends of the pieces of each span that have any."""
    start = F.lit(None).cast("bigint")
    for a, b in spans:
        own = F.lit(a) + F.floor((F.col("end") - a - 1) / width).cast("bigint") * width
        start = F.when((F.col("end") > a) & (F.col("end") <= b), own).otherwise(start)
    inside = groups.select("end", start.alias("start")).where(F.col("start").isNotNull())
    found = inside.groupBy("start").agg(F.max("end").alias("last"), F.count(F.lit(1)).alias("n"))
    return [tuple(r) for r in found.collect()]  # at most as many rows as there are pieces


def minimax_cuts(groups: DataFrame, shards: int = SHARDS, *, marks: int = MARKS) -> tuple[int, list[int]]:
    """The smallest feasible capacity and the ends of the greedily filled shards.

    ``groups`` holds ``end``, the summed size up to and including each group, and its
    ``size``; it is read once per round and should be a written table. A round looks at
    about ``marks`` pieces, at least half as wide as the last one's; pieces of one byte
    leave nothing open, so the rounds end.
    """
    row = groups.agg(F.max("end"), F.max("size")).first()
    total, largest = row[0] or 0, row[1] or 0
    if not total:
        return 0, [0] * (shards + 1)
    low, high = max(largest, -(-total // shards)), min(total, -(-total // shards) + largest)
    ends, spans, width = Ends(total), [(0, total)], 2 * total
    while spans:
        width = max(1, min(width // 2, -(-sum(b - a for a, b in spans) // marks)))
        ends.learn(_finer(groups, spans, width), spans)
        low = ends.smallest(low, high, shards, True)
        # Proven by known ends alone, or by the bound that always holds.
        high = ends.smallest(low, high, shards, False)
        spans = ends.doubtful(ends.cuts(low, shards, False), ends.cuts(high, shards, True))
    return low, ends.cuts(low, shards, False)


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, *, doc_id: str = "doc_id", text: str = "text", marks: int = MARKS
) -> DataFrame:
    """Per row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The size is the text's UTF-8 bytes plus one (null text: as empty). Rows of equal text
    (null equals empty) stay together, ordered by their smallest id, ids without a value
    first and groups without any by their digest. The ``law`` is ``bytes``: the largest
    shard is as small as contiguous cuts allow. ``slot`` numbers a shard's rows from 0
    in that order. ``grown_shard`` is null under this law. Rows that repeat an id are
    rows of their own; other columns are ignored. An empty table gives an empty result.
    """
    body = text_or_empty(col(text))
    rows = settle(
        docs.select(
            col(doc_id).alias("doc_id"),
            (F.octet_length(body) + 1).cast("bigint").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(body, 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("size"))
    placed = settle(running(groups, ["first_id", "digest"], F.col("size"), "end"), "groups")
    _, cuts = minimax_cuts(placed, shards, marks=marks)
    begin = F.col("end") - F.col("size")
    # A group belongs to the shard in which it ends; shards may be empty at the end.
    shard = sum((begin >= F.lit(c)).cast("int") for c in cuts[1:-1]) if shards > 1 else F.lit(0)
    dealt = rows.join(placed.select("digest", "first_id", shard.alias("shard")), "digest")
    ranked = running(dealt, ["first_id", "digest", "doc_id", "row"], F.lit(1), "place", F.col("shard"))
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
